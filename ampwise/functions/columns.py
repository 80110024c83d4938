"""Whole-frame column helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_TOKENS = ("NA", "NULL", "NaN", "nan", "")

# Fixed values of the reference: ordered substring rules of the ranking table's column names.
RANKING_RENAME_RULES = (
    ("min_min", "min"), ("max_max", "max"), ("avg_mean", "mean"), ("wmean", "mean"),
    ("mean_mean", "mean"), ("trips", "driving"), ("ah_throughput", "ah_charged"),
)


def rename_by_rules(df: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Apply substring replacements to every column name, in order."""
    out = []
    for c in df.columns:
        n = c
        for old, new in rules:
            n = n.replace(old, new)
        out.append(F.col(f"`{c}`").alias(n))
    return df.select(*out)


def strip_utc_offset(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop a trailing ``+hh:mm`` / ``-hh:mm`` offset from text timestamps."""
    for c in cols:
        df = df.withColumn(c, F.regexp_replace(F.col(c), r"[+-]\d{2}:\d{2}$", ""))
    return df


def split_date_time(df: DataFrame, col: str, date_col: str | None = None, time_col: str | None = None) -> DataFrame:
    """Date and time-of-day parts of a timestamp."""
    return (df.withColumn(date_col or f"{col}_date", F.to_date(F.col(col)))
              .withColumn(time_col or f"{col}_time", F.date_format(F.col(col), "HH:mm:ss")))


def nulls_for_missing(df: DataFrame) -> DataFrame:
    """P5: per type, NaN -> null for floating columns and the null tokens
    (NA, NULL, NaN, empty) -> null for text columns. Comparing numbers to
    text tokens, as the reference did, fails under ANSI mode."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c)
        elif isinstance(f.dataType, T.StringType):
            c = F.when(~F.trim(c).isin(*NULL_TOKENS), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def in_date_range(df: DataFrame, start: str, end: str, col: str = "day") -> DataFrame:
    """Inclusive date-range filter (pushed down to partitioned scans)."""
    return df.where(F.col(col).between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def for_vehicles(df: DataFrame, vins: Sequence, col: str = "vin") -> DataFrame:
    """P10: rows of the given vehicles."""
    return df.where(F.col(col).isin(*vins))


def integral(df: DataFrame, col: str) -> DataFrame:
    """Rows with a value, cast to an integer."""
    return df.where(F.col(col).isNotNull()).withColumn(col, F.col(col).cast("long"))
