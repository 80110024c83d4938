"""Raw day-file scans and typed projection.

``spark.read.text`` reads one record per line; the file path comes from the
``_metadata`` column, the day from a hive-style ``d=yyyymmdd`` directory or a
``..._yyyymmdd.csv`` file name. A field-count guard keeps well-formed lines
and counts the rejected ones. The positional projection only splits once per
line and keeps the mapped fields, so unused fields never leave the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import LOCAL_TZ, array_mean, epoch_ms_to_local, list_to_array, yyyymmdd_to_date
from . import schemas as SC

NULL_TOKENS = ("", "NA", "NULL", "NaN", "nan", "null")


def read_day_files(spark: SparkSession, paths: str | Sequence[str], base_path: str | None = None) -> DataFrame:
    """Text lines of one or many day files (directories of
    part files are read whole) with ``file_path`` and ``file_day``: the
    ``d=yyyymmdd`` directory when present, else the last 8-digit run of the
    file name."""
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    df = reader.text(list(paths) if not isinstance(paths, str) else paths)
    fp = F.col("_metadata.file_path")
    d = F.coalesce(F.nullif(F.regexp_extract(fp, r"d=(\d{8})", 1), F.lit("")),
                   F.nullif(F.regexp_extract(F.col("_metadata.file_name"), r"(\d{8})\D*$", 1), F.lit("")))
    out = df.select("value", fp.alias("file_path"), F.to_date(d, "yyyyMMdd").alias("file_day"))
    if "d" in df.columns:  # partition discovery already typed the directory value
        out = out.drop("d")
    return out


def field_count(value: str = "value", sep: str = ",") -> Column:
    return F.size(F.split(F.col(value), sep, -1))


def guard(lines: DataFrame, lengths: Iterable[int] = SC.SCHEMA_A_LENGTHS) -> tuple[DataFrame, DataFrame]:
    """Lines whose field count is one of ``lengths``, and a per-file
    count of rejected lines by field count (rejected rows are counted, not
    silently lost)."""
    n = field_count()
    ok = lines.where(n.isin(*lengths))
    rejected = (lines.where(~n.isin(*lengths))
                .groupBy(*[c for c in ("file_path", "file_day") if c in lines.columns], n.alias("n_fields"))
                .agg(F.count(F.lit(1)).alias("n_lines")))
    return ok, rejected


def clean_value(c: Column, typ: str) -> Column:
    """Null tokens to null, numbers by ``try_cast`` (bad value -> null,
    NaN -> null) so the result is ANSI-safe."""
    s = F.when(~F.trim(c).isin(*NULL_TOKENS), F.trim(c))
    if typ == "string":
        return s
    if typ == "long":
        return s.try_cast("double").try_cast("long")
    v = s.try_cast("double")
    return F.when(~F.isnan(v), v)


def project(lines: DataFrame, fields: dict[int, str], canonical: dict[str, tuple[str, str]],
            keep: Sequence[str] = ("file_day",), tz: str = LOCAL_TZ) -> DataFrame:
    """S3: positional projection of ``fields`` to typed canonical columns, plus
    ``ts`` (local wall clock, P7), ``day``, ``event_id`` (a hash of the line,
    used only as a deterministic tie-breaker)."""
    parts = F.split(F.col("value"), ",", -1)
    cols = []
    for idx, sig in fields.items():
        name, typ = canonical[sig]
        raw = parts.getItem(idx)
        if typ == "list":
            cols.append(list_to_array(F.when(~F.trim(raw).isin(*NULL_TOKENS), raw)).alias(name))
        else:
            cols.append(clean_value(raw, typ).alias(name))
    df = lines.select(*[c for c in keep if c in lines.columns], F.xxhash64("value").alias("event_id"), *cols)
    ts = epoch_ms_to_local("ts_ms", tz)
    return df.withColumn("ts", ts).withColumn("day", F.to_date("ts"))


def parse_schema_a(lines: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Schema A records (85 or 86 fields) in canonical form; ``sdate`` (the
    file's ``yyyymmdd`` date field) becomes a date (P8)."""
    ok, _ = guard(lines, SC.SCHEMA_A_LENGTHS)
    df = project(ok, SC.SCHEMA_A_FIELDS, SC.CANONICAL_A, tz=tz)
    return df.withColumn("sdate", yyyymmdd_to_date("sdate"))


def parse_schema_b(lines: DataFrame, tz: str = LOCAL_TZ) -> DataFrame:
    """Schema B records (79 fields): list fields become ``array<double>``
    (F3) and ``temp_avg`` is the mean of the temperature list (A14)."""
    ok, _ = guard(lines, SC.SCHEMA_B_LENGTHS)
    df = project(ok, SC.SCHEMA_B_FIELDS, SC.CANONICAL_B, tz=tz)
    return df.withColumn("temp_avg", array_mean("temp_list"))


# Fixed value of the national-standard protocol: charging state while parked.
CHARGING_PARKED = 1


def stat_columns_b(records: DataFrame) -> DataFrame:
    """Schema B records with the columns that the statistics use. The layout
    has no charger signals: while the charging state says "charging parked",
    the charge current is the size of the battery current and the charge
    voltage the battery voltage; the state itself becomes 1, or 0 for any
    other state."""
    on = F.col("charge_st") == CHARGING_PARKED
    return (records.withColumn("charge_cur", F.when(on, F.abs("curr")).otherwise(F.lit(0.0)))
            .withColumn("charge_volt", F.col("volt"))
            .withColumn("charge_st", F.when(F.col("charge_st").isNotNull(), on.cast("double"))))


def duplicates_dropped(records: DataFrame, keys: Sequence[str] = ("vin", "day")) -> DataFrame:
    """Records without those equal to the one before in (time, line hash) order
    of their vehicle-day: a line that was delivered twice counts once."""
    w = Window.partitionBy(*keys).orderBy("ts", "event_id")
    this = F.struct("ts", "event_id")
    return (records.withColumn("_again", F.coalesce(F.lag(this).over(w) == this, F.lit(False)))
            .where(~F.col("_again")).drop("_again"))


def read_header_csv(spark: SparkSession, path: str, config_rows, header: bool = False) -> DataFrame:
    """CSV whose column names and types come from a header config."""
    schema = SC.struct_from_header_config(config_rows)
    return spark.read.option("header", header).schema(schema).csv(path)


def read_csv_with_header(spark: SparkSession, path: str, schema=None, all_string: bool = False) -> DataFrame:
    """CSV with a header line; an explicit schema, or every column as text."""
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    elif not all_string:
        raise ValueError("give a schema or all_string=True; schemas are never inferred")
    return r.csv(path)


def day_paths(base: str, days: Iterable[str], hive_style_from: str = "2018") -> list[str]:
    """Path of each ``yyyymmdd`` day: hive-style ``csv/d=<day>`` from
    ``hive_style_from`` on, a single ``by-day/<day>.csv`` file before."""
    out = []
    for d in days:
        out.append(f"{base}/csv/d={d}" if str(d)[:4] >= hive_style_from else f"{base}/by-day/{d}.csv")
    return out
