"""Column profiles and distributions (SURVEY A5, A10, A14-A18, A22, A24, P25,
W8, T3, U1, U2). Plots of the reference are re-aimed as the tables behind
them (histogram bins, 2-D bin counts, correlation)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import r6
from ..session import reliable_checkpoint
from .scan import last_n_per_key


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A5."""
    return df.select(*cols).distinct()


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A10: counts per value, most frequent first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(col))


def exact_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation between the values ranked
    ``floor(q (n-1))`` and ``ceil(q (n-1))`` (0-based): one row per column,
    ``column`` and ``q0``, ``q1``, ... (null without values).

    Values are counted first, combined map-side, so a value that most rows
    share is one row afterwards. The distinct values of all columns are
    range-partitioned together and their counts summed along the order: inside
    each range, plus what earlier ranges hold (a table with a row per range
    and column). A quantile's neighbours are the first values whose summed
    count reaches their ranks."""
    each = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in cols])).alias("e")).select("e.*")
    counts = each.where(F.col("x").isNotNull() & ~F.isnan("x")).groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = reliable_checkpoint(counts.repartitionByRange(parts, "column", "x").withColumn("_pid", F.spark_partition_id()), eager=False)
    totals = ranged.groupBy("column", "_pid").agg(F.sum("n").alias("t"))
    w = Window.partitionBy("column").orderBy("_pid")
    offs = totals.select("column", "_pid", F.coalesce(F.sum("t").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
                         F.sum("t").over(Window.partitionBy("column")).alias("all"))
    inside = F.sum("n").over(Window.partitionBy("column", "_pid").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = ranged.withColumn("upto", inside).join(F.broadcast(offs), ["column", "_pid"]).withColumn("upto", F.col("upto") + F.col("before"))
    at = [(F.lit(q) * (F.col("all") - 1)) for q in qs]
    picked = summed.groupBy("column", "all").agg(
        *[F.min(F.when(F.col("upto") >= F.floor(p) + 1, F.col("x"))).alias(f"lo{i}") for i, p in enumerate(at)],
        *[F.min(F.when(F.col("upto") >= F.least(F.floor(p) + 2, F.col("all")), F.col("x"))).alias(f"hi{i}") for i, p in enumerate(at)])
    return picked.select("column", *[(F.col(f"lo{i}") + (F.col(f"hi{i}") - F.col(f"lo{i}")) * (p - F.floor(p))).alias(f"q{i}") for i, p in enumerate(at)])


def _stacked(row: DataFrame, cols: Sequence[str], stats: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per column from a row with ``<column>\x00<stat>`` fields."""
    return row.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{c}\x00{s}`").alias(s) for s in stats]) for c in cols])).alias("e")).select(*keys, "e.*")


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles (linear
    interpolation, :func:`exact_quantiles`) and max per column, one row per
    column; one aggregate and one count of values for all columns."""
    fns = {"count": F.count, "mean": lambda x: r6(F.avg(x)), "std": lambda x: r6(F.stddev_samp(x)), "min": lambda x: r6(F.min(x)), "max": lambda x: r6(F.max(x))}
    stats = _stacked(df.agg(*[f(F.col(c)).alias(f"{c}\x00{s}") for c in cols for s, f in fns.items()]), cols, list(fns))
    q = exact_quantiles(df, cols, (0.25, 0.5, 0.75))
    return stats.join(F.broadcast(q), "column", "left").select(
        "column", "count", "mean", "std", "min", r6("q0").alias("q25"), r6("q1").alias("q50"), r6("q2").alias("q75"), "max")


def profile(df: DataFrame, plan: dict[str, Sequence[str]], keys: Sequence[str] = ()) -> DataFrame:
    """Stats by declared type in long form ``keys + (column, stat,
    category, value)``: numeric columns get avg/max/min, categorical ones a
    histogram (count per value, ``stat = 'count'``). One aggregate for all
    numeric columns, one count of (column, value) for all others."""
    fns = {"avg": F.avg, "max": F.max, "min": F.min}
    numeric = {c: [s for s in stats if s in fns] for c, stats in plan.items() if "histogram" not in stats}
    listed = [c for c, stats in plan.items() if "histogram" in stats]
    parts = []
    if numeric:
        wide = df.groupBy(*keys).agg(*[r6(fns[s](F.col(c).cast("double"))).alias(f"{c}\x00{s}") for c, stats in numeric.items() for s in stats])
        parts.append(wide.select(*keys, F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.lit(s).alias("stat"), F.lit(None).cast("string").alias("category"), F.col(f"`{c}\x00{s}`").alias("value"))
            for c, stats in numeric.items() for s in stats])).alias("e")).select(*keys, "e.*"))
    if listed:
        each = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in listed])).alias("e")).select(*keys, "e.*")
        parts.append(each.groupBy(*keys, "column", "category").agg(F.count(F.lit(1)).cast("double").alias("value"))
                     .select(*keys, "column", F.lit("count").alias("stat"), "category", "value"))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def histogram(df: DataFrame, col: str, lo: float, width: float, keys: Sequence[str] = ()) -> DataFrame:
    """Fixed-width bins ``floor((x - lo) / width)`` with their counts."""
    b = F.floor((F.col(col) - lo) / width)
    return (df.where(F.col(col).isNotNull())
            .groupBy(*keys, b.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("bin_lo", F.col("bin") * width + lo))


def pair_relation(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation, sample covariance and the regression line of
    ``y`` on ``x``."""
    return df.groupBy(*keys).agg(
        F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"),
        r6(F.corr(x, y)).alias("corr"), r6(F.covar_samp(x, y)).alias("covar"),
        r6(F.regr_slope(y, x)).alias("slope"), r6(F.regr_intercept(y, x)).alias("intercept"))


def joint_bins(df: DataFrame, x: str, y: str, wx: float, wy: float) -> DataFrame:
    """2-D bin counts (the table behind a joint plot)."""
    return (df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            .groupBy(F.floor(F.col(x) / wx).alias("bx"), F.floor(F.col(y) / wy).alias("by"))
            .agg(F.count(F.lit(1)).alias("n")))


def late_records(df: DataFrame, file_day: str = "file_day", day: str = "day") -> DataFrame:
    """Records in a day's file dated before (or otherwise not on)
    the file's day, counted by (file day, record day)."""
    return (df.where(F.col(day) != F.col(file_day))
            .groupBy(file_day, day).agg(F.count(F.lit(1)).alias("n_records"),
                                       F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
            .withColumn("days_late", F.datediff(F.col(file_day), F.col(day))))


def time_bounds(*dfs: DataFrame, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Earliest start and latest end across several tables (U1 union)."""
    u = dfs[0].select(start, end)
    for d in dfs[1:]:
        u = u.unionByName(d.select(start, end))
    return u.agg(F.min(start).alias("first_start"), F.max(end).alias("last_end"))


def positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "position") -> DataFrame:
    """0-based position after sorting within each key (used on period
    tables, one row per period)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w) - 1)


def last_records(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[str]) -> DataFrame:
    """The last ``n`` records per key in order (skew-safe, see
    :func:`ampwise.operators.scan.last_n_per_key`)."""
    return last_n_per_key(df, keys, n, order, "day")


def union_keys(*dfs: DataFrame, key: str = "vin") -> DataFrame:
    """Distinct keys of several tables."""
    u = dfs[0].select(key)
    for d in dfs[1:]:
        u = u.union(d.select(key))
    return u.distinct()
