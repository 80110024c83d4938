"""Mergeable daily profiles and rolling windows over them.

A rolling month over raw records reads each record thirty times, or all of them every
day. Here a day is summarised once, per signal: count, sum, least and largest value,
the counts of fixed bins (A17), a quantile sketch (KLL), and per day a sketch of the
distinct vehicles (HLL). All of these can be merged, so a window is made of as many
rows as it has days. Counts, bounds and bins are exact. A quantile's rank is off by
at most about 1.7 % with 99 % confidence at the default size of 200, merged or not; the
number of vehicles is exact up to some thousands and within about 0.6 % beyond (HLL with
2 ** 15 registers).

Records without a day take no part; missing values and NaN of a signal aren't counted;
a day of the table without records has no row, and windows end on days that have one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import r6

#: Size of a quantile sketch, log2 of the registers of a distinct sketch, days of a window.
KLL_SIZE, HLL_BITS, WINDOW_DAYS = 200, 15, 30


def daily(df: DataFrame, signals: Mapping[str, tuple[float, float]], keys: Sequence[str] = (), vehicle: str = "vin",
          day: str = "day") -> DataFrame:
    """(keys, day, vehicles, one struct a signal): the table to store. ``signals`` gives each
    signal's histogram origin and bin width. One aggregate, combined map-side; bins are counted
    before (one row per distinct bin), so that no list grows with the records."""
    rows = df.where(F.col(day).isNotNull())
    fine = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    stats = rows.groupBy(*keys, day).agg(
        F.hll_sketch_agg(F.col(vehicle).cast("string"), HLL_BITS).alias("vehicles"),
        *[F.struct(F.count(fine(c)).alias("n"), F.sum(fine(c)).alias("total"), F.min(fine(c)).alias("low"), F.max(fine(c)).alias("high"),
                   F.kll_sketch_agg_double(fine(c), F.lit(KLL_SIZE)).alias("kll")).alias(c) for c in signals])
    each = rows.select(*keys, day, F.explode(F.array(*[
        F.struct(F.lit(c).alias("signal"), F.floor((fine(c) - lo) / width).cast("bigint").alias("bin")) for c, (lo, width) in signals.items()])).alias("b"))
    bins = each.where("b.bin IS NOT NULL").groupBy(*keys, day, "b.signal", "b.bin").agg(F.count(F.lit(1)).alias("n")) \
        .groupBy(*keys, day).agg(F.collect_list(F.struct("signal", "bin", "n")).alias("bins"))
    # days are few: both sides have one row for each
    return stats.join(bins, [*keys, day], "left").withColumnRenamed(day, "day")


def _windows(sketches: DataFrame, keys: Sequence[str], days: int) -> DataFrame:
    """Each day's row once for every window that it belongs to (``end``: the window's last day)."""
    spread = sketches.withColumn("end", F.explode(F.sequence("day", F.date_add("day", days - 1), F.expr("INTERVAL 1 DAY"))))
    ends = sketches.select(*keys, F.col("day").alias("end"))
    return spread.join(ends, [*keys, "end"], "left_semi")


def rolling(sketches: DataFrame, signals: Sequence[str], keys: Sequence[str] = (), days: int = WINDOW_DAYS,
            quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(keys, day, signal, n, mean, low, high, q..., vehicles) of the ``days`` days up to each day."""
    g = _windows(sketches, keys, days).groupBy(*keys, "end").agg(
        F.hll_sketch_estimate(F.hll_union_agg("vehicles")).alias("vehicles"),
        *[F.struct(F.sum(f"{c}.n").alias("n"), F.sum(f"{c}.total").alias("total"), F.min(f"{c}.low").alias("low"), F.max(f"{c}.high").alias("high"),
                   F.kll_merge_agg_double(F.when(F.col(f"{c}.n") > 0, F.col(f"{c}.kll"))).alias("kll")).alias(c) for c in signals])
    one = F.explode(F.array(*[F.struct(F.lit(c).alias("signal"), F.col(c).alias("s")) for c in signals])).alias("e")
    g = g.select(*keys, F.col("end").alias("day"), "vehicles", one)
    q = [F.when(F.col("e.s.n") > 0, F.kll_sketch_get_quantile_double(F.col("e.s.kll"), F.lit(float(p)))).alias(f"q{round(100 * p)}") for p in quantiles]
    return g.select(*keys, "day", "e.signal", F.col("e.s.n").alias("n"), r6(F.col("e.s.total") / F.nullif(F.col("e.s.n"), F.lit(0))).alias("mean"),
                    r6("e.s.low").alias("low"), r6("e.s.high").alias("high"), *q, F.col("vehicles"))


def rolling_histogram(sketches: DataFrame, keys: Sequence[str] = (), days: int = WINDOW_DAYS) -> DataFrame:
    """(keys, day, signal, bin, n): exact histograms of the ``days`` days up to each day."""
    w = _windows(sketches.select(*keys, "day", "bins"), keys, days)
    return w.select(*keys, F.col("end").alias("day"), F.explode("bins").alias("b")).groupBy(*keys, "day", "b.signal", "b.bin").agg(F.sum("b.n").alias("n"))
