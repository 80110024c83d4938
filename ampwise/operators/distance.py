"""Odometer based distances.

Semantics (per group of rows, e.g. one vehicle-day):

* B2 ``distance``: keep rows with a time and an odometer > 0, take
  consecutive odometer differences ``d`` in time order; the distance is
  ``|sum(d where |d| < jump)|``. No valid row gives null, one row gives 0.
* B3 ``offset``: ``sum(d where |d| >= jump)`` times the sign of the signed
  sum of B2 (0 when that sum is 0).
* B4 ``distance on battery``: rows flagged by the battery-driving predicate
  form runs of consecutive rows; each run's slice also takes the first flagged
  row of the next run, so the difference across a gap belongs to the run on
  its left. The result is the sum over runs of B2's ``|sum(d where |d| < jump)|``.
  A group without rows gives null, one with no or one flagged row gives 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.scalar import r6
from .scan import ordered_scan

JUMP_THRESHOLD = 10  # fixed value of the reference: a step of 10 or more is an odometer jump
ORDER = ("ts", "event_id")


def valid_odometer(odo="odo", ts="ts") -> Column:
    return F.col(ts).isNotNull() & F.coalesce(F.col(odo) > 0, F.lit(False))


def odometer_step(odo: str = "odo", prev_valid_odo: str = "_prev_valid_odo",
                  valid: Column | None = None) -> Column:
    """Difference to the previous valid reading, on valid rows only."""
    valid = valid_odometer(odo) if valid is None else valid
    return F.when(valid, F.col(odo) - F.col(prev_valid_odo))


def distance_aggs(step: Column, valid: Column, jump: float = JUMP_THRESHOLD,
                  names=("distance", "offset")) -> list[Column]:
    """Aggregate expressions of B2/B3 from a per-row step column."""
    small = F.when(F.abs(step) < jump, step)
    big = F.when(F.abs(step) >= jump, step)
    signed = F.coalesce(F.sum(small), F.lit(0)).cast("double")
    has = F.count_if(valid) > 0
    dist = F.when(has, F.abs(signed))
    off = F.when(has, F.coalesce(F.sum(big), F.lit(0)).cast("double") * F.signum(signed))
    return [r6(dist).alias(names[0]), r6(off).alias(names[1])]


def odometer_distance(df: DataFrame, keys: Sequence[str] = ("vin", "day"),
                      order: Sequence[str] = ORDER, jump: float = JUMP_THRESHOLD,
                      bucket: Column | str | None = None) -> DataFrame:
    """B2 + B3 per group: ``keys + [distance, offset, n_records]``.

    Differences are taken inside each group (a vehicle-day by default, as the
    reference processes one day file at a time). ``bucket`` optionally splits a
    group's ordered scan further (e.g. ``date_trunc('hour', ts)``) for groups
    too large for one task.
    """
    valid = valid_odometer()
    s = ordered_scan(df, keys, order, bucket,
                     lasts={"_prev_valid_odo": F.when(valid, F.col("odo"))})
    step = odometer_step(valid=valid)
    return (s.groupBy(*keys)
            .agg(*distance_aggs(step, valid, jump), F.count("*").alias("n_records")))


def battery_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ORDER,
                     flag: Column | None = None, bucket: Column | str | None = None) -> DataFrame:
    """Per-row columns for B4: ``_bflag``, ``_bstep`` (difference to the previous
    flagged row) and ``_bseg`` (run that owns the difference)."""
    flag = P.on_battery() if flag is None else flag
    s = df.withColumn("_bflag", flag)
    s = ordered_scan(s, keys, order, bucket,
                     lags={"_bprev": F.col("_bflag")},
                     lasts={"_bprev_odo": F.when(F.col("_bflag"), F.col("odo"))})
    start = F.col("_bflag") & ~F.coalesce(F.col("_bprev"), F.lit(False))
    s = s.withColumn("_bstart", start)
    s = ordered_scan(s, keys, order, bucket,
                     cums={"_bseg_no": F.col("_bstart").cast("int")})
    return (s.withColumn("_bstep", F.when(F.col("_bflag"), F.col("odo") - F.col("_bprev_odo")))
             .withColumn("_bseg", F.col("_bseg_no") - F.col("_bstart").cast("int"))
             .drop("_bprev", "_bprev_odo", "_bseg_no"))


def battery_distance(df: DataFrame, keys: Sequence[str] = ("vin", "day"),
                     order: Sequence[str] = ORDER, min_soc: float = P.MIN_SOC_ON_BATTERY,
                     jump: float = JUMP_THRESHOLD, bucket: Column | str | None = None,
                     name: str = "distance_on_battery") -> DataFrame:
    """B4 per group: ``keys + [distance_on_battery]``."""
    s = battery_segments(df, keys, order, P.on_battery(min_soc), bucket)
    small = F.when(F.abs(F.col("_bstep")) < jump, F.col("_bstep"))
    per_seg = (s.groupBy(*keys, "_bseg")
               .agg(F.abs(F.coalesce(F.sum(small), F.lit(0))).cast("double").alias("_segd")))
    # _bseg is null for rows before the first flagged row: they contribute 0,
    # but keep the group present so an unflagged group gives 0 (not missing).
    return (per_seg.groupBy(*keys)
            .agg(r6(F.coalesce(F.sum(F.when(F.col("_bseg").isNotNull(), F.col("_segd"))),
                               F.lit(0.0))).alias(name)))
