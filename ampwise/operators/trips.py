"""Record gaps, near-duplicate removal and trip segmentation.

B1 semantics: driving rows (P12) of one vehicle with a position, in time
order. A new trip starts where the whole seconds since the previous such row
exceed ``max_gap_s`` (600 by default). Trips of one row are discarded. Per
trip: start/end time and position, B2 distance over the trip's rows, duration
in hours ``int(seconds) / 3600``, the seconds and their text form (F1).

Elapsed seconds are true elapsed time truncated to whole seconds; the
reference took the seconds field of the difference, i.e. modulo one day
(deviation D2).

Nothing is windowed over a vehicle's whole history: :func:`trips` combines
per-(vehicle, day) segments (:mod:`ampwise.operators.segments`), and the
per-row labels of :func:`label_trips` come from a day-bucketed
:func:`ampwise.operators.scan.ordered_scan`; a trip that crosses midnight is
joined across the day edge in both.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.scalar import duration_text, gap_seconds, r6
from .distance import JUMP_THRESHOLD, ORDER, valid_odometer
from .scan import ordered_scan
from .segments import island_stats

FIRST_GAP_S = 10        # gap assigned to a key's first record (fixed value of the reference)
NEAR_DUP_GAP_S = 5      # records closer than this to the previous one are duplicates
TRIP_GAP_S = 600        # default trip break: 10 minutes without driving records

DAY_BUCKET = "day"  # canonical telemetry carries day = date(ts)


def with_gap(df: DataFrame, keys: Sequence[str] = ("vin",), order: Sequence[str] = ORDER,
             bucket: Column | str | None = DAY_BUCKET, first_gap: int = FIRST_GAP_S,
             name: str = "gap_s") -> DataFrame:
    """Whole seconds since the key's previous record; ``first_gap`` for the first."""
    s = ordered_scan(df, keys, order, bucket, lags={"_prev_ts": F.col("ts")})
    return (s.withColumn(name, F.coalesce(gap_seconds("_prev_ts", "ts"), F.lit(first_gap).cast("long")))
             .drop("_prev_ts"))


def drop_near_duplicates(df: DataFrame, keys: Sequence[str] = ("vin",), order: Sequence[str] = ORDER,
                         min_gap: int = NEAR_DUP_GAP_S,
                         bucket: Column | str | None = DAY_BUCKET) -> DataFrame:
    """Keep rows more than ``min_gap`` seconds after the previous record
    (gaps measured before dropping, as in the reference)."""
    return with_gap(df, keys, order, bucket).where(F.col("gap_s") > min_gap).drop("gap_s")


def label_islands(rows: DataFrame, keys: Sequence[str] = ("vin",), order: Sequence[str] = ORDER,
                  max_gap_s: int = TRIP_GAP_S, bucket: Column | str | None = DAY_BUCKET,
                  id_col: str = "trip_no", carry: Sequence[str] = ("odo",), known: str | None = None) -> DataFrame:
    """Number runs of ``rows`` (already filtered to the qualifying records):
    a run breaks where more than ``max_gap_s`` whole seconds separate a row
    from the key's previous qualifying row. ``id_col`` counts breaks since the
    key's first row. For each column ``c`` of ``carry`` the value on the
    previous row *of the same run* is added as ``_prev_c`` (null on a run's
    first row), and ``_prev_ts`` likewise. ``known`` (with a bucket column) adds,
    for one column that may be null: ``_prev_known``, time and value of the run's
    last earlier row that has one; ``_last_known``, the place (``order``) of the
    run's last such row; and the run's ends ``_first_ts`` and ``_last_ts``."""
    rows = rows.where(F.col("ts").isNotNull())  # a row without a time has no place in any order
    lags = {"_prev_ts": "ts", **{f"_prev_{c}": c for c in carry}}
    if not (isinstance(bucket, str) and bucket in rows.columns):
        s = ordered_scan(rows, keys, order, bucket, lags={n: F.col(c) for n, c in lags.items()})
        s = s.withColumn("_brk", F.coalesce(gap_seconds("_prev_ts", "ts") > max_gap_s, F.lit(False)))
        s = ordered_scan(s, keys, order, bucket, cums={id_col: F.col("_brk").cast("long")})
        for n in lags:
            s = s.withColumn(n, F.when(~F.col("_brk"), F.col(n)))
        return s.drop("_brk")

    # rows are cut into segments inside (key, bucket); the segments' first and last rows decide
    # across buckets, and each bucket gets one row with its segments' run numbers. The rows are
    # shuffled once, into (key, bucket), and joined where they are.
    w = Window.partitionBy(*keys, bucket).orderBy(*[F.col(c) for c in order])
    r = rows
    for n, c in lags.items():
        r = r.withColumn(n, F.lag(c).over(w))
    r = r.withColumn("_cut", F.col("_prev_ts").isNull() | (gap_seconds("_prev_ts", "ts") > max_gap_s))
    r = r.withColumn("_seg", F.sum(F.col("_cut").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    at = F.struct(*[F.col(c) for c in order])
    more = []
    if known:
        has = F.when(F.col(known).isNotNull(), F.struct(F.col("ts").alias("ts"), F.col(known).cast("double").alias("v")))
        r = r.withColumn("_pk", F.last(F.when(has.isNotNull(), F.struct(has.alias("k"), "_seg")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
        more = [F.max("ts").alias("_end"), F.max(F.when(has.isNotNull(), at)).alias("_known_at"), F.max_by(has, F.when(has.isNotNull(), at)).alias("_known")]
    segs = r.groupBy(*keys, bucket, "_seg").agg(
        F.min("ts").alias("_first"), F.max_by(F.struct(*[F.col(c).alias(n) for n, c in lags.items()]), at).alias("_tail"), *more)
    ws = Window.partitionBy(*keys).orderBy(bucket, "_seg")
    segs = segs.withColumn("_before", F.lag("_tail").over(ws))
    joins = F.coalesce(gap_seconds("_before._prev_ts", "_first") <= max_gap_s, F.lit(False))
    segs = segs.withColumn("_no", F.sum((~joins).cast("long")).over(ws.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - 1)
    told = []
    if known:
        run = Window.partitionBy(*keys, "_no")
        earlier = run.orderBy(bucket, "_seg").rowsBetween(Window.unboundedPreceding, -1)
        segs = segs.withColumns({"_joins": joins, "_known_before": F.last("_known", ignorenulls=True).over(earlier), "_run_first": F.min("_first").over(run),
                                 "_run_last": F.max("_end").over(run), "_run_known": F.max("_known_at").over(run)})
        joins, told = F.col("_joins"), ["_known_before", "_run_first", "_run_last", "_run_known"]
    one = F.struct(F.col("_seg"), F.col("_no"), F.when(joins, F.col("_before")).alias("_before"), *told)
    per = segs.groupBy(*keys, bucket).agg(F.array_sort(F.collect_list(one)).alias("_segs"))  # segments of one bucket
    out = r.join(per, [*keys, bucket]).withColumn("_own", F.element_at("_segs", F.col("_seg").cast("int")))
    for n in lags:
        out = out.withColumn(n, F.when(F.col("_cut"), F.col(f"_own._before.{n}")).otherwise(F.col(n)))
    if known:
        here = F.when(F.col("_pk._seg") == F.col("_seg"), F.col("_pk.k"))
        out = out.withColumns({"_prev_known": F.coalesce(here, F.col("_own._known_before")), "_last_known": F.col("_own._run_known"),
                               "_first_ts": F.col("_own._run_first"), "_last_ts": F.col("_own._run_last")}).drop("_pk")
    return out.withColumn(id_col, F.col("_own._no")).drop("_cut", "_seg", "_segs", "_own")


def label_trips(df: DataFrame, keys: Sequence[str] = ("vin",), order: Sequence[str] = ORDER,
                max_gap_s: int = TRIP_GAP_S, bucket: Column | str | None = DAY_BUCKET,
                driving_only: bool = True) -> DataFrame:
    """Trip number per driving row with a position (``trip_no`` counts
    breaks since the key's first row), plus ``_step`` (odometer difference to
    the previous row of the same trip)."""
    rows = df.where(P.driving()) if driving_only else df
    rows = rows.where(P.valid_coordinates())
    s = label_islands(rows, keys, order, max_gap_s, bucket, "trip_no", ("odo",))
    step = F.when(F.col("_prev_odo").isNotNull() & valid_odometer(),
                  F.col("odo") - F.col("_prev_odo"))
    return s.withColumn("_step", step).drop("_prev_ts", "_prev_odo")


def trips(df: DataFrame, keys: Sequence[str] = ("vin",), order: Sequence[str] = ORDER,
          max_gap_s: int = TRIP_GAP_S, jump: float = JUMP_THRESHOLD,
          bucket: str = DAY_BUCKET) -> DataFrame:
    """B1: one row per trip of two or more records (segment combination, see
    :mod:`ampwise.operators.segments`: one shuffle of raw rows into
    (vehicle, day), the rest on per-segment rows)."""
    rows = df.where(P.driving() & P.valid_coordinates())

    def valid(cur):
        return cur("ts").isNotNull() & F.coalesce(cur("odo") > 0, F.lit(False))

    def step(prev, cur):
        return F.when(prev("odo").isNotNull() & valid(cur), cur("odo") - prev("odo"))

    st = island_stats(
        rows, keys, order, bucket, max_gap_s, carry=("lat", "lon", "odo"),
        row_aggs={"_nvalid": ("sum", lambda c: valid(c).cast("long"))},
        pair_aggs={"_small": ("sum", lambda p, c: F.when(F.abs(step(p, c)) < jump, step(p, c)))},
        id_col="trip_no").where(F.col("_n") > 1)
    signed = F.coalesce(F.col("_small"), F.lit(0)).cast("double")
    secs = gap_seconds("start_time", "end_time")
    out = st.select(*keys, "trip_no", F.col("_n").alias("n_records"),
                    F.col("_head.ts").alias("start_time"), F.col("_tail.ts").alias("end_time"),
                    F.col("_head.lat").alias("start_lat"), F.col("_head.lon").alias("start_lon"),
                    F.col("_tail.lat").alias("end_lat"), F.col("_tail.lon").alias("end_lon"),
                    r6(F.when(F.col("_nvalid") > 0, F.abs(signed))).alias("distance"))
    return (out.withColumn("dura_sec", secs)
               .withColumn("duration", r6(secs / 3600.0))
               .withColumn("duration_text", duration_text(secs))
               .withColumn("day", F.to_date("start_time")))
