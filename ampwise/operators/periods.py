"""Charging, driving and polarization periods and their statistics
(SURVEY 2.10 B9-B20, B23; W9, W12-W14; P17, P24).

The reference's period finder is absent (only its call sites and output
columns exist), so the period definition is *ours*: a period is a run of
qualifying rows of one vehicle (charging: P13; driving on battery: P14;
polarization: charging rows with the max cell voltage in a window) where
consecutive qualifying rows are at most ``max_gap_s`` apart. Periods of one
row are dropped.

Sign convention (ours): positive battery current charges the battery.
Per period (B9): start/end time and SOC, ``delta_soc = end - start``,
duration in hours, ``count_records``; B10 sums ``ah_charged = sum(max(I,0))``,
``ah_discharged = sum(max(-I,0))``, ``ah_throughput = sum(|I|)``,
``ah_consumption = sum(I)`` (each x 10/3600) and the kWh forms with V*I/1000;
``normalized_*`` = value / |delta_soc| x 100 (F15); temperatures and the mean
cell-voltage difference; B2 distance.

Time correction (W9): a step longer than ``compaction_s`` counts as 10 s.
B11 integrates |I| and I by the trapezoid rule over corrected steps (the
reference uses cubic interpolation and quadrature, deviation D10: for a
piecewise-linear current both agree exactly; otherwise the difference is the
interpolation error, bounded by the current's curvature times step^3).
B12 scales a sum by real/observed duration; B13 by total SOC change over the
SOC change seen in steps of at most 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.scalar import SAMPLE_SECONDS, avg6, bucket_upper, gap_seconds, per_full_soc, r6
from .distance import JUMP_THRESHOLD, ORDER
from .segments import breaks, cut, head, here, island_stats, islands_by_kind, joined, lagged, tail_before
from .trips import DAY_BUCKET, label_islands

PERIOD_GAP_S = 600
COMPACTION_S = 120            # driving; 60 in polarization work
POLAR_COMPACTION_S = 60
POLAR_VOLT_WINDOW = (3.8, 4.1)
POLAR_DROP_TOLERANCE = 1.0
CURRENT_JUMP = 5.0            # W14 split threshold
KIND = {"charging": 1, "charging_full_soc": 2, "driving": 3, "driving_full_soc": 4, "polarization": 5}

def period_flag(kind: str) -> Column:
    if kind.startswith("charging"):
        return P.charging()
    if kind.startswith("driving"):
        return P.on_battery()
    if kind == "polarization":
        lo, hi = POLAR_VOLT_WINDOW
        v = F.col("cell_volt_max")
        return P.charging() & F.coalesce((v >= lo) & (v <= hi), F.lit(False))
    raise ValueError(kind)


def label_periods(df: DataFrame, kind: str = "charging", keys: Sequence[str] = ("vin",),
                  order: Sequence[str] = ORDER, max_gap_s: int = PERIOD_GAP_S,
                  bucket: str = DAY_BUCKET, known: str | None = None) -> DataFrame:
    """Rows of the periods of ``kind`` with ``period_no`` and in-period
    previous values ``_prev_ts/_prev_odo/_prev_soc/_prev_curr/_prev_cell_volt_max``; with ``known``
    also the columns of :func:`ampwise.operators.trips.label_islands` about that column."""
    rows = df.where(period_flag(kind))
    return label_islands(rows, keys, order, max_gap_s, bucket, "period_no",
                         ("odo", "soc", "curr", "cell_volt_max") if known is None else (), known)


def _dtc(compaction_s: float | Column):
    def fn(prev, cur):
        dt = gap_seconds(prev("ts"), cur("ts"))
        return F.when(dt > compaction_s, F.lit(SAMPLE_SECONDS).cast("long")).otherwise(dt)
    return fn


def _polar_split(p, c) -> Column:
    return (p("cell_volt_max") - c("cell_volt_max")) > POLAR_DROP_TOLERANCE


#: Columns that the aggregates of a period need from the row before.
_CARRY = ("soc", "odo", "curr", "cell_volt_max")


def _period_aggs(compaction_s: float | Column, jump: float) -> tuple[dict, dict]:
    """What is added up over a period's rows, and over pairs of neighbouring rows."""
    dtc = _dtc(compaction_s)
    pos = lambda x: F.greatest(x, F.lit(0.0))

    def valid(c):
        return c("ts").isNotNull() & F.coalesce(c("odo") > 0, F.lit(False))

    def step(p, c):
        return F.when(p("odo").isNotNull() & valid(c), c("odo") - p("odo"))

    def soc_step(p, c):
        return F.abs(c("soc") - p("soc"))

    row_aggs = {
        "_ich": ("sum", lambda c: pos(c("curr"))), "_idis": ("sum", lambda c: pos(-c("curr"))),
        "_ithr": ("sum", lambda c: F.abs(c("curr"))), "_icons": ("sum", lambda c: c("curr")),
        "_pch": ("sum", lambda c: pos(c("curr")) * c("volt")), "_pdis": ("sum", lambda c: pos(-c("curr")) * c("volt")),
        "_pthr": ("sum", lambda c: F.abs(c("curr")) * c("volt")), "_pcons": ("sum", lambda c: c("curr") * c("volt")),
        "battery_temp_min": ("min", lambda c: c("temp_min")), "battery_temp_max": ("max", lambda c: c("temp_max")),
        "_tsum": ("sum", lambda c: c("temp_avg")), "_tn": ("sum", lambda c: c("temp_avg").isNotNull().cast("long")),
        "_csum": ("sum", lambda c: c("cell_volt_max") - c("cell_volt_min")),
        "_cn": ("sum", lambda c: (c("cell_volt_max") - c("cell_volt_min")).isNotNull().cast("long")),
        "_nvalid": ("sum", lambda c: valid(c).cast("long")),
    }
    pair_aggs = {
        "_trap_thr": ("sum", lambda p, c: (F.abs(c("curr")) + F.abs(p("curr"))) / 2 * dtc(p, c)),
        "_trap_cons": ("sum", lambda p, c: (c("curr") + p("curr")) / 2 * dtc(p, c)),
        "_steps_s": ("sum", dtc),
        "_soc_seen": ("sum", lambda p, c: F.when(soc_step(p, c) <= 1, soc_step(p, c))),
        "_small": ("sum", lambda p, c: F.when(F.abs(step(p, c)) < jump, step(p, c))),
    }
    return row_aggs, pair_aggs


def periods(df: DataFrame, kind: str = "charging", keys: Sequence[str] = ("vin",),
            max_gap_s: int = PERIOD_GAP_S, compaction_s: float | None = None,
            bucket: str = DAY_BUCKET, jump: float = JUMP_THRESHOLD, min_records: int = 2,
            order: Sequence[str] = ORDER, **soc_window) -> DataFrame:
    """Period table of ``kind`` with B9-B13 statistics,
    computed by segment combination (one shuffle of raw rows into
    (vehicle, day), see :mod:`ampwise.operators.segments`)."""
    base = kind.replace("_full_soc", "")
    comp = compaction_s if compaction_s is not None else (
        POLAR_COMPACTION_S if kind == "polarization" else COMPACTION_S)
    row_aggs, pair_aggs = _period_aggs(comp, jump)
    st = island_stats(df.where(period_flag(base)), keys, order, bucket, max_gap_s, carry=_CARRY, row_aggs=row_aggs,
                      pair_aggs=pair_aggs, split=_polar_split if kind == "polarization" else None, id_col="period_no")
    st = st.where(F.col("_n") >= min_records)
    out = _period_columns(st, keys).withColumn("kind", F.lit(KIND[base]))
    if kind.endswith("full_soc"):
        out = full_soc(out, charging=base == "charging", **soc_window)
    return out


def periods_of(df: DataFrame, kinds: Sequence[str] = ("charging", "driving"), keys: Sequence[str] = ("vin",),
               max_gap_s: int = PERIOD_GAP_S, bucket: str = DAY_BUCKET, jump: float = JUMP_THRESHOLD,
               min_records: int = 2, order: Sequence[str] = ORDER) -> DataFrame:
    """The period tables of several kinds (charging, driving, polarization) as one, told apart by
    ``kind``: the raw rows are read and shuffled once
    (:func:`ampwise.operators.segments.islands_by_kind`), also where a row belongs to several kinds.
    Rows equal those of :func:`periods` of each kind."""
    comp = F.when(F.col("kind") == KIND["polarization"], F.lit(POLAR_COMPACTION_S)).otherwise(F.lit(COMPACTION_S))
    row_aggs, pair_aggs = _period_aggs(comp, jump)
    st = islands_by_kind(df, {KIND[k]: period_flag(k) for k in kinds}, keys, order, bucket, max_gap_s, carry=_CARRY, row_aggs=row_aggs,
                         pair_aggs=pair_aggs, splits={KIND[k]: _polar_split for k in kinds if k == "polarization"}, id_col="period_no")
    return _period_columns(st.where(F.col("_n") >= min_records), [*keys, "kind"])


def full_soc(per: DataFrame, charging: bool = True, **window) -> DataFrame:
    """Kinds 2 and 4 from an already computed period table of kind 1 or 3
    (so both tables share one computation)."""
    k = KIND["charging_full_soc" if charging else "driving_full_soc"]
    return per.where(full_soc_filter(charging=charging, **window)).withColumn("kind", F.lit(k))


def _period_columns(g: DataFrame, keys: Sequence[str]) -> DataFrame:
    """B9-B13 output columns from the combined island aggregates."""
    g = g.select("*", F.col("_n").alias("count_records"),
                 F.col("_head.ts").alias("start_time"), F.col("_tail.ts").alias("end_time"),
                 F.col("_head.soc").alias("start_soc"), F.col("_tail.soc").alias("end_soc"))
    secs = gap_seconds("start_time", "end_time")
    ds = F.col("end_soc") - F.col("start_soc")
    ads = F.abs(ds)
    norm = lambda x: per_full_soc(x, ads)
    real_s = F.col("_steps_s") + SAMPLE_SECONDS   # corrected span plus the first sample
    # same operation order as the SQL form, so both round identically
    ah = lambda c: F.col(c) * SAMPLE_SECONDS / 3600.0
    kwh = lambda c: F.col(c) * SAMPLE_SECONDS / 3600.0 / 1000
    dist = r6(F.when(F.col("_nvalid") > 0, F.abs(F.coalesce(F.col("_small"), F.lit(0)).cast("double"))))
    g = g.withColumn("distance_driven", dist)
    return g.select(
        *keys, "period_no", "count_records", "start_time", "end_time",
        F.to_date("end_time").alias("day"),
        r6("start_soc").alias("start_soc"), r6("end_soc").alias("end_soc"), r6(ds).alias("delta_soc"),
        r6(secs / 3600.0).alias("duration"),
        r6(ah("_ich")).alias("ah_charged"), r6(ah("_idis")).alias("ah_discharged"),
        r6(ah("_ithr")).alias("ah_throughput"), r6(ah("_icons")).alias("ah_consumption"),
        r6(kwh("_pch")).alias("kwh_charged"), r6(kwh("_pdis")).alias("kwh_discharged"),
        r6(kwh("_pthr")).alias("kwh_throughput"), r6(kwh("_pcons")).alias("kwh_consumption"),
        r6(norm(ah("_ithr"))).alias("normalized_ah_throughput"),
        r6(norm(ah("_icons"))).alias("normalized_ah_consumption"),
        r6(norm(kwh("_pthr"))).alias("normalized_kwh_throughput"),
        r6(norm(F.col("distance_driven"))).alias("normalized_distance_driven"),
        r6(F.coalesce(F.col("_trap_thr"), F.lit(0.0)) / 3600).alias("ah_throughput_trapz"),
        r6(F.coalesce(F.col("_trap_cons"), F.lit(0.0)) / 3600).alias("ah_consumption_trapz"),
        r6(real_s).alias("real_duration_s"),
        r6(ah("_ithr") * real_s / (F.col("count_records") * SAMPLE_SECONDS)).alias("ah_throughput_time_comp"),
        r6(F.when(F.col("_soc_seen") > 0, ah("_ithr") * ads / F.col("_soc_seen"))).alias("ah_throughput_soc_comp"),
        r6(F.when(secs > 0, (secs - F.col("count_records") * SAMPLE_SECONDS) / secs * 100)).alias("missing_time_pct"),
        r6("battery_temp_min").alias("battery_temp_min"), r6("battery_temp_max").alias("battery_temp_max"),
        r6(F.col("_tsum") / F.col("_tn")).alias("battery_temp_avg"),
        r6(F.col("_csum") / F.col("_cn")).alias("cell_volt_diff_mean"),
        F.col("distance_driven"),
    )


def full_soc_filter(charging: bool = True, delta_min: float = 50, delta_max: float = 100,
                    low=(0.0, 100.0), high=(0.0, 100.0)) -> Column:
    """Full-SOC selection (kinds 2 and 4; ours): |delta_soc| within
    [delta_min, delta_max]; the low end (start of a charge, end of a drive)
    within ``low``, the high end within ``high``. Defaults are the reference's
    notebook parameters (windows 0-100, delta 50-100)."""
    lo_soc = F.col("start_soc") if charging else F.col("end_soc")
    hi_soc = F.col("end_soc") if charging else F.col("start_soc")
    a = F.abs(F.col("delta_soc"))
    return F.coalesce((a >= delta_min) & (a <= delta_max) & lo_soc.between(*low) & hi_soc.between(*high),
                      F.lit(False))


def soc_category_capacity(per: DataFrame, step: float = 10, value: str = "normalized_ah_throughput",
                          by: str = "delta_soc", delta_min: float = 40, end_min: float = 90) -> DataFrame:
    """P17 filter (delta_soc > 40 and end_soc > 90), then count and mean
    of ``value`` per ``ceil(by / step) * step`` category (F7)."""
    sel = per.where(P.soc_window(delta_min, end_min))
    return (sel.groupBy(bucket_upper(by, step).cast("double").alias("category"))
            .agg(F.count("*").alias("n_periods"), r6(avg6(value)).alias(f"{value}_avg")))


def low_capacity_periods(per: DataFrame, threshold: float,
                         value: str = "normalized_ah_throughput") -> DataFrame:
    """Periods below a capacity threshold, start/end columns only."""
    return per.where(F.col(value) < threshold).select("vin", "start_time", "end_time", value)


def current_split(lab: DataFrame, keys: Sequence[str] = ("vin", "period_no"),
                  order: Sequence[str] = ORDER, jump: float = CURRENT_JUMP) -> DataFrame:
    """Row number ``rn`` (1-based) in the period and ``side`` 0/1, the
    split being at the first row whose current differs from the previous by
    more than ``jump`` (row 2 when no such jump exists)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    wall = Window.partitionBy(*keys)
    s = lab.withColumn("rn", F.row_number().over(w))
    diff = F.col("curr") - F.lag("curr").over(w)
    s = s.withColumn("_jump_rn", F.when(F.abs(diff) > jump, F.col("rn")))
    s = s.withColumn("split_rn", F.coalesce(F.min("_jump_rn").over(wall), F.lit(2)))
    return s.withColumn("side", (F.col("rn") >= F.col("split_rn")).cast("int")).drop("_jump_rn")


def constant_current_models(df: DataFrame, kind: str = "charging", keys: Sequence[str] = ("vin",), order: Sequence[str] = ORDER,
                            max_gap_s: int = PERIOD_GAP_S, compaction_s: float = COMPACTION_S, trim: bool = False,
                            jump: float = CURRENT_JUMP, bucket: str = DAY_BUCKET) -> DataFrame:
    """B16 (+ B17 with ``trim``): each side of the W14 split (:func:`current_split`) is replaced by
    its mean current held over the side's corrected duration; the two halves are added and
    normalised by 100/|delta_soc|. B18: a least-squares line of current over corrected time per
    period, integrated over the period. B17 trim: the lowest-SOC rows of side 0 and the highest-SOC
    rows of side 1 are dropped before averaging.

    The records of a period are never brought together. Each local segment inside (vehicle, day)
    is summed in parts: its first row, its rows before its first jump of current, and those from
    there on (with ``trim`` also by SOC value). A part holds moments of current I over time t,
    counted from the segment's start: n, sums of t, t2, I and tI, and the ends. Segments are then
    put in order per vehicle: a segment's time in the period is the sum of the segments before and
    the steps between them, and moments are shifted by it (sum of (t + o)2 = sum t2 + 2 o sum t + n o2, sum of
    (t + o) I = sum tI + o sum I); the first segment with a jump, inside or at its first row, decides
    the side of every part."""
    keys, brk = list(keys), breaks(max_gap_s)
    rows = df.where(period_flag(kind)).where(F.col("ts").isNotNull())
    carry = list(dict.fromkeys([*order, "ts", "curr", "soc"]))
    dtc = _dtc(compaction_s)
    r = cut(rows, keys, order, bucket, brk, carry)
    run = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = lambda x: F.when(~F.col("_brk"), x)
    jumps = lambda p, c: F.coalesce(F.abs(c("curr") - p("curr")) > jump, F.lit(False))
    r = r.withColumn("_c", F.sum(F.coalesce(inner(dtc(lagged, here)), F.lit(0))).over(run))
    r = r.withColumn("_k", F.sum(F.coalesce(inner(jumps(lagged, here)).cast("int"), F.lit(0))).over(run))
    at_start = lambda c: F.last(F.when(F.col("_brk"), F.col(c)), ignorenulls=True).over(run)
    r = r.withColumn("_t", F.col("_c") - at_start("_c")).withColumn("_part", F.when(F.col("_brk"), 0).when(F.col("_k") > at_start("_k"), 2).otherwise(1))
    okey, row = F.struct(*order), F.struct(*[F.col(c) for c in carry])
    by = ["_part", *(["soc"] if trim else [])]
    t, i = F.col("_t").cast("double"), F.col("curr")
    known = lambda x: F.when(i.isNotNull(), x)
    parts = r.groupBy(*keys, bucket, "_seg", *by).agg(
        F.count(F.lit(1)).alias("rows"), F.count(i).alias("n"), F.sum(known(t)).alias("t"), F.sum(known(t * t)).alias("tt"), F.sum(i).alias("i"), F.sum(t * i).alias("ti"),
        F.min("_t").alias("lo"), F.max("_t").alias("hi"), F.min_by(row, okey).alias("first"), F.max_by(row, okey).alias("last"))
    moments = ["n", "t", "tt", "i", "ti", "lo", "hi", "first", "last"]
    segs = parts.groupBy(*keys, bucket, "_seg").agg(
        F.sum("rows").alias("_n"), F.min_by("first", F.struct(*[F.col(f"first.{c}") for c in order])).alias("_head"),
        F.max_by("last", F.struct(*[F.col(f"last.{c}") for c in order])).alias("_tail"), F.max("hi").alias("_span"),
        (F.max("_part") == 2).alias("_inside"), F.collect_list(F.struct(*by, *moments)).alias("_parts"))

    # segments in order: time before, and the segment with the first jump
    segs = joined(segs, keys, bucket, brk, "period_no")
    pk = [*keys, "period_no"]
    wp = Window.partitionBy(*pk).orderBy(bucket, "_seg")
    upto, before = wp.rowsBetween(Window.unboundedPreceding, Window.currentRow), wp.rowsBetween(Window.unboundedPreceding, -1)
    segs = segs.withColumn("_no", F.row_number().over(wp)).withColumn("_edge", F.col("_merge") & jumps(tail_before, head))
    segs = segs.withColumn("_o", (F.coalesce(F.sum("_span").over(before), F.lit(0))
                                  + F.coalesce(F.sum(F.when(F.col("_merge"), dtc(tail_before, head))).over(upto), F.lit(0))).cast("double"))
    segs = segs.withColumn("_split", F.min(F.when(F.col("_edge") | F.col("_inside"), F.col("_no"))).over(Window.partitionBy(*pk)))
    e = segs.select(*pk, "_no", "_edge", "_o", "_split", F.explode("_parts").alias("p")).select(*pk, "_no", "_edge", "_o", "_split", "p.*")
    side = (F.when(F.col("_split").isNull(), F.when((F.col("_no") == 1) & (F.col("_part") == 0), 0).otherwise(1))
            .when(F.col("_no") != F.col("_split"), (F.col("_no") > F.col("_split")).cast("int"))
            .otherwise((F.col("_edge") | (F.col("_part") == 2)).cast("int")))
    e = e.withColumn("side", side)
    if trim:
        ws = Window.partitionBy(*pk, "side")
        e = e.withColumns({"_low": F.min("soc").over(ws), "_high": F.max("soc").over(ws)})
        e = e.where(F.when(F.col("side") == 0, F.col("soc") > F.col("_low")).otherwise(F.col("soc") < F.col("_high")))
    o = F.col("_o")
    lo, hi = F.col("lo") + o, F.col("hi") + o
    of = lambda agg, x, k: agg(F.when(F.col("side") == k, x))
    half = lambda k: of(F.sum, F.col("i"), k) / of(F.sum, F.col("n"), k) * (of(F.max, hi, k) - of(F.min, lo, k) + SAMPLE_SECONDS) / 3600
    first_key, last_key = (F.struct(*[F.col(f"{x}.{c}") for c in order]) for x in ("first", "last"))
    g = e.groupBy(*pk).agg(
        half(0).alias("h0"), half(1).alias("h1"), F.sum("n").alias("n"), F.sum(F.col("t") + o * F.col("n")).alias("t"),
        F.sum(F.col("tt") + 2 * o * F.col("t") + o * o * F.col("n")).alias("tt"), F.sum("i").alias("i"), F.sum(F.col("ti") + o * F.col("i")).alias("ti"),
        F.min(lo).alias("t0"), F.max(hi).alias("t1"), F.min_by("first.soc", first_key).alias("s0"), F.max_by("last.soc", last_key).alias("s1"))
    ah = F.coalesce(F.col("h0") + F.col("h1"), F.col("h0"), F.col("h1"))
    var = F.col("n") * F.col("tt") - F.col("t") * F.col("t")
    b = F.when(var > 0, (F.col("n") * F.col("ti") - F.col("t") * F.col("i")) / var)
    a = (F.col("i") - b * F.col("t")) / F.col("n")
    t0, t1, ads = F.col("t0"), F.col("t1"), F.abs(F.col("s1") - F.col("s0"))
    integral = (a * (t1 - t0) + b * (t1 * t1 - t0 * t0) / 2) / 3600
    return g.select(*pk, r6(ah).alias("ah_const_current"), r6(F.when(ads != 0, ah / ads * 100)).alias("normalized_ah_const_current"),
                    r6(integral).alias("ah_linear_fit"), r6(F.when(ads != 0, integral / ads * 100)).alias("normalized_ah_linear_fit"))


def grid_interpolate(lab: DataFrame, keys: Sequence[str] = ("vin", "period_no"),
                     step_s: int = SAMPLE_SECONDS, value: str = "soc", order: Sequence[str] = ORDER) -> DataFrame:
    """W12 + W13: ``value`` linearly interpolated on a regular ``step_s`` grid from each period's
    first record (up to its last), with the slope per minute to the previous grid point.

    ``lab`` are period rows labelled with ``known=value`` (:func:`label_periods`). A grid point is
    made by the record after it, where that is, from the last record before with a value: no grid
    is joined or merged with the records. The period's last record with a value makes the points
    that are left. Before the first value points have none, after the last they keep it. Only grid
    points are shuffled, by period, for the slope."""
    us = lambda a, b: F.timestamp_diff("MICROSECOND", a, b)
    step, v = step_s * 1_000_000, F.col(value).cast("double")
    first, last, prev = F.col("_first_ts"), F.col("_last_ts"), F.col("_prev_known")
    here_, empty = us(first, F.col("ts")), F.array().cast("array<struct<k: bigint, v: double>>")
    after = lambda x: F.floor((x + (step - 1)) / step).cast("bigint")
    point = lambda k, x: F.struct(k.cast("bigint").alias("k"), x.cast("double").alias("v"))

    def points(lo, hi, x):  # grid numbers lo <= k < hi
        return F.when(hi > lo, F.transform(F.sequence(lo, hi - 1), lambda k: point(k, x(k)))).otherwise(empty)

    none = F.lit(None).cast("double")
    from_ = us(first, prev["ts"])
    line = lambda k: prev["v"] + (v - prev["v"]) * (k * step - from_) / (here_ - from_)
    end = F.floor(us(first, last) / step).cast("bigint") + 1
    zero = F.lit(0).cast("bigint")
    mine = F.when(prev.isNull(), points(zero, after(here_), lambda k: none)).otherwise(points(after(from_), after(here_), line))
    is_last = F.struct(*order) == F.col("_last_known")
    made = F.when(v.isNotNull(), F.concat(mine, F.when(is_last, points(after(here_), end, lambda k: v)).otherwise(empty))) \
            .when(F.col("_last_known").isNull() & F.col("_prev_ts").isNull(), points(zero, end, lambda k: none))
    g = lab.select(*keys, "_first_ts", F.explode(made).alias("p")).select(
        *keys, "p.k", F.timestamp_add("SECOND", F.col("p.k") * step_s, F.col("_first_ts")).alias("ts"), F.col("p.v").alias(value))
    wg = Window.partitionBy(*keys).orderBy("k")
    slope = (F.col(value) - F.lag(value).over(wg)) / (step_s / 60.0)
    return g.select(*keys, "ts", r6(value).alias(value), r6(slope).alias("slope_per_min"))


SLOPE_LIMIT_CHARGING = 0.001       # SOC points per second (fixed value of the reference's calls)
SLOPE_LIMIT_DRIVING = -0.0005
THRESHOLD_FACTOR = 2.5             # current-dependent threshold factor (10 in a second call)


def missing_time_treatments(df: DataFrame, kind: str = "charging", keys: Sequence[str] = ("vin",), order: Sequence[str] = ORDER,
                            max_gap_s: int = PERIOD_GAP_S, offset_s: float = COMPACTION_S,
                            slope_limit: float = SLOPE_LIMIT_CHARGING, negative_slope: bool = False,
                            factor: float = THRESHOLD_FACTOR, bucket: str = DAY_BUCKET) -> DataFrame:
    """B14 + B15 + B12 per period (definitions ours; the treatment functions
    are absent from the reference, only their parameters are known).

    * B14 fixed offset: a step longer than ``offset_s`` counts as 10 s when
      the SOC moved slower than ``slope_limit`` points per second across it
      (for driving, ``negative_slope``: when SOC fell slower than the limit),
      i.e. nothing happened during the gap.
    * B15 current-dependent threshold: a step counts as 10 s when it is longer
      than ``factor`` times the period's observed seconds per SOC point
      (records x 10 / |delta SOC|).

    Each gives a real duration (corrected steps + the first sample) and the
    Ah throughput scaled by real / observed duration (B12).

    B15's threshold is known only once the period is, so each local segment
    inside (vehicle, day) keeps how often each step length occurs (whole
    seconds, at most ``max_gap_s`` values); these counts are added up with the
    steps between segments and weighed against the threshold at the end.
    Records are shuffled once, into (vehicle, day)."""
    keys, brk = list(keys), breaks(max_gap_s)
    carry = list(dict.fromkeys([*order, "ts", "soc"]))
    r = cut(df.where(period_flag(kind)).where(F.col("ts").isNotNull()), keys, order, bucket, brk, carry)

    def fixed(p, c):
        dt = gap_seconds(p("ts"), c("ts"))
        slope = (c("soc") - p("soc")) / dt
        idle = (slope > slope_limit) if negative_slope else (slope < slope_limit)
        return F.when((dt > offset_s) & F.coalesce(idle, F.lit(False)), F.lit(SAMPLE_SECONDS).cast("long")).otherwise(dt)

    r = r.withColumn("_dt", F.when(~F.col("_brk"), gap_seconds(lagged("ts"), here("ts"))))
    okey, row = F.struct(*order), F.struct(*[F.col(c) for c in carry])
    steps = r.groupBy(*keys, bucket, "_seg", "_dt").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.abs("curr")).alias("i"), F.sum(F.when(~F.col("_brk"), fixed(lagged, here))).alias("f"),
        F.min_by(row, okey).alias("first"), F.max_by(row, okey).alias("last"))
    segs = steps.groupBy(*keys, bucket, "_seg").agg(
        F.sum("n").alias("_n"), F.sum("i").alias("_i"), F.sum("f").alias("_f"), F.min_by("first", F.struct(*[F.col(f"first.{c}") for c in order])).alias("_head"),
        F.max_by("last", F.struct(*[F.col(f"last.{c}") for c in order])).alias("_tail"),
        F.collect_list(F.when(F.col("_dt").isNotNull(), F.struct(F.col("_dt").alias("dt"), "n"))).alias("_steps"))
    segs = joined(segs, keys, bucket, brk, "period_no")
    between = F.when(F.col("_merge"), F.array(F.struct(gap_seconds(tail_before("ts"), head("ts")).alias("dt"), F.lit(1).cast("bigint").alias("n")))).otherwise(F.array())
    at = F.struct(F.col(bucket), F.col("_seg"))
    g = segs.withColumn("_steps", F.concat("_steps", between)).groupBy(*keys, "period_no").agg(
        F.sum("_n").alias("count_records"), F.sum("_i").alias("_ithr"),
        F.coalesce(F.sum(F.coalesce("_f", F.lit(0)) + F.coalesce(F.when(F.col("_merge"), fixed(tail_before, head)), F.lit(0))), F.lit(0)).alias("_fixed"),
        F.min_by("_head.soc", at).alias("_s0"), F.max_by("_tail.soc", at).alias("_s1"), F.flatten(F.collect_list("_steps")).alias("_steps"))
    span = F.abs(F.col("_s1") - F.col("_s0"))
    thr = F.when(span > 0, factor * F.col("count_records") * SAMPLE_SECONDS / span)
    g = g.withColumn("_thr", thr).withColumn("real_s_fixed", F.col("_fixed") + SAMPLE_SECONDS)
    counted = F.aggregate("_steps", F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"] * F.when(
        F.col("_thr").isNotNull() & (x["dt"] > F.col("_thr")), F.lit(SAMPLE_SECONDS).cast("bigint")).otherwise(x["dt"]))
    g = g.withColumn("real_s_current", counted + SAMPLE_SECONDS)
    ah = F.col("_ithr") * SAMPLE_SECONDS / 3600.0
    obs = F.col("count_records") * SAMPLE_SECONDS
    return g.select(*keys, "period_no", "count_records", r6("real_s_fixed").alias("real_s_fixed"),
                    r6("real_s_current").alias("real_s_current"),
                    r6(ah * F.col("real_s_fixed") / obs).alias("ah_throughput_fixed_comp"),
                    r6(ah * F.col("real_s_current") / obs).alias("ah_throughput_current_comp"))


def charge_soc_ranges(per: DataFrame, step: float = 10, keys: Sequence[str] = ("vin", "day")) -> DataFrame:
    """B8 ``soc_range_charge_start`` / ``_end`` (ours): periods counted by the
    ``step`` bucket (upper edge, F7) of their start and end SOC."""
    edges = per.select(*keys, F.explode(F.array(
        F.struct(F.lit("start").alias("edge"), F.col("start_soc").alias("soc")),
        F.struct(F.lit("end").alias("edge"), F.col("end_soc").alias("soc")))).alias("e"))
    return (edges.groupBy(*keys, F.col("e.edge").alias("edge"),
                          bucket_upper(F.col("e.soc"), step).cast("double").alias("soc_bucket"))
            .agg(F.count(F.lit(1)).alias("n_periods")))
