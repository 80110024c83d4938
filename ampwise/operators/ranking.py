"""Vehicle rankings and period comparisons (SURVEY A11-A13, A20, B21-B23,
W6, J1-J5, P20, P21, T2, T4, R8).

Everything stays in one DataFrame plan: the per-vehicle aggregates, the
joins between them and the ranking. Inputs are period tables (see
:mod:`ampwise.operators.periods`) or daily stat rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import avg6, missing_time_hours, r6
from ..session import reliable_checkpoint
from .periods import KIND, full_soc_filter
from .scan import scalar_column


# ---------------------------------------------------------------- A11 / A12
def recency_weight(keys: Sequence[str], order: Sequence[str]) -> Column:
    """A11 weight of the i-th (0-based) of n rows of a key in ``order``:
    ``(i + 1) / n / 2 + 0.5``, from just above 0.5 (oldest) to 1 (newest)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return F.row_number().over(w) / n / 2 + 0.5


def wmean(value: str, weight: str = "_w") -> Column:
    """A11 aggregate: ``sum(w x) / sum(w)``; null (the reference's NaN) when
    any value of the group is missing."""
    x = F.col(value)
    return F.when(F.count(x) == F.count(F.lit(1)), F.sum(F.col(weight) * x) / F.sum(weight))


def by_vehicle(periods: DataFrame, spec: dict[str, Sequence[str]], order: Sequence[str] = ("end_time", "period_no"),
               keys: Sequence[str] = ("vin",), count_of: str | None = None) -> DataFrame:
    """Per-vehicle aggregates of a period table. ``spec`` maps a column
    to aggregate names among ``wmean, count, min, max, mean``; outputs are
    named ``<column>_<agg>``. ``count`` counts non-null values."""
    df = periods.withColumn("_w", recency_weight(keys, order))
    aggs = []
    for col, names in spec.items():
        for a in names:
            e = {"wmean": lambda c: wmean(c), "count": lambda c: F.count(c), "min": lambda c: F.min(c),
                 "max": lambda c: F.max(c), "mean": lambda c: avg6(c)}[a](col)
            aggs.append((r6(e) if a != "count" else e).alias(f"{col}_{a}"))
    return df.groupBy(*keys).agg(*aggs)


# ---------------------------------------------------------------- filters
def recent(df: DataFrame, day_range: int, end_day: Column | None = None, day: str = "day") -> DataFrame:
    """``day > date_sub(last_day, day_range)``; ``last_day`` defaults to the
    table's own ``max(day)`` as a scalar subquery (T4)."""
    if end_day is None:
        end_day = scalar_column(df, F.max(day))
    return df.where(F.col(day) > F.date_sub(end_day, day_range))


def of_type(df: DataFrame, vehicles: DataFrame, vintype: str) -> DataFrame:
    """``vin IN (SELECT vin FROM vehicles WHERE vintype = ...)`` as a left semi join."""
    return df.join(vehicles.where(F.col("vintype") == vintype).select("vin"), "vin", "left_semi")


# ---------------------------------------------------------------- B21
_CELLS_AND_TEMPERATURES = {"battery_temp_min": ("battery_temp_min", "min"), "battery_temp_max": ("battery_temp_max", "max"),
                           "battery_temp_mean": ("battery_temp_avg", "mean"), "cell_volt_diff_mean": ("cell_volt_diff_mean", "wmean")}
#: B21's four tables: the published columns (column and aggregate behind each), and the column whose
#: values are counted for A13. The first two decide which vehicles are listed.
RANKED = {
    "driving": ({f"{n}_driving": c for n, c in _CELLS_AND_TEMPERATURES.items()}, "cell_volt_diff_mean"),
    "charging": ({f"{n}_charging": c for n, c in _CELLS_AND_TEMPERATURES.items()}, "cell_volt_diff_mean"),
    "charging_full_soc": ({"normalized_ah_charged_mean": ("normalized_ah_throughput", "wmean")}, "normalized_ah_throughput"),
    "driving_full_soc": ({"normalized_ah_consumption_mean": ("normalized_ah_consumption", "wmean"),
                          "normalized_distance_driven_mean": ("normalized_distance_driven", "wmean")}, "normalized_ah_consumption"),
}


def vehicle_ranking(per: DataFrame, vehicles: DataFrame, vintype: str, day_range: int = 30,
                    min_count_records: int = 20, min_count_periods: int = 5) -> DataFrame:
    """A12 x4 -> A13 -> J4 -> J5 x2 -> P1, over charging and driving periods in one table
    (:func:`ampwise.operators.periods.periods_of`), which is checkpointed as it is read for the last
    day and for the ranking.

    The window end is the last day of the driving periods (trips on battery). Charging and driving
    periods need more than ``min_count_records`` records (P20); each per-vehicle aggregate keeps
    vehicles with more than ``min_count_periods`` periods (A13). A period enters each of the four
    tables of :data:`RANKED` that it belongs to; one aggregate by (vehicle, table) and one by vehicle
    stand for the aggregates and joins, and vehicles of the driving or the charging table are listed
    (full outer J4; J5 adds the others' columns). Columns are labelled ``_charging`` and
    ``_driving`` (deviation D3; no debug limit, D4)."""
    columns = sorted({c for named, _ in RANKED.values() for c, _ in named.values()})
    per = reliable_checkpoint(per.select("vin", "kind", "period_no", "day", "end_time", "count_records", "start_soc", "end_soc", "delta_soc", *columns))
    end = scalar_column(per.where(F.col("kind") == KIND["driving"]), F.max("day"))
    rows = of_type(per, vehicles, vintype).where(F.col("day") > F.date_sub(end, day_range))
    many = F.col("count_records") > min_count_records
    member = {"driving": (F.col("kind") == KIND["driving"]) & many, "charging": (F.col("kind") == KIND["charging"]) & many,
              "charging_full_soc": (F.col("kind") == KIND["charging"]) & full_soc_filter(charging=True),
              "driving_full_soc": (F.col("kind") == KIND["driving"]) & full_soc_filter(charging=False)}
    rows = rows.withColumn("table", F.explode(F.array_compact(F.array(*[F.when(member[t], F.lit(t)) for t in RANKED]))))
    spec: dict[str, list[str]] = {}
    for named, counted in RANKED.values():
        for column, agg in [*named.values(), (counted, "count")]:
            if agg not in spec.setdefault(column, []):
                spec[column].append(agg)
    each = by_vehicle(rows, spec, keys=("vin", "table"))
    enough = F.lit(False)
    for t, (_, counted) in RANKED.items():
        enough = enough | ((F.col("table") == t) & (F.col(f"{counted}_count") > min_count_periods))
    wide = each.where(enough).groupBy("vin").agg(
        F.max(F.col("table").isin("driving", "charging")).alias("_listed"),
        *[F.max(F.when(F.col("table") == t, F.col(f"{c}_{a}"))).alias(name) for t, (named, _) in RANKED.items() for name, (c, a) in named.items()])
    return wide.where("_listed").drop("_listed")


# ---------------------------------------------------------------- W6
def global_row_number(df: DataFrame, order: Sequence[Column], name: str = "row_number",
                      partitions: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (ORDER BY ...)`` without a single-partition window.

    Rows are range-partitioned on the order (a final hash of the row breaks
    ties, so equal keys are spread), sorted within partitions, and numbered by
    ``monotonically_increasing_id`` (partition id in the upper 31 bits,
    position in the lower 33 bits, per the API contract). These rows are
    checkpointed, lazily: the numbered rows and the partition counts read the
    same partitions, also after a retry. Each partition's offset is the count
    of rows in earlier partitions, from a table with one row per partition
    (size bounded by the partition count, hence broadcast)."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = F.xxhash64(*[F.col(c) for c in df.columns])
    ranged = df.repartitionByRange(parts, *order, whole).sortWithinPartitions(*order, whole)
    ranged = ranged.withColumn("_mid", F.monotonically_increasing_id())
    ranged = ranged.withColumn("_pid", F.shiftright("_mid", 33)) \
                   .withColumn("_pos", F.col("_mid") - F.shiftleft(F.col("_pid"), 33))
    ranged = reliable_checkpoint(ranged, eager=False)
    counts = ranged.groupBy("_pid").agg(F.count("*").alias("_n"))
    offs = counts.select("_pid", F.coalesce(F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offs), "_pid")
            .withColumn(name, (F.col("_off") + F.col("_pos") + 1).cast("long"))
            .drop("_mid", "_pid", "_pos", "_off"))


# ---------------------------------------------------------------- B22
def cell_volt_ranking(daily: DataFrame, vehicles: DataFrame, vintype: str, day_range: int = 30,
                      min_days: int = 5, value: str = "cell_volt_diff_avg") -> DataFrame:
    """P21 -> J3 -> A3 -> A4 -> W6 (rank 1 = largest mean daily cell
    voltage spread; ties by vin)."""
    last = scalar_column(daily, F.max("day"))
    sel = of_type(daily, vehicles, vintype).withColumn("last_daily_stats_day", last) \
        .where(F.col("day") > F.date_sub(last, day_range))
    agg = (sel.groupBy("vin", "last_daily_stats_day")
           .agg(F.count("day").alias("counts"),
                r6(avg6(value)).alias("mean_daily_avg_cell_volt_diff"))
           .where(F.col("counts") > min_days))
    ranked = global_row_number(agg, [F.col("mean_daily_avg_cell_volt_diff").desc(), F.col("vin")])
    return ranked.select("vin", "row_number", "mean_daily_avg_cell_volt_diff",
                         F.current_date().alias("update_date"), "last_daily_stats_day")


def needs_rebuild(source_last_day, stored_last_day) -> bool:
    """Rebuild a ranking only if its source advanced (or none is stored)."""
    return stored_last_day is None or source_last_day != stored_last_day


# ---------------------------------------------------------------- A20 / J2
def month_compare(periods: DataFrame, vehicles: DataFrame, vintype: str, first: int = 1,
                  second: int = 2, min_counts: int = 4, bucket: Column | None = None) -> DataFrame:
    """Per vehicle, averages of normalised Ah, missing-time share and
    the three temperatures in two months, and ``(b - a) / b * 100`` of Ah.
    One scan with conditional aggregation replaces the reference's two
    aggregates joined on vin (J2); both months need more than ``min_counts``
    periods with a missing-time value. ``bucket`` replaces ``month(day)`` to
    compare other calendar units."""
    p = of_type(periods, vehicles, vintype)
    mt = F.when(F.col("duration") != 0,
                (F.col("duration") - F.col("count_records") / 360) / F.col("duration") * 100)
    p = p.withColumn("_month", F.month("day") if bucket is None else bucket).withColumn("_mt", mt)
    cols = {"ah": "normalized_ah_throughput", "missing_time": "_mt", "min_temp": "battery_temp_min",
            "max_temp": "battery_temp_max", "avg_temp": "battery_temp_avg"}
    aggs = []
    for tag, m in (("a", first), ("b", second)):
        inm = F.col("_month") == m
        for k, c in cols.items():
            aggs.append((avg6(F.when(inm, F.col(c))) if c != "_mt" else F.avg(F.when(inm, F.col(c))))
                        .alias(f"avg_{k}_{tag}"))
        aggs.append(F.count(F.when(inm, F.col("_mt"))).alias(f"counts_{tag}"))
    g = p.groupBy("vin").agg(*aggs).where((F.col("counts_a") > min_counts) & (F.col("counts_b") > min_counts))
    diff = F.when(F.col("avg_ah_b") != 0, (F.col("avg_ah_b") - F.col("avg_ah_a")) / F.col("avg_ah_b") * 100)
    out = [F.col("vin"), r6(diff).alias("ah_percent_diff")]
    for k in cols:
        for tag in ("a", "b"):
            out.append(r6(f"avg_{k}_{tag}").alias(f"avg_{k}_{tag}"))
    return g.select(*out)


# ---------------------------------------------------------------- T2 / J1 / B23
def top_vehicles(periods: DataFrame, vehicles: DataFrame, vintype: str, n: int = 20) -> DataFrame:
    """T2 + J1: the ``n`` vehicles of a type with most periods (ties by vin).
    The vehicle dimension is joined after aggregation; ``orderBy().limit()``
    is planned as a distributed top-k (TakeOrderedAndProject)."""
    counts = periods.groupBy("vin").agg(F.count("day").alias("counts"))
    dim = vehicles.where(F.col("vintype") == vintype)
    return (counts.join(dim, "vin").orderBy(F.col("counts").desc(), F.col("vin")).limit(n)
            .select("vin", "vintype", "counts"))


def vehicle_series(per: DataFrame) -> DataFrame:
    """Charging and driving full-SOC periods side by side with the
    missing time in hours (F16 hours form: duration - n*10/3600) and as a
    share (D9: two separate columns), from one table of both kinds."""
    charging = F.col("kind") == KIND["charging"]
    wanted = F.when(charging, full_soc_filter(charging=True)).otherwise((F.col("kind") == KIND["driving"]) & full_soc_filter(charging=False))
    return per.where(wanted).select(
        "vin", F.when(charging, F.lit("charging")).otherwise(F.lit("driving")).alias("series"), "start_time", "end_time", "day",
        "delta_soc", "duration", "count_records", r6(missing_time_hours("duration", "count_records")).alias("missing_time_h"), "missing_time_pct")
