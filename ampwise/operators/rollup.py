"""Daily-to-monthly rollups, dense calendars and stat documents
(SURVEY 2.9 R1-R4, R6, W10, U2; S10, K7).

Long form: one row per (vin, stat, freq, time_label) with ``value`` and, for
averages, ``weight`` (the number of samples behind the average).

* R3/W10: each vehicle gets every day from its first day to the batch's last
  day; a missing day carries a null value (weight 0).
* R1: a monthly sum is null only if every day of the month is null, which is
  SQL ``sum``.
* R2: the monthly speed average folds the month's days in order:
  ``(a, n) + (b, m)``: both averages missing -> (null, 0); an average equal to
  0 counts with weight 1; otherwise ``(a n + b m) / (n + m)``. The first day
  of the month is taken as is. Because of the zero rule the fold is
  order-dependent (deviation D7 keeps it), so it runs over the day-sorted
  array of one (vin, month) group, at most 31 entries.
* R4: a new vehicle's month starts from its first day, which falls out of the
  grouping.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import r6, sum6

# monthly stat name -> (daily value column, daily weight column or None)
MONTHLY_STATS = {
    "average_speed": ("speed_average", "speed_n"),
    "miles_driven": ("distance_driven", None),
    "charging_hours": ("charging_hours", None),
}


def dense_calendar(daily: DataFrame, end_day: Column | None = None) -> DataFrame:
    """(vin, day) for every day from the vehicle's first day to the last
    day of the batch (``end_day``, default the table's ``max(day)``)."""
    first = daily.groupBy("vin").agg(F.min("day").alias("_first"))
    if end_day is None:
        from .scan import scalar_column
        end_day = scalar_column(daily, F.max("day"))
    return first.select("vin", F.explode(F.sequence("_first", end_day, F.expr("INTERVAL 1 DAY"))).alias("day"))


def dense_daily(daily: DataFrame, end_day: Column | None = None) -> DataFrame:
    """The daily stat rows on the dense calendar (missing days -> nulls;
    ``_present`` marks days the vehicle reported). Several rows of one (vin,
    day), as late records leave behind, are combined first: sums add up, the
    speed average is weighted by its samples."""
    x = F.col("speed_average") * F.col("speed_n")
    d = daily.groupBy("vin", "day").agg(
        *[(F.when(F.count(F.lit(1)) == 1, F.max(c)).otherwise(sum6(c))).alias(c) for c in ("distance_driven", "charging_hours")],
        F.when(F.count(F.lit(1)) == 1, F.max("speed_average")).otherwise(
            F.sum(x) / F.nullif(F.sum(F.when(F.col("speed_average").isNotNull(), F.col("speed_n"))), F.lit(0))).alias("speed_average"),
        F.sum("speed_n").alias("speed_n"), F.lit(True).alias("_present"))
    return dense_calendar(daily, end_day).join(d, ["vin", "day"], "left") \
        .withColumn("_present", F.coalesce("_present", F.lit(False)))


def _fold_avg(acc: Column, x: Column) -> Column:
    an = F.when(acc["avg"] == 0, F.lit(1).cast("long")).otherwise(acc["n"])
    bn = F.when(x["avg"] == 0, F.lit(1).cast("long")).otherwise(x["n"])
    cnt = an + bn
    tot = F.coalesce(acc["avg"] * an, F.lit(0.0)) + F.coalesce(x["avg"] * bn, F.lit(0.0))
    both_missing = acc["avg"].isNull() & x["avg"].isNull()
    return F.when(both_missing, F.struct(F.lit(None).cast("double").alias("avg"), F.lit(0).cast("long").alias("n"))) \
            .otherwise(F.struct(F.when(cnt != 0, tot / cnt).alias("avg"), cnt.alias("n")))


def ordered_weighted_average(days: Column) -> Column:
    """R2 fold over an array of ``struct(day, avg, n, present)`` sorted by
    day: the month's first entry (a null entry when the vehicle was missing on
    day 01) starts the month, then every day the vehicle reported is folded
    in; days it was missing leave the monthly value untouched."""
    s = F.array_sort(days)
    init = F.struct(s[0]["avg"].alias("avg"), s[0]["n"].alias("n"))
    rest = F.filter(F.slice(s, 2, F.size(s)), lambda e: e["present"])
    rest = F.transform(rest, lambda e: F.struct(e["avg"].alias("avg"), e["n"].alias("n")))
    return F.aggregate(rest, init, _fold_avg)


def monthly_rollup(daily: DataFrame, end_day: Column | None = None) -> DataFrame:
    """Long-form monthly rows ``(vin, stat, freq, time_label, value, weight)``."""
    d = dense_daily(daily, end_day).withColumn("_month", F.date_format("day", "yyyy-M"))
    agg = d.groupBy("vin", "_month").agg(
        sum6("distance_driven").alias("miles_driven"),
        sum6("charging_hours").alias("charging_hours"),
        ordered_weighted_average(F.collect_list(F.struct(
            F.col("day"), F.col("speed_average").alias("avg"),
            F.coalesce(F.col("speed_n"), F.lit(0)).cast("long").alias("n"),
            F.col("_present").alias("present")))).alias("_sp"))
    long = agg.select("vin", "_month", F.explode(F.array(
        F.struct(F.lit("miles_driven").alias("stat"), r6("miles_driven").alias("value"),
                 F.lit(None).cast("long").alias("weight")),
        F.struct(F.lit("charging_hours").alias("stat"), r6("charging_hours").alias("value"),
                 F.lit(None).cast("long").alias("weight")),
        F.struct(F.lit("average_speed").alias("stat"), r6(F.col("_sp.avg")).alias("value"),
                 F.col("_sp.n").alias("weight")))).alias("r"))
    return long.select("vin", "r.stat", F.lit("monthly").alias("freq"),
                       F.col("_month").alias("time_label"), "r.value", "r.weight")


def daily_long(daily: DataFrame, end_day: Column | None = None) -> DataFrame:
    """Daily long form on the dense calendar (R3 nulls included)."""
    d = dense_daily(daily, end_day)
    rows = F.array(
        F.struct(F.lit("miles_driven").alias("stat"), F.col("distance_driven").alias("value"),
                 F.lit(None).cast("long").alias("weight")),
        F.struct(F.lit("charging_hours").alias("stat"), F.col("charging_hours").alias("value"),
                 F.lit(None).cast("long").alias("weight")),
        F.struct(F.lit("average_speed").alias("stat"), F.col("speed_average").alias("value"),
                 F.coalesce(F.col("speed_n"), F.lit(0)).cast("long").alias("weight")))
    return d.select("vin", F.date_format("day", "yyyy-MM-dd").alias("time_label"),
                    F.explode(rows).alias("r")) \
            .select("vin", "r.stat", F.lit("daily").alias("freq"), "time_label", "r.value", "r.weight")


def merge_day(state: DataFrame, daily: DataFrame, day: str) -> DataFrame:
    """Fold one day's stat rows into the monthly long-form state
    (the reference's incremental job). ``state`` holds monthly rows
    ``(vin, stat, freq, time_label, value, weight)``; ``daily`` the stat rows
    of ``day`` (``yyyy-MM-dd``). Callers check R6 (:func:`next_day_allowed`)
    first. State and day are grouped together by (vin, stat, label), which
    covers the three cases: vehicle missing today (its rows pass through; on
    day 01 it gets a null entry), new vehicle (its month starts from today),
    present in both (null-aware sum, R2 fold step for the speed average)."""
    y, m, _ = (int(x) for x in day.split("-"))
    label = f"{y}-{m}"
    value, weight = F.lit(None).cast("double"), F.lit(None).cast("long")
    none = F.lit(0).cast("long")

    def entry(kind, label_, value_, weight_):
        return F.struct(F.lit(kind).alias("kind"), label_.alias("time_label"), value_.alias("value"), weight_.alias("weight"))

    held = [entry("old", F.col("time_label"), F.col("value"), F.col("weight"))]
    if day.endswith("-01"):  # a known vehicle's new month, should today bring nothing
        held.append(entry("known", F.lit(label), value, F.when(F.col("stat") == "average_speed", none)))
    old = state.select("vin", "stat", F.explode(F.array(*held)).alias("e"))
    new = daily.where(F.col("day") == F.lit(day).cast("date")).select("vin", F.explode(F.array(*[
        F.struct(F.lit(stat).alias("stat"), entry("new", F.lit(label), F.col(c), w).alias("e")) for stat, c, w in (
            ("miles_driven", "distance_driven", weight), ("charging_hours", "charging_hours", weight),
            ("average_speed", "speed_average", F.coalesce(F.col("speed_n"), none).cast("long")))])).alias("r")).select("vin", "r.stat", "r.e")
    of = lambda kind: F.max(F.when(F.col("e.kind") == kind, F.struct(F.col("e.value").alias("avg"), F.col("e.weight").alias("n"))))
    g = old.unionByName(new).select("vin", "stat", F.col("e.time_label").alias("time_label"), "e").groupBy("vin", "stat", "time_label").agg(
        of("old").alias("a"), of("new").alias("b"), of("known").alias("k"))
    a, b = F.col("a"), F.col("b")
    summed = F.struct(F.coalesce(a["avg"] + b["avg"], a["avg"], b["avg"]).alias("avg"), weight.alias("n"))
    got = F.when(a.isNotNull() & b.isNotNull(), F.when(F.col("stat") == "average_speed", _fold_avg(a, b)).otherwise(summed)) \
           .otherwise(F.coalesce(b, a, F.col("k")))
    return g.select("vin", "stat", F.lit("monthly").alias("freq"), "time_label", got["avg"].alias("value"), got["n"].alias("weight"))


def next_day_allowed(last_day: dt.date | None, day: dt.date) -> bool:
    """Only the day after the last merged day may be merged."""
    return last_day is None or day == last_day + dt.timedelta(days=1)


# ---------------------------------------------------------------- K7 / S10
DOC_SCHEMA = "vin string, month string, stats map<string, array<struct<label: string, value: double, weight: bigint>>>"


def stat_documents(long: DataFrame) -> DataFrame:
    """K7: one document per (vin, month): ``stat_freq -> [(label, value, weight)]``
    sorted by label. Grouping by month keeps every document bounded."""
    month = F.when(F.col("freq") == "monthly", F.col("time_label")).otherwise(
        F.date_format(F.to_date(F.substring("time_label", 1, 10)), "yyyy-M"))
    entries = (long.withColumn("month", month)
               .groupBy("vin", "month", F.concat_ws("_", "stat", "freq").alias("key"))
               .agg(F.array_sort(F.collect_list(F.struct(F.col("time_label").alias("label"),
                                                         F.col("value"), F.col("weight")))).alias("vals")))
    return entries.groupBy("vin", "month").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "vals"))).alias("stats"))


def read_stat_documents(spark, path: str) -> DataFrame:
    """Read stat documents back into the long form."""
    return long_form(spark.read.schema(DOC_SCHEMA).json(path))


def long_form(docs: DataFrame) -> DataFrame:
    """The rows (vin, stat, freq, time_label, value, weight) of stat documents."""
    e = docs.select("vin", F.explode("stats").alias("key", "vals"))
    e = e.select("vin", "key", F.explode("vals").alias("v"))
    return e.select("vin", F.regexp_extract("key", r"^(.*)_[a-z]+$", 1).alias("stat"),
                    F.regexp_extract("key", r"_([a-z]+)$", 1).alias("freq"),
                    F.col("v.label").alias("time_label"), F.col("v.value").alias("value"),
                    F.col("v.weight").alias("weight"))
