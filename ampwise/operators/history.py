"""Daily, hourly and monthly stat history that late rows correct (SURVEY J10,
R1-R4, W10 with versions).

The reference appends a day to a vehicle's lists and folds it into the month;
a record that arrives later for an earlier day never reaches them. Here every
batch (a day file) may carry stat rows for any label, in any order, and a batch
may be delivered again. What is kept is versioned by (vehicle, label):

* ``arrivals``: the stat rows of every batch, keyed by (freq, vin, label, batch).
  A batch delivered again replaces its rows; rows that it no longer has are
  marked deleted.
* ``days``: the value of each (vin, day) that has rows, combined over its batches,
  and the month so far up to that day: the null-aware sums (R1) and the ordered
  speed fold (R2).
* ``vehicles``: the first day of each vehicle, from which its calendar is dense
  (R3, R4).

:func:`apply` writes one version: only the keys it changes. A changed day changes
the month-so-far of that day and of the month's later days, and no other: the
fold restarts from the day before, whose month-so-far is stored (the fold depends
on the order of the days, so its later part has to be done again). A vehicle whose
first day moves has the months of the old and of the new first day folded again.
Months that nothing touches are neither read nor written.

A version counts once its row in ``versions`` is written, which is the last step:
a run that dies before leaves files that no reader takes, and the next run writes
that version anew. :func:`compact` writes the current rows as one version, so
readers open few files. Readers take, of each key, the row of the newest version,
and show days up to the newest batch. One writer at a time.

Each step deals the rows once, by vehicle (and label), and groups them there: the
newest version of a key column by column, the batches of a label in sorted order,
gaps from one present day to the next. What a version changes is kept while it is
written, so that no step reads the arrivals again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import r6
from .rollup import _fold_avg

VALUES = ("distance_driven", "charging_hours", "speed_average", "speed_n")
_STATS = "distance_driven double, charging_hours double, speed_average double, speed_n bigint"
ROWS = f"freq string, vin string, label string, batch date, {_STATS}"
_RUN = "run struct<avg: double, n: bigint, miles: bigint, hours: bigint>"
_RUN_FIELDS = ("avg", "n", "miles", "hours")
_TABLES = {
    "arrivals": f"{ROWS}, deleted boolean",
    "days": f"vin string, day date, present boolean, {_STATS}, {_RUN}",
    "vehicles": "vin string, first_day date",
}
#: What holds for rows that still count.
_CURRENT = {"arrivals": "NOT deleted", "days": "present", "vehicles": "first_day IS NOT NULL"}
_KEYS = {"arrivals": ("freq", "vin", "label", "batch"), "days": ("vin", "day"), "vehicles": ("vin",)}
_VERSIONS = "version bigint, base boolean, batches array<date>, last_batch date, months array<string>, written_at timestamp"
#: The log's name in the history's folder.
LOG = "versions"


def stat_rows(table: DataFrame, batch: str = "file_day") -> DataFrame:
    """Rows for :func:`apply` from a stat table of several frequencies that carries its batch
    (:func:`ampwise.operators.stats.period_stats` with ``freq=("daily", "hourly")``)."""
    return table.select("freq", F.col("vin").cast("string").alias("vin"), F.col("time_label").alias("label"), F.col(batch).cast("date").alias("batch"),
                        *[F.col(c).cast("bigint" if c == "speed_n" else "double").alias(c) for c in VALUES])


# ---------------------------------------------------------------- versions
def versions(spark: SparkSession, path: str) -> DataFrame:
    """The history's log: one row per version."""
    try:
        return spark.read.schema(_VERSIONS).parquet(f"{path}/{LOG}")
    except AnalysisException as e:  # no log yet is an empty history
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _VERSIONS)


def _log(spark: SparkSession, path: str) -> tuple[int, list[int], list]:
    """(newest version, versions to read, days of all batches); a row a version, few after compaction."""
    rows = sorted(versions(spark, path).collect(), key=lambda r: r["version"])
    base = max((r["version"] for r in rows if r["base"]), default=0)
    return (rows[-1]["version"] if rows else 0, [r["version"] for r in rows if r["version"] >= base],
            sorted({d for r in rows for d in r["batches"] or []} | {r["last_batch"] for r in rows if r["last_batch"]}))


def _table(spark: SparkSession, path: str, name: str, read: Sequence[int], months: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``read`` versions, of ``months`` if given (partitions are pruned by both)."""
    schema = _TABLES[name] + ", version bigint" + ("" if name == "vehicles" else ", month string")
    try:
        df = spark.read.schema(schema).parquet(f"{path}/{name}") if read else spark.createDataFrame([], schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema)
    df = df.where(F.col("version").isin(list(read)))
    return df if months is None else df.where(F.col("month").isin(list(months)))


def _latest(df: DataFrame, name: str) -> DataFrame:
    """Of each key the row of the newest version (a version has a key once), column by column: flat
    buffers are grouped without a sort."""
    keys = [*_KEYS[name], *([] if name == "vehicles" else ["month"])]
    flat = {c: [f"{c}.{x}" for x in _RUN_FIELDS] if c == "run" else [c] for c in df.columns if c not in (*keys, "version")}
    got = df.groupBy(*keys).agg(F.max("version").alias("version"), *[F.max_by(x, "version").alias(x.replace(".", "_")) for of in flat.values() for x in of])
    run = F.when(F.col("run_n").isNotNull(), F.struct(*[F.col(f"run_{x}").alias(x) for x in _RUN_FIELDS]))
    return got.select(*[run.alias("run") if c == "run" else c for c in df.columns])


def _write(df: DataFrame, path: str, name: str, version: int) -> None:
    w = df.write.mode("overwrite")
    (w if name == "vehicles" else w.partitionBy("month")).parquet(f"{path}/{name}/version={version}")


def _commit(spark: SparkSession, path: str, version: int, base: bool, batches: Sequence, last, months: Sequence[str]) -> None:
    row = spark.createDataFrame([(version, base, list(batches), last, list(months))], "version bigint, base boolean, batches array<date>, last_batch date, months array<string>")
    row.withColumn("written_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{path}/{LOG}")


# ---------------------------------------------------------------- combining
def _micro(c: str) -> Column:
    return F.round(F.col(c) * 1_000_000).cast("bigint")


def _combine(rows: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """:func:`combined` for rows dealt by ``keys``; those marked deleted do not count, though a key
    that has no others stays. ``live`` is the number of rows that count."""
    rows = rows.select(*[c for c in rows.columns if c not in VALUES], *[F.when(~F.col("deleted"), F.col(c)).alias(c) for c in VALUES])
    avg, n = F.col("speed_average"), F.col("speed_n")
    # sums of doubles follow the order of the batches
    g = rows.sortWithinPartitions(*keys, "batch").groupBy(*keys).agg(
        F.count_if(~F.col("deleted")).alias("live"), *[F.max(c).alias(f"_{c}") for c in VALUES], *[(F.sum(_micro(c)) / 1_000_000).alias(f"_sum_{c}") for c in VALUES[:2]],
        F.sum("speed_n").alias("_sum_speed_n"), F.sum(avg * n).alias("_total"), F.sum(F.when(avg.isNotNull(), n)).alias("_weight"),
        F.count_if(avg.isNotNull() & n.isNull()).alias("_unknown"), *more)
    mean = F.when(F.col("_unknown") == 0, F.col("_total") / F.nullif("_weight", F.lit(0).cast("bigint")))
    several = {**{c: F.col(f"_sum_{c}") for c in VALUES if c != "speed_average"}, "speed_average": mean}
    added = [c for c in g.columns if not c.startswith("_")]
    return g.select(*added, *[F.when(F.col("live") == 1, F.col(f"_{c}")).otherwise(several[c]).alias(c) for c in VALUES])


def combined(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key from the rows of its batches: one row stays as it is; of several, sums add up
    and the speed average is weighted by its samples, in the order of the batches."""
    rows = rows.select(*keys, "batch", *VALUES, F.lit(False).alias("deleted"))
    return _combine(rows.repartition(*keys), keys).select(*keys, *VALUES)


def _plus(a: Column, b: Column) -> Column:
    return F.coalesce(a + b, a, b)


def _month_so_far(groups: DataFrame) -> DataFrame:
    """The days from ``since`` on with their month so far: one row each, of groups (vin, month, days,
    since, first_day). ``days``: structs of the month's present days."""
    g = groups.withColumn("days", F.sort_array("days"))
    g = g.select("vin", "month", "first_day", F.try_element_at(F.filter("days", lambda d: d["day"] < F.col("since")), F.lit(-1))["run"].alias("last"),
                 F.filter("days", lambda d: d["day"] >= F.col("since")).alias("rest"))

    def step(runs, d):
        last, zero = F.element_at(runs, -1), F.lit(0).cast("bigint")
        this = F.struct(d["speed_average"].alias("avg"), F.coalesce(d["speed_n"], zero).alias("n"))
        # the first entry of a month is taken as it is; a known vehicle that was missing on day 01 starts from an empty one
        starts = last.isNull() & ((F.dayofmonth(d["day"]) == 1) | (d["day"] == F.col("first_day")))
        old = F.struct(last["avg"].alias("avg"), F.coalesce(last["n"], zero).alias("n"))
        speed = F.when(starts, this).otherwise(_fold_avg(old, this))
        miles, hours = (F.round(d[c] * 1_000_000).cast("bigint") for c in VALUES[:2])
        return F.concat(runs, F.transform(F.array(speed), lambda x: F.struct(  # one entry: the speed is worked out once
            x["avg"].alias("avg"), x["n"].cast("bigint").alias("n"), _plus(last["miles"], miles).alias("miles"), _plus(last["hours"], hours).alias("hours"))))

    runs = F.aggregate("rest", F.array("last").cast(f"array<{_RUN.split(' ', 1)[1]}>"), step)
    g = g.select("vin", "month", "rest", runs.alias("runs")).withColumn("runs", F.slice("runs", F.lit(2), F.size("rest")))
    g = g.select("vin", "month", F.explode(F.arrays_zip("rest", "runs")).alias("d"))
    return g.select("vin", "month", *[F.col(f"d.rest.{c}").alias(c) for c in ("day", *VALUES)], F.col("d.runs").alias("run"))


# ---------------------------------------------------------------- apply
#: Rows that a version changes up to which their keys are broadcast, so that earlier rows of other
#: keys are passed over where they are read; beyond that all rows of the months are dealt.
FEW = 200_000


def _of(df: DataFrame, keys: DataFrame, few: bool) -> DataFrame:
    return df.join(F.broadcast(keys.distinct()), keys.columns, "left_semi") if few else df


def apply(spark: SparkSession, path: str, rows: DataFrame, batches: Sequence | None = None) -> int:
    """Merge the stat rows of one or more batches (columns :data:`ROWS`) and return the version.

    ``batches`` names the days delivered (by default those found in ``rows``); a batch that was
    merged before is replaced, also by nothing. Rows without vehicle, label or batch are left out;
    of rows with one key the largest counts."""
    newest, read, known = _log(spark, path)
    version, here = newest + 1, [*read, newest + 1]
    month = lambda c: F.date_format(c, "yyyy-MM")
    rows = rows.where("vin IS NOT NULL AND label IS NOT NULL AND batch IS NOT NULL").select(*_KEYS["arrivals"], *VALUES)
    if batches is None:
        batches = [r[0] for r in rows.select("batch").distinct().collect()]
    again = sorted(set(batches) & set(known))
    rows = rows.withColumn("came", F.lit(True))
    if again:  # what an earlier delivery of these batches had and this one has not
        old = _latest(_table(spark, path, "arrivals", read).where(F.col("batch").isin(again)), "arrivals").where(~F.col("deleted"))
        rows = rows.unionByName(old.select(*_KEYS["arrivals"], *VALUES, F.lit(False).alias("came")))
    keys = ("month", *_KEYS["arrivals"])  # in the order of the files
    rows = (rows.repartition("vin", "label").withColumn("month", F.substring("label", 1, 7)).groupBy(*keys)
            .agg(F.max(F.struct("came", *VALUES)).alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in VALUES], (~F.col("_r.came")).alias("deleted")))
    _write(rows, path, "arrivals", version)

    mine = _table(spark, path, "arrivals", [version]).where(F.col("freq") == "daily")
    counts = {r[0]: r[1] for r in mine.groupBy("month").agg(F.count("*")).collect()}
    few = sum(counts.values()) <= FEW
    arrived = _table(spark, path, "arrivals", here, sorted(m for m in counts if m is not None)).where(F.col("freq") == "daily")
    arrived = _latest(_of(arrived, mine.select("vin", "label"), few and bool(read)).repartition("vin", "label"), "arrivals")
    now = _combine(arrived, ("vin", "label"), F.max("version").alias("newest")).where(F.col("newest") == version)
    now = now.select("vin", F.to_date("label").alias("day"), (F.col("live") > 0).alias("present"), *VALUES).persist(StorageLevel.MEMORY_AND_DISK)

    # first days
    firsts = _latest(_table(spark, path, "vehicles", read), "vehicles").select("vin", F.col("first_day").alias("old"))
    moved = now.groupBy("vin").agg(F.min(F.when(F.col("present"), F.col("day"))).alias("low")).join(firsts, "vin", "left")
    lost = firsts.join(now.where(~F.col("present")).select("vin", F.col("day").alias("old")), ["vin", "old"], "left_semi").select("vin") if again else None
    if again and lost.limit(1).count():  # the first day itself went: look through these vehicles' other days
        others = _latest(_table(spark, path, "days", read).join(lost, "vin", "left_semi"), "days").where("present")
        others = others.join(now.select("vin", "day"), ["vin", "day"], "left_anti").groupBy("vin").agg(F.min("day").alias("other"))
        moved = moved.join(lost.withColumn("lost", F.lit(True)), "vin", "left").join(others, "vin", "left")
    else:
        moved = moved.withColumn("lost", F.lit(None).cast("boolean")).withColumn("other", F.lit(None).cast("date"))
    moved = moved.select("vin", "old", F.least("low", F.when(F.col("lost").isNull(), F.col("old")), "other").alias("new")).persist(StorageLevel.MEMORY_AND_DISK)
    changed = moved.where(~F.col("old").eqNullSafe(F.col("new")))
    _write(changed.select("vin", F.col("new").alias("first_day")), path, "vehicles", version)

    # each (vin, month) is folded again from its first day that changed
    ends = changed.select("vin", F.explode(F.array("old", "new")).alias("day")).where("day IS NOT NULL")
    places = now.select("vin", month("day").alias("month")).unionByName(ends.select("vin", month("day").alias("month")))
    months = sorted(r[0] for r in places.select("month").distinct().collect())
    state = _of(_table(spark, path, "days", read, months), places, few and bool(read))
    fresh = now.select("vin", "day", "present", *VALUES, F.lit(None).cast(_RUN.split(" ", 1)[1]).alias("run"), F.lit(version).cast("bigint").alias("version"), month("day").alias("month"))
    days = _latest(state.unionByName(fresh).repartition("vin"), "days").groupBy("vin", "month").agg(
        F.collect_list(F.when(F.col("present"), F.struct("day", *VALUES, "run"))).alias("days"), F.min(F.when(F.col("version") == version, F.col("day"))).alias("since"))
    end = lambda c: F.when(~F.col("old").eqNullSafe(F.col("new")) & (month(c) == F.col("month")), F.col(c))
    groups = days.join(moved, "vin").withColumn("since", F.least("since", end("old"), end("new"))).where("since IS NOT NULL")
    out = _month_so_far(groups.select("vin", "month", "days", "since", F.col("new").alias("first_day"))).withColumn("present", F.lit(True))
    if again:
        out = out.unionByName(fresh.where(~F.col("present")).drop("version"))
    _write(out, path, "days", version)
    _commit(spark, path, version, False, batches, max([*known, *batches], default=None), months)
    now.unpersist()
    moved.unpersist()
    return version


def compact(spark: SparkSession, path: str) -> int:
    """The current rows as one version that readers start from. Readers that opened earlier versions
    keep their files; nothing is deleted here."""
    newest, read, known = _log(spark, path)
    version = newest + 1
    for name in _TABLES:
        rows = _latest(_table(spark, path, name, read), name)
        _write(rows.where(_CURRENT[name]).drop("version"), path, name, version)
    _commit(spark, path, version, True, known, max(known, default=None), [])
    return version


# ---------------------------------------------------------------- reading
def _present(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame, Column]:
    """Present days and first days, both dealt by vehicle, and the last day."""
    _, read, known = _log(spark, path)
    days = _latest(_table(spark, path, "days", read, months).repartition("vin"), "days").where("present")
    end = F.lit(max(known, default=None)).cast("date")
    firsts = _latest(_table(spark, path, "vehicles", read), "vehicles").where(F.col("first_day") <= end).select("vin", "first_day")
    return days, firsts, end


def daily(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """(vin, day, values) for every day of a vehicle from its first day to the last batch, of
    ``months`` if given: a missing day has nulls (R3). Each present day, and the first day, is
    followed by the missing days up to the next."""
    days, firsts, end = _present(spark, path, months)
    none = [F.lit(None).cast("bigint" if c == "speed_n" else "double").alias(c) for c in VALUES]
    rows = days.where(F.col("day") <= end).select("vin", "day", *VALUES, "present").unionByName(
        firsts.select("vin", F.col("first_day").alias("day"), *none, F.lit(False).alias("present")))
    rows = rows.withColumn("until", F.coalesce(F.date_sub(F.lead("day").over(Window.partitionBy("vin").orderBy("day", "present")), 1), end))
    each = F.explode(F.sequence("since", "until", F.expr("INTERVAL 1 DAY")))
    rows = rows.where(F.col("day") <= F.col("until")).withColumnRenamed("day", "since").withColumn("day", each)
    rows = rows if months is None else rows.where(F.date_format("day", "yyyy-MM").isin(list(months)))
    here = F.col("present") & (F.col("day") == F.col("since"))
    return rows.select("vin", "day", *[F.when(here, F.col(c)).alias(c) for c in VALUES], here.alias("present"))


def hourly(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """(vin, time_label, values): the hours that have rows, and 24 hours of nulls for each day that a
    known vehicle is missing (R3)."""
    _, read, known = _log(spark, path)
    rows = _table(spark, path, "arrivals", read, months).where(F.col("freq") == "hourly")
    rows = rows.where(F.to_date(F.substring("label", 1, 10)) <= F.lit(max(known, default=None)).cast("date"))
    rows = _latest(rows.repartition("vin", "label"), "arrivals").where(~F.col("deleted"))
    have = _combine(rows, ("vin", "label")).withColumnRenamed("label", "time_label")
    gaps = daily(spark, path, months).where(~F.col("present")).select("vin", F.date_format("day", "yyyy-MM-dd").alias("date"))
    gaps = gaps.select("vin", "date", F.explode(F.array(*[F.lit(f" {h:02d}:00:00") for h in range(24)])).alias("hour"))
    gaps = gaps.select("vin", F.concat("date", "hour").alias("time_label"),
                       *[F.lit(None).cast("double").alias(c) for c in VALUES[:3]], F.lit(0).cast("bigint").alias("speed_n"))
    return have.select("vin", "time_label", *VALUES).unionByName(gaps)


def monthly(spark: SparkSession, path: str, months: Sequence[str] | None = None) -> DataFrame:
    """(vin, month, values): each month's last month-so-far; a month without a day has nulls."""
    days, firsts, end = _present(spark, path, months)
    last = days.groupBy("vin", "month").agg(*[F.max_by(f"run.{x}", "day").alias(x) for x in _RUN_FIELDS])
    dense = firsts.select("vin", F.explode(F.sequence(F.trunc("first_day", "month"), F.trunc(end, "month"), F.expr("INTERVAL 1 MONTH"))).alias("m"))
    dense = dense.select("vin", F.date_format("m", "yyyy-MM").alias("month"), F.date_format("m", "yyyy-M").alias("time_label"))
    if months is not None:
        dense = dense.where(F.col("month").isin(list(months)))
    return dense.join(last, ["vin", "month"], "left").select(
        "vin", "month", "time_label", (F.col("miles") / 1_000_000).alias("distance_driven"), (F.col("hours") / 1_000_000).alias("charging_hours"),
        F.col("avg").alias("speed_average"), F.coalesce("n", F.lit(0).cast("bigint")).alias("speed_n"))


def _long(df: DataFrame, freq: str) -> DataFrame:
    e = F.explode(F.array(*[
        F.struct(F.lit(stat).alias("stat"), r6(c).alias("value"), (F.coalesce("speed_n", F.lit(0).cast("bigint")) if c == "speed_average" else F.lit(None).cast("bigint")).alias("weight"))
        for stat, c in (("miles_driven", "distance_driven"), ("charging_hours", "charging_hours"), ("average_speed", "speed_average"))])).alias("r")
    return df.select("vin", "time_label", e).select("vin", "r.stat", F.lit(freq).alias("freq"), "time_label", "r.value", "r.weight")


def long_rows(spark: SparkSession, path: str, months: Sequence[str] | None = None, freqs: Sequence[str] = ("daily", "hourly", "monthly")) -> DataFrame:
    """(vin, stat, freq, time_label, value, weight) as stat documents hold them
    (:func:`ampwise.operators.rollup.stat_documents`)."""
    parts = {"daily": lambda: daily(spark, path, months).withColumn("time_label", F.date_format("day", "yyyy-MM-dd")),
             "hourly": lambda: hourly(spark, path, months), "monthly": lambda: monthly(spark, path, months)}
    out = None
    for f in freqs:
        p = _long(parts[f](), f)
        out = p if out is None else out.unionByName(p)
    return out
