"""Publishing day-partitioned results and the batch ledger (SURVEY 2.2 K1-K8,
K12-K15; 2.9 R5, R7-R9; P22).

Tables are datasource (parquet) tables partitioned by ``day``; replacing a
day is a dynamic partition overwrite, so a re-run rewrites only the days it
produces and a failed job leaves the previous files (the commit protocol
publishes a job's files only when every task succeeded). The ledger is a
small table ``(job, day, status, n_rows, written_at)``; days are skipped with
an anti join against it, never by listing files on the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import reliable_checkpoint

LEDGER_SCHEMA = "job string, day date, status string, n_rows bigint, written_at timestamp"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"   # fixed value of the reference's exports


def _quote(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


# ---------------------------------------------------------------- K1 / K11 / K8
def write_csv(df: DataFrame, path: str, timestamp_format: str = TIMESTAMP_FORMAT, mode: str = "overwrite") -> None:
    """CSV with a header and a fixed timestamp format."""
    (df.write.mode(mode).option("header", True).option("timestampFormat", timestamp_format)
       .option("timestampNTZFormat", timestamp_format).csv(path))


def split_by_vehicle(df: DataFrame, path: str, keys: Sequence[str] = ("vintype", "vin")) -> None:
    """K8: one directory per model and vehicle; rows are first clustered on
    the same keys so each task writes few files. The clustering is a rebalance:
    adaptive execution splits a vehicle with many rows over several tasks."""
    df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys).option("header", True).csv(path)


# ---------------------------------------------------------------- K4 / K2 / K3 / K5 / K6
def create_table(df: DataFrame, table: str, partition_by: Sequence[str] = ("day",), mode: str = "overwrite") -> None:
    """K4: create (or replace / append to) a partitioned table."""
    df.write.mode(mode).format("parquet").partitionBy(*partition_by).saveAsTable(table)


def create_clustered(df: DataFrame, table: str, buckets: int, keys: Sequence[str] = ("vin", "day"),
                     order: Sequence[str] = ("ts", "event_id"), mode: str = "overwrite") -> None:
    """K4/K8 for records: a table bucketed by vehicle and day and sorted inside. Jobs over it whose
    windows and groups contain both (trips, periods; statistics with ``keys=("vin", "day")``) need no
    exchange of records. Rows are dealt to the buckets before the write, so each bucket is one file
    and its sort order holds; a vehicle with very many records is spread over its days."""
    (df.repartition(buckets, *keys).write.mode(mode).format("parquet").bucketBy(buckets, *keys).sortBy(*keys, *order).saveAsTable(table))


def overwrite_days(df: DataFrame, table: str) -> None:
    """K2: replace exactly the ``day`` partitions present in ``df`` (dynamic
    partition overwrite); creates the table on first use."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        create_table(df, table)
        return
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    cols = spark.table(table).columns
    df.select(*cols).write.insertInto(table, overwrite=True)


def insert_overwrite_day(spark: SparkSession, table: str, view: str, day: str, columns: Sequence[str]) -> None:
    """K2 in SQL form: ``INSERT OVERWRITE ... PARTITION (day='...')`` from a view."""
    cols = ", ".join(f"`{c}`" for c in columns if c != "day")
    spark.sql(f"INSERT OVERWRITE TABLE {_quote(table)} PARTITION (day = DATE'{day}') SELECT {cols} FROM {view}")


def append_day(spark: SparkSession, table: str, view: str, day: str, columns: Sequence[str]) -> None:
    """K3: ``INSERT INTO ... PARTITION (day='...')``."""
    cols = ", ".join(f"`{c}`" for c in columns if c != "day")
    spark.sql(f"INSERT INTO TABLE {_quote(table)} PARTITION (day = DATE'{day}') SELECT {cols} FROM {view}")


def replace_table_as_select(spark: SparkSession, table: str, select_sql: str) -> None:
    """K5: replace a whole table by a query's result. The rows are complete
    (checkpointed) before the old table goes, so a failing query leaves it."""
    rows = reliable_checkpoint(spark.sql(select_sql))
    rows.write.mode("overwrite").format("parquet").saveAsTable(table)


def delete_day(spark: SparkSession, table: str, day: str) -> None:
    """K6: remove one day. Datasource tables reject ``DELETE``; the day's
    partition is dropped instead (its files go with it)."""
    spark.sql(f"ALTER TABLE {_quote(table)} DROP IF EXISTS PARTITION (day = DATE'{day}')")


def register_view(df: DataFrame, name: str) -> DataFrame:
    """K12."""
    df.createOrReplaceTempView(name)
    return df


# ---------------------------------------------------------------- K13 / K14 / K15
def day_counts(df: DataFrame, day: str = "day") -> DataFrame:
    """Rows per partition value."""
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("n_rows"))


def single_day(df: DataFrame, day: str = "day") -> str:
    """The batch's only ``day`` value; raises when it holds none or several
    (one scalar aggregate, checked before publishing)."""
    r = df.agg(F.count_distinct(day).alias("n"), F.min(day).alias("d")).first()
    if r["n"] != 1:
        raise ValueError(f"expected exactly one {day} in the batch, found {r['n']}")
    return str(r["d"])


def append_rows(df: DataFrame, path: str) -> None:
    """Set-based append of a whole result (instead of one row at a time)."""
    df.write.mode("append").parquet(path)


# ---------------------------------------------------------------- ledger
def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The batch ledger at ``path`` (empty when it does not exist yet)."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except AnalysisException as e:  # a missing ledger is an empty ledger; anything else is an error
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def record(spark: SparkSession, path: str, job: str, counts: DataFrame, status: str = "done") -> None:
    """Append one ledger row per written day (``counts`` from :func:`day_counts`
    of the rows actually written)."""
    rows = counts.select(F.lit(job).alias("job"), F.col("day").cast("date").alias("day"),
                         F.lit(status).alias("status"), F.col("n_rows").cast("long").alias("n_rows"),
                         F.current_timestamp().alias("written_at"))
    rows.write.mode("append").parquet(path)


def pending_days(days: DataFrame, ledger_df: DataFrame, job: str, force: bool = False) -> DataFrame:
    """Days not yet done for ``job`` (anti join); ``force`` redoes all."""
    if force:
        return days
    done = ledger_df.where((F.col("job") == job) & (F.col("status") == "done")).select("day")
    return days.join(done, "day", "left_anti")


def day_range(spark: SparkSession, start: str, end: str, descending: bool = False) -> DataFrame:
    """The inclusive list of days as a one-column DataFrame."""
    seq = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    out = spark.range(1).select(F.explode(seq).alias("day"))
    return out.orderBy(F.col("day").desc()) if descending else out


def high_water_mark(ledger_df: DataFrame, job: str) -> DataFrame:
    """The last day successfully published for ``job`` (max of the days
    actually written, deviation D13), as a one-row DataFrame."""
    return ledger_df.where((F.col("job") == job) & (F.col("status") == "done")) \
                    .agg(F.max("day").alias("last_day"))


def newer_than_mark(df: DataFrame, ledger_df: DataFrame, job: str, day: str = "day") -> DataFrame:
    """Rows after the high-water mark (all rows when there is none)."""
    mark = high_water_mark(ledger_df, job).first()["last_day"]
    return df if mark is None else df.where(F.col(day) > F.lit(mark))


class ObservedDays(NamedTuple):
    """Rows that tell their days while they are written."""

    rows: DataFrame
    seen: Observation

    def days(self) -> set[dt.date]:
        """The days of the rows, once these have been written."""
        return set(self.seen.get["days"])


def observed_days(df: DataFrame) -> ObservedDays:
    """``df`` with its set of days observed (:meth:`DataFrame.observe`): as many values as days, and
    a task that ran twice changes nothing."""
    seen = Observation()
    return ObservedDays(df.observe(seen, F.collect_set(F.col("day").cast("date")).alias("days")), seen)


def publish_days(df: DataFrame, table: str, ledger_path: str, job: str,
                 days: Sequence | None = None, before_ledger: Callable[[], None] | None = None) -> DataFrame:
    """K2 + K13 + R7: replace the batch's days; count the rows of those
    partitions before and after (read back from the table, pruned to the
    batch's days: file footers, no rows); record the after counts in the ledger, only after the write
    committed. ``days`` names the batch's days: then ``df`` is computed once, by the write, and the
    days that it holds are observed on the way (:meth:`DataFrame.observe`; a set of days, so a task
    that ran twice changes nothing). Without it they are the days found in ``df``, which is
    checkpointed to be computed once. A day of the
    batch without rows loses its old partition and is recorded with 0 rows. ``before_ledger`` runs
    between the write and the ledger, for what has to be there once the ledger says done.
    Returns ``day, n_rows_before, n_rows`` (one row per day of the batch)."""
    spark = df.sparkSession
    if days is None:
        df = reliable_checkpoint(df)
        days = [r[0] for r in df.select("day").distinct().collect()]
    wanted = sorted({d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)) for d in days})
    seen = observed_days(df)

    def batch_counts():
        t = spark.table(table).where(F.col("day").isin([F.lit(d) for d in wanted]))
        return {r["day"]: r["n_rows"] for r in day_counts(t).collect()}

    before = batch_counts() if spark.catalog.tableExists(table) else {}
    overwrite_days(seen.rows, table)
    for d in sorted(set(before) - seen.days()):
        delete_day(spark, table, d.isoformat())
    after = batch_counts()
    rows = [(d, before.get(d, 0), after.get(d, 0)) for d in wanted]
    out = spark.createDataFrame(rows, "day date, n_rows_before long, n_rows long")
    if before_ledger is not None:
        before_ledger()
    record(spark, ledger_path, job, out)
    return out
