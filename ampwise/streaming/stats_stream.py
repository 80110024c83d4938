"""Daily statistics as a stream into day partitions (A1/B8 with K2, R5, R7).

A micro-batch of records is made idempotent in three steps, each of which replaces
what an earlier attempt at the same micro-batch left:

1. its records are written below ``records`` as partitions (day, batch), by the
   batch's number;
2. the stat rows of the days it touched are computed anew from all records of these
   days and replace the table's day partitions (dynamic overwrite);
3. the batch's number enters the ledger.

A query that dies anywhere is started again with the same micro-batch by Structured
Streaming; a batch that the ledger marks done is passed over. So every record counts
once, and the table is at every time that of whole micro-batches. A line delivered
twice within the watermark is dropped by ``dropDuplicatesWithinWatermark``, later
copies by the stats themselves, which read a day's records as a whole and drop equal
ones. A late record of an earlier day changes that day's partition alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import stats
from ..plans import publish
from ..session import checkpoint_dir

#: What identifies a record: two lines with these in common are one record.
IDENTITY = ("vin", "ts", "event_id")


def once(stream: DataFrame, watermark: str = "2 days") -> DataFrame:
    """Records of the stream without those that came before within the watermark."""
    timed = stream.where(F.col("ts").isNotNull()).withColumn("_t", F.col("ts").cast("timestamp")).withWatermark("_t", watermark)
    return timed.dropDuplicatesWithinWatermark([*IDENTITY]).drop("_t")


def _records(spark: SparkSession, path: str, schema, days: list) -> DataFrame:
    """All records of ``days``, whichever batch brought them."""
    return spark.read.schema(schema).parquet(path).where(F.col("day").isin(days)).drop("batch")


def merge_batch(batch: DataFrame, number: int, records: str, table: str, ledger: str, job: str) -> bool:
    """Take one micro-batch into ``table``; False if the ledger has it already."""
    spark = batch.sparkSession
    done = publish.ledger(spark, ledger).where((F.col("job") == f"{job}:{number}") & (F.col("status") == "done"))
    if done.limit(1).count():
        batch.write.format("noop").mode("overwrite").save()  # the stream's state moves on only where its rows are taken
        return False
    rows = batch.withColumn("batch", F.lit(number).cast("bigint"))
    seen = publish.observed_days(rows)
    seen.rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch").parquet(records)
    days = sorted(seen.days())
    if days:
        schema = rows.schema
        daily = stats.daily_stats(_records(spark, records, schema, days), dedupe=True).where(F.col("day").isin(days))
        publish.overwrite_days(daily, table)
    counts = spark.createDataFrame([(d, 1) for d in days], "day date, n_rows long")
    publish.record(spark, ledger, f"{job}:{number}", counts if days else spark.createDataFrame([(None, 0)], "day date, n_rows long"))
    return True


def start(spark: SparkSession, stream: DataFrame, records: str, table: str, ledger: str, name: str = "daily_stats",
          watermark: str = "2 days", available_now: bool = True,
          merge: Callable[[DataFrame, int, str, str, str, str], bool] = merge_batch) -> StreamingQuery:
    """Run the stream of canonical ``records`` rows (vin, ts, day, event_id and signals) into ``table``."""
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    w = (once(stream, watermark).writeStream.foreachBatch(lambda df, n: merge(df, n, records, table, ledger, name) and None)
         .option("checkpointLocation", ckpt).queryName(name))
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
