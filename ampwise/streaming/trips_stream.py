"""Trips as a Structured Streaming job.

The reference is batch-only; this is the streaming form of trip
segmentation. Driving rows with a position are grouped per vehicle into
session windows: a session closes ``gap`` after its last record, which is
B1's break rule (``session_window`` treats a gap of exactly ``gap`` like the
batch rule; the batch rule truncates gaps to whole seconds first). One-row
sessions are dropped like one-row trips. Sessions are emitted once the
watermark passes their end (append mode), and rows older than the watermark
are dropped by Spark and reported as late through the query progress
(``numRowsDroppedByWatermark``), the streaming counterpart of A22;
:func:`count_late_rows` adds them up.

The stream keeps only per-(vehicle, open session) aggregation state, so state
grows with the number of active vehicles, not with history. Its checkpoint
lives under the cluster's shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..functions import predicates as P
from ..functions.scalar import gap_seconds
from ..session import checkpoint_dir


def trip_sessions(stream: DataFrame, gap: str = "600 seconds", watermark: str = "1 hour") -> DataFrame:
    """Streaming B1: per vehicle and session, start/end time and position,
    record count, odometer at both ends and the span between them."""
    rows = stream.where(P.driving() & P.valid_coordinates()) \
                 .withColumn("_t", F.col("ts").cast("timestamp"))
    okey = F.struct(F.col("_t"), F.col("event_id"))
    agg = (rows.withWatermark("_t", watermark)
           .groupBy("vin", F.session_window("_t", gap).alias("session"))
           .agg(F.count(F.lit(1)).alias("n_records"),
                F.min_by("ts", okey).alias("start_time"), F.max_by("ts", okey).alias("end_time"),
                F.min_by("lat", okey).alias("start_lat"), F.min_by("lon", okey).alias("start_lon"),
                F.max_by("lat", okey).alias("end_lat"), F.max_by("lon", okey).alias("end_lon"),
                F.min_by("odo", okey).alias("start_odo"), F.max_by("odo", okey).alias("end_odo")))
    return (agg.where(F.col("n_records") > 1)
            .withColumn("dura_sec", gap_seconds("start_time", "end_time"))
            .withColumn("odometer_span", F.col("end_odo") - F.col("start_odo"))
            .drop("session"))


def start_trip_stream(spark: SparkSession, source_dir: str, schema, sink_path: str,
                      name: str = "trip_sessions", gap: str = "600 seconds", watermark: str = "1 hour",
                      available_now: bool = True, source_format: str = "parquet") -> StreamingQuery:
    """Run :func:`trip_sessions` over files arriving in ``source_dir`` and
    append finished sessions to parquet at ``sink_path``. ``source_format``
    is ``parquet`` (canonical rows with ``schema``) or ``text_a`` (raw
    schema-A lines, parsed with :func:`ampwise.sources.raw.parse_schema_a`).
    With ``available_now`` the query processes what is there and stops."""
    from ..sources import raw
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    if source_format == "text_a":
        stream = raw.parse_schema_a(spark.readStream.text(source_dir))
    else:
        stream = spark.readStream.schema(schema).parquet(source_dir)
    w = (trip_sessions(stream, gap, watermark).writeStream.outputMode("append").format("parquet")
         .option("path", sink_path).option("checkpointLocation", ckpt).queryName(name))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


class LateRows(StreamingQueryListener):
    """Adds up the rows that a query dropped as later than its watermark, over
    all its progress from the time the listener is added (``recentProgress``
    keeps only the last batches). ``total`` holds the sum so far."""

    def __init__(self, name: str) -> None:
        self.name, self.total = name, 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name:
            self.total += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def count_late_rows(spark: SparkSession, name: str) -> LateRows:
    """Start counting the late rows of the query called ``name``; add it before the query starts."""
    listener = LateRows(name)
    spark.streams.addListener(listener)
    return listener
