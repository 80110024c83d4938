"""Trips as a stream with B1's break and B2's distance rule, by keyed state and timers.

:mod:`ampwise.streaming.trips_stream` closes session windows, which know a trip's
ends but not the steps between its records. Here each vehicle keeps two things in
the state store: the records that the watermark has not passed yet (they may still
be overtaken by older ones), and a summary of the open trip. When the watermark
moves on, the records it has passed are taken in their order: a record more than
``max_gap_s`` whole seconds after the last one closes the trip and opens the next;
any other adds its step to the distance, unless the step is a jump (B2). A trip
without a further record is closed once the watermark lies so far behind its last
record that none can join. Both moments are event-time timers. Closed trips of two
or more records are emitted once, in append mode, with the columns of
:func:`ampwise.operators.trips.trips` (but for the trip's number).

State per vehicle is the records of one watermark delay and one summary, whatever
the history. It lives in the RocksDB state store and, like the sink's and the
source's progress, in the checkpoint folder, so a restarted query goes on where it
was. Records older than the watermark are dropped and counted
(:func:`ampwise.streaming.trips_stream.count_late_rows`).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from ..functions import predicates as P
from ..functions.scalar import duration_text, gap_seconds, r6
from ..operators.distance import JUMP_THRESHOLD
from ..operators.trips import TRIP_GAP_S
from ..session import checkpoint_dir

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_RECORD = "us bigint, event_id bigint, lat double, lon double, odo double"
_OPEN = ("n bigint, start_us bigint, start_lat double, start_lon double, last_us bigint, last_lat double, last_lon double, "
         "last_odo double, valid bigint, steps double")
_CLOSED = ("vin {vin}, n_records bigint, start_us bigint, end_us bigint, start_lat double, start_lon double, end_lat double, "
           "end_lon double, valid bigint, steps double")


class TripState(StatefulProcessor):
    """One vehicle's waiting records and open trip."""

    def __init__(self, max_gap_s: int, jump: float) -> None:
        self.gap, self.jump = max_gap_s, jump

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _RECORD)
        self.open = handle.getValueState("open", _OPEN)

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        new = [r for pdf in rows for r in zip(*(_plain(pdf[c]) for c in ("us", "event_id", "lat", "lon", "odo")))]
        yield from self._advance(key, new, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        yield from self._advance(key, [], timerValues)

    def close(self) -> None:
        pass

    def _advance(self, key, new: list, timers) -> Iterator:
        import pandas as pd
        passed = timers.getCurrentWatermarkInMs() * 1000
        rows = [tuple(r) for r in self.waiting.get()] + new if self.waiting.exists() else new
        ready = sorted((r for r in rows if r[0] < passed), key=lambda r: (r[0], r[1]))
        later = [r for r in rows if r[0] >= passed]
        trip = list(self.open.get()) if self.open.exists() else None
        closed = []
        for us, _, lat, lon, odo in ready:
            if trip is not None and (us - trip[4]) // 1_000_000 <= self.gap:
                trip[0] += 1
                if odo is not None and odo > 0:
                    trip[8] += 1
                    if trip[7] is not None and abs(odo - trip[7]) < self.jump:
                        trip[9] += odo - trip[7]
                trip[4:8] = us, lat, lon, odo
            else:
                if trip is not None:
                    closed.append(trip)
                trip = [1, us, lat, lon, us, lat, lon, odo, int(odo is not None and odo > 0), 0.0]
        # a record at the watermark or after it can't join any more
        if trip is not None and (passed - trip[4]) // 1_000_000 > self.gap:
            closed.append(trip)
            trip = None
        self.open.update(tuple(trip)) if trip is not None else self.open.clear()
        self.waiting.put(later) if later else self.waiting.clear()
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        due = [min(r[0] for r in later) // 1000 + 1] if later else []
        if trip is not None:
            due.append(trip[4] // 1000 + (self.gap + 1) * 1000 + 1)
        if due:
            self.handle.registerTimer(max(min(due), passed // 1000 + 1))
        done = [t for t in closed if t[0] > 1]
        if done:
            yield pd.DataFrame([(key[0], t[0], t[1], t[4], t[2], t[3], t[5], t[6], t[8], t[9]) for t in done],
                               columns=["vin", "n_records", "start_us", "end_us", "start_lat", "start_lon", "end_lat", "end_lon", "valid", "steps"])


def _plain(column) -> list:
    """Python values, None for missing ones."""
    return [None if x != x else x for x in column.tolist()]


def stream_trips(stream: DataFrame, max_gap_s: int = TRIP_GAP_S, watermark: str = "1 hour", jump: float = JUMP_THRESHOLD) -> DataFrame:
    """B1 with B2 over a stream of canonical records (see the module text)."""
    rows = stream.where(P.driving() & P.valid_coordinates() & F.col("ts").isNotNull())
    us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("ts"))
    rows = rows.select("vin", F.col("ts").cast("timestamp").alias("_t"), us.alias("us"), "event_id", "lat", "lon", F.col("odo").cast("double").alias("odo"))
    closed = rows.withWatermark("_t", watermark).groupBy("vin").transformWithStateInPandas(
        statefulProcessor=TripState(max_gap_s, jump), outputStructType=_CLOSED.format(vin=stream.schema["vin"].dataType.simpleString()),
        outputMode="Append", timeMode="EventTime")
    at = lambda c: F.timestamp_add("MICROSECOND", F.col(c), F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"))
    secs = gap_seconds("start_time", "end_time")
    return (closed.select("vin", "n_records", at("start_us").alias("start_time"), at("end_us").alias("end_time"), "start_lat", "start_lon", "end_lat", "end_lon",
                          r6(F.when(F.col("valid") > 0, F.abs(F.col("steps")))).alias("distance"))
            .withColumn("dura_sec", secs).withColumn("duration", r6(secs / 3600.0)).withColumn("duration_text", duration_text(secs))
            .withColumn("day", F.to_date("start_time")))


def start(spark: SparkSession, stream: DataFrame, sink_path: str, name: str, available_now: bool = True) -> StreamingQuery:
    """Append the closed trips of ``stream`` (:func:`stream_trips`) to Parquet at ``sink_path``; the
    checkpoint is kept below the shared folder under ``name``. Sets the session's state store to
    RocksDB, which keyed state with timers needs."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STORE)
    ckpt = f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"
    w = stream.writeStream.outputMode("append").format("parquet").option("path", sink_path).option("checkpointLocation", ckpt).queryName(name)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
