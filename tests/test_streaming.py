"""Streaming trip sessions against the batch trips on the same rows."""

import datetime as dt
import os

from pyspark.sql import functions as F

from ampwise.operators import trips
from ampwise.sources import fixture
from ampwise.streaming import trips_stream

SF = "/root/testdata/sf0.001"
GAP_S = 8 * 3600


def test_stream_sessions_match_batch_trips(spark, tmp_out):
    t = fixture.telemetry(spark, SF)
    src = os.path.join(tmp_out, "src")
    # files arrive one day at a time
    t.repartition("day").write.partitionBy("day").parquet(src)
    flat = os.path.join(tmp_out, "flat")
    spark.read.parquet(src).write.parquet(flat)
    schema = spark.read.parquet(flat).schema
    sink = os.path.join(tmp_out, "sink")
    counted = trips_stream.count_late_rows(spark, f"ts_{os.path.basename(tmp_out)}")
    q = trips_stream.start_trip_stream(spark, flat, schema, sink, name=f"ts_{os.path.basename(tmp_out)}",
                                       gap=f"{GAP_S} seconds", watermark="1 day")
    q.awaitTermination(300)
    assert counted.total == 0
    spark.streams.removeListener(counted)
    got = spark.read.parquet(sink)
    batch = trips.trips(t, max_gap_s=GAP_S)
    key = ["vin", "start_time", "end_time", "n_records"]
    # every emitted session is a batch trip; a trip is still open (not yet
    # emitted in append mode) only if its session end, last record + gap, is
    # after the final watermark (newest driving record - 1 day)
    emitted = {tuple(r) for r in got.select(*key).collect()}
    expected = {tuple(r) for r in batch.select(*key).collect()}
    assert emitted and emitted <= expected
    newest = t.where("odo > 0").agg(F.max("ts")).first()[0]
    watermark = newest - dt.timedelta(days=1)
    missing = expected - emitted
    assert all(e + dt.timedelta(seconds=GAP_S) > watermark for _, _, e, _ in missing)
    assert len(emitted) > len(missing)


def test_stream_counts_rows_later_than_watermark(spark, tmp_out):
    import time
    t = fixture.telemetry(spark, SF).where("odo > 0 AND charge_cur IS NOT NULL AND charge_cur < 0.1 "
                                           "AND (charge_st IS NULL OR charge_st = 0)")
    src = os.path.join(tmp_out, "src")
    newest = t.agg(F.max("day")).first()[0]
    # first batch: the last days; second batch: records from two weeks earlier
    t.where(F.col("day") >= F.lit(newest - dt.timedelta(days=3))).write.parquet(os.path.join(src, "a"))
    schema = spark.read.parquet(os.path.join(src, "a")).schema
    ckpt = os.path.join(tmp_out, "ckpt")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(os.path.join(src, "*"))
    counted = trips_stream.count_late_rows(spark, f"late_{os.path.basename(tmp_out).replace('-', '_')}")
    q = (trips_stream.trip_sessions(stream, gap="600 seconds", watermark="1 hour")
         .writeStream.outputMode("append").format("memory").queryName(f"late_{os.path.basename(tmp_out).replace('-', '_')}")
         .option("checkpointLocation", ckpt).start())
    q.processAllAvailable()
    t.where(F.col("day") <= F.lit(newest - dt.timedelta(days=14))).write.parquet(os.path.join(src, "b"))
    time.sleep(1)
    q.processAllAvailable()
    q.stop()
    for _ in range(50):  # progress reaches listeners a little later
        if counted.total:
            break
        time.sleep(0.2)
    spark.streams.removeListener(counted)
    assert counted.total > 0


def test_stream_from_raw_text_lines(spark, tmp_out):
    from ampwise.sources import raw
    lines = fixture.raw_lines_a(spark, SF)
    src = os.path.join(tmp_out, "text")
    lines.select("value").write.text(src)
    sink = os.path.join(tmp_out, "sink")
    q = trips_stream.start_trip_stream(spark, src, None, sink, name=f"tx_{os.path.basename(tmp_out)}",
                                       gap=f"{GAP_S} seconds", watermark="1 day", source_format="text_a")
    q.awaitTermination(300)
    got = {tuple(r) for r in spark.read.parquet(sink).select("vin", "start_time", "end_time", "n_records").collect()}
    batch = trips.trips(raw.parse_schema_a(lines), max_gap_s=GAP_S)
    want = {tuple(r) for r in batch.select("vin", "start_time", "end_time", "n_records").collect()}
    assert got and got <= want


def _closed(rows, watermark, gap):
    """Batch trips that no record at the watermark or later can join."""
    return {tuple(r) for r in rows if (watermark - r["end_time"]).total_seconds() // 1 > gap}


def test_stateful_trips_equal_batch_trips_across_a_restart(spark, tmp_out):
    """Keyed state with timers: distance by the jump rule, files out of order within the watermark,
    the query stopped between files and started again on its checkpoint."""
    from ampwise.streaming import trip_state
    t = fixture.telemetry(spark, SF).where("vin < 40")
    src, sink, name = os.path.join(tmp_out, "src"), os.path.join(tmp_out, "sink"), f"st_{os.path.basename(tmp_out)}"
    schema = t.schema
    cols = ["vin", "start_time", "end_time", "n_records", "start_lat", "end_lon", "distance", "duration_text"]
    cuts = [dt.date(2024, 1, 20), dt.date(2024, 2, 25), dt.date(2024, 4, 30)]
    lo = dt.date(2023, 12, 1)
    for cut in cuts:
        part = t.where((F.col("day") >= F.lit(lo)) & (F.col("day") < F.lit(cut)))
        # records of the part come in any order, in two files
        part.repartition(2, F.hash("event_id")).write.mode("append").parquet(src)
        stream = trip_state.stream_trips(spark.readStream.schema(schema).parquet(src), max_gap_s=GAP_S, watermark="3 days")
        q = trip_state.start(spark, stream, sink, name)
        q.awaitTermination(300)
        assert q.exception() is None
        lo = cut
    got = spark.read.parquet(sink).select(*cols).collect()
    newest = t.where("odo > 0 AND charge_cur < 0.1").agg(F.max("ts")).first()[0]
    batch = trips.trips(t, max_gap_s=GAP_S).select(*cols).collect()
    emitted = {tuple(r) for r in got}
    assert len(emitted) == len(got)  # each trip once
    # all of them are batch trips, and none that could be closed is missing
    assert emitted <= {tuple(r) for r in batch}
    assert _closed(batch, newest - dt.timedelta(days=4), GAP_S) <= emitted and len(emitted) > 20
    assert any(r["distance"] for r in got)


def test_stats_stream_counts_each_record_once_after_crashes(spark, tmp_out):
    """Files out of order with records delivered twice; the query dies after each step of a batch and
    is started again; the table equals the batch statistics."""
    from ampwise.operators import stats
    from ampwise.plans import publish
    from ampwise.streaming import stats_stream
    t = fixture.telemetry(spark, SF).where("vin < 15")
    src, tag = os.path.join(tmp_out, "src"), os.path.basename(tmp_out).replace("-", "_")
    records, ledger, table, name = os.path.join(tmp_out, "records"), os.path.join(tmp_out, "ledger"), f"ss_{tag}", f"ss_{tag}"
    fail = {"after": None}

    def dying(df, n, *rest):
        if fail["after"] == "all":
            stats_stream.merge_batch(df, n, *rest)
            raise RuntimeError("lost")
        if fail["after"] == "stats":
            keep, publish.record = publish.record, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost"))
            try:
                return stats_stream.merge_batch(df, n, *rest)
            finally:
                publish.record = keep
        return stats_stream.merge_batch(df, n, *rest)

    def run():
        stream = spark.readStream.schema(t.schema).parquet(src)
        q = stats_stream.start(spark, stream, records, table, ledger, name, watermark="400 days", merge=dying)
        try:
            q.awaitTermination(300)
        except Exception as e:  # noqa: BLE001 - the planted failure
            assert "lost" in str(e)

    halves = [t.where("event_id % 2 = 0"), t.where("event_id % 2 = 1 OR event_id % 10 = 0")]  # some records in both
    for half, step in zip(halves, ("stats", "all")):
        half.repartition(1).write.mode("append").parquet(src)
        fail["after"] = step
        run()
        fail["after"] = None
        run()
    cols = ["vin", "time_label", "n_records", "distance_driven", "charging_hours", "speed_average"]
    got = sorted(map(str, spark.table(table).select(*cols).collect()))
    assert got == sorted(map(str, stats.daily_stats(t).select(*cols).collect())) and len(got) > 100
    assert spark.read.parquet(records).count() == t.count()
    # a micro-batch enters the ledger once for each of its days
    assert publish.ledger(spark, ledger).groupBy("job", "day").count().where("count > 1").count() == 0
