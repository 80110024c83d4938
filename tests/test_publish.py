"""Sinks, table maintenance, ledger and file sources."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from ampwise.operators import rollup
from ampwise.plans import export, jobs, publish
from ampwise.sources import raw, schemas

D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def _rows(spark, rows):
    return spark.createDataFrame(rows, "vin string, value double, day date")


def test_overwrite_days_replaces_only_batch_days(spark, tmp_out):
    t = f"pub_{os.path.basename(tmp_out).replace('-', '_')}"
    publish.overwrite_days(_rows(spark, [("a", 1.0, D1), ("b", 2.0, D2)]), t)
    publish.overwrite_days(_rows(spark, [("c", 3.0, D2)]), t)
    got = sorted((r.vin, r.day) for r in spark.table(t).collect())
    assert got == [("a", D1), ("c", D2)]
    publish.delete_day(spark, t, "2024-01-01")
    assert [r.vin for r in spark.table(t).collect()] == ["c"]


def test_sql_partition_insert_and_ctas(spark, tmp_out):
    t = f"sqlpub_{os.path.basename(tmp_out).replace('-', '_')}"
    publish.create_table(_rows(spark, [("a", 1.0, D1)]), t)
    publish.register_view(spark.createDataFrame([("x", 5.0)], "vin string, value double"), "upd")
    publish.insert_overwrite_day(spark, t, "upd", "2024-01-02", ["vin", "value", "day"])
    publish.append_day(spark, t, "upd", "2024-01-02", ["vin", "value", "day"])
    counts = {r.day: r.n_rows for r in publish.day_counts(spark.table(t)).collect()}
    assert counts == {D1: 1, D2: 2}
    publish.replace_table_as_select(spark, t + "_agg", f"SELECT day, count(*) AS n FROM {t} GROUP BY day")
    assert spark.table(t + "_agg").count() == 2


def test_single_day_guard(spark):
    assert publish.single_day(_rows(spark, [("a", 1.0, D1)])) == "2024-01-01"
    with pytest.raises(ValueError):
        publish.single_day(_rows(spark, [("a", 1.0, D1), ("b", 1.0, D2)]))


def test_ledger_pending_days_and_high_water_mark(spark, tmp_out):
    path = os.path.join(tmp_out, "ledger")
    led = publish.ledger(spark, path)
    assert led.count() == 0
    days = publish.day_range(spark, "2024-01-01", "2024-01-04")
    assert days.count() == 4
    publish.record(spark, path, "daily", spark.createDataFrame([(D1, 3), (D2, 4)], "day date, n_rows long"))
    led = publish.ledger(spark, path)
    pend = sorted(r.day.isoformat() for r in publish.pending_days(days, led, "daily").collect())
    assert pend == ["2024-01-03", "2024-01-04"]
    assert publish.pending_days(days, led, "daily", force=True).count() == 4
    assert publish.high_water_mark(led, "daily").first().last_day == D2
    newer = publish.newer_than_mark(_rows(spark, [("a", 1.0, D1), ("b", 1.0, dt.date(2024, 1, 5))]), led, "daily")
    assert [r.vin for r in newer.collect()] == ["b"]


def test_publish_days_records_written_counts(spark, tmp_out):
    t = f"pd_{os.path.basename(tmp_out).replace('-', '_')}"
    path = os.path.join(tmp_out, "ledger")
    publish.publish_days(_rows(spark, [("a", 1.0, D1), ("b", 1.0, D1)]), t, path, "j")
    assert publish.high_water_mark(publish.ledger(spark, path), "j").first().last_day == D1


def test_csv_exports(spark, tmp_out):
    df = spark.createDataFrame([("a", "M1", dt.datetime(2024, 1, 1, 8, 5, 9))], "vin string, vintype string, ts timestamp_ntz")
    publish.write_csv(df, os.path.join(tmp_out, "csv"))
    text = "".join(open(f).read() for f in glob.glob(os.path.join(tmp_out, "csv", "*.csv")))
    assert "2024-01-01 08:05:09" in text and text.startswith("vin,vintype,ts")
    publish.split_by_vehicle(df, os.path.join(tmp_out, "split"))
    assert glob.glob(os.path.join(tmp_out, "split", "vintype=M1", "vin=a", "*.csv"))


def test_read_day_files_and_guard(spark, tmp_out):
    os.makedirs(os.path.join(tmp_out, "csv", "d=20180329"))
    os.makedirs(os.path.join(tmp_out, "by-day"))
    good = ",".join(["V1", "1522281600000", "20180329"] + [""] * 83)       # 86 fields
    short = ",".join(["V1"] * 84)
    with open(os.path.join(tmp_out, "csv", "d=20180329", "part-0.csv"), "w") as f:
        f.write(good + "\n" + short + "\n")
    with open(os.path.join(tmp_out, "by-day", "20171201.csv"), "w") as f:
        f.write(good[:-1] + "\n")                                           # 85 fields
    paths = raw.day_paths(tmp_out, ["20171201", "20180329"])
    lines = raw.read_day_files(spark, paths)
    days = sorted(r.file_day.isoformat() for r in lines.collect())
    assert days == ["2017-12-01", "2018-03-29", "2018-03-29"]
    ok, rejected = raw.guard(lines)
    assert ok.count() == 2
    assert [(r.n_fields, r.n_lines) for r in rejected.collect()] == [(84, 1)]
    parsed = raw.parse_schema_a(lines)
    r = parsed.orderBy("file_day").first()
    assert r.vin == "V1" and r.sdate == dt.date(2018, 3, 29) and r.soc is None


def test_clean_value_tokens(spark):
    df = spark.createDataFrame([("NaN",), ("NA",), ("NULL",), ("",), ("1.5",), ("abc",), ("nan",)], "x string")
    got = [r.v for r in df.select(raw.clean_value(F.col("x"), "double").alias("v")).collect()]
    assert got == [None, None, None, None, 1.5, None, None]


def test_header_config_csv(spark, tmp_out):
    cfg = [{"No": 1, "Column": "speed ", "Type": "numerical"}, {"No": 0, "Column": "vin", "Type": None},
           {"No": 2, "Column": "brake", "Type": "categorical"}, {"No": 3, "Column": "soc", "Type": "numeric"}]
    p = os.path.join(tmp_out, "h.csv")
    with open(p, "w") as f:
        f.write("V1,12.5,1,80\nV2,x,0,81\n")
    df = raw.read_header_csv(spark, p, cfg)
    assert df.columns == ["vin", "speed", "brake", "soc"]
    assert [r.speed for r in df.collect()] == [12.5, None]
    assert schemas.stat_plan_from_header_config(cfg) == {"speed": ("avg", "max", "min"),
                                                         "brake": ("histogram",), "soc": ("avg", "max", "min")}


def test_stat_documents_roundtrip(spark, tmp_out):
    long = spark.createDataFrame(
        [("V1", "miles_driven", "daily", "2024-01-01", 3.0, None),
         ("V1", "miles_driven", "daily", "2024-01-02", None, None),
         ("V1", "average_speed", "monthly", "2024-1", 40.0, 12)],
        "vin string, stat string, freq string, time_label string, value double, weight bigint")
    docs = rollup.stat_documents(long)
    docs.write.mode("overwrite").json(os.path.join(tmp_out, "docs"))
    back = rollup.read_stat_documents(spark, os.path.join(tmp_out, "docs"))
    got = sorted((r.stat, r.freq, r.time_label, r.value, r.weight) for r in back.collect())
    assert got == sorted([("miles_driven", "daily", "2024-01-01", 3.0, None),
                          ("miles_driven", "daily", "2024-01-02", None, None),
                          ("average_speed", "monthly", "2024-1", 40.0, 12)])


def test_index_documents(spark, tmp_out):
    df = spark.createDataFrame(
        [("V1", 0.0, "", 23.1, 113.2, None, 113.0, dt.datetime(2024, 1, 1, 8, 0, 0))] +
        [("V%d" % i, 1.5, "x", 23.0, 113.0, 23.0, 113.0, dt.datetime(2024, 1, 1, 8, 0, 0)) for i in range(24)],
        "vin string, distance double, note string, start_latitude double, start_longitude double, "
        "end_latitude double, end_longitude double, start_time timestamp_ntz")
    docs = export.documents(df, "trips")
    first = docs.first().value.split("\n")
    assert json.loads(first[0]) == {"index": {"_index": "trips", "_type": "doc"}}
    d = json.loads(first[1])
    assert d == {"vin": "V1", "distance": 0.0, "start_time": "2024-01-01 08:00:00",
                 "start_location": {"lat": 23.1, "lon": 113.2}}
    export.write_documents(docs.coalesce(1), os.path.join(tmp_out, "idx"), per_file=10)
    sizes = sorted(sum(1 for _ in open(f)) // 2 for f in glob.glob(os.path.join(tmp_out, "idx", "part-*")))
    assert sizes == [5, 10, 10]


def _write_day(root, day, lines, hive=True):
    if hive:
        d = os.path.join(root, "csv", f"d={day}")
        os.makedirs(d, exist_ok=True)
        path = os.path.join(d, "part-00000.csv")
    else:
        os.makedirs(os.path.join(root, "by-day"), exist_ok=True)
        path = os.path.join(root, "by-day", f"{day}.csv")
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def test_jobs_end_to_end(spark, tmp_out):
    from ampwise.plans import jobs
    from ampwise.sources import fixture
    # schema-A day files built from the fixture lines, one file per day
    lines = fixture.raw_lines_a(spark, "/root/testdata/sf0.001").collect()
    by_day = {}
    for r in lines:
        by_day.setdefault(r.file_day.strftime("%Y%m%d"), []).append(r.value)
    root = os.path.join(tmp_out, "raw")
    for i, (d, ls) in enumerate(sorted(by_day.items())):
        _write_day(root, d, ls, hive=i % 2 == 0)
    ledger = os.path.join(tmp_out, "ledger")
    tag = os.path.basename(tmp_out).replace("-", "_")
    table = f"daily_{tag}"
    first = jobs.daily_stats_job(spark, root, "2024-01-01", "2024-01-10", table, ledger)
    assert first.count() > 0
    again = jobs.daily_stats_job(spark, root, "2024-01-01", "2024-01-10", table, ledger)   # R5: all done
    assert again.count() == 0
    none = jobs.daily_stats_job(spark, root, "2025-06-01", "2025-06-03", table, ledger)   # no files: skipped
    assert none.count() == 0
    jobs.daily_stats_job(spark, root, "2024-01-01", "2024-04-10", table, ledger)
    # the published table equals the stats computed on all records at once
    from ampwise.operators import stats as S
    from ampwise.sources import raw as R
    direct = S.period_stats(R.parse_schema_a(fixture.raw_lines_a(spark, "/root/testdata/sf0.001")),
                            "daily", keys=("file_day", "vin"), dedupe=True).withColumnRenamed("file_day", "day")
    cols = ["day", "vin", "time_label", "distance_driven", "charging_hours", "n_records"]
    got = sorted(tuple(r) for r in spark.table(table).select(*cols).collect())
    want = sorted(tuple(r) for r in direct.select(*cols).collect())
    assert got == want
    # malformed lines are counted per file day
    bad = jobs.rejects(spark, ledger).where("job = 'daily_stats'")
    lines = fixture.raw_lines_a(spark, "/root/testdata/sf0.001")
    assert bad.agg({"n_lines": "sum"}).first()[0] == lines.where(F.size(F.split("value", ",", -1)) == 84).count() > 0
    assert bad.agg({"n_read": "sum"}).first()[0] == lines.count() and bad.where("n_lines > 0").select("fewest_fields", "most_fields").distinct().collect() == [(84, 84)]
    # a forced day replaces its counts
    jobs.daily_stats_job(spark, root, "2024-01-04", "2024-01-04", table, ledger, force=True)
    assert jobs.rejects(spark, ledger).where("job = 'daily_stats'").agg({"n_read": "sum"}).first()[0] == lines.count()
    # the hourly variant of the same job
    hc = jobs.daily_stats_job(spark, root, "2024-01-01", "2024-01-03", f"hourly_{tag}", ledger, freq="hourly")
    assert hc.count() > 0
    assert set(spark.table(f"hourly_{tag}").columns) >= {"time_label", "distance_driven", "speed_average",
                                                         "charging_hours", "driving_hours", "charged_energy"}
    # a forced re-run of a day rewrites the same rows
    jobs.daily_stats_job(spark, root, "2024-01-05", "2024-01-05", table, ledger, force=True)
    assert sorted(tuple(r) for r in spark.table(table).select(*cols).collect()) == want
    # trips per batch
    tt = jobs.trips_job(spark, root, "2024-01-01", "2024-04-10", f"trips_{tag}", ledger, max_gap_s=8 * 3600)
    assert tt.count() > 0
    # incremental monthly merge over the first days, with the next-day rule
    state = os.path.join(tmp_out, "state")
    for d in ("2024-01-01", "2024-01-02", "2024-01-03"):
        cur = jobs.monthly_merge_job(spark, table, state, ledger, d)
    assert cur.count() > 0
    with pytest.raises(ValueError):
        jobs.monthly_merge_job(spark, table, state, ledger, "2024-01-05")
    # ranking rebuilt only when the daily table advanced
    from ampwise.sources import fixture as FX
    veh = FX.vehicles(spark, "/root/testdata/sf0.001").withColumn("vin", F.col("vin").cast("string"))
    vt = veh.join(spark.table(table).select("vin").distinct(), "vin").first().vintype
    assert jobs.cell_volt_ranking_job(spark, table, veh, vt, f"rank_{tag}", min_days=0)
    assert not jobs.cell_volt_ranking_job(spark, table, veh, vt, f"rank_{tag}", min_days=0)
    assert spark.table(f"rank_{tag}").count() > 0
    # index export: only days after the mark
    out = os.path.join(tmp_out, "idx")
    c1 = jobs.index_export_job(spark, table, "daily_stats", out, ledger)
    assert c1.count() > 0
    c2 = jobs.index_export_job(spark, table, "daily_stats", out, ledger)
    assert c2.count() == 0
    first = spark.read.text(os.path.join(out, "daily_stats")).count()
    assert first == 2 * spark.table(table).count()
    newest = c1.agg({"day": "max"}).first()[0] + dt.timedelta(days=1)
    more = spark.table(table).limit(3).withColumn("day", F.lit(newest))
    more.select(*spark.table(table).columns).write.insertInto(table)
    assert [(r.day, r.n_rows) for r in jobs.index_export_job(spark, table, "daily_stats", out, ledger).collect()] == [(newest, 3)]
    # both batches are kept, each under the name of its newest day
    assert spark.read.text(os.path.join(out, "daily_stats")).select("value").count() == first + 6
    assert sorted(f for f in os.listdir(os.path.join(out, "daily_stats")) if f.startswith("batch=")) == [f"batch={newest - dt.timedelta(days=1)}", f"batch={newest}"]


def test_publishing_an_empty_day_drops_its_old_rows(spark, tmp_out):
    t = f"em_{os.path.basename(tmp_out).replace('-', '_')}"
    path = os.path.join(tmp_out, "ledger")
    publish.publish_days(_rows(spark, [("a", 1.0, D1), ("b", 1.0, D2)]), t, path, "j", [D1, D2])
    got = publish.publish_days(_rows(spark, [("c", 1.0, D2)]), t, path, "j", [D1, D2])
    assert [tuple(r) for r in got.orderBy("day").collect()] == [(D1, 1, 0), (D2, 1, 1)]
    assert [r.vin for r in spark.table(t).collect()] == ["c"]
    # without days only the batch's own are counted and recorded
    publish.publish_days(_rows(spark, [("d", 1.0, D1)]), t, path, "k")
    assert [r.day for r in publish.ledger(spark, path).where("job = 'k'").collect()] == [D1]


def test_monthly_merge_with_text_ids_and_after_a_crash(spark, tmp_out):
    t, ledger, state = f"mm_{os.path.basename(tmp_out).replace('-', '_')}", os.path.join(tmp_out, "ledger"), os.path.join(tmp_out, "state")
    rows = [(f"LSV{k}X", dt.date(2024, 1, d), f"2024-01-{d:02d}", 1.0 * d, 0.5, 30.0, 2) for d in range(1, 4) for k in range(3) if (d + k) % 4]
    cols = "vin string, day date, time_label string, distance_driven double, charging_hours double, speed_average double, speed_n long"
    publish.create_table(spark.createDataFrame(rows, cols), t)
    for d in ("2024-01-01", "2024-01-02"):
        jobs.monthly_merge_job(spark, t, state, ledger, d)
    want = sorted(map(str, jobs.monthly_merge_job(spark, t, state, ledger, "2024-01-03").collect()))
    # the day's state is written but the ledger is not: the day runs again
    kept = spark.createDataFrame(publish.ledger(spark, ledger).where("day < '2024-01-03'").collect(), publish.LEDGER_SCHEMA)
    other = os.path.join(tmp_out, "ledger2")
    kept.write.parquet(other)
    assert sorted(map(str, jobs.monthly_merge_job(spark, t, state, other, "2024-01-03").collect())) == want
    assert sorted(map(str, jobs.monthly_merge_job(spark, t, state, ledger, "2024-01-03").collect())) == want
    miles = {r[0]: r[1] for r in spark.createDataFrame(rows, cols).groupBy("vin").sum("distance_driven").collect()}
    got = {r.vin: r.value for r in jobs.monthly_merge_job(spark, t, state, ledger, "2024-01-03").where("stat = 'miles_driven'").collect()}
    assert got == miles


def test_a_broken_ledger_is_an_error(spark, tmp_out):
    path = os.path.join(tmp_out, "ledger")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        publish.ledger(spark, path).count()
    assert publish.ledger(spark, os.path.join(tmp_out, "none")).count() == 0


def test_csv_with_header_and_set_append(spark, tmp_out):
    """S7 and K15."""
    path, out = os.path.join(tmp_out, "h"), os.path.join(tmp_out, "rows")
    df = spark.createDataFrame([("a", 1.5), ("b", None)], "vin string, x double")
    publish.write_csv(df, path)
    back = raw.read_csv_with_header(spark, path, "vin string, x double")
    assert sorted(back.columns) == ["vin", "x"] and back.count() == 2
    publish.append_rows(df, out)
    publish.append_rows(df, out)
    assert spark.read.parquet(out).count() == 4


def test_publish_days_before_after_counts(spark, tmp_out):
    t = f"ba_{os.path.basename(tmp_out).replace('-', '_')}"
    path = os.path.join(tmp_out, "ledger")
    first = publish.publish_days(_rows(spark, [("a", 1.0, D1), ("b", 1.0, D1)]), t, path, "j", ["2024-01-01"])
    assert [(r.day, r.n_rows_before, r.n_rows) for r in first.collect()] == [(D1, 0, 2)]
    second = publish.publish_days(_rows(spark, [("c", 1.0, D1)]), t, path, "j", ["2024-01-01"])
    assert [(r.day, r.n_rows_before, r.n_rows) for r in second.collect()] == [(D1, 2, 1)]


def test_daily_job_of_the_national_layout(spark, tmp_out):
    from ampwise.operators import stats as S
    from ampwise.sources import fixture
    lines = fixture.raw_lines_b(spark, "/root/testdata/sf0.001")
    lines.withColumn("d", F.date_format("file_day", "yyyyMMdd")).select("value", "d").write.partitionBy("d").text(os.path.join(tmp_out, "csv"))
    t, ledger = f"nb_{os.path.basename(tmp_out).replace('-', '_')}", os.path.join(tmp_out, "ledger")
    assert jobs.daily_stats_job(spark, tmp_out, "2024-01-01", "2024-04-10", t, ledger, layout="b").count() > 60
    want = S.period_stats(raw.stat_columns_b(raw.parse_schema_b(lines)), "daily", keys=("file_day", "vin"))
    cols = ["vin", "time_label", "n_records", "charging_hours", "charged_energy", "distance_driven"]
    assert sorted(map(tuple, spark.table(t).select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert want.agg({"charging_hours": "sum"}).first()[0] > 0


def test_merged_month_equals_the_rollup(spark):
    """The registered day-by-day merge of all days against the rollup."""
    from ampwise.operators import stats as S
    from ampwise.plans.queries import QUERIES
    from ampwise.sources import fixture
    sf = "/root/testdata/sf0.001"
    want = rollup.monthly_rollup(S.daily_stats(fixture.telemetry(spark, sf)))
    key = lambda r: (r.vin, r.stat, r.time_label, None if r.value is None else round(r.value, 5), r.weight)
    assert sorted(map(key, QUERIES["merged_month"](spark, sf).collect()), key=str) == sorted(map(key, want.collect()), key=str)


def test_history_job_in_any_order_equals_a_rebuild(spark, tmp_out):
    """Day files that arrive out of order, a run that dies before the ledger, a forced day: the
    documents equal those of the rollup over all records."""
    from ampwise.operators import history, rollup as R, stats as S
    from ampwise.sources import fixture
    lines = fixture.raw_lines_a(spark, "/root/testdata/sf0.001")
    d = F.date_format("file_day", "yyyyMMdd")
    lines.withColumn("d", d).select("value", "d").write.partitionBy("d").text(os.path.join(tmp_out, "csv"))
    h, docs, ledger = (os.path.join(tmp_out, x) for x in ("h", "docs", "ledger"))
    assert jobs.history_job(spark, tmp_out, "2024-02-01", "2024-02-20", h, docs, ledger) == ["2024-01", "2024-02"]
    assert jobs.history_job(spark, tmp_out, "2024-02-21", "2024-04-10", h, docs, ledger)
    jobs.history_job(spark, tmp_out, "2024-01-01", "2024-01-31", h, docs, ledger)
    assert jobs.history_job(spark, tmp_out, "2024-01-01", "2024-04-10", h, docs, ledger) == []
    jobs.history_job(spark, tmp_out, "2024-02-03", "2024-02-04", h, docs, ledger, force=True)
    got = R.read_stat_documents(spark, docs)
    key = lambda r: (r.vin, r.stat, r.freq, r.time_label, None if r.value is None else round(r.value, 5), r.weight)
    rows = S.period_stats(raw.parse_schema_a(lines), ("daily", "hourly"), keys=("file_day", "vin"), dedupe=True)
    whole = history.combined(history.stat_rows(rows).where("freq = 'daily'"), ("vin", "label")).withColumn("day", F.to_date("label"))
    end = F.lit(lines.agg(F.max("file_day")).first()[0])
    assert sorted(map(key, got.where("freq = 'monthly'").collect()), key=str) == sorted(map(key, R.monthly_rollup(whole, end).collect()), key=str)
    assert sorted(map(key, got.where("freq = 'daily'").collect()), key=str) == sorted(map(key, R.daily_long(whole, end).collect()), key=str)
    assert got.where("freq = 'hourly'").count() == history.hourly(spark, h).count() * 3
    assert jobs.rejects(spark, ledger).where("job = 'history'").agg({"n_read": "sum"}).first()[0] == lines.count()


def test_jobs_over_a_clustered_table_move_no_records(spark, tmp_out):
    """Trips, periods and daily statistics over a table bucketed by vehicle and day: the same rows,
    and no exchange of records in the plans (only of segments, by vehicle)."""
    from ampwise.operators import periods, stats as S, trips as T
    from ampwise.sources import fixture
    t = fixture.telemetry(spark, "/root/testdata/sf0.001")
    name = f"cl_{os.path.basename(tmp_out).replace('-', '_')}"
    publish.create_clustered(t, name, 4)
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    jobs_ = {"trips": lambda d: T.trips(d, max_gap_s=8 * 3600), "periods": lambda d: periods.periods_of(d, max_gap_s=86400),
             "stats": lambda d: S.daily_stats(d, keys=("vin", "day")).select("vin", "time_label", "n_records", "distance_driven", "energy_throughput")}
    try:
        for shuffle in ("4", keep):
            spark.conf.set("spark.sql.shuffle.partitions", shuffle)
            for what, job in jobs_.items():
                df = job(spark.table(name))
                plan = df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
                moved = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x and "day#" in x]
                assert not moved, (what, moved)
                assert sorted(map(str, df.collect())) == sorted(map(str, job(t).collect())), what
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
