"""Segment combination (island_stats) against per-row island labels."""

import datetime as dt
import random

from pyspark.sql import functions as F

from ampwise.operators import trips
from ampwise.operators.segments import island_stats

T0 = dt.datetime(2024, 2, 1, 0, 0, 0)


def _rows(seed, n_vins=25):
    rng = random.Random(seed)
    out, eid = [], 0
    for vin in range(n_vins):
        t = T0 + dt.timedelta(seconds=rng.randint(0, 80000))
        v = 3.9
        for _ in range(rng.randint(1, 80)):
            t += dt.timedelta(seconds=rng.choice([5, 60, 590, 600, 600.5, 601, 3000, 40000, 90000, 200000]))
            v = round(v + rng.choice([0.0, 0.1, -0.1, -1.5]), 2)
            out.append((vin, eid, t, t.date(), float(eid % 7), v, float(eid % 5) - 2))
            eid += 1
    return out


def _frame(spark, rows):
    return spark.createDataFrame(rows, "vin long, event_id long, ts timestamp_ntz, day date, odo double, "
                                       "cell_volt_max double, curr double")


def test_island_stats_matches_row_labels(spark):
    df = _frame(spark, _rows(11))
    split = lambda p, c: (p("cell_volt_max") - c("cell_volt_max")) > 1.0
    st = island_stats(df, ["vin"], ["ts", "event_id"], "day", 600, carry=("odo", "curr", "cell_volt_max"),
                      row_aggs={"s_odo": ("sum", lambda c: c("odo")), "mx": ("max", lambda c: c("curr"))},
                      pair_aggs={"d": ("sum", lambda p, c: c("odo") - p("odo")),
                                 "mn": ("min", lambda p, c: c("curr") - p("curr"))},
                      split=split)
    got = {(r.vin, r.island_no): (r._n, r._head.ts, r._tail.ts, r.s_odo, r.mx, r.d, r.mn) for r in st.collect()}

    # brute force per vehicle in Python
    exp = {}
    by_vin = {}
    for r in _rows(11):
        by_vin.setdefault(r[0], []).append(r)
    for vin, rows in by_vin.items():
        rows.sort(key=lambda r: (r[2], r[1]))
        isl, prev = 0, None
        for r in rows:
            if prev is not None:
                us = (r[2] - prev[2]) / dt.timedelta(microseconds=1)
                gap = int(us // 1_000_000)
                if gap > 600 or (prev[5] - r[5]) > 1.0:
                    isl += 1
                    prev = None
            e = exp.setdefault((vin, isl), {"n": 0, "h": r[2], "t": r[2], "s": 0.0, "mx": None, "d": None, "mn": None})
            e["n"] += 1
            e["t"] = r[2]
            e["s"] += r[4]
            e["mx"] = r[6] if e["mx"] is None else max(e["mx"], r[6])
            if prev is not None:
                e["d"] = (e["d"] or 0.0) + (r[4] - prev[4])
                dm = r[6] - prev[6]
                e["mn"] = dm if e["mn"] is None else min(e["mn"], dm)
            prev = r
    want = {k: (v["n"], v["h"], v["t"], v["s"], v["mx"], v["d"], v["mn"]) for k, v in exp.items()}
    assert got == want


def test_trips_segment_combination_equals_row_labels(spark):
    rows = [(v, e, t, d, o, 0.0, 0, 23.0, 113.0) for (v, e, t, d, o, _, _) in _rows(5)]
    df = spark.createDataFrame(rows, "vin long, event_id long, ts timestamp_ntz, day date, odo double, "
                                     "charge_cur double, charge_st int, lat double, lon double") \
              .withColumn("odo", F.col("odo") + 1)
    t = trips.trips(df, max_gap_s=600)
    lab = trips.label_trips(df, max_gap_s=600)
    by_label = lab.groupBy("vin", "trip_no").agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("s"),
                                                F.max("ts").alias("e")).where("n > 1")
    a = {(r.vin, r.trip_no, r.n_records, r.start_time, r.end_time) for r in t.collect()}
    b = {(r.vin, r.trip_no, r.n, r.s, r.e) for r in by_label.collect()}
    assert a == b and len(a) > 20


def test_ordered_scan_buckets_equal_plain_window(spark):
    from ampwise.operators.scan import ordered_scan
    rng = random.Random(9)
    rows, eid = [], 0
    for vin in range(30):
        t = T0
        for _ in range(rng.randint(1, 60)):
            t += dt.timedelta(seconds=rng.choice([30, 3600, 30000, 200000]))
            x = rng.choice([None, None, 1.0, 2.5, -3.0])     # runs of nulls across buckets
            rows.append((vin, eid, t, t.date(), x))
            eid += 1
    df = spark.createDataFrame(rows, "vin long, event_id long, ts timestamp_ntz, day date, x double")
    spec = dict(lags={"px": F.col("x"), "pts": F.col("ts")},
                lasts={"lx": F.col("x")},
                cums={"cx": F.when(F.col("x") > 0, F.lit(1)).otherwise(F.lit(0))})
    a = ordered_scan(df, ["vin"], ["ts", "event_id"], None, **spec)
    b = ordered_scan(df, ["vin"], ["ts", "event_id"], "day", **spec)
    c = ordered_scan(df, ["vin"], ["ts", "event_id"], F.date_trunc("hour", "ts"), **spec)
    cols = ["vin", "event_id", "px", "pts", "lx", "cx"]
    ra = sorted(tuple(r) for r in a.select(*cols).collect())
    assert ra == sorted(tuple(r) for r in b.select(*cols).collect())
    assert ra == sorted(tuple(r) for r in c.select(*cols).collect())
