"""Edge cases on small hand-made frames (FIXTURES.md section 4)."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ampwise.functions import scalar
from ampwise.operators import distance, geo, periods, ranking, rollup, stats, trips

T0 = dt.datetime(2024, 5, 1, 8, 0, 0)
COLS = ("vin long, event_id long, ts timestamp_ntz, day date, odo double, charge_cur double, charge_st int, "
        "fuel double, soc double, lat double, lon double, curr double, volt double, speed double, "
        "temp_avg double, temp_max double, temp_min double, cell_volt_max double, cell_volt_min double, "
        "acc_pedal double, brake_pedal string, charge_volt double")


def rec(vin, i, secs, odo, **kw):
    ts = T0 + dt.timedelta(seconds=secs)
    base = dict(charge_cur=0.0, charge_st=0, fuel=0.0, soc=80.0, lat=23.0, lon=113.0, curr=-10.0,
                volt=350.0, speed=30.0, temp_avg=25.0, temp_max=27.0, temp_min=23.0, cell_volt_max=3.9,
                cell_volt_min=3.8, acc_pedal=10.0, brake_pedal="0", charge_volt=380.0)
    base.update(kw)
    odo = float(odo) if odo is not None else None
    return (vin, i, ts, ts.date(), odo, base["charge_cur"], base["charge_st"], base["fuel"], base["soc"],
            base["lat"], base["lon"], base["curr"], base["volt"], base["speed"], base["temp_avg"],
            base["temp_max"], base["temp_min"], base["cell_volt_max"], base["cell_volt_min"],
            base["acc_pedal"], base["brake_pedal"], base["charge_volt"])


def frame(spark, rows):
    return spark.createDataFrame(rows, COLS)


# ---------------------------------------------------------------- B1 trips
def test_trip_gap_boundaries(spark):
    # gaps: 600 s (same trip), 600.9 s (truncated to 600: same trip), 601 s (break)
    rows = [rec(1, 0, 0, 100), rec(1, 1, 600, 101), rec(1, 2, 1200.9, 102), rec(1, 3, 1801.9, 103),
            rec(1, 4, 1811.9, 104)]
    out = sorted((r.trip_no, r.n_records, r.distance) for r in trips.trips(frame(spark, rows)).collect())
    assert out == [(0, 3, 2.0), (1, 2, 1.0)]


def test_trip_single_rows_dropped_and_midnight(spark):
    base = dt.datetime(2024, 5, 1, 23, 59, 0)
    rows = [rec(2, 0, 0, 10), rec(2, 1, 5000, 11),                       # lone rows on both sides
            rec(2, 2, 10000, 12), rec(2, 3, 10000 + 300, 13),             # one trip
            rec(2, 4, 20000, 14, lat=None), rec(2, 5, 30000, 15)]          # null position, last alone
    df = frame(spark, rows)
    got = [(r.n_records, r.distance) for r in trips.trips(df).collect()]
    assert got == [(2, 1.0)]
    # a trip across midnight stays one trip (bucketed scan joins the days)
    mid = [rec(3, i, (base - T0).total_seconds() + 30 * i, 50 + i) for i in range(6)]
    t = trips.trips(frame(spark, mid)).collect()
    assert len(t) == 1 and t[0].n_records == 6 and t[0].start_time.day == 1 and t[0].end_time.day == 2


@pytest.mark.parametrize("secs,text", [(5, "05s"), (125, "02m05s"), (3725, "1h02m05s"), (59.9, "59s")])
def test_duration_text_values(spark, secs, text):
    assert spark.range(1).select(scalar.duration_text(F.lit(secs)).alias("t")).first().t == text


# ---------------------------------------------------------------- B2 / B3
def test_odometer_distance_rules(spark):
    rows = ([rec(1, 0, 0, 100), rec(1, 1, 10, 105), rec(1, 2, 20, 115), rec(1, 3, 30, 112)]   # jump of exactly 10
            + [rec(2, 0, 0, 50)]                                                               # one row -> 0
            + [rec(3, 0, 0, None), rec(3, 1, 10, 0.0)]                                          # no valid -> null
            + [rec(4, 0, 0, 20), rec(4, 1, 10, 18), rec(4, 2, 20, 33)])                         # descending, negative sum
    res = {r.vin: (r.distance, r.offset) for r in distance.odometer_distance(frame(spark, rows)).collect()}
    assert res[1] == (2.0, 10.0)      # small steps +5, -3 -> 2; jump +10 times sign(+)
    assert res[2] == (0.0, 0.0)
    assert res[3] == (None, None)
    assert res[4] == (2.0, -15.0)     # small -2 -> |.| = 2; jump +15 times sign(-2)


# ---------------------------------------------------------------- B4
def test_battery_distance_runs(spark):
    on = dict(fuel=0.0, soc=80.0)
    off = dict(fuel=5.0, soc=80.0)
    rows = [rec(1, 0, 0, 100, **on), rec(1, 1, 10, 103, **on), rec(1, 2, 20, 104, **off),
            rec(1, 3, 30, 110, **on), rec(1, 4, 40, 108, **on),
            rec(2, 0, 0, 100, **off), rec(2, 1, 10, 101, **on),                      # one flagged row -> 0
            rec(3, 0, 0, 100, **off)]                                                 # none flagged -> 0
    res = {r.vin: r.distance_on_battery for r in distance.battery_distance(frame(spark, rows)).collect()}
    # run 1: 100->103 (+3) and the gap step 103->110 (+7) belong to run 1 -> 10; run 2: 110->108 -> 2
    assert res == {1: 12.0, 2: 0.0, 3: 0.0}


# ---------------------------------------------------------------- B7 / A9
def test_primary_location_tie_and_zero(spark):
    rows = [rec(1, i, 10 * i, 100 + i, lat=lat, lon=lon) for i, (lat, lon) in enumerate(
        [(23.129, 113.255), (23.121, 113.251), (22.5, 114.0), (22.509, 114.001), (0.001, 113.0), (23.1, 0.004)])]
    rows += [rec(2, 0, 0, 1, lat=-33.8688, lon=151.2093), rec(2, 1, 10, 2, lat=1e-5, lon=2.5e-5)]
    res = {r.vin: (r.lat, r.lon, r.n_records) for r in geo.primary_locations(frame(spark, rows)).collect()}
    assert res[1] == ("22.50", "114.00", 2)     # tie 2 vs 2 -> smallest text
    assert res[2] == ("-33.86", "151.20", 1)    # exponent-form text is rounded, then 0.00 dropped


def test_last_n_cutoff_inside_a_day(spark):
    rows = [rec(1, i, 3600 * i, 100 + i, lat=23.0 + (0.1 if i >= 20 else 0.0)) for i in range(30)]
    res = geo.primary_locations(frame(spark, rows), n=10).first()
    assert (res.lat, res.n_records) == ("23.10", 10)


# ---------------------------------------------------------------- J9 / B6
def _pt(vin, i, lat, lon):
    return rec(vin, i, 100 * i, 1, lat=lat, lon=lon, charge_cur=16.0, charge_st=1)


def _offset(lat, metres_north=0.0, metres_east=0.0):
    d = 180.0 / (math.pi * scalar.EARTH_RADIUS_M)
    return lat + metres_north * d, metres_east * d / math.cos(math.radians(lat))


def test_cluster_distance_boundaries(spark):
    pts = []
    lat0 = 60.0
    a = (lat0, 10.0)
    b = (_offset(lat0, 19.9)[0], 10.0)                  # 19.9 m north of a: same cluster
    c = (_offset(lat0, 19.9 + 20.1)[0], 10.0)           # 20.1 m north of b: separate
    chain = [(23.0, 100.0 + _offset(23.0, 0, 15 * k)[1]) for k in range(3)]   # 15 m chain
    edge = [(23.5, 120.0 - 1e-6), (23.5, 120.0 + 5e-5)]                        # across a cell edge, ~5 m
    for i, p in enumerate([a, b, c, *chain, *edge, edge[0]]):                  # duplicate point too
        pts.append(_pt(1, i, *p))
    lab = geo.cluster_points(frame(spark, pts).select("lat", "lon"))
    groups = {}
    for r in lab.collect():
        groups.setdefault((r.cluster.lat, r.cluster.lon), set()).add((r.lat, r.lon))
    sizes = sorted(len(v) for v in groups.values())
    assert sizes == [1, 2, 2, 3]
    assert {a, b} in [v for v in groups.values()]


# ---------------------------------------------------------------- A11 / A13
def test_recency_weighted_mean(spark):
    df = spark.createDataFrame(
        [(1, T0, 1, 10.0), (1, T0 + dt.timedelta(hours=1), 2, 20.0),
         (2, T0, 1, 5.0),
         (3, T0, 1, 1.0), (3, T0 + dt.timedelta(hours=1), 2, None)],
        "vin long, end_time timestamp_ntz, period_no long, x double")
    res = {r.vin: (r.x_wmean, r.x_count) for r in ranking.by_vehicle(df, {"x": ("wmean", "count")}).collect()}
    # weights 0.75 and 1.0 -> (7.5 + 20) / 1.75
    assert res[1] == (round(27.5 / 1.75, 6), 2)
    assert res[2] == (5.0, 1)
    assert res[3] == (None, 1)       # a missing value makes the mean missing


def test_global_row_number(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v"), F.col("id"))
    r = ranking.global_row_number(df, [F.col("v").desc(), F.col("id")], partitions=7)
    got = [(x.row_number, x.v) for x in r.orderBy("row_number").collect()]
    assert [g[0] for g in got] == list(range(1, 1001))
    assert [g[1] for g in got] == sorted((g[1] for g in got), reverse=True)


# ---------------------------------------------------------------- R1-R4
def test_monthly_rollup_rules(spark):
    D = lambda d: dt.date(2024, 3, d)
    daily = spark.createDataFrame(
        [(1, D(1), 0.0, 100, 1.0, 0.5), (1, D(2), 5.0, 10, 2.0, None),      # zero rule: (0,100) counts as 1
         (1, D(4), None, 0, None, 1.0),                                    # day 3 missing -> null
         (2, D(2), 4.0, 4, 3.0, 0.25)],                                    # new vehicle mid-month
        "vin long, day date, speed_average double, speed_n long, distance_driven double, charging_hours double")
    m = {(r.vin, r.stat): (r.value, r.weight) for r in rollup.monthly_rollup(daily).collect()}
    assert m[(1, "average_speed")] == (round(50 / 11, 6), 11)
    assert m[(1, "miles_driven")] == (3.0, None)
    assert m[(1, "charging_hours")] == (1.5, None)
    assert m[(2, "average_speed")] == (4.0, 4)
    dl = rollup.daily_long(daily).where("vin = 1 AND stat = 'miles_driven'").orderBy("time_label").collect()
    assert [(r.time_label, r.value) for r in dl] == [("2024-03-01", 1.0), ("2024-03-02", 2.0),
                                                     ("2024-03-03", None), ("2024-03-04", None)]


def test_weighted_average_all_missing(spark):
    daily = spark.createDataFrame([(1, dt.date(2024, 3, 1), None, 0, 1.0, 1.0),
                                   (1, dt.date(2024, 3, 2), None, 0, 1.0, 1.0)],
                                  "vin long, day date, speed_average double, speed_n long, "
                                  "distance_driven double, charging_hours double")
    m = {r.stat: (r.value, r.weight) for r in rollup.monthly_rollup(daily).collect()}
    assert m["average_speed"] == (None, 0)


# ---------------------------------------------------------------- W9 / B10-B12 / W14
def test_period_compaction_and_sums(spark):
    chg = dict(charge_cur=16.0, charge_st=1)
    rows = [rec(1, 0, 0, 1, curr=10.0, soc=50.0, **chg), rec(1, 1, 10, 1, curr=20.0, soc=51.0, **chg),
            rec(1, 2, 310, 1, curr=20.0, soc=60.0, **chg)]            # a 300 s jump compacts to 10 s
    p = periods.periods(frame(spark, rows), "charging").first()
    assert p.count_records == 3 and p.delta_soc == 10.0
    assert p.real_duration_s == 30.0                                     # 10 + 10 + first sample
    assert p.ah_throughput == round(50 * 10 / 3600, 6)
    assert p.ah_throughput_trapz == round((15 * 10 + 20 * 10) / 3600, 6)
    assert p.ah_throughput_soc_comp == round(50 * 10 / 3600 * 10 / 1, 6)   # only the 1-point step is seen


def test_current_split_default_and_jump(spark):
    chg = dict(charge_cur=16.0, charge_st=1)
    rows = [rec(1, i, 10 * i, 1, curr=c, **chg) for i, c in enumerate([10.0, 11.0, 30.0, 31.0])]
    rows += [rec(2, i, 10 * i, 1, curr=c, **chg) for i, c in enumerate([10.0, 11.0, 12.0])]
    lab = periods.label_periods(frame(spark, rows), "charging")
    sp = {(r.vin, r.rn): r.side for r in periods.current_split(lab).collect()}
    assert [sp[(1, k)] for k in (1, 2, 3, 4)] == [0, 0, 1, 1]
    assert [sp[(2, k)] for k in (1, 2, 3)] == [0, 1, 1]


def test_stats_hourly_subset(spark):
    rows = [rec(1, i, 600 * i, 100 + i) for i in range(12)]
    h = stats.hourly_stats(frame(spark, rows))
    assert h.count() == 2 and set(h.columns) >= {"distance_driven", "speed_average", "charged_energy"}


def test_truncate_text(spark):
    df = spark.createDataFrame([(23.129,), (-0.001,), (1e-5,), (113.0,)], "x double")
    got = [r.t for r in df.select(scalar.truncate_text("x", 2).alias("t")).collect()]
    assert got == ["23.12", "-0.00", "0.00", "113.00"]


def test_merge_day_matches_batch_rollup(spark):
    from ampwise.sources import fixture
    daily = stats.daily_stats(fixture.telemetry(spark, "/root/testdata/sf0.001")).select(
        "vin", "day", "speed_average", "speed_n", "distance_driven", "charging_hours")
    daily = spark.createDataFrame(daily.collect(), daily.schema)          # small, keep lineage short
    schema = "vin long, stat string, freq string, time_label string, value double, weight long"
    state = spark.createDataFrame([], schema)
    days = sorted({r.day for r in daily.select("day").distinct().collect()})
    for d in days:
        state = spark.createDataFrame(rollup.merge_day(state, daily, d.isoformat()).collect(), schema)
    batch = rollup.monthly_rollup(daily)
    # the state keeps full precision, the rollup is rounded to six places
    got, want = ({(r.vin, r.stat, r.time_label): (r.value, r.weight) for r in df.collect()} for df in (state, batch))
    assert got.keys() == want.keys()
    for k, (value, weight) in want.items():
        assert got[k][1] == weight and (got[k][0] is None) == (value is None), k
        assert value is None or abs(got[k][0] - value) <= 1e-6, k


def test_column_helpers(spark):
    from ampwise.functions import columns
    df = spark.createDataFrame([("a", float("nan"), "NA", "2024-01-01 08:00:00+08:00", dt.date(2024, 1, 3))],
                               "battery_temp_min_min_trips string, x double, y string, t string, day date")
    r = columns.rename_by_rules(df, columns.RANKING_RENAME_RULES)
    assert r.columns[0] == "battery_temp_min_driving"
    n = columns.nulls_for_missing(df).first()
    assert n.x is None and n.y is None
    s = columns.strip_utc_offset(df, ["t"]).first()
    assert s.t == "2024-01-01 08:00:00"
    assert columns.in_date_range(df, "2024-01-01", "2024-01-03").count() == 1
    assert columns.in_date_range(df, "2024-01-04", "2024-01-05").count() == 0


def test_small_helpers(spark):
    row = spark.range(1).select(
        scalar.day_fraction(F.lit("1970-01-02 12:00:00").cast("timestamp_ntz")).alias("w16"),
        scalar.truncate_number(F.lit(-1.239), 2).alias("f2"),
        scalar.per_full_soc(F.lit(5.0), F.lit(50.0)).alias("f15"),
        scalar.per_full_soc(F.lit(5.0), F.lit(0.0)).alias("f15z"),
        scalar.missing_time_pct(F.lit(2.0), F.lit(360)).alias("f16"),
        scalar.missing_time_hours(F.lit(2.0), F.lit(360)).alias("f16h"),
        scalar.bucket_upper(F.lit(41.0), 10).alias("f7"),
    ).first()
    assert row.w16 == 1.5 and row.f2 == -1.23 and row.f15 == 10.0 and row.f15z is None
    assert row.f16 == 50.0 and row.f16h == 1.0 and row.f7 == 50.0
    d1, d2, d3 = (dt.date(2024, 1, k) for k in (1, 2, 3))
    assert rollup.next_day_allowed(d1, d2) and not rollup.next_day_allowed(d1, d3) and rollup.next_day_allowed(None, d3)
    assert not ranking.needs_rebuild(d2, d2) and ranking.needs_rebuild(d3, None) and ranking.needs_rebuild(d3, d2)


def test_hour_buckets_equal_whole_day_scan(spark):
    """A hot vehicle-day can be split into hourly scan buckets without
    changing any result."""
    from ampwise.sources import fixture
    t = fixture.telemetry(spark, "/root/testdata/sf0.001")
    hour = F.date_trunc("hour", F.col("ts"))
    a = stats.daily_stats(t)
    b = stats.daily_stats(t, bucket=hour)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())
    a = distance.odometer_distance(t, ("vin", "day"))
    b = distance.odometer_distance(t, ("vin", "day"), bucket=hour)
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())


def test_neighbour_edges_match_brute_force(spark):
    import random
    rng = random.Random(3)
    pts = set()
    for lat0 in (0.0, 45.0, 70.0, 85.0, -60.0):
        for _ in range(60):
            lat = lat0 + rng.uniform(-0.0006, 0.0006)
            lon = 10.0 + rng.uniform(-0.0006, 0.0006) / max(math.cos(math.radians(lat0)), 0.1)
            pts.add((round(lat, 7), round(lon, 7)))
    pts = sorted(pts)

    def hav(a, b):
        la1, la2 = math.radians(a[0]), math.radians(b[0])
        h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * scalar.EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))

    want = {(a, b) for a in pts for b in pts if a != b and hav(a, b) <= 20.0 - 1e-6}
    maybe = {(a, b) for a in pts for b in pts if a != b and abs(hav(a, b) - 20.0) <= 1e-6}
    df = spark.createDataFrame(pts, "lat double, lon double")
    got = {((r.src.lat, r.src.lon), (r.dst.lat, r.dst.lon)) for r in geo.neighbour_edges(df).collect()}
    assert want <= got and got <= want | maybe and len(want) > 100


def test_trips_with_hour_buckets(spark):
    from ampwise.sources import fixture
    t = fixture.telemetry(spark, "/root/testdata/sf0.001").withColumn("hour", F.date_trunc("hour", "ts"))
    a = trips.trips(t, max_gap_s=8 * 3600)
    b = trips.trips(t, max_gap_s=8 * 3600, bucket="hour")
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())
    pa = periods.periods(t, "charging", max_gap_s=8 * 3600)
    pb = periods.periods(t, "charging", max_gap_s=8 * 3600, bucket="hour")
    assert sorted(tuple(r) for r in pa.collect()) == sorted(tuple(r) for r in pb.collect())


def test_clusters_of_a_long_line_dense_sites_and_edges(spark):
    """No round limit; links do not grow with the points of a site; 180 degrees and the poles."""
    import random
    rnd = random.Random(3)
    step = 15 / 111_195
    line = [(round(10 + k * step, 9), 20.0) for k in range(2000)]
    rnd.shuffle(line)
    lab = geo.cluster_points(spark.createDataFrame(line, "lat double, lon double"))
    assert lab.select("cluster").distinct().count() == 1 and lab.count() == 2000
    dense = spark.range(100_000).select((F.lit(30.0) + F.rand(1) * 18 / 111_195).alias("lat"), (F.lit(50.0) + F.rand(2) * 18 / 96_300).alias("lon"))
    side = geo._deg(20.0) * 0.99 / math.sqrt(2)
    cells, links = geo.cell_links(geo._grid(dense, side), 20.0, side)
    assert cells.count() <= 16 and links.count() <= 16 * 15
    assert geo.cluster_points(dense).select("cluster").distinct().count() == 1
    for pair in ([(0.0, 179.99999), (0.0, -179.99999)], [(89.9999, 0.0), (89.9999, 60.0)], [(89.99995, 0.0), (89.99995, 179.0)], [(-89.99995, 10.0), (-89.99995, -100.0)], [(12.0, 180.0), (12.0, -180.0)]):
        assert geo.cluster_points(spark.createDataFrame(pair, "lat double, lon double")).select("cluster").distinct().count() == 1, pair
    far = [(0.0, 179.9997), (0.0, -179.9997), (89.99, 0.0), (89.99, 90.0)]
    assert geo.cluster_points(spark.createDataFrame(far, "lat double, lon double")).select("cluster").distinct().count() == 4


@pytest.mark.parametrize("lat0", [0.0, 37.5, -72.0, 89.9996])
def test_clusters_by_brute_force(spark, lat0):
    import random
    rnd = random.Random(int(lat0 * 10))
    n, width = (160, 0.0016 / math.cos(math.radians(lat0))) if abs(lat0) < 80 else (22, 180.0)
    pts = sorted({(round(lat0 + rnd.uniform(-0.0003, 0.0003), 7), round(((179.9999 + rnd.uniform(-width, width)) + 180) % 360 - 180, 7)) for _ in range(n)})

    def hav(a, b):
        la1, la2 = math.radians(a[0]), math.radians(b[0])
        h = math.sin((la2 - la1) / 2) ** 2 + math.cos(la1) * math.cos(la2) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * scalar.EARTH_RADIUS_M * math.asin(min(1.0, math.sqrt(h)))

    label = {p: p for p in pts}
    for _ in pts:
        new = {p: min(label[q] for q in pts if hav(p, q) <= 20.0) for p in pts}
        if new == label:
            break
        label = new
    got = {(r.lat, r.lon): (r.cluster.lat, r.cluster.lon) for r in geo.cluster_points(spark.createDataFrame(pts, "lat double, lon double")).collect()}
    assert got == label and 1 < len(set(label.values())) < len(pts)


def test_rounding_passes_large_and_special_values_on(spark):
    row = spark.createDataFrame([(float("nan"), float("inf"), 1e13, -1e300, 1.2345674)], "a double, b double, c double, d double, e double").select(*[scalar.r6(c).alias(c) for c in "abcde"]).first()
    assert math.isnan(row.a) and row.b == float("inf") and row.c == 1e13 and row.d == -1e300 and row.e == 1.234567


def test_monthly_rollup_of_many_rows_a_day(spark):
    """Late records leave several rows per vehicle and day; every day of the month is folded."""
    day = lambda k: dt.date(2024, 1, k)
    rows = [("v", day(k), float(k), 1.0, 10.0, 2) for k in range(1, 32)] + [("v", day(k), 0.5, 0.0, 40.0, 1) for k in range(1, 31)]
    df = spark.createDataFrame(rows, "vin string, day date, distance_driven double, charging_hours double, speed_average double, speed_n long")
    got = {r.stat: (r.value, r.weight) for r in rollup.monthly_rollup(df).collect()}
    assert got["miles_driven"] == (sum(range(1, 32)) + 15.0, None) and got["charging_hours"] == (31.0, None)
    assert got["average_speed"] == (scalar_round((31 * 2 * 10.0 + 30 * 40.0) / 92), 92)


def scalar_round(x):
    return math.floor(x * 1e6 + 0.50001) / 1e6
