"""Periods of several kinds in one pass, and period models from summed segments, against plain loops."""

import datetime as dt
import random

import numpy as np
import pytest

from ampwise.operators import periods
from ampwise.sources import fixture

T0 = dt.datetime(2024, 2, 1, 22, 0, 0)
COLUMNS = ("vin long, event_id long, ts timestamp_ntz, day date, odo long, soc double, curr double, volt double, charge_cur double, "
           "charge_st int, fuel double, cell_volt_max double, cell_volt_min double, temp_avg double, temp_max double, temp_min double")


def records(seed, vehicles=6, holes=True):
    """Charging records over several days with gaps, jumps of current, missing SOC and current, equal times."""
    rnd, out, eid = random.Random(seed), [], 0
    for vin in range(vehicles):
        t, soc = T0 + dt.timedelta(seconds=rnd.randint(0, 9000)), 20.0
        for _ in range(rnd.randint(1, 120)):
            t += dt.timedelta(seconds=rnd.choice([0, 10, 10, 10, 30, 130, 590, 600.5, 601, 20000]))
            soc = max(0.0, soc + rnd.choice([0, 0, 1, 0.5, -3]))
            out.append((vin, eid, t, t.date(), 100, None if holes and rnd.random() < 0.15 else soc,
                        None if holes and rnd.random() < 0.1 else rnd.choice([1.0, 2.5, 9.0, 3.0]), 300.0, rnd.choice([16.0, 16.0, 16.0, 0.0]), 1, 0.0, rnd.choice([3.7, 3.9, 4.0, 5.5]),
                        3.5, 20.0, 22.0, 18.0))
            eid += 1
    return out


def charging_periods(rows, max_gap=600):
    """{(vin, number): rows} by walking every vehicle's charging records."""
    out, by = {}, {}
    for r in rows:
        if r[8] is not None and r[8] > 0:
            by.setdefault(r[0], []).append(r)
    for vin, rs in by.items():
        no, last = -1, None
        for r in sorted(rs, key=lambda r: (r[2], r[1])):
            if last is None or int((r[2] - last).total_seconds()) > max_gap:
                no += 1
            out.setdefault((vin, no), []).append(r)
            last = r[2]
    return out


def near(a, b):
    return (a is None) == (b is None) and (a is None or abs(a - b) <= 2e-6 * max(1.0, abs(b)))


def model(rows, trim):
    """B16-B18 of one period, record by record."""
    t, corrected = 0, []
    for i, r in enumerate(rows):
        if i:
            d = int((r[2] - rows[i - 1][2]).total_seconds())
            t += 10 if d > 120 else d
        corrected.append(t)
    split = next((i for i in range(1, len(rows)) if rows[i][6] is not None and rows[i - 1][6] is not None and abs(rows[i][6] - rows[i - 1][6]) > 5), 1)
    sides = [[(r, c) for i, (r, c) in enumerate(zip(rows, corrected)) if (i >= split) == bool(k)] for k in (0, 1)]
    if trim:
        low = min((r[5] for r, _ in sides[0] if r[5] is not None), default=None)
        high = max((r[5] for r, _ in sides[1] if r[5] is not None), default=None)
        sides = [[x for x in sides[0] if x[0][5] is not None and x[0][5] > low], [x for x in sides[1] if x[0][5] is not None and x[0][5] < high]]
    ah = None
    for s in sides:
        known = [r[6] for r, _ in s if r[6] is not None]
        if known:
            ah = (ah or 0) + sum(known) / len(known) * (max(c for _, c in s) - min(c for _, c in s) + 10) / 3600
    kept = sorted([x for s in sides for x in s], key=lambda x: (x[0][2], x[0][1]))
    if not kept:
        return None
    xs = [(c, r[6]) for r, c in kept if r[6] is not None]
    line = None
    if len({c for c, _ in xs}) > 1:
        b, a = np.polyfit(*map(np.array, zip(*[(float(c), i) for c, i in xs])), 1)
        t0, t1 = kept[0][1], kept[-1][1]
        line = (a * (t1 - t0) + b * (t1 * t1 - t0 * t0) / 2) / 3600
    s0, s1 = kept[0][0][5], kept[-1][0][5]
    ads = None if s0 is None or s1 is None else abs(s1 - s0)
    scaled = lambda x: None if x is None or not ads else x / ads * 100
    return ah, scaled(ah), line, scaled(line)


@pytest.mark.parametrize("trim", [False, True])
def test_current_models_equal_a_walk_over_the_records(spark, trim):
    rows = records(4)
    got = {(r["vin"], r["period_no"]): tuple(r)[2:] for r in periods.constant_current_models(spark.createDataFrame(rows, COLUMNS), trim=trim).collect()}
    want = {k: m for k, v in charging_periods(rows).items() if (m := model(v, trim)) is not None}
    assert got.keys() == want.keys() and len(want) > 15
    for k in want:
        assert all(near(a, b) for a, b in zip(got[k], want[k])), (k, got[k], want[k])


def test_grid_equals_interpolation_of_the_records(spark):
    rows = records(7)
    lab = periods.label_periods(spark.createDataFrame(rows, COLUMNS), known="soc")
    got = {}
    for r in periods.grid_interpolate(lab, step_s=15).collect():
        got.setdefault((r["vin"], r["period_no"]), []).append((r["ts"], r["soc"], r["slope_per_min"]))
    want = charging_periods(rows)
    assert got.keys() == want.keys()
    for k, rs in want.items():
        at, points, before = rs[0][2], [], None
        while at <= rs[-1][2]:
            p = [r for r in rs if r[5] is not None and r[2] <= at]
            n = [r for r in rs if r[5] is not None and r[2] > at]
            if not p:
                v = None
            elif not n or p[-1][2] == at:
                v = p[-1][5]
            else:
                a, b = p[-1], n[0]
                v = a[5] + (b[5] - a[5]) * ((at - a[2]) / (b[2] - a[2]))
            points.append((at, v, None if v is None or before is None else (v - before) / 0.25))
            before, at = v, at + dt.timedelta(seconds=15)
        mine = sorted(got[k])
        assert [x[0] for x in mine] == [x[0] for x in points]
        assert all(near(a[1], b[1]) and near(a[2], b[2]) for a, b in zip(mine, points)), k


@pytest.mark.parametrize("negative", [False, True])
def test_missing_time_equals_a_walk_over_the_records(spark, negative):
    rows = records(9)
    got = {(r["vin"], r["period_no"]): tuple(r)[2:] for r in periods.missing_time_treatments(
        spark.createDataFrame(rows, COLUMNS), slope_limit=-0.002 if negative else 0.001, negative_slope=negative).collect()}
    want = charging_periods(rows)
    assert got.keys() == want.keys()
    for k, rs in want.items():
        n, s0, s1 = len(rs), rs[0][5], rs[-1][5]
        span = None if s0 is None or s1 is None else abs(s1 - s0)
        thr = 2.5 * n * 10 / span if span else None
        fixed = current = 10
        for p, c in zip(rs, rs[1:]):
            d = int((c[2] - p[2]).total_seconds())
            slope = None if p[5] is None or c[5] is None or not d else (c[5] - p[5]) / d
            idle = slope is not None and (slope > -0.002 if negative else slope < 0.001)
            fixed += 10 if d > 120 and idle else d
            current += 10 if thr is not None and d > thr else d
        amps = [abs(r[6]) for r in rs if r[6] is not None]
        ah = sum(amps) * 10 / 3600 if amps else None
        scaled = lambda x: None if ah is None else ah * x / (n * 10)
        assert all(near(a, b) for a, b in zip(got[k], (n, fixed, current, scaled(fixed), scaled(current)))), k


def test_kinds_in_one_pass_equal_each_alone(spark):
    t = fixture.telemetry(spark, "/root/testdata/sf0.001")
    kinds = ("charging", "driving", "polarization")
    got = sorted(map(str, periods.periods_of(t, kinds, max_gap_s=86400).collect()))
    cols = periods.periods_of(t, kinds, max_gap_s=86400).columns
    want = sorted(str(r) for k in kinds for r in periods.periods(t, k, max_gap_s=86400).select(*cols).collect())
    assert got == want and len(got) > 50


def test_raw_rows_are_read_and_shuffled_once(spark):
    """One scan of the events, and one exchange by vehicle and day; the others carry segments."""
    t = fixture.telemetry(spark, "/root/testdata/sf0.001")
    for df in (periods.periods_of(t), periods.constant_current_models(t), periods.constant_current_models(t, trim=True), periods.missing_time_treatments(t)):
        plan = df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
        assert plan.count("FileScan parquet") == 1, plan
        assert plan.count("hashpartitioning(vin#") >= 1 and sum("day#" in x for x in plan.split("\n") if "hashpartitioning(" in x) == 1, plan
