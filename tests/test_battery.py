"""B5 SOC trips: the window formulation against a literal state machine."""

import datetime as dt
import random

from ampwise.operators import battery

T0 = dt.datetime(2024, 3, 1, 6, 0, 0)


def state_machine(rows, up_min=90, dn_min=60, dn_max=70, ending_date=None, offset=1):
    """The reference's per-row loop, restated (newest to oldest)."""
    rows = sorted(rows, key=lambda r: (r["ts"], r["odo"], r["event_id"]), reverse=True)
    if not rows:
        return []
    end = ending_date if ending_date is not None else rows[0]["day"]
    out, state, complete, trip, last = [], 0, False, [], None
    for r in rows:
        soc = r["soc"]
        if state == 0:
            if dn_min <= soc <= dn_max:
                if r["day"] == end:
                    trip, last, complete, state = [r], soc, False, 1
                else:
                    break
        else:
            if soc - last > -offset:
                trip.append(r)
                last = soc
                if soc >= up_min:
                    complete = True
            else:
                if complete:
                    out.append(trip)
                    complete = False
                state = 0
    if complete:
        out.append(trip)
    return out


def _frame(spark, rows):
    return spark.createDataFrame(
        [(r["vin"], r["event_id"], r["ts"], r["day"], float(r["soc"]), r["odo"]) for r in rows],
        "vin long, event_id long, ts timestamp_ntz, day date, soc double, odo long")


def _expected(rows):
    out = set()
    for vin in {r["vin"] for r in rows}:
        for trip in state_machine([r for r in rows if r["vin"] == vin]):
            out.add((vin, trip[-1]["ts"], trip[0]["ts"], float(trip[-1]["soc"]), float(trip[0]["soc"]), len(trip)))
    return out


def _actual(spark, rows):
    res = battery.soc_trips(_frame(spark, rows)).collect()
    return {(r.vin, r.start_time, r.end_time, r.start_soc, r.end_soc, r.n_records) for r in res}


def _random_rows(rng, n_vins=40):
    rows, eid = [], 0
    for vin in range(n_vins):
        t, soc, odo = T0, rng.choice([65, 95, 80, 62]), 1000
        for _ in range(rng.randint(1, 60)):
            t += dt.timedelta(seconds=rng.choice([10, 10, 30, 3600, 20000]))
            soc = max(41, min(100, soc + rng.choice([-3, -2, -1, -0.5, 0, 0.5, 1, 2, 5, 20, -20])))
            odo += rng.choice([0, 1])
            rows.append({"vin": vin, "event_id": eid, "ts": t, "day": t.date(), "soc": soc, "odo": odo})
            eid += 1
    return rows


def test_random_sequences_match_state_machine(spark):
    rng = random.Random(7)
    rows = _random_rows(rng)
    assert _actual(spark, rows) == _expected(rows)


def test_hand_cases(spark):
    def seq(vin, socs, start=T0, step=10):
        return [{"vin": vin, "event_id": vin * 100 + i, "ts": start + dt.timedelta(seconds=i * step),
                 "day": (start + dt.timedelta(seconds=i * step)).date(), "soc": s, "odo": 5000 + i}
                for i, s in enumerate(socs)]
    rows = (seq(1, [95, 90, 80, 70, 65])                 # one complete trip
            + seq(2, [95, 85, 86, 70])                    # dip of exactly 1 back in time breaks it
            + seq(3, [95, 80, 65, 92, 75, 66])            # recharge between two openers
            + seq(4, [91, 66], start=T0 - dt.timedelta(days=1)) + seq(4, [64], start=T0)   # opener on last day, continues back
            + seq(5, [95, 65], start=T0 - dt.timedelta(days=1)) + seq(5, [80], start=T0)   # eligible row on another date first: stop
            + seq(6, [60, 70, 95, 69]))                   # trip open at the end of the data
    assert _actual(spark, rows) == _expected(rows)
