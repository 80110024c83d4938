"""The versioned stat history against a rebuild from scratch, for any order of arrival."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from ampwise.operators import history, rollup

D0 = dt.date(2024, 1, 28)


def day(i):
    return D0 + dt.timedelta(days=i)


def random_rows(seed, vehicles=4, days=40):
    """{batch: rows}: each batch has rows of its own day and, now and then, of earlier days."""
    rnd, out = random.Random(seed), {}
    for i in range(days):
        rows = []
        for v in range(vehicles):
            labels = {i} if rnd.random() < 0.5 else set()
            if rnd.random() < 0.3:
                labels.add(max(0, i - rnd.randint(1, 12)))
            for j in labels:
                avg = rnd.choice([None, 0.0, float(rnd.randint(1, 90))])
                n = 0 if avg is None else rnd.randint(1, 5)
                values = (rnd.choice([None, rnd.randint(0, 500) / 10]), rnd.choice([None, rnd.randint(0, 24) / 4]), avg, n)
                rows.append(("daily", f"v{v}", day(j).isoformat(), day(i), *values))
                for h in rnd.sample(range(24), 2):
                    rows.append(("hourly", f"v{v}", f"{day(j).isoformat()} {h:02d}:00:00", day(i), *values))
        out[day(i)] = rows
    return out


def rebuilt(rows, end):
    """What the history must say, from all rows at once, with plain loops."""
    def merged(items):
        items = sorted(items, key=lambda r: r[3])
        if len(items) == 1:
            return items[0][4:]
        add = lambda c: None if all(r[c] is None for r in items) else round(sum(r[c] or 0 for r in items), 6)
        said = [r for r in items if r[6] is not None]
        n = sum(r[7] for r in said)
        return add(4), add(5), (sum(r[6] * r[7] for r in said) / n if n else None), sum(r[7] for r in items)

    by = {}
    for r in rows:
        by.setdefault((r[0], r[1], r[2]), []).append(r)
    values = {k: merged(v) for k, v in by.items()}
    out = set()

    def put(vin, freq, label, miles, hours, avg, n):
        near = lambda x: None if x is None else round(x, 5)
        out.update({(vin, "miles_driven", freq, label, near(miles), None), (vin, "charging_hours", freq, label, near(hours), None),
                    (vin, "average_speed", freq, label, near(avg), n)})

    for (freq, vin, label), v in values.items():
        if freq == "hourly":
            put(vin, "hourly", label, *v)
    for vin in {k[1] for k in values}:
        have = {dt.date.fromisoformat(k[2]): v for k, v in values.items() if k[0] == "daily" and k[1] == vin}
        if not have:
            continue
        d, month, first = min(have), None, min(have)
        while d <= end:
            v = have.get(d)
            if v is None:
                for h in range(24):
                    put(vin, "hourly", f"{d.isoformat()} {h:02d}:00:00", None, None, None, 0)
            put(vin, "daily", d.isoformat(), *(v or (None, None, None, 0)))
            if d.day == 1 or d == first:
                month = v or (None, None, None, 0)
            elif v is not None:
                (am, ah, aa, an), (bm, bh, ba, bn) = month, v
                plus = lambda a, b: None if a is None and b is None else (a or 0) + (b or 0)
                if aa is None and ba is None:
                    speed = (None, 0)
                else:
                    an, bn = 1 if aa == 0 else an, 1 if ba == 0 else bn
                    speed = (((aa or 0) * an + (ba or 0) * bn) / (an + bn) if an + bn else None, an + bn)
                month = (plus(am, bm), plus(ah, bh), *speed)
            nxt = d + dt.timedelta(days=1)
            if nxt.day == 1 or nxt > end:
                put(vin, "monthly", f"{d.year}-{d.month}", *month)
            d = nxt
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, history.ROWS)


def said(spark, path):
    return {(r["vin"], r["stat"], r["freq"], r["time_label"], None if r["value"] is None else round(r["value"], 5), r["weight"])
            for r in history.long_rows(spark, path).collect()}


@pytest.mark.parametrize("seed", [2])
def test_any_order_of_arrival_equals_a_rebuild(spark, tmp_out, seed):
    """Batches in random order and groups, some delivered twice (the first time with other rows),
    a compaction in between."""
    rnd, batches = random.Random(seed), random_rows(seed)
    left, path = list(batches), f"{tmp_out}/h"
    rnd.shuffle(left)
    wrong = left[:6]
    other = random_rows(seed + 50)
    history.apply(spark, path, frame(spark, [r for b in wrong for r in other[b]]), wrong)
    left = left[6:] + wrong
    while left:
        k = rnd.randint(8, 20)
        take, left = left[:k], left[k:]
        history.apply(spark, path, frame(spark, [r for b in take for r in batches[b]]), take)
        if rnd.random() < 0.4:
            history.compact(spark, path)
    assert said(spark, path) == rebuilt([r for rows in batches.values() for r in rows], max(batches))


def test_only_touched_keys_are_written(spark, tmp_out):
    """A late row rewrites its day and the later days of that month, nothing else."""
    path = f"{tmp_out}/h"
    rows = [("daily", v, day(i).isoformat(), day(i), 10.0, 1.0, 50.0, 3) for v in ("a", "b") for i in range(30)]
    history.apply(spark, path, frame(spark, rows))
    late = ("daily", "a", "2024-02-20", day(40), 1.0, None, 0.0, 2)
    v = history.apply(spark, path, frame(spark, [late]))
    got = spark.read.parquet(f"{path}/days/version={v}")
    assert sorted({r["month"] for r in got.collect()}) == ["2024-02"]
    assert sorted((r["vin"], r["day"].isoformat()) for r in got.collect()) == [("a", f"2024-02-{d}") for d in range(20, 27)]
    assert spark.read.parquet(f"{path}/vehicles/version={v}").count() == 0
    # nothing arrives: a version without rows, the calendar goes on to the new batch
    history.apply(spark, path, frame(spark, []), [day(45)])
    assert history.daily(spark, path).agg(F.max("day")).first()[0] == day(45)


def test_first_day_moves(spark, tmp_out):
    """An earlier first day makes the old first month start from an empty day 01."""
    path, r = f"{tmp_out}/h", lambda d, avg, n: ("daily", "a", d, dt.date(2024, 3, 5), 1.0, None, avg, n)
    history.apply(spark, path, frame(spark, [r("2024-03-05", 0.0, 4)]))
    first = [x for x in said(spark, path) if x[1:3] == ("average_speed", "monthly")]
    assert first == [("a", "average_speed", "monthly", "2024-3", 0.0, 4)]
    history.apply(spark, path, frame(spark, [("daily", "a", "2024-01-30", dt.date(2024, 3, 9), 1.0, None, 5.0, 2)]))
    got = {x[3]: x[4:] for x in said(spark, path) if x[1:3] == ("average_speed", "monthly")}
    assert got == {"2024-1": (5.0, 2), "2024-2": (None, 0), "2024-3": (0.0, 1)}  # 0 counts once in the fold
    history.apply(spark, path, frame(spark, []), [dt.date(2024, 3, 9)])  # the batch again, empty: its row goes
    got = {x[3]: x[4:] for x in said(spark, path) if x[1:3] == ("average_speed", "monthly")}
    assert got == {"2024-3": (0.0, 4)}


def test_a_run_that_dies_leaves_the_history_as_it_was(spark, tmp_out, monkeypatch):
    path, batches = f"{tmp_out}/h", random_rows(3, days=12)
    order = sorted(batches)
    history.apply(spark, path, frame(spark, [r for b in order[:6] for r in batches[b]]), order[:6])
    before = said(spark, path)
    with monkeypatch.context() as m:
        m.setattr(history, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            history.apply(spark, path, frame(spark, [r for b in order[6:] for r in batches[b]]), order[6:])
    assert said(spark, path) == before and os.path.exists(f"{path}/days/version=2")
    history.apply(spark, path, frame(spark, [r for b in order[6:] for r in batches[b]]), order[6:])
    assert said(spark, path) == rebuilt([r for rows in batches.values() for r in rows], order[-1])


def test_odd_rows_and_documents(spark, tmp_out):
    path = f"{tmp_out}/h"
    rows = [("daily", None, "2024-02-01", D0, 1.0, 1.0, 1.0, 1), ("daily", "a", None, D0, 1.0, 1.0, 1.0, 1), ("daily", "a", "2024-02-01", None, 1.0, 1.0, 1.0, 1),
            ("daily", "a", "2024-02-01", dt.date(2024, 2, 2), 1.0, None, None, None), ("daily", "a", "2024-02-01", dt.date(2024, 2, 2), 2.0, None, None, None)]
    assert history.long_rows(spark, path).count() == 0
    history.apply(spark, path, frame(spark, rows))
    assert ("a", "miles_driven", "monthly", "2024-2", 2.0, None) in said(spark, path)
    docs = rollup.stat_documents(history.long_rows(spark, path))
    assert {tuple(r) for r in rollup.long_form(docs).collect()} == {tuple(r) for r in history.long_rows(spark, path).collect()}
    assert {r["month"] for r in docs.collect()} == {"2024-2"}


def test_gaps_are_filled_without_a_join_and_nothing_stays_cached(spark, tmp_out, capsys):
    """Missing days follow from the next present day of the vehicle, so the dense calendar is neither dealt nor sorted."""
    path = f"{tmp_out}/h"
    rows = [("daily", v, day(i).isoformat(), day(i), 1.0, None, 5.0, 2) for v, i in (("a", 0), ("a", 3), ("b", 2))]
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    history.apply(spark, path, frame(spark, rows), [day(5)])
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    df = history.daily(spark, path)
    capsys.readouterr()
    df.explain()
    assert "Join" not in capsys.readouterr().out
    got = sorted((r["vin"], (r["day"] - D0).days, r["present"], r["speed_n"]) for r in df.collect())
    assert got == [("a", i, i in (0, 3), 2 if i in (0, 3) else None) for i in range(6)] + [("b", i, i == 2, 2 if i == 2 else None) for i in range(2, 6)]
    later = history.daily(spark, path, ["2024-02"])  # from 2024-02-01, day 4, on
    assert sorted((r["vin"], (r["day"] - D0).days, r["present"]) for r in later.collect()) == [(v, i, False) for v in "ab" for i in (4, 5)]
