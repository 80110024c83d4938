"""Rolling windows from daily sketches against the raw records."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from ampwise.operators import sketches
from ampwise.sources import fixture

SF = "/root/testdata/sf0.01"
D0 = dt.date(2024, 1, 1)


def test_quantiles_keep_their_bound_after_merging(spark):
    """Rank error of merged quantiles over all records of each window; counts and vehicles exact."""
    t = fixture.telemetry(spark, SF).select("vin", "day", "speed", "curr")
    days = sketches.daily(t, {"speed": (0, 5), "curr": (0, 5)})
    got = {(r["day"], r["signal"]): r for r in sketches.rolling(days, ["speed", "curr"]).collect()}
    rows = t.toPandas()
    worst = 0.0
    for (day, signal), r in got.items():
        part = rows[(rows["day"] <= day) & (rows["day"] > day - dt.timedelta(days=30))]
        x = np.sort(part[signal].to_numpy())
        assert r["n"] == len(x) and r["vehicles"] == part["vin"].nunique()
        assert abs(r["mean"] - x.mean()) < 1e-5 and abs(r["low"] - x[0]) < 1e-5 and abs(r["high"] - x[-1]) < 1e-5
        for p, q in ((0.25, r["q25"]), (0.5, r["q50"]), (0.75, r["q75"])):
            lo, hi = np.searchsorted(x, q, "left") / len(x), np.searchsorted(x, q, "right") / len(x)
            worst = max(worst, 0.0 if lo <= p <= hi else min(abs(lo - p), abs(hi - p)))
    assert len(got) > 150 and worst < 0.025


def test_odd_rows_and_keys(spark):
    rnd = random.Random(3)
    rows = [("m1", f"v{rnd.randint(0, 5)}", D0 + dt.timedelta(days=rnd.choice([0, 1, 5, 9])), rnd.choice([None, float("nan"), 1.0, 2.5, -3.0])) for _ in range(200)]
    rows += [("m2", "v", D0, None), ("m2", "w", None, 4.0)]
    df = spark.createDataFrame(rows, "model string, vin string, day date, x double")
    days = sketches.daily(df, {"x": (0.0, 2.0)}, keys=("model",))
    assert days.count() == len({(r[0], r[2]) for r in rows if r[2]})
    got = {(r["model"], r["day"]): r for r in sketches.rolling(days, ["x"], ("model",), days=5).collect()}
    hist = {(r["model"], r["day"], r["bin"]): r["n"] for r in sketches.rolling_histogram(days, ("model",), days=5).collect()}
    for (model, day), r in got.items():
        part = [x for m, v, d, x in rows if m == model and d and day - dt.timedelta(days=5) < d <= day]
        x = [v for v in part if v is not None and v == v]
        assert r["n"] == len(x) and (r["mean"] is None) == (not x) and r["q50"] in (x or [None])
        for b in {int(v // 2) for v in x}:
            assert hist[(model, day, b)] == sum(v // 2 == b for v in x)
    assert sum(hist.values()) > 0 and sketches.rolling(sketches.daily(df.where(F.lit(False)), {"x": (0.0, 2.0)}), ["x"]).count() == 0
