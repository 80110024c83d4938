"""Points in polygons by grid cells, against testing every polygon."""

import random

import pytest
from pyspark.sql import functions as F

from ampwise.operators import areas

SCHEMA = "area long, ring array<struct<lat:double,lon:double>>"


def inside(lat, lon, ring):
    """Closed polygon: on a side, or an odd number of crossings to the east."""
    odd = False
    for (ay, ax), (by, bx) in zip(ring, ring[1:] + ring[:1]):
        (y0, x0), (y1, x1) = ((ay, ax), (by, bx)) if ay <= by else ((by, bx), (ay, ax))
        s = (lon - x0) * (y1 - y0) - (x1 - x0) * (lat - y0)
        if s == 0 and y0 <= lat <= y1 and min(x0, x1) <= lon <= max(x0, x1):
            return True
        odd ^= y0 <= lat < y1 and s < 0
    return odd


@pytest.mark.parametrize("cell", [0.25, 1.0, 64.0])
def test_points_equal_testing_every_polygon(spark, cell):
    """Random rings that may cross themselves, corners and points on a coarse grid so that many
    points lie on sides and corners, negative coordinates, a ring given closed."""
    rnd = random.Random(5)
    rings = [[(rnd.randint(-12, 12) / 4, rnd.randint(-12, 12) / 4) for _ in range(rnd.randint(3, 9))] for _ in range(40)]
    rings.append(rings[0] + rings[0][:1])
    points = {(rnd.randint(-16, 16) / 4, rnd.randint(-16, 16) / 4) for _ in range(500)} | {(rnd.uniform(-4, 4), rnd.uniform(-4, 4)) for _ in range(300)}
    polygons = spark.createDataFrame([(i, r) for i, r in enumerate(rings)] + [(-5, rings[0][:2]), (-6, []), (-7, None)], SCHEMA)
    df = spark.createDataFrame([(y, x, "k") for y, x in points], "lat double, lon double, more string")
    got = {(r["lat"], r["lon"]): r["area"] for r in areas.locate(df, polygons, cell).collect()}
    want = {(y, x): min((i for i, r in enumerate(rings) if inside(y, x, r)), default=None) for y, x in points}
    assert got == want and len({v for v in want.values()}) > 10


def test_rows_without_a_place_stay(spark):
    square = spark.createDataFrame([(1, [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0), (1.0, 0.0)])], SCHEMA)
    df = spark.createDataFrame([(0.5, 0.5), (0.5, 0.5), (None, 0.5), (1.0, 1.0), (1.1, 0.5)], "lat double, lon double")
    got = sorted((str(r["lat"]), r["area"]) for r in areas.locate(df, square).collect())
    assert got == [("0.5", 1), ("0.5", 1), ("1.0", 1), ("1.1", None), ("None", None)]
    assert areas.locate(df, square.where(F.lit(False))).where("area IS NOT NULL").count() == 0
