"""Points to administrative areas by geometry.

An area is a polygon (its ring as an array of (lat, lon), closed or not) with an id.
Polygons are covered by grid cells of ``cell`` degrees; a point meets the areas of its
own cell only, by an equi-join on the cell. For a cell the cover keeps the edges that
decide a point there: those whose latitudes touch the cell's and that don't lie wholly
to its west. A point is inside where the ray to the east from it crosses an odd number
of these edges (an edge from its lower end inclusive to its upper end exclusive), or
where it lies on an edge: areas are closed. A point of several areas belongs to that
with the smallest id.

Everything is native: the cover is an ``explode`` of number sequences, the test a
``filter`` over a cell's few edges. A long border is spread over its cells, so a large
polygon costs a point no more than a small one. Points are summed per coordinate before
the join, so a place where a third of all records lie is one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.scalar import r6, record_energy_kwh

#: Degrees of a grid cell's side.
CELL = 0.01


def _row(x: Column, cell: float) -> Column:
    return F.floor(x / F.lit(cell)).cast("bigint")


def edges(areas: DataFrame, id_col: str = "area", ring: str = "ring") -> DataFrame:
    """(area, edge): the sides of each polygon, lower end first."""
    r = F.col(ring)
    nxt = F.concat(F.slice(r, 2, F.size(r)), F.slice(r, 1, 1))
    sides = F.filter(F.zip_with(r, nxt, lambda a, b: F.struct(
        F.least(a["lat"], b["lat"]).alias("lat0"), F.greatest(a["lat"], b["lat"]).alias("lat1"),
        F.when(a["lat"] <= b["lat"], a["lon"]).otherwise(b["lon"]).alias("lon0"), F.when(a["lat"] <= b["lat"], b["lon"]).otherwise(a["lon"]).alias("lon1"))),
        lambda e: e["lat0"].isNotNull() & e["lon0"].isNotNull() & e["lon1"].isNotNull())
    return areas.where(F.size(r) >= 3).select(F.col(id_col).alias("area"), F.explode(sides).alias("e"))


def cover(areas: DataFrame, cell: float = CELL, id_col: str = "area", ring: str = "ring") -> DataFrame:
    """(cy, cx, area, edges): for each cell that a polygon may reach, the edges that matter there."""
    e = edges(areas, id_col, ring)
    west, east = F.least("e.lon0", "e.lon1"), F.greatest("e.lon0", "e.lon1")
    span = e.groupBy("area").agg(_row(F.min(west), cell).alias("west"), _row(F.max(east), cell).alias("east"))
    rows = e.select("area", "e", F.explode(F.sequence(_row(F.col("e.lat0"), cell), _row(F.col("e.lat1"), cell))).alias("cy"), _row(east, cell).alias("to"))
    # an edge counts for the cells at its longitudes and west of them, up to the polygon's western end
    cells = rows.join(span, "area").select("area", "e", "cy", F.explode(F.sequence(F.col("west"), F.col("to"))).alias("cx"))
    return cells.groupBy("cy", "cx", "area").agg(F.collect_list("e").alias("edges"))


def _inside(lat: Column, lon: Column, sides: Column) -> Column:
    # which side of an edge a point is on: negative to the west of it
    def side(e):
        return (lon - e["lon0"]) * (e["lat1"] - e["lat0"]) - (e["lon1"] - e["lon0"]) * (lat - e["lat0"])

    crossed = F.size(F.filter(sides, lambda e: (lat >= e["lat0"]) & (lat < e["lat1"]) & (side(e) < 0)))
    on = F.exists(sides, lambda e: (side(e) == 0) & lat.between(e["lat0"], e["lat1"]) & lon.between(F.least(e["lon0"], e["lon1"]), F.greatest(e["lon0"], e["lon1"])))
    return (crossed % 2 == 1) | on


def locate(points: DataFrame, areas: DataFrame, cell: float = CELL, id_col: str = "area", ring: str = "ring",
           lat: str = "lat", lon: str = "lon") -> DataFrame:
    """``points`` with the ``area`` each lies in (null outside of all): the smallest id of several.
    Rows with the same coordinate get the same area; rows without one get none."""
    grid = cover(areas, cell, id_col, ring)
    at = points.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon")).where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).distinct()
    at = at.withColumn("cy", _row(F.col("_lat"), cell)).withColumn("cx", _row(F.col("_lon"), cell))
    hits = at.join(grid, ["cy", "cx"]).where(_inside(F.col("_lat"), F.col("_lon"), F.col("edges")))
    found = hits.groupBy("_lat", "_lon").agg(F.min("area").alias("area"))
    return points.join(found, (points[lat] == found["_lat"]) & (points[lon] == found["_lon"]), "left").drop("_lat", "_lon")


def energy_by_levels(df: DataFrame, areas: DataFrame, levels: Sequence[str] = ("province", "city", "district"),
                     cell: float = CELL) -> DataFrame:
    """Energy of the charging records (F14) and their number by administrative levels, of which
    ``areas`` carries the columns beside ``area`` and ``ring``. Records outside of all areas have
    null levels."""
    ch = df.where(P.charging() & P.valid_coordinates() & F.col("charge_volt").isNotNull() & F.col("charge_cur").isNotNull())
    per = ch.groupBy("lat", "lon").agg(F.sum(record_energy_kwh("charge_volt", "charge_cur")).alias("kwh"), F.count(F.lit(1)).alias("n"))
    placed = locate(per, areas, cell).join(areas.select("area", *levels), "area", "left")
    return placed.groupBy(*levels).agg(r6(F.sum("kwh")).alias("energy_kwh"), F.sum("n").alias("n_records"))
