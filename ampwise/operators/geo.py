"""Locations and charging-station clusters (SURVEY B6, B7, J6, J8, J9, A6-A9,
A23, F2, F5, F6, P23, W7).

Clusters: DBSCAN with ``min_samples=1`` makes every point a core point, so a
cluster is exactly a connected component of the graph joining points at most
``eps`` metres apart (haversine). Points are first reduced to distinct
coordinates, then to grid cells whose diagonal is at most ``eps``: a cell's
points are one cluster by definition, so components run over cells. Two cells
nearby are linked once if any of their points are within ``eps``, around the
circle of longitudes and over the poles. Components come from iterative
min-label propagation with pointer jumping until nothing changes; each round's
labels are checkpointed to the shared ``spark.checkpoint.dir`` so lineage stays
short and a lost executor recomputes one round only. Cluster labels are the
smallest (lat, lon) of the component, so they are deterministic.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as P
from ..functions.scalar import EARTH_RADIUS_M, coord_key, haversine_m, r6, record_energy_kwh, truncate_text
from ..session import reliable_checkpoint as _ckpt
from .scan import last_n_per_key
from .trips import drop_near_duplicates

# Fixed values of the reference.
LOCATION_DECIMALS = 2       # primary location: coordinates truncated to 2 places
LAST_N_RECORDS = 10_000     # primary location: latest records considered
CLUSTER_EPS_M = 20.0        # charging-station clustering radius (metres)


# ---------------------------------------------------------------- A6 / J6 / J8
def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in ``order`` (a ``min_by``
    aggregation, so a key with very many rows is combined map-side)."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    okey = F.struct(*[F.col(c) for c in order])
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), okey).alias("_r"))
    return first.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest])


def locate(points: DataFrame, lookup: DataFrame, order: str = "seq",
           keys: Sequence[str] = ("lat", "lon")) -> DataFrame:
    """Attach ``city`` and ``province`` from a coordinate lookup whose
    first entry per coordinate (by ``order``) wins; a left join whose build
    side AQE broadcasts when its measured size allows."""
    lk = first_per_key(lookup.select(*keys, order, "city", "province"), keys, [order]).drop(order)
    return points.join(lk, list(keys), "left")


# ---------------------------------------------------------------- B7
def primary_locations(df: DataFrame, n: int = LAST_N_RECORDS, decimals: int = LOCATION_DECIMALS,
                      order: Sequence[str] = ("ts", "event_id")) -> DataFrame:
    """Per vehicle the most frequent coordinate, truncated to ``decimals``
    places (F2), among its latest ``n`` records (W7, by time: deviation D14)
    with neither coordinate equal to ``0.00`` (P23). Ties go to the smallest
    ``lat+lon`` text (A9)."""
    p = df.where(P.valid_coordinates()).select(
        "vin", "day", *order, truncate_text("lat", decimals).alias("tlat"),
        truncate_text("lon", decimals).alias("tlon"))
    zero = "0." + "0" * decimals
    p = p.where((F.col("tlat") != zero) & (F.col("tlon") != zero))
    p = last_n_per_key(p, ["vin"], n, order, "day")
    counts = p.groupBy("vin", coord_key("tlat", "tlon").alias("coord")).agg(F.count(F.lit(1)).alias("n"))
    mode = counts.groupBy("vin").agg(
        F.min_by("coord", F.struct((-F.col("n")).alias("k"), F.col("coord"))).alias("coord"),
        F.max("n").alias("n_records"))
    parts = F.split("coord", "[+]")
    return mode.select("vin", parts[0].alias("lat"), parts[1].alias("lon"), "n_records")


# ---------------------------------------------------------------- J9 + components
def _deg(eps_m: float) -> float:
    return eps_m / (EARTH_RADIUS_M * math.pi / 180.0)


def _across(top: Column, least_deg: float) -> Column:
    """Into how many equal cells a latitude band is cut so that a cell is at
    least ``least_deg`` of arc wide up to latitude ``top``: one near a pole."""
    return F.greatest(F.lit(1), F.floor(F.cos(F.radians(F.least(top, F.lit(90.0)))) * 360 / least_deg)).cast("long")


def _cell(lon: Column, n: Column) -> Column:
    """Cell of a longitude among ``n`` around the circle; 180 is -180."""
    return F.pmod(F.floor((lon + 180) / 360 * n), n)


def neighbour_edges(points: DataFrame, eps_m: float = CLUSTER_EPS_M) -> DataFrame:
    """Pairs of distinct points (``lat, lon`` columns, distinct rows) at
    most ``eps_m`` apart, both directions, as ``src``/``dst`` structs.

    Latitude bands are ``eps`` of arc high, each cut into cells that are at
    least as wide in it and in the bands beside it. A point probes the three
    bands around it, in each the cell of its longitude and those beside it,
    around the circle: every pair within ``eps`` meets in one equi-join on
    (band, cell). The output is all pairs, by definition; clusters do not use
    it."""
    dlat = _deg(eps_m) * 1.01

    def n(band: Column) -> Column:
        return _across(F.greatest(F.abs(band - 1), F.abs(band + 2)) * dlat, dlat)

    cells = points.select("lat", "lon", F.floor(F.col("lat") / dlat).alias("cy"))
    build = cells.select(F.struct("lat", "lon").alias("dst"), "cy", _cell(F.col("lon"), n(F.col("cy"))).alias("cx"))
    bands = cells.select(F.struct("lat", "lon").alias("src"), "lon", F.explode(F.array(*[F.col("cy") + d for d in (-1, 0, 1)])).alias("cy"))
    bands = bands.withColumn("n", n(F.col("cy"))).withColumn("cx0", _cell(F.col("lon"), F.col("n")))
    probe = bands.select("src", "cy", F.explode(F.array_distinct(F.array(*[F.pmod(F.col("cx0") + d, F.col("n")) for d in (-1, 0, 1)]))).alias("cx"))
    pairs = probe.join(build, ["cy", "cx"])
    return pairs.where((F.col("src") != F.col("dst")) &
                       (haversine_m("src.lat", "src.lon", "dst.lat", "dst.lon") <= eps_m)).select("src", "dst")


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Min-label propagation with pointer jumping: ``node -> label`` where the
    label is the smallest node of the component. ``nodes`` has a ``node``
    column, ``edges`` has ``src``/``dst`` in both directions. Runs until a
    round changes nothing."""
    # the edge list is read every round: materialise it once (reliable
    # checkpoint) instead of recomputing it from the raw rows each time
    edges = _ckpt(edges)
    labels = _ckpt(nodes.select("node", F.col("node").alias("label")))
    while True:
        via = edges.join(labels.withColumnRenamed("node", "src"), "src") \
                   .select(F.col("dst").alias("node"), "label")
        prop = labels.unionByName(via).groupBy("node").agg(F.min("label").alias("label"))
        # pointer jumping: adopt the label of your label
        jump = prop.join(prop.select(F.col("node").alias("label"), F.col("label").alias("l2")), "label", "left") \
                   .select("node", F.least("label", F.coalesce("l2", "label")).alias("label"))
        # the change flag is part of the checkpointed round, so the check below
        # only reads the checkpoint
        new = _ckpt(jump.join(labels.withColumnRenamed("label", "old"), "node")
                    .select("node", "label", (F.col("label") != F.col("old")).alias("_changed")))
        labels = new.select("node", "label")
        if not new.where("_changed").limit(1).count():
            return labels


# Directions in which a cell's outermost points are kept: (lat, lon) weights.
_SIDES = ((1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (1, -1), (-1, 1), (-1, -1))


def _grid(points: DataFrame, side: float) -> DataFrame:
    """``lat, lon, cell`` with cells at most ``side`` degrees of arc high and
    wide: a struct (band, place)."""
    cy = F.floor(F.col("lat") / side)
    nearest = F.when(cy >= 0, cy).when(cy < -1, -cy - 1).otherwise(0) * side  # smallest |latitude| of the band
    n = F.greatest(F.lit(1), F.ceil(F.cos(F.radians(nearest)) * 360 / side)).cast("long")
    return points.select("lat", "lon", F.struct(cy.cast("long").alias("y"), _cell(F.col("lon"), n).cast("long").alias("x")).alias("cell"))


def cell_links(grid: DataFrame, eps_m: float, side: float) -> tuple[DataFrame, DataFrame]:
    """Cells (``cell``, their smallest point ``low``), and links (``src``,
    ``dst``, both directions) between cells with two points at most ``eps_m``
    apart: at most one link for each pair of cells nearby, however many points
    they hold. A pair is first tried on the cells' outermost points; the rest
    compare the points that lie within ``eps_m`` of the other cell's box."""
    eps = _deg(eps_m) * 1.001
    pt = F.struct("lat", "lon")
    outer = F.array(*[F.max_by(pt, F.struct((a * F.col("lat") + b * F.col("lon")).alias("k"), "lat", "lon")) for a, b in _SIDES])
    cells = _ckpt(grid.groupBy("cell").agg(
        F.min(pt).alias("low"), F.min("lat").alias("s"), F.max("lat").alias("n"), F.min("lon").alias("w"), F.max("lon").alias("e"), outer.alias("outer")))
    # bands in reach, in each the cells within eps of the cell's box
    up = math.ceil(eps / side)
    near = cells.select("*", F.explode(F.sequence(F.col("cell.y") - up, F.col("cell.y") + up)).alias("y"))
    top = F.greatest(F.abs(F.col("y")), F.abs(F.col("y") + 1), F.abs(F.col("cell.y")), F.abs(F.col("cell.y") + 1)) * side
    reach = F.least(F.lit(180.0), eps / F.greatest(F.cos(F.radians(F.least(top, F.lit(90.0)))), F.lit(1e-12)))
    at = F.when(F.col("y") >= 0, F.col("y")).when(F.col("y") < -1, -F.col("y") - 1).otherwise(0) * side
    n = F.greatest(F.lit(1), F.ceil(F.cos(F.radians(F.least(at, F.lit(90.0)))) * 360 / side)).cast("long")
    near = near.withColumn("reach", reach).withColumn("n_x", n)
    first = F.floor((F.col("w") - F.col("reach") + 180) / 360 * F.col("n_x"))
    last = F.floor((F.col("e") + F.col("reach") + 180) / 360 * F.col("n_x"))
    xs = F.array_distinct(F.transform(F.sequence(first, F.least(last, first + F.col("n_x") - 1)), lambda x: F.pmod(x, F.col("n_x"))))
    probe = near.select(F.col("cell").alias("src"), F.col("outer").alias("o1"), "reach", F.struct("s", "n", "w", "e").alias("b1"),
                        F.explode(F.transform(xs, lambda x: F.struct(F.col("y").cast("long").alias("y"), x.cast("long").alias("x")))).alias("dst"))
    other = cells.select(F.col("cell").alias("dst"), F.col("outer").alias("o2"), F.struct("s", "n", "w", "e").alias("b2"))
    pairs = probe.where(F.col("src") < F.col("dst")).join(other, "dst")
    met = F.exists("o1", lambda p: F.exists("o2", lambda q: haversine_m(p["lat"], p["lon"], q["lat"], q["lon"]) <= eps_m))
    pairs = _ckpt(pairs.where((F.col("b1.s") <= F.col("b2.n") + eps) & (F.col("b2.s") <= F.col("b1.n") + eps))
                  .select("src", "dst", "reach", "b1", "b2", met.alias("met")))
    open_ = pairs.where(~F.col("met"))

    def strip(mine: str, box: str) -> DataFrame:
        """Points of one cell of each open pair that are near the other's box."""
        p = open_.join(grid.withColumnRenamed("cell", mine), mine)
        width = F.pmod(F.col(f"{box}.e") - F.col(f"{box}.w"), F.lit(360.0)) + 2 * F.col("reach")
        return p.where((F.col("lat") >= F.col(f"{box}.s") - eps) & (F.col("lat") <= F.col(f"{box}.n") + eps)
                       & ((width >= 360) | (F.pmod(F.col("lon") - F.col(f"{box}.w") + F.col("reach"), F.lit(360.0)) <= width))).select("src", "dst", F.struct("lat", "lon").alias(f"p_{mine}"))

    close = strip("src", "b2").join(strip("dst", "b1"), ["src", "dst"]).where(
        haversine_m("p_src.lat", "p_src.lon", "p_dst.lat", "p_dst.lon") <= eps_m).select("src", "dst").distinct()
    links = pairs.where("met").select("src", "dst").union(close)
    return cells.select("cell", "low"), links.union(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def cluster_points(points: DataFrame, eps_m: float = CLUSTER_EPS_M, distinct: bool = False) -> DataFrame:
    """``lat, lon, cluster`` for the points' distinct coordinates; ``cluster``
    is a struct (lat, lon) of the component's smallest point. ``distinct``
    says the input already has one materialised row per coordinate."""
    pts = points.select("lat", "lon") if distinct else _ckpt(points.select("lat", "lon").distinct())
    side = _deg(eps_m) * 0.99 / math.sqrt(2)  # points of one cell are within eps of each other
    grid = _grid(pts, side)
    cells, links = cell_links(grid, eps_m, side)
    labels = connected_components(cells.select(F.col("cell").alias("node")), links)
    placed = labels.select(F.col("node").alias("cell"), "label").join(cells, "cell")
    lows = placed.groupBy("label").agg(F.min("low").alias("cluster"))
    return grid.join(placed.select("cell", "label").join(lows, "label").select("cell", "cluster"), "cell").select("lat", "lon", "cluster")


def cluster_summary(labelled: DataFrame) -> DataFrame:
    """Per cluster the number of points, the centroid (mean lat, mean
    lon), the centermost and the farthest member by haversine distance to the
    centroid (ties by coordinate)."""
    cen = labelled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.avg("lat").alias("centroid_lat"), F.avg("lon").alias("centroid_lon"))
    j = labelled.join(cen, "cluster")
    d = r6(haversine_m("lat", "lon", "centroid_lat", "centroid_lon"))
    pt = F.struct(F.col("lat"), F.col("lon"))
    out = j.groupBy("cluster", "n_points", "centroid_lat", "centroid_lon").agg(
        F.min_by(pt, F.struct(d, F.col("lat"), F.col("lon"))).alias("center"),
        F.max_by(pt, F.struct(d, -F.col("lat"), -F.col("lon"))).alias("far"),
        F.max(d).alias("radius_m"))
    return out.select("cluster", "n_points", r6("centroid_lat").alias("centroid_lat"),
                      r6("centroid_lon").alias("centroid_lon"),
                      F.col("center.lat").alias("center_lat"), F.col("center.lon").alias("center_lon"),
                      F.col("far.lat").alias("far_lat"), F.col("far.lon").alias("far_lon"), "radius_m")


def charging_stations(df: DataFrame, eps_m: float = CLUSTER_EPS_M, dedupe: bool = True,
                      order: Sequence[str] = ("vin", "ts", "event_id")) -> DataFrame:
    """Charging rows (P13, with position, charge voltage and current) ->
    near-duplicate removal per vehicle (W2, deviation D1) -> one record per
    coordinate when ``dedupe`` (A6; the reference's behaviour, so station
    energy is a lower bound, D12) -> clusters -> centermost member as the
    station (A23, J8) -> per-record energy (F14) -> sum per station (A7)."""
    ch = df.where(P.charging() & P.valid_coordinates()
                  & F.col("charge_volt").isNotNull() & F.col("charge_cur").isNotNull())
    ch = drop_near_duplicates(ch, ("vin",))
    if dedupe:
        # one row per distinct coordinate; clustered and joined back below
        ch = _ckpt(first_per_key(ch.select("lat", "lon", *order, "charge_volt", "charge_cur"),
                                 ["lat", "lon"], order))
    lab = cluster_points(ch.select("lat", "lon"), eps_m, distinct=dedupe)
    summ = cluster_summary(lab)
    rows = ch.join(lab, ["lat", "lon"]).join(summ.select("cluster", "center_lat", "center_lon"), "cluster")
    energy = record_energy_kwh("charge_volt", "charge_cur")
    st = (rows.groupBy(F.col("center_lat").alias("station_lat"), F.col("center_lon").alias("station_lon"))
          .agg(F.count(F.lit(1)).alias("n_records"), r6(F.sum(energy)).alias("energy_kwh")))
    # The representative record of each station, the first record at its coordinate
    rep = first_per_key(ch.select("lat", "lon", *order), ["lat", "lon"], order).select(
        F.col("lat").alias("station_lat"), F.col("lon").alias("station_lon"),
        F.col("vin").alias("rep_vin"), F.col("ts").alias("rep_ts"))
    return st.join(rep, ["station_lat", "station_lon"], "left").orderBy(F.col("energy_kwh").desc())


def energy_by_area(stations: DataFrame, lookup: DataFrame, decimals: int = LOCATION_DECIMALS,
                   levels: Sequence[str] = ("province", "city")) -> DataFrame:
    """Station energy summed by administrative area (J6 lookup on the
    station coordinate truncated to ``decimals`` places), descending."""
    s = stations.select(truncate_text("station_lat", decimals).alias("lat"),
                        truncate_text("station_lon", decimals).alias("lon"), "energy_kwh")
    a = locate(s, lookup)
    return (a.groupBy(*levels).agg(r6(F.sum("energy_kwh")).alias("energy_kwh"),
                                   F.count(F.lit(1)).alias("n_stations"))
            .orderBy(F.col("energy_kwh").desc()))
