"""Nearest zones of points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import EARTH_MILES, plane_xy
from .relational import small

#: Edges (of 32 bytes) that may be broadcast with their zones.
MOST_EDGES = 250_000


def zones_from_wkt(zones: DataFrame, wkt: str = "wkt", zone: str = "zone_id") -> DataFrame:
    """zone, edges array<struct<x1, y1, x2, y2>> of POLYGON and MULTIPOLYGON texts; every ring's edges count, so holes are outside."""
    rings = F.split(F.regexp_extract(F.col(wkt), r"\(\s*\(?\s*\(([^a-zA-Z]*?)\)\s*\)?\s*\)\s*$", 1), r"\)\s*\)?\s*,\s*\(?\s*\(")
    point = lambda t: F.struct(F.split(F.trim(t), r"\s+")[0].cast("double").alias("x"), F.split(F.trim(t), r"\s+")[1].cast("double").alias("y"))
    edges = F.flatten(
        F.transform(
            rings,
            lambda r: F.transform(
                F.filter(F.transform(F.split(r, ","), lambda t, i: F.struct(point(t).alias("a"), point(F.get(F.split(r, ","), i + 1)).alias("b"))), lambda e: e["b"]["x"].isNotNull()),
                lambda e: F.struct(e["a"]["x"].alias("x1"), e["a"]["y"].alias("y1"), e["b"]["x"].alias("x2"), e["b"]["y"].alias("y2")),
            ),
        )
    )
    return zones.select(F.col(zone), edges.alias("edges"))


def _distance(x, y, edges):
    """From a point to a polygon: 0 inside, else to the nearest edge."""

    def to_edge(e):
        dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
        t = F.coalesce(F.try_divide((x - e["x1"]) * dx + (y - e["y1"]) * dy, dx * dx + dy * dy), F.lit(0.0))
        t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
        return F.hypot(x - (e["x1"] + t * dx), y - (e["y1"] + t * dy))

    crossed = F.filter(edges, lambda e: ((e["y1"] > y) != (e["y2"] > y)) & (x < F.coalesce(F.try_divide((e["x2"] - e["x1"]) * (y - e["y1"]), e["y2"] - e["y1"]), F.lit(0.0)) + e["x1"]))
    return F.when(F.size(crossed) % 2 == 1, 0.0).otherwise(F.array_min(F.transform(edges, to_edge)))


def zone_cells(zones: DataFrame, max_distance: float, zone: str = "zone_id") -> DataFrame:
    """(zone, _level, _cx, _cy): the cells of a grid of several levels that zones, widened by max_distance, touch.

    Cells of a level are 2 ** level wide, and a zone is listed at the first level whose cells are no smaller than it, so
    in four cells at most, whatever sizes the other zones have.
    """
    ends = lambda n: F.transform("edges", lambda e: e[n])
    side = lambda f, *names: f(F.flatten(F.array(*map(ends, names))))
    boxes = zones.select(zone, *((side(F.array_min, f"{c}1", f"{c}2") - max_distance).alias(f"_{c}1") for c in "xy"), *((side(F.array_max, f"{c}1", f"{c}2") + max_distance).alias(f"_{c}2") for c in "xy"))
    size = F.greatest(F.col("_x2") - F.col("_x1"), F.col("_y2") - F.col("_y1"), F.lit(1e-9))
    boxes = boxes.withColumn("_level", F.ceil(F.log2(size)).cast("int"))
    span = lambda c: F.sequence(_cell(F.col(f"_{c}1"), F.col("_level")), _cell(F.col(f"_{c}2"), F.col("_level")))
    return boxes.select(zone, "_level", F.explode(span("x")).alias("_cx"), span("y").alias("_ys")).select(zone, "_level", "_cx", F.explode("_ys").alias("_cy"))


def _cell(at: Column, level: Column) -> Column:
    return F.floor(at / F.pow(F.lit(2.0), level)).cast("long")


def in_feet(points: DataFrame, zones: DataFrame, latitude: float, x: str = "x", y: str = "y") -> tuple[DataFrame, DataFrame]:
    """points and zones with degrees (x: longitude) made feet on a plane around a latitude."""
    flat = lambda a, b: plane_xy(a, b, latitude, EARTH_MILES * 5280)

    def edge(e: Column) -> Column:
        ends = [flat(e[f"x{k}"], e[f"y{k}"]) for k in (1, 2)]
        return F.struct(*(c.alias(f"{n}{k}") for k, pair in enumerate(ends, 1) for n, c in zip("xy", pair, strict=True)))

    px, py = flat(F.col(x).cast("double"), F.col(y).cast("double"))
    return points.withColumns({x: px, y: py}), zones.withColumn("edges", F.transform("edges", edge))


def nearest_zone_join(points: DataFrame, zones: DataFrame, max_distance: float, point_id: str = "point_id", x: str = "x", y: str = "y", zone: str = "zone_id", latitude: float | None = None) -> DataFrame:
    """points with the nearest zone within max_distance, or null: inside counts as 0, ties (to 1e-9) go to the smallest zone id.

    Zones are listed in the few cells of their own size (zone_cells), and a point looks up one cell at each level that
    zones have, so the join has an equal key and its rows don't depend on how unlike zones are. Only ids are listed; the
    edges come in later, broadcast if their counted size allows it. Cells are broadcast or, if there are too many,
    joined by a shuffle, where Spark splits a cell with very many points. Point ids are unique. Points without
    coordinates have no zone. With a latitude, x and y are degrees, and max_distance and distance are in feet.
    """
    keyed = points.select(point_id, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    shapes = zones.select(zone, "edges")
    if latitude is not None:
        keyed, shapes = in_feet(keyed, shapes, latitude, "_x", "_y")
    cells = zone_cells(shapes, max_distance, zone)
    levels, edges = cells.agg(F.collect_set("_level")).first()[0], shapes.agg(F.sum(F.size("edges"))).first()[0]
    keyed = keyed.where("_x IS NOT NULL AND _y IS NOT NULL").withColumn("_level", F.explode(F.array(*map(F.lit, sorted(levels))) if levels else F.array().cast("array<int>")))
    keyed = keyed.withColumns({"_cx": _cell(F.col("_x"), F.col("_level")), "_cy": _cell(F.col("_y"), F.col("_level"))})
    shapes = F.broadcast(shapes) if (edges or 0) <= MOST_EDGES else shapes
    near = keyed.join(small(cells), ["_level", "_cx", "_cy"]).join(shapes, zone).withColumn("_d", _distance(F.col("_x"), F.col("_y"), F.col("edges"))).where(F.col("_d") <= max_distance)
    best = near.groupBy(point_id).agg(F.min_by(zone, F.struct(F.round("_d", 9), zone)).alias(zone), F.min("_d").alias("distance"))
    return points.join(best, point_id, "left")


def nearest_zones(points: DataFrame, zones: DataFrame, max_distance: float, roles: dict[str, tuple[str, str]], point_id: str = "point_id", zone: str = "zone_id", latitude: float | None = None) -> DataFrame:
    """points with <role>_zone for each role, the names of its coordinates: all roles go through one nearest_zone_join.

    roles: {"home": ("home_x", "home_y"), "work": ("work_x", "work_y")}.
    """
    spots = points.select(F.col(point_id).alias("_id"), F.explode(F.array(*(F.struct(F.lit(r).alias("role"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y")) for r, (a, b) in roles.items()))).alias("p"))
    spots = spots.select(F.struct("_id", "p.role").alias("spot"), "p.x", "p.y")
    found = nearest_zone_join(spots, zones, max_distance, "spot", zone=zone, latitude=latitude)
    by_role = found.groupBy(F.col("spot._id").alias(point_id)).agg(*(F.max(F.when(F.col("spot.role") == r, F.col(zone))).alias(f"{r}_zone") for r in roles))
    return points.join(by_role, point_id, "left")
