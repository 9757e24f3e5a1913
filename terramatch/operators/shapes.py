"""Polygons as relations: a row a ring, with its points as an array of (x, y). Predicates are column expressions, joins go by cells."""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geodesy import utm_epsg, utm_forward, utm_inverse
from ..session import durable
from .filters import found
from .matching import small


def edges(ring: Column) -> Column:
    """(x0, y0, x1, y1) of all edges, the closing one included."""
    after = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, F.lit(1)))
    return F.zip_with(ring, after, lambda a, b: F.struct(a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1")))


def all_edges(ring: Column, holes: Column | None = None) -> Column:
    """Edges of a ring and of its holes."""
    return edges(ring) if holes is None else F.concat(edges(ring), F.flatten(F.transform(F.coalesce(holes, F.array()), edges)))


def holes_of(polygons: DataFrame) -> list[str]:
    """The column of holes, if there is one."""
    return [c for c in polygons.columns if c == "holes"]


def contains(ring: Column, x: Column, y: Column, holes: Column | None = None) -> Column:
    """Whether a ring contains a point and no hole does, by crossings of a ray to the right; a point on a lower or left edge is inside, on the
    others not."""
    return odd_crossings(all_edges(ring, holes), x, y)


def box(ring: Column) -> dict[str, Column]:
    value = lambda f, c: f(F.transform(ring, lambda p: p[c]))
    return {"west": value(F.array_min, "x"), "south": value(F.array_min, "y"), "east": value(F.array_max, "x"), "north": value(F.array_max, "y")}


def shoelace(ring: Column) -> Column:
    """Signed area, counter-clockwise positive."""
    return F.aggregate(edges(ring), F.lit(0.0), lambda a, e: a + (e["x0"] * e["y1"] - e["x1"] * e["y0"])) / 2.0


def centroid(ring: Column) -> tuple[Column, Column]:
    """Of a ring without area, as of points on a line, the mean of its points; of one without points, null."""
    area, mean = shoelace(ring), lambda c: F.aggregate(ring, F.lit(0.0), lambda a, p: a + p[c]) / F.nullif(F.size(ring).cast("double"), F.lit(0.0))
    at = lambda c: F.aggregate(edges(ring), F.lit(0.0), lambda a, e: a + (e[f"{c}0"] + e[f"{c}1"]) * (e["x0"] * e["y1"] - e["x1"] * e["y0"])) / F.nullif(6.0 * area, F.lit(0.0))
    return F.coalesce(at("x"), mean("x")), F.coalesce(at("y"), mean("y"))


def to_utm(ring: Column, zone: Column, south: Column) -> Column:
    """A ring in degrees, projected."""
    def project(p: Column) -> Column:
        east, north = utm_forward(p["y"], p["x"], zone, south)
        return F.struct(east.alias("x"), north.alias("y"))

    return F.transform(ring, project)


def modal_zone(polygons: DataFrame) -> DataFrame:
    """epsg: the code that most polygons' centroids lie in, the smallest among equals. One row."""
    x, y = centroid(F.col("ring"))
    counts = polygons.select(x.alias("x"), y.alias("y")).filter("x IS NOT NULL").select(utm_epsg(F.col("y"), F.col("x")).alias("epsg")).groupBy("epsg").count()
    return counts.orderBy(F.desc("count"), "epsg").limit(1).select("epsg")


def zone_of(polygons: DataFrame) -> tuple[Column, Column]:
    """Number and hemisphere (whether southern) of the modal zone, as constants: one number comes to the driver. No polygons have zone 1."""
    row = modal_zone(polygons).first()
    epsg = row[0] if row else 32601
    return F.lit(epsg % 100), F.lit(epsg >= 32700)


def area_m2(polygons: DataFrame) -> DataFrame:
    """One row: the area of all polygons in square metres, projected to their modal zone."""
    zone, south = zone_of(polygons)
    size = lambda ring: F.abs(shoelace(to_utm(ring, zone, south)))
    a = size(F.col("ring"))
    if holes_of(polygons):
        a = a - F.aggregate(F.coalesce("holes", F.array()), F.lit(0.0), lambda t, hole: t + size(hole))
    return polygons.select(a.alias("a")).agg(F.coalesce(F.sum("a"), F.lit(0.0)).alias("area_m2"))


def cells_of(polygons: DataFrame, size: float) -> DataFrame:
    """polygons with each cell of a coarse grid that the box touches, as cx, cy: the key of the joins below."""
    b = box(F.col("ring"))
    span = lambda lo, hi: F.sequence(F.floor(b[lo] / size).cast("int"), F.floor(b[hi] / size).cast("int"))
    return polygons.withColumn("cx", F.explode(span("west", "east"))).withColumn("cy", F.explode(span("south", "north")))


def odd_crossings(sides: Column, x: Column, y: Column) -> Column:
    """Whether a ray to the right from a point crosses an odd number of edges."""
    crosses = lambda e: ((e["y0"] > y) != (e["y1"] > y)) & (x < (e["x1"] - e["x0"]) * (y - e["y0"]) / (e["y1"] - e["y0"]) + e["x0"])
    return F.size(F.filter(sides, crosses)) % 2 == 1


def edges_by_cell(polygons: DataFrame, size: float) -> DataFrame:
    """polygon_id, cx, cy, sides: of a polygon's edges, for each coarse cell that its box touches, those that a ray to the right from within
    the cell can cross: in the cell's rows, and not to its left. A ring is not sent as a whole to each of its cells."""
    holes = F.col("holes") if holes_of(polygons) else None
    cells = cells_of(polygons.select("polygon_id", "ring", all_edges(F.col("ring"), holes).alias("sides")), size)
    south, north, west = F.col("cy") * size, (F.col("cy") + 1) * size, F.col("cx") * size
    near = lambda e: (F.greatest(e["y0"], e["y1"]) >= south) & (F.least(e["y0"], e["y1"]) <= north) & (F.greatest(e["x0"], e["x1"]) >= west)
    return cells.select("polygon_id", "cx", "cy", F.filter("sides", near).alias("sides")).filter(F.size("sides") > 0)


def points_in_polygons(points: DataFrame, polygons: DataFrame, size: float = 1.0) -> DataFrame:
    """points (x, y, ...) joined to polygons (polygon_id, ring, holes if any): an equi-join on coarse cells, then the exact test. A point in
    several gets a row for each."""
    keyed = points.withColumn("cx", F.floor(F.col("x") / size).cast("int")).withColumn("cy", F.floor(F.col("y") / size).cast("int"))
    met = keyed.join(small(edges_by_cell(polygons, size)), ["cx", "cy"]).filter(odd_crossings(F.col("sides"), F.col("x"), F.col("y")))
    return met.drop("cx", "cy", "sides")


def boxes_meet(a: dict[str, Column], b: dict[str, Column]) -> Column:
    return (a["west"] <= b["east"]) & (b["west"] <= a["east"]) & (a["south"] <= b["north"]) & (b["south"] <= a["north"])


def edges_cross(e: Column, f: Column) -> Column:
    """Whether two segments meet, touching included, except where they lie on one line."""
    side = lambda ax, ay, bx, by, px, py: (bx - ax) * (py - ay) - (by - ay) * (px - ax)
    d1, d2 = side(e["x0"], e["y0"], e["x1"], e["y1"], f["x0"], f["y0"]), side(e["x0"], e["y0"], e["x1"], e["y1"], f["x1"], f["y1"])
    d3, d4 = side(f["x0"], f["y0"], f["x1"], f["y1"], e["x0"], e["y0"]), side(f["x0"], f["y0"], f["x1"], f["y1"], e["x1"], e["y1"])
    return (d1 * d2 <= 0) & (d3 * d4 <= 0) & ~((d1 == 0) & (d2 == 0))


def intersects(a: Column, b: Column, a_holes: Column | None = None, b_holes: Column | None = None) -> Column:
    """Whether two rings, less their holes, share a point: an edge of one meets one of the other, or one contains the other."""
    first = lambda r: F.get(r, 0)
    crossing = F.exists(all_edges(a, a_holes), lambda e: F.exists(all_edges(b, b_holes), lambda f: edges_cross(e, f)))
    return boxes_meet(box(a), box(b)) & (crossing | contains(a, first(b)["x"], first(b)["y"], a_holes) | contains(b, first(a)["x"], first(a)["y"], b_holes))


def disjoint(a: Column, b: Column, a_holes: Column | None = None, b_holes: Column | None = None) -> Column:
    """Whether two rings, less their holes, share no point."""
    return ~intersects(a, b, a_holes, b_holes)


def from_utm(ring: Column, zone: Column, south: Column) -> Column:
    """A ring in metres, in degrees."""
    def project(p: Column) -> Column:
        lat, lng = utm_inverse(p["x"], p["y"], zone, south)
        return F.struct(lng.alias("x"), lat.alias("y"))

    return F.transform(ring, project)


def capsule(e: Column, radius: float, corners: int = 32) -> Column:
    """The ring of all points within a radius of an edge: half a circle around either end, counter-clockwise."""
    half = corners // 2
    angle = F.atan2(e["y1"] - e["y0"], e["x1"] - e["x0"])

    def arc(x: Column, y: Column, first: Column) -> Column:
        at = lambda i: first + i * (math.pi / half)
        return F.transform(F.sequence(F.lit(0), F.lit(half)), lambda i: F.struct((x + radius * F.cos(at(i))).alias("x"), (y + radius * F.sin(at(i))).alias("y")))

    return F.concat(arc(e["x1"], e["y1"], angle - math.pi / 2), arc(e["x0"], e["y0"], angle + math.pi / 2))


def projected(polygons: DataFrame, zone: Column, south: Column, to: Callable[[Column, Column, Column], Column] = to_utm) -> DataFrame:
    """polygons with rings and holes projected."""
    return polygons.withColumns({"ring": to(F.col("ring"), zone, south)} | {c: F.transform(c, lambda h: to(h, zone, south)) for c in holes_of(polygons)})


def parts_in_metres(polygons: DataFrame, metres: float, corners: int = 32) -> DataFrame:
    """polygon_id, part, ring, holes of polygons in metres: a polygon as part 0, and the capsule of each of its edges, those of holes included. Their union
    is the polygon's surroundings of so many metres."""
    holes = F.col("holes") if holes_of(polygons) else F.expr("cast(array() as array<array<struct<x: double, y: double>>>)")
    sides = polygons.select("polygon_id", F.posexplode(all_edges(F.col("ring"), *[F.col(c) for c in holes_of(polygons)])).alias("part", "e"))
    none = F.expr("cast(array() as array<array<struct<x: double, y: double>>>)")
    around = sides.select("polygon_id", (F.col("part") + 1).alias("part"), capsule(F.col("e"), metres, corners).alias("ring"), none.alias("holes"))
    return polygons.select("polygon_id", F.lit(0).alias("part"), "ring", F.coalesce(holes, none).alias("holes")).unionByName(around)


def buffer_parts(polygons: DataFrame, metres: float, corners: int = 32) -> DataFrame:
    """polygon_id, part, ring, holes: shapes in degrees whose union is a polygon's surroundings of so many metres, the polygon included; overlay.buffer() makes
    one shape of them. Distances are those of the modal zone of all polygons; a circle has `corners` corners and lies inside the true one by
    radius * (1 - cos(pi / corners)) at most. A point is within the distance if any part contains it."""
    zone, south = zone_of(polygons)
    return projected(parts_in_metres(projected(polygons, zone, south), metres, corners), zone, south, from_utm)


def points_within_metres(points: DataFrame, polygons: DataFrame, metres: float, size: float = 1.0) -> DataFrame:
    """points (x, y in degrees, ...) joined to the polygons that contain them or are at most so many metres away, measured in the modal zone of all
    polygons. Points within several get a row for each.

    Edges are cut into pieces no longer than the distance, and each piece meets the points of the cells, as wide as the distance,
    around it: an equi-join, after which the exact distance to the piece decides."""
    zone, south = zone_of(polygons)
    row = F.struct(*[F.col(c) for c in points.columns])
    flat = durable(projected(polygons.select("polygon_id", "ring", *holes_of(polygons)), zone, south), "projected")
    sides = flat.select("polygon_id", F.explode(all_edges(F.col("ring"), *[F.col(c) for c in holes_of(polygons)])).alias("e")).select("polygon_id", "e.*")
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    n = F.greatest(F.ceil(F.sqrt(dx * dx + dy * dy) / metres), F.lit(1)).cast("int")
    cut = sides.withColumn("n", n).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    at = lambda c, k: F.col(f"{c}0") + (F.col(f"{c}1") - F.col(f"{c}0")) * (F.col("i") + k) / F.col("n")
    pieces = cut.select("polygon_id", at("x", 0).alias("ax"), at("y", 0).alias("ay"), at("x", 1).alias("bx"), at("y", 1).alias("by"))
    cell = lambda v: F.floor(v / metres)
    # a little over the distance, which rounding may have made of it
    reach = metres * (1 + 1e-9)
    span = lambda a, b: F.sequence(cell(F.least(a, b) - reach), cell(F.greatest(a, b) + reach))
    pieces = pieces.withColumn("cx", F.explode(span(F.col("ax"), F.col("bx")))).withColumn("cy", F.explode(span(F.col("ay"), F.col("by"))))
    east, north = utm_forward(F.col("y"), F.col("x"), zone, south)
    placed = points.select(row.alias("row"), east.alias("px"), north.alias("py")).withColumn("cx", cell(F.col("px"))).withColumn("cy", cell(F.col("py")))
    ux, uy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    along = ((F.col("px") - F.col("ax")) * ux + (F.col("py") - F.col("ay")) * uy) / F.nullif(ux * ux + uy * uy, F.lit(0.0))
    t = F.least(F.greatest(F.coalesce(along, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    gx, gy = F.col("px") - F.col("ax") - t * ux, F.col("py") - F.col("ay") - t * uy
    near = placed.join(small(pieces), ["cx", "cy"]).filter(gx * gx + gy * gy <= metres * metres).select("row", "polygon_id").distinct().select("row.*", "polygon_id")
    return near.unionByName(points_in_polygons(points, polygons, size).select(*near.columns)).distinct()


def spatial_join(a: DataFrame, b: DataFrame, size: float = 1.0) -> DataFrame:
    """a_id, b_id of polygons (polygon_id, ring, holes if any) that intersect.

    Ids meet on coarse cells and pairs are made distinct; then edges meet on the cells that both cross, for pairs whose edges do; what is left is a ring within
    another one, which its first point tells. No ring is sent to its cells or compared whole with another."""
    corners = lambda df: df.select("polygon_id", "ring", *holes_of(df))
    a, b = corners(a), corners(b)
    crossed = _edge_cells(a, size).alias("a").join(_edge_cells(b, size).alias("b"), ["cx", "cy"]).filter(F.exists(F.col("a.sides"), lambda e: F.exists(F.col("b.sides"), lambda f: edges_cross(e, f))))
    pairs = crossed.select(F.col("a.polygon_id").alias("a_id"), F.col("b.polygon_id").alias("b_id")).distinct()
    first = lambda df, name: df.select(F.col("polygon_id").alias(name), F.get("ring", 0)["x"].alias("x"), F.get("ring", 0)["y"].alias("y")).filter("x IS NOT NULL")
    a_in_b = points_in_polygons(first(a, "a_id"), b, size).select("a_id", F.col("polygon_id").alias("b_id"))
    b_in_a = points_in_polygons(first(b, "b_id"), a, size).select(F.col("polygon_id").alias("a_id"), "b_id")
    return pairs.unionByName(a_in_b).unionByName(b_in_a).distinct()


def _edge_cells(polygons: DataFrame, size: float) -> DataFrame:
    """polygon_id, cx, cy, sides: a polygon's edges by the coarse cells that an edge's box touches."""
    holes = [F.col(c) for c in holes_of(polygons)]
    each = polygons.select("polygon_id", F.explode(all_edges(F.col("ring"), *holes)).alias("e"))
    span = lambda c: F.sequence(F.floor(F.least(f"e.{c}0", f"e.{c}1") / size), F.floor(F.greatest(f"e.{c}0", f"e.{c}1") / size))
    return each.withColumn("cx", F.explode(span("x"))).withColumn("cy", F.explode(span("y"))).groupBy("polygon_id", "cx", "cy").agg(F.collect_list("e").alias("sides"))


def _half_hull(points: list[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for p in points:
        while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
            out.pop()
        out.append(p)
    return out[:-1]


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))
def convex_hull(rings: pd.Series) -> pd.Series:
    """By Andrew's monotone chain, counter-clockwise from the leftmost point."""
    def hull(ring) -> list[dict[str, float]]:
        points = sorted({(p["x"], p["y"]) for p in ring})
        corners = points if len(points) < 3 else _half_hull(points) + _half_hull(points[::-1])
        return [{"x": x, "y": y} for x, y in corners]

    return rings.map(hull)


def pixel_centres(pixels: DataFrame, origin: tuple[float, float], step: tuple[float, float]) -> DataFrame:
    """px, py, and the place of a pixel's centre as x, y."""
    return pixels.select(F.col("x").alias("px"), F.col("y").alias("py"), (origin[0] + (F.col("x") + 0.5) * step[0]).alias("x"), (origin[1] + (F.col("y") + 0.5) * step[1]).alias("y"))


def pixels_within_metres(pixels: DataFrame, polygons: DataFrame, metres: float, origin: tuple[float, float], step: tuple[float, float], size: float = 1.0, outside_only: bool = False) -> DataFrame:
    """x, y of pixels whose centres are in a polygon or at most so many metres away; with outside_only, of those that no polygon contains: a
    leakage zone."""
    centres = pixel_centres(pixels, origin, step)
    near = points_within_metres(centres, polygons, metres, size).select(F.col("px").alias("x"), F.col("py").alias("y")).distinct()
    if not outside_only:
        return near
    inside = points_in_polygons(centres, polygons, size).select(F.col("px").alias("x"), F.col("py").alias("y")).distinct()
    return near.join(inside, ["x", "y"], "left_anti")


def tile_square(corner_lat: Column, corner_lng: Column, degrees: float = 10.0) -> Column:
    """The ring of a tile from its north-west corner."""
    point = lambda dx, dy: F.struct((corner_lng + dx).cast("double").alias("x"), (corner_lat - dy).cast("double").alias("y"))
    return F.array(point(0, 0), point(0, degrees), point(degrees, degrees), point(degrees, 0))


def first_polygon(polygons: DataFrame) -> DataFrame:
    """The polygon of least polygon_id."""
    return polygons.orderBy("polygon_id").limit(1)


def points_in_first(points: DataFrame, polygons: DataFrame, size: float = 1.0) -> DataFrame:
    """The points that the first polygon contains."""
    return points_in_polygons(points, first_polygon(polygons), size).drop("polygon_id")


def meeting(polygons: DataFrame, area: DataFrame, size: float = 1.0) -> DataFrame:
    """The polygons that intersect any of area's; none is an error."""
    return found(polygons.join(spatial_join(polygons, area, size).select(F.col("a_id").alias("polygon_id")).distinct(), "polygon_id", "left_semi"), "no polygon meets the area")


def rank_index(codes: DataFrame, code: str = "code", name: str = "rank") -> DataFrame:
    """Distinct codes in order with their place from 1: 0 stays free for the background of a raster. A row a code goes through the window."""
    return codes.select(code).distinct().withColumn(name, F.row_number().over(W.orderBy(code)).cast("int"))
