"""Polygons in pieces: filled rows of a raster, clipping to chunks, outlines of fewer points."""

from __future__ import annotations

import heapq
from collections import defaultdict

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shapes import all_edges, box, edges, holes_of, shoelace

POINTS = T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())]))
#: Fixed value: points of an outline with which a catalogue is asked.
MOST_POINTS = 200


def _indexes(low: Column, high: Column, origin: float, step: float) -> Column:
    """Indexes of the cells whose centres may lie between two values, and one more on either side, which rounding may have moved."""
    at = lambda v: (v - origin) / step - 0.5
    a, b = (at(low), at(high)) if step > 0 else (at(high), at(low))
    return F.sequence((F.floor(a) - 1).cast("int"), (F.ceil(b) + 1).cast("int"))


def filled_spans(polygons: DataFrame, origin: tuple[float, float], step: tuple[float, float]) -> DataFrame:
    """polygon_id, y, west, east: for each row of a raster the stretches that a polygon (ring, holes if any) fills, west included and east not.

    An edge gives its crossing with each row of centres that it passes; in a polygon's row the crossings in order are, in turn, where a stretch begins and
    where it ends. Work grows with the rows that edges pass; no pixel is compared with an edge. The crossings are those of contains()."""
    sides = polygons.select("polygon_id", F.explode(all_edges(F.col("ring"), *[F.col(c) for c in holes_of(polygons)])).alias("e")).select("polygon_id", "e.*").filter("y0 <> y1")
    rows = sides.withColumn("y", F.explode(_indexes(F.least("y0", "y1"), F.greatest("y0", "y1"), origin[1], step[1])))
    centre = origin[1] + (F.col("y") + 0.5) * step[1]
    passed = rows.filter((F.col("y0") > centre) != (F.col("y1") > centre))
    crossing = (F.col("x1") - F.col("x0")) * (centre - F.col("y0")) / (F.col("y1") - F.col("y0")) + F.col("x0")
    order = W.partitionBy("polygon_id", "y").orderBy("west")
    ends = passed.select("polygon_id", "y", crossing.alias("west")).withColumns({"east": F.lead("west").over(order), "_n": F.row_number().over(order)})
    return ends.filter((F.col("_n") % 2 == 1) & (F.col("east") > F.col("west"))).drop("_n")


def filled_pixels(polygons: DataFrame, origin: tuple[float, float], step: tuple[float, float]) -> DataFrame:
    """polygon_id, x, y: the pixels whose centres a polygon contains, as contains() has it."""
    spans = filled_spans(polygons, origin, step).withColumn("x", F.explode(_indexes(F.col("west"), F.col("east"), origin[0], step[0])))
    centre = origin[0] + (F.col("x") + 0.5) * step[0]
    return spans.filter((centre >= F.col("west")) & (centre < F.col("east"))).select("polygon_id", "x", "y")


def rasterise(pixels: DataFrame, polygons: DataFrame, value: str, origin: tuple[float, float], step: tuple[float, float]) -> DataFrame:
    """x, y, value: pixels whose centres lie in a polygon, with an attribute of it; where polygons overlap, the largest value. Polygons are filled row by row,
    and the filled pixels meet the given ones on x and y."""
    of = polygons.select("polygon_id", F.col(value).alias("value"))
    filled = filled_pixels(polygons, origin, step).join(of, "polygon_id").groupBy("x", "y").agg(F.max("value").alias("value"))
    return pixels.select("x", "y").join(filled, ["x", "y"])


def clipped(ring: Column, axis: str, bound: Column, above: bool) -> Column:
    """What of a ring lies above a value of one coordinate, or below it: a step of Sutherland and Hodgman's. Parts of a concave ring stay joined along
    the border, where they have no area."""
    other = "y" if axis == "x" else "x"

    def kept(e: Column) -> Column:
        p, q = e[f"{axis}0"], e[f"{axis}1"]
        p_in, q_in = (p >= bound, q >= bound) if above else (p <= bound, q <= bound)
        at = e[f"{other}0"] + (e[f"{other}1"] - e[f"{other}0"]) * (bound - p) / F.nullif(q - p, F.lit(0.0))
        point = lambda v, o: F.struct(*[(v if c == axis else o).alias(c) for c in "xy"])
        end, cross = point(q, e[f"{other}1"]), point(bound, at)
        return F.when(p_in & q_in, F.array(end)).when(p_in, F.array(cross)).when(q_in, F.array(cross, end)).otherwise(F.array().cast(POINTS))

    return F.flatten(F.transform(edges(ring), kept))


def _on_one_side(df: DataFrame, axis: str, bound: Column, above: bool) -> DataFrame:
    holes = F.filter(F.transform("holes", lambda h: clipped(h, axis, bound, above)), lambda h: F.size(h) > 2)
    return df.withColumns({"ring": clipped(F.col("ring"), axis, bound, above), "holes": holes})


def chunks(polygons: DataFrame, most: float) -> DataFrame:
    """polygon_id, i, j, west, south, east, north, ring, holes: polygons clipped to squares of `most` degrees from the south-west corner of their box; squares in
    which a polygon has no area are left out.

    A ring is clipped to columns first, and what is in a column to squares, so that a square does not get the whole ring."""
    none = F.expr("cast(array() as array<array<struct<x: double, y: double>>>)")
    b = box(F.col("ring"))
    out = polygons.select("polygon_id", F.col("ring").cast(POINTS).alias("ring"), (F.coalesce(F.col("holes").cast(T.ArrayType(POINTS)), none) if holes_of(polygons) else none).alias("holes"), *[v.alias(f"_{c}") for c, v in b.items()])
    count = lambda a, b: F.greatest(F.ceil(F.round((F.col(b) - F.col(a)) / most, 9)), F.lit(1)).cast("int")
    for axis, index, low, high, ends in (("x", "i", "west", "east", ("_west", "_east")), ("y", "j", "south", "north", ("_south", "_north"))):
        out = out.filter(F.size("ring") > 2).withColumn(index, F.explode(F.sequence(F.lit(0), count(*ends) - 1)))
        out = out.withColumns({low: F.col(ends[0]) + F.col(index) * most, high: F.col(ends[0]) + (F.col(index) + 1) * most})
        for bound, above in ((low, True), (high, False)):
            out = _on_one_side(out, axis, F.col(bound), above)
    area = F.abs(shoelace(F.col("ring"))) - F.aggregate("holes", F.lit(0.0), lambda t, h: t + F.abs(shoelace(h)))
    kept = out.withColumn("_area", area).filter(F.col("_area") > 1e-12 * most * most)
    return kept.select("polygon_id", "i", "j", "west", "south", "east", "north", "ring", "holes")


class Outline:
    """A ring that loses its least noticeable points one by one (Visvalingam and Whyatt, 1993): the one whose triangle with its neighbours is smallest, and
    in which no other point lies, since the ring would cross itself then."""

    def __init__(self, points: list[tuple[float, float]]) -> None:
        self.points = [p for p, q in zip(points, points[1:] + points[:1], strict=True) if p != q]
        n = len(self.points)
        self.before, self.after, self.gone = [(i - 1) % max(n, 1) for i in range(n)], [(i + 1) % max(n, 1) for i in range(n)], [False] * n
        xs, ys = zip(*self.points, strict=True) if n else ((0.0,), (0.0,))
        self.side = max(max(xs) - min(xs), max(ys) - min(ys), 1e-300) / max(1.0, n**0.5)
        self.cells: dict[tuple[int, int], set[int]] = defaultdict(set)
        for i, p in enumerate(self.points):
            self.cells[self._cell(p)].add(i)

    def _cell(self, p: tuple[float, float]) -> tuple[int, int]:
        return int(p[0] // self.side), int(p[1] // self.side)

    def _area(self, i: int) -> float:
        a, b, c = (self.points[j] for j in (self.before[i], i, self.after[i]))
        return abs((b[0] - a[0]) * (c[1] - a[1]) - (c[0] - a[0]) * (b[1] - a[1])) / 2

    def _blocked(self, i: int) -> bool:
        three = (self.before[i], i, self.after[i])
        corners = [self.points[j] for j in three]
        (west, south), (east, north) = self._cell(tuple(map(min, zip(*corners, strict=True)))), self._cell(tuple(map(max, zip(*corners, strict=True))))
        turn = lambda p, q, r: (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
        for x in range(west, east + 1):
            for y in range(south, north + 1):
                for j in self.cells.get((x, y), ()):
                    if j not in three:
                        t = [turn(corners[k], corners[(k + 1) % 3], self.points[j]) for k in range(3)]
                        if min(t) >= 0 or max(t) <= 0:
                            return True
        return False

    def reduced(self, most: int) -> list[tuple[float, float]]:
        left = len(self.points)
        queue = [(self._area(i), i) for i in range(left)]
        heapq.heapify(queue)
        waiting: list[tuple[float, int]] = []
        while left > max(most, 3):
            if not queue:
                # every point's triangle holds another one: the smallest goes all the same
                queue, waiting, forced = sorted((a, i) for a, i in waiting if not self.gone[i] and a == self._area(i)), [], True
                if not queue:
                    queue = sorted((self._area(i), i) for i, g in enumerate(self.gone) if not g)
            else:
                forced = False
            area, i = heapq.heappop(queue)
            if self.gone[i] or area != self._area(i):
                continue
            if not forced and self._blocked(i):
                waiting.append((area, i))
                continue
            self.gone[i] = True
            self.cells[self._cell(self.points[i])].discard(i)
            a, c = self.before[i], self.after[i]
            self.after[a], self.before[c], left = c, a, left - 1
            for j in (a, c):
                heapq.heappush(queue, (self._area(j), j))
        return [p for p, g in zip(self.points, self.gone, strict=True) if not g]


def simplified(polygons: DataFrame, most: int = MOST_POINTS) -> DataFrame:
    """polygons with rings of at most so many points. Rings that have no more stay as they are; holes are left out, since a catalogue is asked with outlines."""

    @F.pandas_udf(POINTS)
    def fewer(rings: pd.Series) -> pd.Series:
        return rings.map(lambda r: [{"x": x, "y": y} for x, y in Outline([(float(p["x"]), float(p["y"])) for p in r]).reduced(most)])

    return polygons.drop("holes").withColumn("ring", F.when(F.size("ring") > most, fewer(F.col("ring").cast(POINTS))).otherwise(F.col("ring").cast(POINTS)))
