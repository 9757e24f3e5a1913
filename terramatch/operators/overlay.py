"""Union, intersection and difference of layers of polygons with holes, by strips: a sweep in each, then stitching of boundaries from strip to strip."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import durable
from .shapes import all_edges, from_utm, holes_of, parts_in_metres, points_in_polygons, projected, shoelace, zone_of

#: Edges in a strip on average, strips whose boundaries are stitched together in one step.
STRIP_EDGES, FAN_IN = 256, 8
#: Pairs of edges that are held against each other at once.
PAIRS = 1_000_000
#: Parts of the largest coordinate that count as nothing.
TOLERANCE = 1e-12
#: Whether a point belongs to the result, from whether it is in either layer.
RULES: dict[str, Callable[[np.ndarray, np.ndarray], np.ndarray]] = {"union": lambda a, b: a | b, "intersection": lambda a, b: a & b, "difference": lambda a, b: a & ~b}

Chain = list[tuple[float, float]]


def crossing_heights(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> np.ndarray:
    """Heights at which edges (y0 < y1) cross, ends left out. Equal edges are one, an edge is held against those that begin within its width, and pairs are
    formed in runs of about PAIRS, so memory grows with edges and crossings and not with pairs."""
    each = np.unique(np.stack([x0, y0, x1, y1], axis=1), axis=0)
    each = each[np.argsort(np.minimum(each[:, 0], each[:, 2]), kind="stable")]
    x0, y0, x1, y1 = each.T
    # those after an edge that begin before it ends
    after = np.searchsorted(np.minimum(x0, x1), np.maximum(x0, x1), side="right") - np.arange(len(each)) - 1
    total, found, begin = np.cumsum(after), [np.empty(0)], 0
    while begin < len(each):
        end = max(begin + 1, int(np.searchsorted(total, total[begin] - after[begin] + PAIRS, side="right")))
        n = after[begin:end]
        i = np.repeat(np.arange(begin, end), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        near = np.maximum(y0[i], y0[j]) < np.minimum(y1[i], y1[j])
        i, j, begin = i[near], j[near], end
        a, b = (x1[i] - x0[i]) / (y1[i] - y0[i]), (x1[j] - x0[j]) / (y1[j] - y0[j])
        with np.errstate(divide="ignore", invalid="ignore"):
            y = ((x0[j] - b * y0[j]) - (x0[i] - a * y0[i])) / (a - b)
        inside = np.isfinite(y) & (y > np.maximum(y0[i], y0[j])) & (y < np.minimum(y1[i], y1[j]))
        found.append(np.unique(y[inside]))
    return np.unique(np.concatenate(found))


def speaking_once(edges: np.ndarray, layer: np.ndarray, polygon: np.ndarray) -> np.ndarray:
    """Places of the edges without those of polygons that another one of their layer equals, edge for edge: a layer is what any of its polygons holds."""
    _, edge = np.unique(edges, axis=0, return_inverse=True)
    order = np.lexsort((edge.ravel(), polygon, layer))
    starts = np.flatnonzero(np.r_[True, (np.diff(layer[order]) != 0) | (polygon[order][1:] != polygon[order][:-1])]) if len(order) else []
    seen: dict[tuple[int, bytes], np.ndarray] = {}
    for places in np.split(order, starts[1:]) if len(order) else []:
        seen.setdefault((int(layer[places[0]]), edge.ravel()[places].tobytes()), places)
    return np.sort(np.concatenate([np.empty(0, dtype=int), *seen.values()]))


def changes(below: list[tuple[float, float]], above: list[tuple[float, float]], y: float) -> Iterator[Chain]:
    """Horizontal boundaries at a height between the spans of the result below it and above it, the result on their left."""
    # one more span above than below, or one less: also right where rounding has turned a span's ends round
    marks: dict[float, int] = defaultdict(int)
    for sign, spans in ((-1, below), (1, above)):
        for a, b in spans:
            marks[a] += sign
            marks[b] -= sign
    more, last = 0, 0.0
    for x in sorted(marks):
        for _ in range(abs(more)):
            yield [(last, y), (x, y)] if more > 0 else [(x, y), (last, y)]
        more, last = more + marks[x], x


def swept(edges: np.ndarray, layer: np.ndarray, polygon: np.ndarray, low: float, high: float, how: str, nothing: float) -> tuple[list[Chain], list, list]:
    """Boundaries of the result within a strip, and its spans at the strip's lower and upper border. edges: x0, y0, x1, y1 with y0 < y1.

    Between two neighbouring heights of ends and crossings no edges cross: from left to right each one changes whether its polygon holds the point, and the
    rule says where the result begins and ends. Spans and gaps without width, as between neighbours with a common side, are none."""
    one = speaking_once(edges, layer, polygon)
    edges, layer, polygon = edges[one], layer[one], polygon[one]
    x0, y0, x1, y1 = edges.T
    heights = np.concatenate([[low, high], y0, y1, crossing_heights(x0, y0, x1, y1)])
    heights = np.unique(heights[(heights >= low) & (heights <= high)])
    # heights that rounding has split
    heights = heights[np.concatenate([[True], np.diff(heights) > nothing])] if len(heights) > 1 else heights
    heights[0], heights[-1] = low, high
    _, polygon = np.unique(np.stack([layer, polygon]), axis=1, return_inverse=True)
    polygon, out, bottom, below = polygon.ravel(), [], [], []

    def at(e: np.ndarray, y: float) -> np.ndarray:
        return np.where(y <= y0[e], x0[e], np.where(y >= y1[e], x1[e], x0[e] + (y - y0[e]) * ((x1[e] - x0[e]) / (y1[e] - y0[e]))))

    for n, (a, b) in enumerate(zip(heights, heights[1:], strict=False)):
        middle = (a + b) / 2
        active = np.flatnonzero((y0 < middle) & (y1 > middle))
        active = active[np.argsort(at(active, middle), kind="stable")]
        left, right = at(active, a), at(active, b)
        held, counts, spans, begun = set(), [0, 0], [], None
        inside = np.zeros(len(active), dtype=bool)
        for i, e in enumerate(active):
            p = int(polygon[e])
            counts[int(layer[e])] += -1 if p in held else 1
            held ^= {p}
            inside[i] = RULES[how](np.bool_(counts[0] > 0), np.bool_(counts[1] > 0))
        for i in range(len(active)):
            if inside[i] and begun is None:
                begun = i
            elif not inside[i] and begun is not None:
                if max(left[i] - left[begun], right[i] - right[begun]) > nothing:
                    if spans and max(left[begun] - left[spans[-1][1]], right[begun] - right[spans[-1][1]]) <= nothing:
                        begun = spans.pop()[0]
                    spans.append((begun, i))
                begun = None
        for i, j in spans:
            out.append([(float(right[i]), float(b)), (float(left[i]), float(a))])
            out.append([(float(left[j]), float(a)), (float(right[j]), float(b))])
        lower = [(float(left[i]), float(left[j])) for i, j in spans]
        if n:
            out += changes(below, lower, float(a))
        else:
            bottom = lower
        below = [(float(right[i]), float(right[j])) for i, j in spans]
    return out, bottom, below


def stitched(chains: list[Chain]) -> tuple[list[Chain], list[Chain]]:
    """Closed rings and what stays open, of directed chains that meet at equal points. Where several leave a point, the way goes as far to the left as it
    can, so that shapes that touch at a point stay apart."""
    leaving: dict[tuple[float, float], list[int]] = defaultdict(list)
    for i, c in enumerate(chains):
        leaving[c[0]].append(i)
    used, closed, open_ = [False] * len(chains), [], []
    arriving = defaultdict(int)
    for c in chains:
        arriving[c[-1]] += 1
    # ways begin where nothing arrives, then anywhere
    for i in sorted(range(len(chains)), key=lambda i: arriving[chains[i][0]] > 0):
        if used[i]:
            continue
        used[i], way = True, list(chains[i])
        while way[-1] != way[0]:
            here, before = way[-1], way[-2]
            back = math.atan2(before[1] - here[1], before[0] - here[0])
            free = [j for j in leaving[here] if not used[j]]
            if not free:
                break
            turn = lambda j, back=back, here=here: (back - math.atan2(chains[j][1][1] - here[1], chains[j][1][0] - here[0])) % (2 * math.pi) or 2 * math.pi
            j = min(free, key=turn)
            used[j] = True
            way += chains[j][1:]
        (closed if way[-1] == way[0] else open_).append(way)
    return closed, open_


def straightened(ring: Chain, nothing: float) -> Chain:
    """A ring without the points that lie on the way between their neighbours or on one of them."""
    out: Chain = []
    for p in ring[:-1]:
        if not out or math.dist(p, out[-1]) > nothing:
            out.append(p)
    changed = True
    while changed and len(out) > 2:
        changed, kept = False, []
        for i, p in enumerate(out):
            a, b = kept[-1] if kept else out[i - 1], out[(i + 1) % len(out)]
            ux, uy, vx, vy = p[0] - a[0], p[1] - a[1], b[0] - p[0], b[1] - p[1]
            if abs(ux * vy - uy * vx) <= 1e-9 * math.hypot(ux, uy) * math.hypot(vx, vy) and (ux * vx + uy * vy >= 0 or min(math.hypot(ux, uy), math.hypot(vx, vy)) <= 10 * nothing):
                changed = True
            else:
                kept.append(p)
        out = kept
    return out


def _chain_rows(strip: int, chains: list[Chain], closed: bool) -> list[tuple]:
    return [(strip, closed, [p[0] for p in c], [p[1] for p in c]) for c in chains]


CHAINS = "strip long, closed boolean, xs array<double>, ys array<double>"
_COLUMNS = ["strip", "closed", "xs", "ys"]


def _sweep_strip(rows: pd.DataFrame, borders: np.ndarray, how: str, nothing: float) -> pd.DataFrame:
    """Chains of a strip, and its spans at either border: a row with the border's number below 0, its side in `closed`."""
    strip = int(rows["strip"].iloc[0])
    chains, bottom, top = swept(rows[["x0", "y0", "x1", "y1"]].to_numpy(float), rows["layer"].to_numpy(), rows["polygon"].to_numpy(), borders[strip], borders[strip + 1], how, nothing)
    closed, open_ = stitched(chains)
    out = _chain_rows(strip, closed, True) + _chain_rows(strip, open_, False)
    for border, above, spans in ((strip, True, bottom), (strip + 1, False, top)):
        if spans:
            out.append((-1 - border, above, [a for a, _ in spans], [b for _, b in spans]))
    return pd.DataFrame(out, columns=_COLUMNS)


def _at_border(rows: pd.DataFrame, borders: np.ndarray) -> pd.DataFrame:
    """Horizontal chains where the results of two strips differ."""
    border = -1 - int(rows["strip"].iloc[0])
    sides = {bool(above): list(zip(map(float, xs), map(float, ys), strict=True)) for above, xs, ys in rows[["closed", "xs", "ys"]].itertuples(index=False)}
    found = list(changes(sides.get(False, []), sides.get(True, []), float(borders[border])))
    return pd.DataFrame(_chain_rows(max(0, border - 1), found, False), columns=_COLUMNS)


def _stitch(rows: pd.DataFrame) -> pd.DataFrame:
    chains = [list(zip(map(float, xs), map(float, ys), strict=True)) for xs, ys in rows[["xs", "ys"]].itertuples(index=False)]
    closed, open_ = stitched(chains)
    strip = int(rows["strip"].iloc[0])
    return pd.DataFrame(_chain_rows(strip, closed, True) + _chain_rows(strip, open_, False), columns=_COLUMNS)


def _edges(polygons: DataFrame, layer: int) -> DataFrame:
    """Edges that are not horizontal, upwards, numbered by polygon."""
    sides = polygons.select(F.xxhash64(F.col("polygon_id").cast("string")).alias("polygon"), F.explode(all_edges(F.col("ring"), *[F.col(c) for c in holes_of(polygons)])).alias("e"))
    up = F.col("e.y0") < F.col("e.y1")
    ends = {c: F.when(up, F.col(f"e.{c}")).otherwise(F.col(f"e.{o}")) for c, o in (("x0", "x1"), ("y0", "y1"), ("x1", "x0"), ("y1", "y0"))}
    return sides.filter("e.y0 <> e.y1").select(F.lit(layer).alias("layer"), "polygon", *[x.alias(c) for c, x in ends.items()])


def boundaries(edges: DataFrame, how: str) -> DataFrame:
    """x, y arrays of the closed boundaries of a result, from the edges of both layers; the result lies on their left."""
    edges = durable(edges, "overlay-edges")
    n, low, high, most = edges.agg(F.count("*"), F.min("y0"), F.max("y1"), F.max(F.greatest(*[F.abs(c) for c in ("x0", "y0", "x1", "y1")]))).first()
    spark, nothing = edges.sparkSession, TOLERANCE * (most or 1.0)
    if not n:
        return spark.createDataFrame([], CHAINS).select("xs", "ys")
    strips = max(1, -(-n // STRIP_EDGES))
    # borders at quantiles of edges' middles, so that a crowded place has many strips
    inner = edges.select(((F.col("y0") + F.col("y1")) / 2).alias("y")).agg(F.percentile_approx("y", [i / strips for i in range(1, strips)], 100 * strips)).first()[0] if strips > 1 else []
    borders = np.unique([low, *[b for b in inner if low + nothing < b < high - nothing], high])
    borders = borders[np.concatenate([[True], np.diff(borders) > 100 * nothing])]
    borders[-1] = high
    # the strips from the one that an edge begins in to the one that it ends in
    ends = F.array(*[F.lit(float(b)) for b in borders[1:-1]]).cast("array<double>")
    first, last = F.size(F.filter(ends, lambda b: b <= F.col("y0"))), F.size(F.filter(ends, lambda b: b < F.col("y1")))
    met = edges.withColumn("strip", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    found = durable(met.groupBy("strip").applyInPandas(partial(_sweep_strip, borders=borders, how=how, nothing=nothing), CHAINS), "overlay-strips")
    level = found.filter("strip < 0").groupBy("strip").applyInPandas(partial(_at_border, borders=borders), CHAINS)
    done, left, width = found.filter("strip >= 0 AND closed"), durable(found.filter("strip >= 0 AND NOT closed").unionByName(level), "overlay-open"), 1
    while not left.isEmpty():
        # FAN_IN neighbours at a time: what closes is done, and only what crosses their outer borders goes on
        step = durable(left.withColumn("strip", F.floor(F.col("strip") / FAN_IN)).groupBy("strip").applyInPandas(_stitch, CHAINS), "overlay-open")
        done, left, width = done.unionByName(step.filter("closed")), step.filter("NOT closed"), width * FAN_IN
        if width >= FAN_IN * len(borders):
            break
    return done.select("xs", "ys")


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])))
def _ring_of(xs: pd.Series, ys: pd.Series) -> pd.Series:
    def ring(x, y) -> list[dict[str, float]]:
        most = max(1e-300, float(np.abs(x).max()), float(np.abs(y).max()))
        points = straightened(list(zip(map(float, x), map(float, y), strict=True)), TOLERANCE * most * 10)
        return [{"x": a, "y": b} for a, b in points] if len(points) > 2 else []

    return pd.Series([ring(x, y) for x, y in zip(xs, ys, strict=True)])


def overlay(a: DataFrame, b: DataFrame | None, how: str, size: float = 1.0) -> DataFrame:
    """polygon_id, ring, holes of the union, the intersection or the difference of two layers of polygons (polygon_id, ring, holes if any); a layer is what any
    of its polygons holds. Without b the union of a.

    Edges are cut into strips at quantiles of their heights and swept strip by strip; a strip has some hundred edges and those that cross it. Boundaries are
    stitched in each strip, then over FAN_IN neighbours at a time, so a step holds only rings that cross its borders. Rings around holes are told from
    holes by direction, and a hole goes to the smallest ring that contains it, by an equi-join on cells of `size`.

    Defined results: rings run counter-clockwise, holes clockwise; what has no width beyond TOLERANCE of the largest coordinate is not there; a ring without area
    or with fewer than three points holds nothing; null rings hold nothing; polygons of one polygon_id in a layer count as one shape with crossed
    areas left out. Equal input gives equal shapes; their ids are hashes of their rings."""
    if how not in RULES:
        raise ValueError(f"{how} is none of {', '.join(RULES)}")
    edges = _edges(a, 0) if b is None else _edges(a, 0).unionByName(_edges(b, 1))
    rings = boundaries(edges, how).select(_ring_of("xs", "ys").alias("ring")).filter(F.size("ring") > 2)
    least = F.array_min("ring")
    at = F.array_position("ring", least).cast("int")
    # each ring from its least point on, so that equal shapes are equal rows
    turned = rings.withColumn("ring", F.concat(F.expr("slice(ring, cast(array_position(ring, array_min(ring)) as int), size(ring))"), F.slice("ring", F.lit(1), at - 1)))
    rings = durable(turned.withColumn("area", shoelace(F.col("ring"))).filter("area <> 0").withColumn("polygon_id", F.xxhash64("ring")), "overlay-rings")
    outer, inner = rings.filter("area > 0"), rings.filter("area < 0")
    p, q = F.get("ring", 0), F.get("ring", 1)
    points = inner.select(F.col("polygon_id").alias("hole_id"), ((p["x"] + q["x"]) / 2).alias("x"), ((p["y"] + q["y"]) / 2).alias("y"))
    owner = points_in_polygons(points, outer.select("polygon_id", "ring"), size).join(outer.select("polygon_id", "area"), "polygon_id").groupBy("hole_id").agg(F.min_by("polygon_id", F.struct("area", "polygon_id")).alias("polygon_id"))
    holes = owner.join(inner.select(F.col("polygon_id").alias("hole_id"), "ring"), "hole_id").groupBy("polygon_id").agg(F.sort_array(F.collect_list("ring")).alias("holes"))
    return outer.select("polygon_id", "ring").join(holes, "polygon_id", "left").withColumn("holes", F.coalesce("holes", F.expr("cast(array() as array<array<struct<x: double, y: double>>>)")))


def union(a: DataFrame, b: DataFrame | None = None, size: float = 1.0) -> DataFrame:
    return overlay(a, b, "union", size)


def intersection(a: DataFrame, b: DataFrame, size: float = 1.0) -> DataFrame:
    return overlay(a, b, "intersection", size)


def difference(a: DataFrame, b: DataFrame, size: float = 1.0) -> DataFrame:
    return overlay(a, b, "difference", size)


def buffer(polygons: DataFrame, metres: float, corners: int = 32) -> DataFrame:
    """polygon_id, ring, holes in degrees: all points at most so many metres from polygons in degrees, as one layer of shapes that don't overlap. Distances are
    those of the polygons' modal zone; a circle has `corners` corners. A hole that the distance does not fill stays, smaller."""
    zone, south = zone_of(polygons)
    parts = parts_in_metres(projected(polygons.select("polygon_id", "ring", *holes_of(polygons)), zone, south), metres, corners)
    each = parts.withColumn("polygon_id", F.concat_ws(":", F.col("polygon_id").cast("string"), F.col("part").cast("string"))).drop("part")
    return projected(union(each, size=20.0 * metres), zone, south, from_utm)
