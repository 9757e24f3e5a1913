"""Overlay of polygons against point tests on a dense grid, and the areas made of it."""

import math
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from terramatch.operators import overlay, shapes
from terramatch.plans import stages

HOLES = "polygon_id int, ring array<struct<x: double, y: double>>, holes array<array<struct<x: double, y: double>>>"


def star(rng, centre, radius, n):
    turns, far = np.sort(rng.uniform(0, 2 * math.pi, n)), rng.uniform(0.3, 1, n) * radius
    return [(float(centre[0] + r * math.cos(t)), float(centre[1] + r * math.sin(t))) for t, r in zip(turns, far, strict=True)]


def box(x, y, w, h):
    return [(float(a), float(b)) for a, b in ((x, y), (x + w, y), (x + w, y + h), (x, y + h))]


def crossings(ring, x, y):
    out = np.zeros(x.shape, dtype=int)
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
        if ay != by:
            out += ((ay > y) != (by > y)) & (x < (bx - ax) * (y - ay) / (by - ay) + ax)
    return out


def held(layer, x, y):
    """Whether any polygon (ring, holes) of a layer holds each point."""
    return np.any([sum(crossings(r, x, y) for r in [ring, *holes]) % 2 == 1 for ring, holes in layer] or [np.zeros(x.shape, dtype=bool)], axis=0)


def frame(spark, layer):
    return spark.createDataFrame([(i, ring, holes) for i, (ring, holes) in enumerate(layer)], HOLES)


def shapes_of(df):
    return [([tuple(p) for p in r.ring], [[tuple(p) for p in h] for h in r.holes]) for r in df.collect()]


def dense(low, high, n=150):
    return np.meshgrid(np.linspace(low, high, n) + 0.00131, np.linspace(low, high, n) + 0.00173)


RULES = {"union": np.logical_or, "intersection": np.logical_and, "difference": lambda a, b: a & ~b}


@pytest.mark.parametrize("how", RULES)
def test_random_polygons_with_holes(spark, how, monkeypatch):
    monkeypatch.setattr(overlay, "STRIP_EDGES", 20)  # many strips, stitched in several steps
    monkeypatch.setattr(overlay, "FAN_IN", 2)
    rng = np.random.default_rng(11)
    layers = []
    for n in (9, 7):
        layer = [(star(rng, rng.uniform(0, 8, 2), 2.0, int(rng.integers(4, 14))), []) for _ in range(n)]
        layer.append((box(1, 1, 6, 6), [box(2, 2, 1, 3), star(rng, (5.0, 5.0), 0.9, 8)]))
        layers.append(layer)
    got = shapes_of(overlay.overlay(*[frame(spark, x) for x in layers], how, 2.0))
    x, y = dense(-2, 10)
    assert (held(got, x, y) == RULES[how](held(layers[0], x, y), held(layers[1], x, y))).all()
    # no two shapes overlap, and holes lie in their shapes
    assert sum(held([s], x, y).astype(int) for s in got).max() == 1
    assert any(holes for _, holes in got)
    for ring, holes in got:
        assert all(crossings(ring, *(np.array([np.mean(c)]) for c in zip(*h[:2], strict=True)))[0] % 2 == 1 for h in holes)


def test_neighbours_with_common_sides_become_one_shape(spark):
    layer = [(box(i, j, 1, 1), []) for i in range(6) for j in range(5) if (i, j) not in {(2, 2), (3, 2)}]
    ((ring, holes),) = shapes_of(overlay.union(frame(spark, layer)))
    assert sorted(ring) == [(0.0, 0.0), (0.0, 5.0), (6.0, 0.0), (6.0, 5.0)] and [sorted(h) for h in holes] == [[(2.0, 2.0), (2.0, 3.0), (4.0, 2.0), (4.0, 3.0)]]


def test_shapes_that_touch_and_shapes_that_repeat(spark):
    touching = [(box(0, 0, 1, 1), []), (box(1, 1, 1, 1), []), (box(0, 0, 1, 1), [])]
    got = shapes_of(overlay.union(frame(spark, touching)))
    assert sorted(sorted(r) for r, _ in got) == [sorted(box(0, 0, 1, 1)), sorted(box(1, 1, 1, 1))]
    assert overlay.difference(frame(spark, touching), frame(spark, touching)).count() == 0
    assert len(shapes_of(overlay.intersection(frame(spark, touching), frame(spark, touching)))) == 2


def test_empty_layers_flat_rings_and_unknown_rules(spark):
    some, none = frame(spark, [(box(0, 0, 2, 1), [])]), frame(spark, [([], []), ([(0.0, 0.0), (1.0, 1.0), (2.0, 2.0)], []), ([(1.0, 1.0)], [])])
    assert len(shapes_of(overlay.union(some, none))) == len(shapes_of(overlay.difference(some, none))) == 1
    assert overlay.intersection(some, none).count() == overlay.union(none).count() == 0
    nulls = spark.createDataFrame([(7, None, None), (None, box(5, 5, 1, 1), None)], HOLES)
    assert len(shapes_of(overlay.union(some, nulls))) == 2
    with pytest.raises(ValueError, match="none of"):
        overlay.overlay(some, some, "xor")


def test_a_buffer_is_one_shape_and_leaves_holes(spark):
    """A square of a degree with a hole of 0.6: its middle is 33 km from any side."""
    square = frame(spark, [(box(3, 0, 1, 1), [box(3.2, 0.2, 0.6, 0.6)])])
    ((ring, holes),) = shapes_of(overlay.buffer(square, 1000.0))
    assert len(holes) == 1
    width = lambda r, c: max(p[c] for p in r) - min(p[c] for p in r)
    degree = 111_320.0
    assert width(ring, 0) == pytest.approx(1 + 2000 / degree, abs=3e-4) and width(holes[0], 0) == pytest.approx(0.6 - 2000 / degree, abs=3e-4)
    parts = shapes.buffer_parts(square, 1000.0)
    at = spark.createDataFrame([(1, 3.5, 0.5), (2, 3.19, 0.5), (3, 3.205, 0.5), (4, 3.23, 0.5)], "pid int, x double, y double")
    assert {r.pid for r in shapes.points_in_polygons(at, parts.withColumn("polygon_id", F.col("part")), 0.2).collect()} == {2, 3}


def test_zones_of_flat_rings(spark):
    flat = spark.createDataFrame([(1, [(9.0, 45.0), (9.2, 45.0)]), (2, [(9.1, 45.0)]), (3, []), (4, box(9.0, 45.0, 0.1, 0.1))], "polygon_id int, ring array<struct<x: double, y: double>>")
    assert shapes.modal_zone(flat).first()[0] == 32632 and shapes.area_m2(flat).first()[0] == pytest.approx(87_000_000, rel=0.02)
    assert shapes.modal_zone(flat.filter("polygon_id < 3")).first()[0] == 32632


def test_the_matching_area_as_shapes_and_as_pixels(spark):
    square = lambda i, x, y, half: (i, box(x - half, y - half, 2 * half, 2 * half), [])
    make = lambda *rows: spark.createDataFrame(list(rows), HOLES)
    project, countries = make(square(0, 0.0, 0.0, 0.1)), make(square(0, -0.5, 0.0, 1.0), square(1, 0.6, 0.0, 0.3))
    regions = make(square(0, 0.0, 0.0, 0.8), square(1, 5.0, 0.0, 0.5))
    others = make(square(0, 0.6, 0.2, 0.05), square(1, 7.0, 7.0, 0.5)).withColumn("project_id", F.col("polygon_id"))
    origin, step = (-2.0, -2.0), (0.04, 0.04)
    pixels = spark.range(100 * 100).select((F.col("id") % 100).cast("int").alias("x"), F.floor(F.col("id") / 100).cast("int").alias("y"))
    by_pixel = {(r.x, r.y) for r in stages.matching_pixels(pixels, project, countries, regions, others, origin, step, 70_000.0).collect()}
    area = stages.matching_area(project, countries, regions, others, 70_000.0)
    by_shape = {(r.px, r.py) for r in shapes.points_in_polygons(shapes.pixel_centres(pixels, origin, step), area).collect()}
    # circles of 32 corners lie 0.5 % inside the true ones
    assert len(by_pixel) > 400 and len(by_pixel ^ by_shape) < 0.02 * len(by_pixel)
    assert not any(abs(origin[0] + (x + 0.5) * 0.04) < 0.14 and abs(origin[1] + (y + 0.5) * 0.04) < 0.1 for x, y in by_shape)
    with pytest.raises(ValueError, match="meets"):
        stages.matching_area(project, countries, regions.filter("polygon_id = 1"), others)


@pytest.mark.parametrize("how", RULES)
def test_a_crowded_strip_forms_no_table_of_all_pairs(how):
    """21,000 edges at the same heights, six and eight at each place in turn: 220 million pairs."""
    x, many = np.arange(3000.0), 3
    layer, polygon, edges = [], [], []
    for n, (at, width) in enumerate([(x, 0.5)] * many + [(x[::2] + 0.25, 0.5)]):
        for p, left in enumerate(at):
            edges += [(left, 0.0, left, 1.0), (left + width, 0.0, left + width, 1.0)]
            layer += [int(n == many)] * 2
            polygon += [n * len(x) + p] * 2
    tracemalloc.start()
    chains, bottom, top = overlay.swept(np.array(edges), np.array(layer), np.array(polygon), 0.0, 1.0, how, 1e-9)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # a unit square of width a half at each place, and in every second one another a quarter further on
    length = {"union": 0.5 * 3000 + 0.25 * 1500, "intersection": 0.25 * 1500, "difference": 0.5 * 3000 - 0.25 * 1500}[how]
    assert sum(b - a for a, b in bottom) == sum(b - a for a, b in top) == pytest.approx(length)
    assert most < 200 << 20 and len(chains) >= 3000


def test_crossings_in_runs_are_those_of_all_pairs(monkeypatch):
    rng = np.random.default_rng(12)
    for pairs in (1, 50, 10**6):
        monkeypatch.setattr(overlay, "PAIRS", pairs)
        e = rng.integers(0, 15, (120, 4)).astype(float)
        e = e[e[:, 1] < e[:, 3]]
        want = set()
        for i, (ax, ay, bx, by) in enumerate(e):
            for cx, cy, dx, dy in e[:i]:
                a, c = (bx - ax) / (by - ay), (dx - cx) / (dy - cy)
                if a != c:
                    y = ((cx - c * cy) - (ax - a * ay)) / (a - c)
                    want |= {y} if max(ay, cy) < y < min(by, dy) else set()
        got = overlay.crossing_heights(*e.T)
        assert len(want) > 50 and got.tolist() == pytest.approx(sorted(want))
