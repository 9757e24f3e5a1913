"""Filled rasters, chunks and outlines against point tests; appends to a database that fail half-way."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terramatch.operators import pieces, shapes
from terramatch.sources import writers

RING = "polygon_id int, ring array<struct<x: double, y: double>>"
L_SHAPE = [(0.0, 0.0), (1.0, 0.0), (1.0, 0.4), (0.4, 0.4), (0.4, 1.0), (0.0, 1.0)]


def circle(n, radius=1.0, x=0.0, y=0.0, rough=0.0, seed=0):
    far = radius * (1 + rough * np.random.default_rng(seed).uniform(-1, 1, n))
    return [(float(x + r * math.cos(2 * math.pi * i / n)), float(y + r * math.sin(2 * math.pi * i / n))) for i, r in enumerate(far)]


def frame(spark, *rings):
    return spark.createDataFrame(list(enumerate(rings)), RING)


def area(ring):
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def crosses(ring):
    """Whether two edges of a ring that are not neighbours meet."""
    p, q = np.array(ring), np.array(ring[1:] + ring[:1])
    turn = lambda a, b, c: (b[..., 0] - a[..., 0]) * (c[..., 1] - a[..., 1]) - (b[..., 1] - a[..., 1]) * (c[..., 0] - a[..., 0])
    a, b, c, d = p[:, None], q[:, None], p[None], q[None]
    hit = (turn(a, b, c) * turn(a, b, d) <= 0) & (turn(c, d, a) * turn(c, d, b) <= 0)
    n = len(ring)
    near = (np.abs(np.arange(n)[:, None] - np.arange(n)) % (n - 1)) <= 1
    return bool((hit & ~near).any())


@pytest.mark.parametrize("step", [(0.05, 0.05), (0.05, -0.04)])
def test_filled_pixels_are_those_whose_centres_are_inside(spark, step):
    holed = spark.createDataFrame([(9, circle(30, 1.5, 0.3, 0.2, 0.3, 1), [circle(9, 0.4, 0.3, 0.2)])], RING + ", holes array<array<struct<x: double, y: double>>>")
    plain = frame(spark, L_SHAPE, circle(50, 0.7, -0.5, 0.5, 0.6, 2), [(0.0, 0.0), (0.1, 0.1)], []).withColumn("holes", F.lit(None).cast("array<array<struct<x: double, y: double>>>"))
    df, origin = plain.unionByName(holed), (-2.0, -2.0 if step[1] > 0 else 2.0)
    pixels = spark.range(100 * 100).select((F.col("id") % 100).cast("int").alias("x"), F.floor(F.col("id") / 100).cast("int").alias("y"))
    got = {(r.polygon_id, r.x, r.y) for r in pieces.filled_pixels(df, origin, step).collect()}
    want = {(r.polygon_id, r.px, r.py) for r in shapes.points_in_polygons(shapes.pixel_centres(pixels, origin, step), df, 0.3).collect()}
    assert got == want and len(got) > 1000


def test_work_grows_with_edges_and_filled_pixels(spark):
    far = frame(spark, circle(40, 1.0), circle(40, 1.0, 5000.0, 5000.0))
    spans = pieces.filled_spans(far, (-10.0, -10.0), (0.01, 0.01))
    assert spans.count() == 400 and pieces.filled_pixels(far, (-10.0, -10.0), (0.01, 0.01)).count() == pytest.approx(2 * math.pi * 1e4, rel=0.01)


@pytest.mark.parametrize(("ring", "most", "count"), [(circle(48), 0.5, 16), (circle(48), 4.0, 1), (L_SHAPE, 0.2, 16), (L_SHAPE, 0.4, 5), (L_SHAPE, 1.0, 1)])
def test_chunks_of_round_and_concave_outlines(spark, ring, most, count):
    got = pieces.chunks(frame(spark, ring), most).collect()
    assert len(got) == count and sum(area(r.ring) for r in got) == pytest.approx(area(ring))
    for r in got:
        assert all(r.west - 1e-9 <= p.x <= r.east + 1e-9 and r.south - 1e-9 <= p.y <= r.north + 1e-9 for p in r.ring)


def test_chunks_keep_holes_and_leave_empty_squares_out(spark):
    square = [(0.0, 0.0), (3.0, 0.0), (3.0, 3.0), (0.0, 3.0)]
    df = spark.createDataFrame([(1, square, [[(0.9, 0.9), (0.9, 2.1), (2.1, 2.1), (2.1, 0.9)]]), (2, None, None), (3, [], [])], RING + ", holes array<array<struct<x: double, y: double>>>")
    got = pieces.chunks(df, 1.0).collect()
    assert {(r.i, r.j) for r in got} == {(i, j) for i in range(3) for j in range(3)} - {(1, 1)}
    assert sum(abs(area(r.ring)) - sum(abs(area(h)) for h in r.holes) for r in got) == pytest.approx(9 - 1.44)


@pytest.mark.parametrize("ring", [circle(3000, rough=0.02, seed=3), circle(900, rough=0.4, seed=4), circle(201), [(float(i), float(i % 2)) for i in range(300)] + [(300.0, -5.0), (0.0, -5.0)]])
def test_outlines_of_few_points_do_not_cross_themselves(spark, ring):
    (row,) = pieces.simplified(frame(spark, ring)).collect()
    out = [tuple(p) for p in row.ring]
    assert 100 < len(out) <= 200 and set(out) <= set(ring) and not crosses(out)
    assert abs(area(out)) == pytest.approx(abs(area(ring)), rel=0.35)


def test_short_outlines_stay(spark):
    got = pieces.simplified(frame(spark, L_SHAPE, circle(200), [])).orderBy("polygon_id").collect()
    assert [len(r.ring) for r in got] == [6, 200, 0]
    assert pieces.Outline([(0.0, 0.0)] * 5).reduced(3) == []


def test_an_append_that_fails_leaves_the_target_as_it_was(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    first.write.format("jdbc").options(url=url, dbtable="shots", **driver).save()
    there = lambda: sorted(map(tuple, spark.read.format("jdbc").options(url=url, dbtable="shots", **driver).load().collect()))
    more = spark.createDataFrame([(2, "z"), (3, "c"), (3, "d"), (4, "e")], "id long, v string").repartition(3)
    bad = more.withColumn("v", F.when(F.col("id") == 4, F.raise_error(F.lit("a task fails")).cast("string")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="a task fails"):
        writers.append_jdbc(bad, url, "shots", "id", **driver)
    assert there() == [(1, "a"), (2, "b")]
    for _ in range(2):
        writers.append_jdbc(more, url, "shots", "id", **driver)
        assert there() == [(1, "a"), (2, "b"), (3, "c"), (4, "e")]
