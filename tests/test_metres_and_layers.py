"""Distances in metres, filters that must find something, layers that must fit, GeoTIFF's encodings, and the stages over made tiles."""

import io
import json
import math
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terramatch.functions import geodesy
from terramatch.operators import filters, grid, matching, ranks, shapes
from terramatch.plans import stages
from terramatch.session import durable
from terramatch.sources import geotiff, readers, writers


def polygons(spark, *rings):
    return spark.createDataFrame([(i, [tuple(map(float, p)) for p in r]) for i, r in enumerate(rings)], "polygon_id int, ring array<struct<x: double, y: double>>")


def turned(x, y, size, angle):
    """A square about (x, y), turned."""
    corners = [(-size, -size), (size, -size), (size, size), (-size, size)]
    return [(x + a * math.cos(angle) - b * math.sin(angle), y + a * math.sin(angle) + b * math.cos(angle)) for a, b in corners]


CONCAVE = [(3.0, 0.0), (3.04, 0.0), (3.04, 0.04), (3.02, 0.012), (3.0, 0.04)]


def test_projection_goes_both_ways(spark):
    rng = np.random.default_rng(2)
    rows = [(float(lat), float(lng), z, bool(lat < 0)) for z in (1, 17, 31, 60) for lat, lng in zip(rng.uniform(-79, 83, 50), z * 6 - 183 + rng.uniform(-3, 3, 50), strict=True)]
    df = spark.createDataFrame(rows, "lat double, lng double, zone int, south boolean")
    east, north = geodesy.utm_forward(F.col("lat"), F.col("lng"), F.col("zone"))
    lat, lng = geodesy.utm_inverse(F.col("e"), F.col("n"), F.col("zone"), F.col("south"))
    got = df.withColumn("e", east).withColumn("n", north).select("lat", "lng", lat.alias("lat2"), lng.alias("lng2")).toPandas()
    # millimetres: series to the third order
    assert abs(got.lat - got.lat2).max() < 2e-8 and abs(got.lng - got.lng2).max() < 2e-7


def flat_distance(ring, x, y):
    """Metres from a point to a ring's edges near the zone's meridian, by the ellipsoid's lengths of a degree at the point."""
    e2 = geodesy.FLATTENING * (2 - geodesy.FLATTENING)
    w = 1 - e2 * math.sin(math.radians(y)) ** 2
    mx, my = math.pi / 180 * geodesy.SEMI_MAJOR * math.cos(math.radians(y)) / math.sqrt(w), math.pi / 180 * geodesy.SEMI_MAJOR * (1 - e2) / w**1.5
    best = math.inf
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
        px, py, qx, qy = (x - ax) * mx, (y - ay) * my, (bx - ax) * mx, (by - ay) * my
        t = min(1.0, max(0.0, (px * qx + py * qy) / (qx * qx + qy * qy)))
        best = min(best, math.hypot(px - t * qx, py - t * qy))
    return best


def inside(ring, x, y):
    hit = False
    for (ax, ay), (bx, by) in zip(ring, ring[1:] + ring[:1], strict=True):
        if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
            hit = not hit
    return hit


@pytest.mark.parametrize("ring", [turned(3.02, 0.02, 0.015, 0.5), CONCAVE])
def test_buffers_in_metres(spark, ring):
    df = polygons(spark, ring)
    pixels = spark.range(60 * 60).select((F.col("id") % 60).cast("int").alias("x"), F.floor(F.col("id") / 60).cast("int").alias("y"))
    origin, step, metres = (2.98, -0.02), (0.0014, 0.0014), 700.0
    got = {(r.x, r.y) for r in shapes.pixels_within_metres(pixels, df, metres, origin, step, 0.05).collect()}
    zone = {(r.x, r.y) for r in stages.leakage_zone(pixels, df, origin, step, metres).collect()}
    parts = durable(shapes.buffer_parts(df, metres, 64), "parts")
    covered = {(r.px, r.py) for r in shapes.points_in_polygons(shapes.pixel_centres(pixels, origin, step), parts.withColumn("polygon_id", F.col("part")), 0.05).collect()}
    for x in range(60):
        for y in range(60):
            px, py = origin[0] + (x + 0.5) * step[0], origin[1] + (y + 0.5) * step[1]
            d, within = flat_distance(ring, px, py), inside(ring, px, py)
            if abs(d - metres) > 3:  # the zone's scale is 0.9996 at its meridian
                assert ((x, y) in got) == (within or d <= metres) == ((x, y) in covered)
                assert ((x, y) in zone) == (not within and d <= metres)
    assert len(zone) > 100


def test_shapes_that_are_turned_or_concave(spark):
    rings = [turned(3.0, 2.0, 1.0, 0.7), [(2.5, 1.0), (6.0, 1.0), (6.0, 5.0), (4.0, 2.0), (2.5, 5.0)], turned(4.0, 4.5, 0.5, 0.3), turned(9.0, 9.0, 1.0, 1.1)]
    df = polygons(spark, *rings)
    pair = df.alias("a").join(df.alias("b"), F.col("a.polygon_id") < F.col("b.polygon_id"))
    apart = {(r[0], r[1]): r[2] for r in pair.select("a.polygon_id", "b.polygon_id", shapes.disjoint(F.col("a.ring"), F.col("b.ring"))).collect()}
    rng = np.random.default_rng(0)
    points = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(0, 11, (3000, 2)))]
    hits = {(r.pid, r.polygon_id) for r in shapes.points_in_polygons(spark.createDataFrame(points, "pid int, x double, y double"), df, 0.7).collect()}
    assert hits == {(i, j) for i, x, y in points for j, ring in enumerate(rings) if inside(ring, x, y)}
    # the third lies in the notch of the second, near it but apart
    assert apart == {(0, 1): False, (0, 2): True, (0, 3): True, (1, 2): True, (1, 3): True, (2, 3): True}
    assert {(r.a_id, r.b_id) for r in shapes.spatial_join(df, df, 2.0).collect()} == {(i, i) for i in range(4)} | {(0, 1), (1, 0)}


def test_filters_that_must_find_something(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "v int, c string")
    assert filters.listed(df, "c", ["a", "z"]).count() == 1 and [r.v for r in filters.unlike(df, "c", "a").orderBy("v").collect()] == [2, 3]
    with pytest.raises(ValueError, match="listed"):
        filters.listed(df, "c", ["z"])
    assert filters.columns_beyond(df, ["c"]) == ["v"] and filters.matched(df, "v").count() == 3
    a, b = polygons(spark, turned(0, 0, 1, 0)), polygons(spark, turned(0.5, 0, 1, 0.2), turned(9, 9, 1, 0))
    assert [r.polygon_id for r in shapes.meeting(b, a).collect()] == [0]
    with pytest.raises(ValueError, match="meets"):
        shapes.meeting(a, polygons(spark, turned(9, 9, 1, 0)))
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 9.0, 9.0)], "pid int, x double, y double")
    assert [r.pid for r in shapes.points_in_first(points, b).collect()] == [1]
    r = filters.summary(spark.range(1, 102).withColumnRenamed("id", "v"), "v").first()
    assert (r.least, r.most, r.q_25, r.q_50, r.q_75) == (1, 101, 26.0, 51.0, 76.0)


def layer(spark, values, name="value"):
    return spark.createDataFrame([(x, y, float(v)) for y, row in enumerate(values) for x, v in enumerate(row)], f"x int, y int, {name} double")


def test_layers_must_fit(spark):
    a, b = layer(spark, np.ones((5, 5))), layer(spark, np.ones((5, 6)))
    with pytest.raises(ValueError, match="layer b has other pixels than a"):
        grid.co_grid({"a": a, "b": b}, strict=True)
    assert grid.co_grid({"a": a, "b": a}, strict=True).count() == 25 and grid.co_grid({"a": a, "b": b}).count() == 25
    e = filters.extent(b).first()
    assert (e.west, e.east, e.north, e.south, e.n) == (0, 5, 0, 4, 30)
    assert grid.crop(b, 1, 1, 3, 5).count() == 8


def test_treated_pixels_and_the_match_table(spark):
    rng = np.random.default_rng(1)
    elevation, luc = rng.random((40, 40)), rng.integers(1, 4, (40, 40))
    layers = {"elevation": layer(spark, elevation), "luc_2012": layer(spark, luc)}
    boundary = grid.crop(layers["elevation"], 5, 5, 30, 30)
    got = stages.treated_pixels(layers, boundary, 1000.0).collect()
    assert {(r.x, r.y) for r in got} == {(x, y) for x in range(7, 30, 7) for y in range(7, 30, 7)} and all(r.elevation == elevation[r.y, r.x] and r.luc_2012 == luc[r.y, r.x] for r in got)
    with pytest.raises(ValueError, match="no pixel"):
        stages.treated_pixels(layers, grid.crop(boundary, 8, 8, 9, 9), 1000.0)
    marks = grid.raster_sum(layer(spark, (luc == 1) * 1).unionByName(layer(spark, (elevation > 0.9) * 1)))
    table = stages.match_table(layers, marks).collect()
    assert {(r.x, r.y) for r in table} == {(x, y) for x in range(40) for y in range(40) if luc[y, x] == 1 or elevation[y, x] > 0.9}


def test_coverage_over_the_borders_of_tiles_by_year(spark):
    values = {y: np.random.default_rng(y).integers(1, 4, (12, 24)) for y in (2000, 2005)}
    rows = [(y, f"t{x // 12}", x, r, int(v[r, x])) for y, v in values.items() for r in range(12) for x in range(24)]
    rows += [(2000, "t9", 3, 3, 9)]  # an overlap, by a later tile
    got = stages.fine_coverage(spark.createDataFrame(rows, "year int, tile string, x int, y int, value int"), [1, 3], 1.3, radius=4).collect()
    assert len(got) == 2 * 12 * 24
    for r in got:
        if (r.x + r.y) % 7 == 0:
            n = hit = 0
            for dy in range(-4, 5):
                h = math.floor(1.3 * math.sqrt(16 - dy * dy) + 1e-9)
                n += 2 * h + 1
                hit += sum(values[r.year][r.y + dy, r.x + dx] == 3 for dx in range(-h, h + 1) if 0 <= r.y + dy < 12 and 0 <= r.x + dx < 24)
            assert r.share_3 == pytest.approx(hit / n)


def test_slope_over_zones(spark):
    """A plane that rises a metre in ten to the east, across the border of two zones."""
    degrees, north = 0.01, 45.0
    e, _ = geodesy.metres_per_degree(F.lit(north) - (F.col("y") + 0.5) * degrees)
    df = spark.range(10 * 7).select((F.col("id") % 10).cast("int").alias("x"), F.floor(F.col("id") / 10).cast("int").alias("y")).withColumn("value", 0.1 * e * degrees * (F.col("x") - 5))
    got = stages.slope(df, degrees, north).toPandas()
    assert len(got) == 8 * 5 and got.slope.to_numpy() == pytest.approx(math.degrees(math.atan(0.1)), rel=1e-3)


def test_shots_of_a_project(spark):
    rows = [("g1", 3.01, 0.005, "full", 0, 1, "2020-06-01"), ("g1", 3.01, 0.005, "full", 0, 1, "2020-06-01"), ("g2", 3.02, 0.03, "full", 0, 1, "2020-06-01"), ("g1", 3.01, 0.006, "cover", 0, 1, "2020-06-01"), ("g2", 3.01, 0.004, "full", 0, 1, "2021-01-01"), ("g2", 3.03, 0.01, "full", 0, 1, "2020-01-01")]
    df = spark.createDataFrame(rows, "granule string, lng double, lat double, beam_type string, degrade_flag int, l4_quality_flag int, t string").withColumn("absolute_time", F.to_timestamp("t")).drop("t")
    got = stages.project_shots(df, polygons(spark, CONCAVE)).collect()
    assert sorted((r.granule, r.lng, r.lat) for r in got) == [("g1", 3.01, 0.005), ("g2", 3.03, 0.01)]


def test_the_walk_for_candidates_stops_early(spark, monkeypatch):
    """Each row of k matches all of m: rounds form a few times the wanted pairs and no more, and find the same as one long look."""
    n = 4000
    m = durable(ranks.with_position(spark.range(n).selectExpr("id", "cast(1 AS int) AS h", "cast(id % 7 AS double) AS a"), ["id"]), "m")
    k = spark.range(20).selectExpr("id", "cast(1 AS int) AS h", "cast(3.0 AS double) AS a")
    sizes = []
    monkeypatch.setattr(matching, "durable", lambda df, name: sizes.append(name) or durable(df, name))
    for by in (None, "a"):
        got = matching.candidate_pairs(k, m, ["h"], {"a": 1.0}, seed=3, required=5, by=by, span=8)
        want = matching.candidate_pairs(k, m, ["h"], {"a": 1.0}, seed=3, required=5, by=by, span=n)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 100
        assert got.agg(F.max("step")).first()[0] < 32
    assert sizes.count("seeking") <= 6
    narrow = k.withColumn("a", F.when(F.col("id") == 3, 99.0).otherwise(F.col("a")))
    assert {r.id for r in matching.misses(narrow, matching.candidate_pairs(narrow, m, ["h"], {"a": 1.0}, required=5, span=8)).collect()} == {3}


def test_broadcasts_are_decided_by_bytes(spark, monkeypatch):
    df = polygons(spark, *[turned(i, i, 1, 0.1) for i in range(50)])
    hinted = lambda x: "broadcast" in x._jdf.queryExecution().logical().toString().lower()
    assert hinted(matching.small(df))
    monkeypatch.setattr(matching, "BROADCAST_BYTES", 50 * (8 + 4 * 16) - 1)
    assert not hinted(matching.small(df))
    nested = spark.createDataFrame([("ab", [[1.0, 2.0], [3.0]], ("x", 2))], "a string, b array<array<double>>, c struct<d: string, e: int>")
    assert nested.select(sum((matching.bytes_of(F.col(f.name), f.dataType) for f in nested.schema), F.lit(0))).first()[0] == 10 + 24 + (8 + 9 + 8)


def tiff(data, shape, bits, sample, compression=1, predictor=1, nodata=None):
    fields = [(256, "I", (shape[1],)), (257, "I", (shape[0],)), (258, "H", (bits,)), (259, "H", (compression,)), (273, "I", (8,)), (278, "I", (shape[0],)), (279, "I", (len(data),)), (317, "H", (predictor,)), (339, "H", (sample,))]
    at, table, extra = 8 + len(data), b"", b""
    fields += [(42113, "s", nodata.encode() + b"\0")] if nodata else []
    after = at + 2 + 12 * len(fields) + 4
    for tag, code, value in fields:
        raw = value if code == "s" else struct.pack(f"<{len(value)}{code}", *value)
        if len(raw) > 4:
            raw, extra = struct.pack("<I", after + len(extra)), extra + raw
        table += struct.pack("<HHI", tag, {"H": 3, "I": 4, "s": 2}[code], len(value)) + raw.ljust(4, b"\0")
    return b"II" + struct.pack("<HI", 42, at) + data + struct.pack("<H", len(fields)) + table + b"\0\0\0\0" + extra


def lzw(data):
    """Encoder by TIFF 6.0: longest known string, its code, and one entry more; wider codes after entries 511, 1023 and 2047, a new table after
    entry 4094."""
    out, width, table = [(256, 9)], 9, {bytes([i]): i for i in range(256)}
    size, word = 258, b""
    for b in data:
        longer = word + bytes([b])
        if longer in table:
            word = longer
            continue
        out.append((table[word], width))
        table[longer] = size
        size += 1
        if size == 4095:
            out.append((256, width))
            table, size, width = {bytes([i]): i for i in range(256)}, 258, 9
        else:
            width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        word = bytes([b])
    out += [(table[word], width), (257, width)]
    bits = "".join(format(c, f"0{w}b") for c, w in out)
    return int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")


def values(content):
    return np.concatenate([np.array(b.column(5).to_pylist(), dtype=object) for b in geotiff.strips_of(io.BytesIO(content), "t")])


def test_tiff_encodings():
    rng = np.random.default_rng(4)
    floats = rng.normal(size=(9, 11)).astype(np.float32)
    planes = np.frombuffer(floats.astype(">f4").tobytes(), dtype=np.uint8).reshape(9, 11, 4).transpose(0, 2, 1).reshape(9, 44)
    differences = np.diff(planes, axis=1, prepend=np.zeros((9, 1), dtype=np.uint8)).astype(np.uint8)
    assert (values(tiff(zlib.compress(differences.tobytes()), floats.shape, 32, 3, 8, 3)) == floats.ravel()).all()
    ints = rng.integers(0, 5, (40, 300)).astype(np.uint8)
    assert geotiff.unpacked_lzw(lzw(ints.tobytes())) == ints.tobytes() and geotiff.unpacked_lzw(lzw(b"\7" * 9000)) == b"\7" * 9000
    noise = rng.integers(0, 256, 20_000).astype(np.uint8).tobytes()
    assert geotiff.unpacked_lzw(lzw(noise)) == noise
    row = np.diff(ints, axis=1, prepend=np.zeros((40, 1), dtype=np.uint8)).astype(np.uint8)
    assert (values(tiff(lzw(row.tobytes()), ints.shape, 8, 1, 5, 2)) == ints.ravel()).all()
    assert geotiff.unpacked_bits(bytes([2, 1, 2, 3, 254, 9, 128, 0, 7])) == bytes([1, 2, 3, 9, 9, 9, 7])
    assert values(tiff(np.array([[1, 255, 3]], dtype=np.uint8).tobytes(), (1, 3), 8, 1, nodata="255")).tolist() == [1.0, None, 3.0]
    for bad in (dict(compression=7), dict(predictor=3), dict(bits=12)):
        with pytest.raises(ValueError, match="not supported"):
            values(tiff(bytes(64), (4, 4), **{"bits": 8, "sample": 1} | bad))


def test_tiles_through_sparks_own_reader(spark, tmp_path):
    geotiff.write_tiff(str(tmp_path / "a.tif"), np.arange(12, dtype=np.int16).reshape(3, 4), x0=10.0, y0=5.0, step=0.5)
    geotiff.register(spark)
    two = [sorted(map(tuple, df.collect())) for df in (readers.read_geotiff(spark, str(tmp_path)), spark.read.format("geotiff").load(str(tmp_path)))]
    assert two[0] == two[1] and len(two[0]) == 12


def test_features_come_back(spark, tmp_path):
    df = polygons(spark, CONCAVE, turned(0, 0, 1, 0.4)).withColumn("name", F.concat(F.lit("n"), F.col("polygon_id")))
    want = sorted((f"n{i}", len(r)) for i, r in enumerate([CONCAVE, turned(0, 0, 1, 0.4)]))
    writers.write_geojson(df.repartition(2), str(tmp_path / "lines"), writers.ring_geometry(F.col("ring")), ["name"])
    writers.write_feature_collection(df.repartition(2), str(tmp_path / "one"), writers.ring_geometry(F.col("ring")), ["name"])
    a, b = readers.read_geojson(spark, str(tmp_path / "lines"), "name: string", lines=True), readers.read_geojson(spark, str(tmp_path / "one"), "name: string")
    for got in (a, b):
        rows = got.collect()
        assert sorted((r.name, len(r.ring)) for r in rows) == want and len({r.polygon_id for r in rows}) == 2
        assert shapes.points_in_polygons(spark.createDataFrame([(3.005, 0.01)], "x double, y double"), got).count() == 1
    (file,) = (tmp_path / "one").glob("part-*")
    assert json.loads(file.read_text())["type"] == "FeatureCollection"
    writers.write_feature_collection(df.limit(0), str(tmp_path / "none"), writers.ring_geometry(F.col("ring")), ["name"])
    assert readers.read_geojson(spark, str(tmp_path / "none"), "name: string").count() == 0
    pairs = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "k_lng double, k_lat double, s_lng double, s_lat double")
    assert json.loads(writers.pair_features(pairs).first().value)["geometry"] == {"type": "LineString", "coordinates": [[1.0, 2.0], [3.0, 4.0]]}


def test_a_table_is_there_after_a_failed_publish(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    writers.publish(spark.range(3), path)
    writers.publish(spark.range(4), path)
    assert spark.read.parquet(path).count() == 4 and [p.name for p in tmp_path.iterdir() if not p.name.startswith(".")] == ["t"]
    real = writers._path

    class Stuck:
        def __init__(self, fs):
            self.fs, self.moved = fs, 0

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            return False if ".new-" in a.toString() else self.fs.rename(a, b)

    monkeypatch.setattr(writers, "_path", lambda s, p: (lambda a, fs: (a, Stuck(fs)))(*real(s, p)))
    with pytest.raises(OSError, match="publish"):
        writers.publish(spark.range(9), path)
    assert spark.read.parquet(path).count() == 4


def test_simple_readers_and_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("v;c\n1;'x;y'\n")
    assert [tuple(r) for r in readers.read_csv(spark, str(tmp_path / "a.csv"), "v int, c string", ["c"], sep=";", quote="'").collect()] == [("x;y",)]
    (tmp_path / "d.json").write_text('{"a": 1,\n "b": [2]}')
    assert readers.read_json(spark, str(tmp_path / "d.json"), "a int, b array<int>").first().b == [2]
    writers.write_json(spark.range(2), str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    layer(spark, np.ones((2, 2))).write.parquet(str(tmp_path / "N10_W070_2001_x.parquet"))
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    assert [r.name for r in writers.missing_targets(names, names.filter("name = 'a'")).collect()] == ["b"]
    ring = spark.range(1).select(shapes.tile_square(F.lit(10), F.lit(-70)).alias("ring"))
    assert ring.select(shapes.contains(F.col("ring"), F.lit(-65.0), F.lit(5.0)), F.abs(shapes.shoelace(F.col("ring")))).first()[:] == (True, 100.0)
