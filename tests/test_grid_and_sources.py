import datetime as dt
import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terramatch import schema
from terramatch.functions import geodesy, keys
from terramatch.operators import grid, pieces, shapes
from terramatch.sources import geotiff, readers, writers
from terramatch.streaming import ingest


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_utm_codes(spark):
    """Each zone's meridian and both its borders, north and south, by the definition: zone 1 begins at 180 west."""
    for zone in (1, 13, 30, 44, 60):
        west = -180 + 6 * (zone - 1)
        for lat, base in ((71.5, 32600), (0.0, 32600), (-0.001, 32700), (-33.9, 32700)):
            assert [one(spark, geodesy.utm_epsg(F.lit(lat), F.lit(float(lng)))) - base for lng in (west, west + 3, west + 5.999)] == [zone] * 3


def test_aspect_ratio(spark):
    """A degree of latitude over a degree of longitude, each measured along the ellipsoid in small steps."""
    e2 = geodesy.ECCENTRICITY**2
    place = lambda lat, lng: (lambda n: np.array([n * math.cos(lat) * math.cos(lng), n * math.cos(lat) * math.sin(lng), n * (1 - e2) * math.sin(lat)]))(1 / math.sqrt(1 - e2 * math.sin(lat) ** 2))
    for lat in (-71.0, -23.5, 0.0, 12.25, 47.0):
        r, h = math.radians(lat), 1e-5
        ratio = np.linalg.norm(place(r + h, 0) - place(r - h, 0)) / np.linalg.norm(place(r, h) - place(r, -h))
        assert one(spark, geodesy.aspect_ratio(F.lit(lat))) == pytest.approx(ratio, abs=1e-6)


def test_projection_matches_known_points(spark):
    """The zone's meridian lies at 500 km, and a degree of it has its ellipsoidal length."""
    e, n = geodesy.utm_forward(F.lit(0.0), F.lit(3.0), F.lit(31))
    assert one(spark, F.struct(e, n)) == pytest.approx((500000.0, 0.0), abs=1e-6)
    # CN Tower, 43.642567 N 79.387139 W, is at 630084 E 4833439 N of zone 17
    e, n = geodesy.utm_forward(F.lit(43.642567), F.lit(-79.387139), F.lit(17))
    assert one(spark, F.struct(e, n)) == pytest.approx((630084, 4833439), abs=1.0)


def test_bands_and_boxes(spark):
    assert [one(spark, geodesy.utm_band(F.lit(x))) for x in (-80.0, -0.1, 0.0, 83.9, 84.0)] == ["C", "M", "N", "X", None]
    box = geodesy.utm_box(F.lit(31), F.lit("X"))
    assert [one(spark, box[k]) for k in ("west", "east", "south", "north")] == [0.0, 6.0, 72.0, 84.0]


def test_packed_key_and_its_limits(spark):
    key = lambda *v: one(spark, keys.packed_key(*[F.lit(x) for x in v]))
    assert key(5, 7, 1, 2, 3) == 5 << 32 | 7 << 16 | 1 << 10 | 2 << 5 | 3
    with pytest.raises(Exception, match="too large"):
        key(5, 1 << 16, 1, 2, 3)


def test_nan_lies_in_no_band(spark):
    assert not one(spark, keys.within(F.lit(float("nan")), F.lit(1.0), 5.0))


def test_chunks(spark):
    for wide, high, step in ((0.35, 1.0, 0.5), (1.5, 0.75, 0.25), (2.0, 0.1, 0.7), (0.6, 0.6, 0.2)):
        box = spark.createDataFrame([(1, -3.0, 20.0, -3.0 + wide, 20.0 + high)], "id int, west double, south double, east double, north double")
        got = grid.chunk_boxes(box, step).toPandas()
        assert len(got) == math.ceil(round(wide / step, 9)) * math.ceil(round(high / step, 9))
        assert ((got.east - got.west) * (got.north - got.south)).sum() == pytest.approx(wide * high) and (got.east - got.west).max() <= step + 1e-9


@pytest.fixture(scope="module")
def raster(spark):
    values = np.random.default_rng(3).integers(1, 4, (24, 70))
    return values, spark.createDataFrame([(x, y, int(values[y, x])) for y in range(24) for x in range(70)], "x int, y int, value int")


def test_focal_coverage_by_loops(raster):
    values, df = raster
    ratio = lambda y: 1.0 + y / 40
    got = {(r.x, r.y): r for r in grid.focal_coverage(df, [1, 3], radius=5, ratio=1.0 + F.col("y") / 40, block=16).collect()}
    assert len(got) == values.size
    for x, y in [(0, 0), (69, 23), (16, 3), (15, 11), (40, 20), (33, 12)]:
        n = hit = 0
        for dy in range(-5, 6):
            h = math.floor(ratio(y) * math.sqrt(25 - dy * dy) + 1e-9)
            n += 2 * h + 1
            hit += sum(values[y + dy, x + dx] == 1 for dx in range(-h, h + 1) if 0 <= y + dy < 24 and 0 <= x + dx < 70)
        assert got[x, y].share_1 == pytest.approx(hit / n)


def test_slope_of_a_plane(spark):
    df = spark.createDataFrame([(x, y, 3.0 * x + 4.0 * y) for x in range(5) for y in range(5)], "x int, y int, value double")
    got = grid.slope_horn(df, 1.0, 1.0).toPandas()
    assert len(got) == 9 and got.slope.to_numpy() == pytest.approx(math.degrees(math.atan(5.0)))


def test_lattice_steps():
    assert grid.lattice_step(250_000) == 7 and grid.lattice_step(250_001) == 33


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size)]


def polygons(spark, *rings):
    return spark.createDataFrame([(i, [tuple(map(float, p)) for p in r]) for i, r in enumerate(rings)], "polygon_id int, ring array<struct<x: double, y: double>>")


def test_points_areas_hulls_and_joins(spark):
    df = polygons(spark, square(0, 0, 4), [(0, 0), (4, 0), (4, 4), (2, 1), (0, 4)], square(10, 10, 1), square(1, 1, 1))
    got = df.select(shapes.shoelace(F.col("ring")).alias("a"), F.size(shapes.convex_hull("ring")).alias("h"), shapes.contains(F.col("ring"), F.lit(2.0), F.lit(3.0)).alias("c")).collect()
    assert [r.a for r in got] == [16.0, 10.0, 1.0, 1.0] and [r.h for r in got] == [4, 4, 4, 4] and [r.c for r in got] == [True, False, False, False]
    met = {(r.a_id, r.b_id) for r in shapes.spatial_join(df, df, 3.0).collect()}
    assert met == {(a, b) for a in range(4) for b in range(4) if a == b or 2 not in (a, b)}
    points = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 20.0, 0.0)], "pid int, x double, y double")
    assert {(r.pid, r.polygon_id) for r in shapes.points_in_polygons(points, df, 2.0).collect()} == {(1, 0), (1, 1), (2, 0), (2, 1), (2, 3)}


def test_area_in_metres(spark):
    got = shapes.area_m2(polygons(spark, square(3.0, 0.0, 0.01))).first().area_m2
    assert got == pytest.approx((0.01 * 111_320) * (0.01 * 110_574), rel=2e-3)


def test_buffer_grows_and_ring_leaves_out_the_cells(spark):
    cells = spark.createDataFrame([(0, 0), (1, 0)], "x int, y int")
    assert grid.dilate(cells, 1).count() == 8 and grid.ring(cells, 1).count() == 6


@pytest.mark.parametrize("deflate", [True, False])
def test_geotiff_round_trip(spark, tmp_path, deflate):
    geotiff.register(spark)
    a = np.arange(50 * 37, dtype=np.uint16).reshape(50, 37)
    geotiff.write_tiff(str(tmp_path / "a.tif"), a, x0=10.0, y0=5.0, step=0.5, deflate=deflate)
    geotiff.write_tiff(str(tmp_path / "b.tif"), a.astype(np.float32) / 2, deflate=deflate)
    got = spark.read.format("geotiff").option("blocks", "2").load(str(tmp_path)).toPandas()
    first = got[got.tile == "a.tif"].sort_values(["y", "x"])
    assert (first.value.to_numpy().reshape(50, 37) == a).all() and len(got) == 2 * a.size
    assert first.iloc[0].lng == 10.25 and first.iloc[0].lat == 4.75


def test_geojson_both_ways(spark, tmp_path):
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": "a"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}, {"type": "Feature", "properties": {"name": "b"}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}}]}
    (tmp_path / "in.geojson").write_text(json.dumps(doc, indent=1))
    df = readers.read_geojson(spark, str(tmp_path / "in.geojson"), "name: string")
    assert sorted((r.name, r.polygon_id, len(r.ring)) for r in df.collect()) == [("a", "0-0", 3), ("b", "1-0", 3), ("b", "1-1", 3)]
    out = [json.loads(r.value) for r in writers.features(df, writers.ring_geometry(F.col("ring")), ["name"]).collect()]
    assert out[0]["geometry"]["coordinates"][0][0] == out[0]["geometry"]["coordinates"][0][-1] and out[0]["properties"] == {"name": "a"}


def test_tables_by_extension_and_names(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5)], "year int, value double")
    writers.write_csv(df, str(tmp_path / "t.csv"), single=True)
    writers.write_parquet(df, str(tmp_path / "t.parquet"))
    for name in ("t.csv", "t.parquet"):
        assert readers.read_table(spark, str(tmp_path / name), schema.SERIES).collect() == df.collect()
    with pytest.raises(ValueError):
        readers.read_table(spark, "t.xlsx")
    spark.createDataFrame([(0, 0, 1.0)], "x int, y int, value double").write.parquet(str(tmp_path / "tiles" / "JRC_DeforestationYear_2020_SAM_ID11_S10_W70.parquet"))
    tile = spark.read.parquet(str(tmp_path / "tiles" / "*")).select(*[v.alias(k) for k, v in readers.file_metadata(F.col("_metadata.file_path")).items()]).first()
    assert tuple(tile) == (-10, -70, 2020)


def test_appending_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "shots")
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1)], "granule string, n int")
    for _ in range(2):
        writers.append_new(df, path, "granule")
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("a", 1), ("b", 1)]


def test_publish_and_build_once(spark, tmp_path):
    path = str(tmp_path / "table")
    assert writers.build_if_missing(spark, path, lambda: spark.range(3)) and not writers.build_if_missing(spark, path, lambda: spark.range(5))
    writers.publish(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7


def test_granules_as_a_stream(spark, tmp_path):
    source, table = str(tmp_path / "in"), str(tmp_path / "out")
    make = lambda names: spark.createDataFrame([(n, dt.datetime(2024, 1, 1)) for n in names], "granule string, ts timestamp")
    make(["a", "b", "b"]).write.parquet(source)
    for more in (None, ["b", "c"]):
        if more:
            make(more).write.mode("append").parquet(source)
        stream = ingest.granule_stream(spark, source, "granule string, ts timestamp")
        ingest.append_granules(stream, table, "granule", str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.granule for r in spark.read.parquet(table).collect()) == ["a", "b", "c"]


def test_schema_helpers(spark):
    assert schema.matching_years(2012) == (2012, 2007, 2002) and list(schema.stored_years(2012, 2014)) == list(range(2002, 2015))
    df = spark.createDataFrame([(1, 1.0, 2.0)], "iteration int, k_luc_2001 double, k_luc_2000 double")
    assert schema.first_luc_year(df) == 2000 and schema.with_prefix(df, "k_luc") == ["k_luc_2001", "k_luc_2000"]
    with pytest.raises(ValueError):
        schema.conform(df, schema.SERIES)


def test_holes_of_a_boundary_are_outside(spark, tmp_path):
    square = lambda x, y, side: [[x, y], [x + side, y], [x + side, y + side], [x, y + side], [x, y]]
    features = [[square(3.0, 0.0, 0.04), square(3.01, 0.01, 0.02)], [square(3.015, 0.015, 0.005)]]
    text = json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": str(i)}, "geometry": {"type": "Polygon", "coordinates": c}} for i, c in enumerate(features)]})
    (tmp_path / "holes.geojson").write_text(text)
    df = readers.read_geojson(spark, str(tmp_path / "holes.geojson"), "name: string")
    outer = df.filter("name = '0'")
    points = spark.createDataFrame([(1, 3.005, 0.005), (2, 3.012, 0.012), (3, 3.035, 0.02)], "pid int, x double, y double")
    assert {r.pid for r in shapes.points_in_polygons(points, outer).collect()} == {1, 3}
    full = shapes.area_m2(outer.drop("holes")).first().area_m2
    assert shapes.area_m2(outer).first().area_m2 == pytest.approx(0.75 * full, rel=1e-3)
    assert shapes.spatial_join(outer, df.filter("name = '1'")).count() == 0
    pixels = spark.range(4).selectExpr("cast(id AS int) AS x", "1 AS y")
    got = pieces.rasterise(pixels, outer.withColumn("v", F.lit(1)), "v", (3.0, 0.0), (0.01, 0.01))
    assert {r.x for r in got.collect()} == {0, 3}
