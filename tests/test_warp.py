"""Warping there and back, slopes over zones, groups of tiles and missing granules."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terramatch.functions import geodesy
from terramatch.operators import warp
from terramatch.plans import stages

E2 = geodesy.FLATTENING * (2 - geodesy.FLATTENING)


def meridian(lat):
    """Metres from the equator, by small steps of the ellipsoid."""
    at = np.linspace(0, np.radians(lat), 20_001)
    f = geodesy.SEMI_MAJOR * (1 - E2) / (1 - E2 * np.sin(at) ** 2) ** 1.5
    return float(((f[1:] + f[:-1]) / 2 * np.diff(at)).sum())


def raster(spark, west, north, step, width, height, value):
    rows = [(x, y, float(value(west + (x + 0.5) * step, north - (y + 0.5) * step))) for y in range(height) for x in range(width)]
    return spark.createDataFrame(rows, "x int, y int, value double")


@pytest.mark.parametrize(("west", "north"), [(5.96, 45.0), (5.96, 0.02), (11.2, -33.0)])
def test_slope_of_a_plane_over_zones(spark, west, north):
    """A plane that rises a tenth to the north: 5.711 degrees in each zone, within 0.03 for the scale of the zones and the sampling."""
    step, size = 0.002, 40
    heights = {north - (y + 0.5) * step: 0.1 * meridian(north - (y + 0.5) * step) for y in range(size)}
    df = raster(spark, west, north, step, size, size, lambda x, y: heights[min(heights, key=lambda h: abs(h - y))])
    got = {(r.x, r.y): r.slope for r in stages.zone_slope(df, step, west, north).collect()}
    inner = [(x, y) for x in range(4, size - 4) for y in range(4, size - 4)]
    assert all(p in got for p in inner) and max(abs(got[p] - math.degrees(math.atan(0.1))) for p in inner) < 0.03
    assert len(got) < size * size  # the border has no nine cells


def test_there_and_back(spark):
    west, north, step = 8.9, 47.0, 0.001
    df = raster(spark, west, north, step, 30, 30, lambda x, y: 1000 * x + 500 * y).withColumn("zone", F.lit(32))
    grids = warp.in_utm(df, (west, north), (step, -step), 90.0, block=16)
    assert grids.count() == grids.select("zone", "x", "y").distinct().count()
    back = {(r.x, r.y): r.value for r in warp.in_degrees(grids, df, (west, north), (step, -step), 90.0, block=16).collect()}
    want = {(r.x, r.y): r.value for r in df.collect()}
    inner = [p for p in want if all(3 <= c < 27 for c in p)]
    assert all(p in back for p in inner) and max(abs(back[p] - want[p]) for p in inner) < 0.02


@pytest.mark.parametrize("how", ["bilinear", "nearest"])
def test_samples_are_those_of_a_plain_lookup(spark, how):
    rng = np.random.default_rng(2)
    values, places = rng.normal(size=(40, 50)), rng.uniform(-3, 52, (600, 2))
    places[:50] = np.round(places[:50])
    values[7, 9] = np.nan
    pixels = spark.createDataFrame([(x, y, None if np.isnan(values[y, x]) else float(values[y, x])) for y in range(40) for x in range(50)], "x int, y int, value double")
    targets = spark.createDataFrame([(i, 0, float(x), float(y)) for i, (x, y) in enumerate(places)], "x int, y int, fx double, fy double")
    got = {r.x: r.value for r in warp.sampled(pixels, targets, how=how, block=16).collect()}
    at = lambda x, y: values[y, x] if 0 <= x < 50 and 0 <= y < 40 else np.nan
    want = {}
    for i, (x, y) in enumerate(places):
        j, k = math.floor(x), math.floor(y)
        u, v = x - j, y - k
        if how == "nearest":
            value = at(j + (u >= 0.5), k + (v >= 0.5))
        else:
            value = sum(w * at(j + a, k + b) for a, b, w in ((0, 0, (1 - u) * (1 - v)), (1, 0, u * (1 - v)), (0, 1, (1 - u) * v), (1, 1, u * v)) if w)
        if not np.isnan(value):
            want[i] = value
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want) and 200 < len(want) < 600
    with pytest.raises(ValueError, match="neither"):
        warp.sampled(pixels, targets, how="cubic")


def test_groups_hold_all_tiles(spark):
    tiles = spark.createDataFrame([(y, t, 0, 0, 1) for y in (2000, 2005) for t in "ab"], "year int, tile string, x int, y int, value int")
    groups = lambda *rows: spark.createDataFrame(list(rows), "tile string, region string")
    assert stages.coverage_groups(tiles, groups(("a", "r"), ("b", "s"))).count() == 4
    for rows, message in (((("a", "r"),), "no region: b, 20"), ((("a", "r"), ("b", "r"), ("c", "r")), "lacks a tile: 20.*c|lacks a tile: c"), ((("a", "r"), ("b", "r"), ("b", "s")), "several regions: b")):
        with pytest.raises(ValueError, match=message):
            stages.coverage_groups(tiles, groups(*rows))


def test_a_missing_granule_is_an_error(spark):
    shots = spark.createDataFrame([("g1", 0.5, 0.5, "full", 0, 1, "2020-05-05 00:00:00")], "granule string, lat double, lng double, beam_type string, degrade_flag int, l4_quality_flag int, absolute_time string").withColumn("absolute_time", F.to_timestamp("absolute_time"))
    area = spark.createDataFrame([(1, [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])], "polygon_id int, ring array<struct<x: double, y: double>>")
    wanted = spark.createDataFrame([("g1",), ("g2",)], "granule string")
    assert stages.project_shots(shots, area, wanted=wanted.limit(1)).count() == 1
    with pytest.raises(ValueError, match="missing: g2"):
        stages.project_shots(shots, area, wanted=wanted)
