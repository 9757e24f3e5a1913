"""Downloads by stub fetchers, archives, and shapefiles."""

import io
import struct
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from terramatch.operators import grid, matching, shapes
from terramatch.sources import fetch, shapefile


def archive(**files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, content in files.items():
            z.writestr(name.replace("__", "."), content)
    return out.getvalue()


def test_download_rules(spark, tmp_path):
    path, calls = str(tmp_path / "tiles"), str(tmp_path / "calls")
    good = archive(a__tif=b"tif")

    def get(url, timeout):
        with open(calls, "a") as f:
            f.write(url + "\n")
        if url == "slow" and timeout < 40:
            raise TimeoutError
        return {"gone": (404, b""), "broken": (200, b"no archive"), "fine": (200, good), "slow": (200, good), "late": (200, good)}.get(url, (500, b""))

    targets = spark.createDataFrame([(u, u) for u in ("gone", "broken", "fine", "slow")] + [("fine", "fine")], "name string, url string")
    got = {r.name: (r.status, r.content) for r in fetch.download(targets, get, path, archive=True, timeout=10.0).collect()}
    assert {k: v[0] for k, v in got.items()} == {"gone": "absent", "broken": "bad_archive", "fine": "ok", "slow": "ok"}
    assert fetch.one_member(bytes(got["fine"][1]), ".tif") == b"tif"
    # what is there is not asked for again
    more = targets.unionByName(spark.createDataFrame([("late", "late")], "name string, url string"))
    assert fetch.download(more, get, path, archive=True, timeout=10.0).count() == 5 and fetch.stored(spark, path).count() == 3
    asked = open(calls).read().split()
    assert sorted(asked) == ["broken", "fine", "gone", "late", "slow", "slow", "slow"]
    # another answer is an error and leaves the table as it was
    with pytest.raises(Exception, match="answer 500"):
        fetch.download(spark.createDataFrame([("x", "x")], "name string, url string"), get, path)
    assert fetch.stored(spark, path).count() == 3
    with pytest.raises(TimeoutError):
        fetch.patiently(lambda t: get("slow", t), tries=2, timeout=10.0)


def test_an_archive_has_one_raster():
    for files in ({}, {"a__tif": b"1", "b__TIF": b"2"}):
        with pytest.raises(fetch.FetchError, match="not one"):
            fetch.one_member(archive(readme__txt=b"x", **files), ".tif")


def test_countries_in_batches(spark):
    codes = spark.createDataFrame([(f"{a}{b}",) for a in "ABC" for b in "ABCDEFGHIJKLMNOPQ"] + [("RU",), ("NO",), ("AA",)], "code string")
    got = fetch.in_batches(codes, lambda c: "q=" + ",".join(c)).orderBy("name").collect()
    names = [n for r in got for n in r.name.split("-")]
    assert [len(r.name.split("-")) for r in got] == [20, 20, 10] and names == sorted({f"{a}{b}" for a in "ABC" for b in "ABCDEFGHIJKLMNOPQ"} - {"CA"}) and got[0].url.startswith("q=AA,AB")


def test_catalogue_of_chunks_is_distinct(spark):
    ring = [(0.0, 0.0), (1.0, 0.0), (1.0, 0.4), (0.4, 0.4), (0.4, 1.0), (0.0, 1.0)]
    shape = spark.createDataFrame([(1, ring)], "polygon_id int, ring array<struct<x: double, y: double>>")

    def search(outline, start, end):
        assert start < end and 2 < len(outline) <= 200
        return [f"g{min(round(x * 10) for x, _ in outline)}_{min(round(y * 10) for _, y in outline)}", "all"]

    assert {r.granule for r in fetch.catalogue(shape, search, 0.4).collect()} == {"all", "g0_0", "g4_0", "g8_0", "g0_4", "g0_8"}


def shp(records):
    """Records of rings, each closed, as the format has them; None for a record without a shape."""
    body = b""
    for i, rings in enumerate(records, 1):
        if rings is None:
            content = struct.pack("<i", 0)
        else:
            points = np.array([p for r in rings for p in [*r, r[0]]], dtype="<f8")
            starts = np.cumsum([0] + [len(r) + 1 for r in rings[:-1]])
            content = struct.pack("<i4dii", 5, *points.min(axis=0), *points.max(axis=0), len(rings), len(points)) + np.array(starts, dtype="<i4").tobytes() + points.tobytes()
        body += struct.pack(">ii", i, len(content) // 2) + content
    return struct.pack(">i20xi", 9994, 50 + len(body) // 2) + struct.pack("<ii8d", 1000, 5, *[0.0] * 8) + body


def dbf(fields, rows):
    head = b"".join(n.encode().ljust(11, b"\0") + b"C" + bytes(4) + bytes([w]) + bytes(15) for n, w in fields)
    width = 1 + sum(w for _, w in fields)
    return bytes([3, 0, 0, 0]) + struct.pack("<IHH", len(rows), 33 + len(head), width) + bytes(20) + head + b"\r" + b"".join(b" " + b"".join(v.encode().ljust(w) for v, (_, w) in zip(r, fields, strict=True)) for r in rows)


def test_shapefiles_keep_holes_and_parts(spark, tmp_path):
    clockwise = lambda x, y, s: [(x, y), (x, y + s), (x + s, y + s), (x + s, y)]
    outer, hole, island, apart = clockwise(0, 0, 10), clockwise(2, 2, 6)[::-1], clockwise(4, 4, 2), clockwise(20, 0, 1)
    content = archive(land__shp=shp([[outer, hole, island], None, [apart[::-1]]]), land__dbf=dbf([("NAME", 8), ("CODE", 3)], [("one", "A1"), ("none", ""), ("three", "C3")]), land__prj=b"x")
    (tmp_path / "land.zip").write_bytes(content)
    (tmp_path / "plain.shp").write_bytes(shp([[outer]]))
    df = shapefile.read_shapefiles(spark, str(tmp_path))
    rows = {r.polygon_id: r for r in df.collect()}
    assert set(rows) == {"0-0", "0-1", "2-0"} and rows["0-0"].attributes == {"NAME": "one", "CODE": "A1"} and rows["2-0"].attributes["NAME"] == "three"
    assert [len(rows[k].holes) for k in ("0-0", "0-1", "2-0")] == [1, 0, 0] and len(rows["0-0"].ring) == 4
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 5.0, 5.0), (4, 20.5, 0.5)], "pid int, x double, y double")
    assert {r.pid for r in shapes.points_in_polygons(points, df, 4.0).collect()} == {1, 3, 4}
    assert shapefile.read_shapefiles(spark, str(tmp_path), "*.shp").count() == 1
    for bad in (archive(a__shp=b"", b__shp=b""), archive(a__dbf=b"")):
        with pytest.raises(fetch.FetchError, match="not one"):
            shapefile.members(bad)
    with pytest.raises(ValueError, match="not a shapefile"):
        list(shapefile.shapes_of(bytes(100)))


def test_bins_by_the_attribute_that_splits_best(spark):
    df = spark.range(1000).select((F.col("id") % 10).cast("double").alias("a"), F.col("id").cast("double").alias("b"), F.lit(1.0).alias("c"))
    assert matching.best_bin(df, {"a": 1.0, "b": 10.0, "c": 0.1}) == "b" and matching.best_bin(df, {"a": 1.0, "b": 500.0, "c": 0.1}) == "a"
    assert matching.best_bin(df.limit(0), {"a": 1.0, "b": 10.0}) == "a"
    assert [matching.halvings(p, d) for p, d in ((0.01, 9), (0.5, 1), (0.01, 1), (0.9, 2))] == [1, 0, 0, 4]
