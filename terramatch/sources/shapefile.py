"""Polygons of shapefiles, single or zipped, as rows. A file is one binary value, parsed in its task."""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .fetch import FetchError

#: Fixed values of the format: polygons without and with further ordinates.
POLYGONS = (5, 15, 25)
POINTS = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
SCHEMA = "file string, polygon_id string, attributes map<string,string>, ring array<struct<x:double,y:double>>, holes array<array<struct<x:double,y:double>>>"
TYPE = pa.schema([("file", pa.string()), ("polygon_id", pa.string()), ("attributes", pa.map_(pa.string(), pa.string())), ("ring", POINTS), ("holes", pa.list_(POINTS))])


def signed_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0], ring[:, 1]
    return float(x @ np.roll(y, -1) - y @ np.roll(x, -1)) / 2


def holds(ring: np.ndarray, point: np.ndarray) -> bool:
    """Whether a ray to the right from the point crosses the ring an odd number of times."""
    after = np.roll(ring, -1, axis=0)
    over = (ring[:, 1] > point[1]) != (after[:, 1] > point[1])
    a, b = ring[over], after[over]
    return bool((point[0] < a[:, 0] + (point[1] - a[:, 1]) * (b[:, 0] - a[:, 0]) / (b[:, 1] - a[:, 1])).sum() % 2)


def shapes_of(data: bytes) -> Iterator[list[tuple[np.ndarray, list[np.ndarray]]]]:
    """For each record its outer rings (clockwise in the file) with their holes (the others), without closing points. A record without a shape
    has none; a shape that is no polygon is an error."""
    if struct.unpack(">i", data[:4])[0] != 9994:
        raise ValueError("not a shapefile")
    at = 100
    while at < len(data):
        words = struct.unpack(">i", data[at + 4 : at + 8])[0]
        body, at = data[at + 8 : at + 8 + 2 * words], at + 8 + 2 * words
        kind = struct.unpack("<i", body[:4])[0]
        if kind == 0:
            yield []
            continue
        if kind not in POLYGONS:
            raise ValueError(f"shape type {kind} is not a polygon")
        n_parts, n_points = struct.unpack("<ii", body[36:44])
        starts = [*struct.unpack(f"<{n_parts}i", body[44 : 44 + 4 * n_parts]), n_points]
        points = np.frombuffer(body, dtype="<f8", offset=44 + 4 * n_parts, count=2 * n_points).reshape(-1, 2)
        rings = [points[a:b] for a, b in zip(starts, starts[1:], strict=False)]
        rings = [r[:-1] if len(r) > 1 and (r[0] == r[-1]).all() else r for r in rings]
        outer = [(r, []) for r in rings if signed_area(r) <= 0]
        for hole in (r for r in rings if signed_area(r) > 0):
            around = [o for o in outer if holds(o[0], hole[0])]
            # the smallest ring around a hole is the one that it belongs to; a lone one is an outer ring of the wrong direction
            min(around, key=lambda o: abs(signed_area(o[0])))[1].append(hole) if around else outer.append((hole, []))
        yield outer


def attributes_of(data: bytes) -> list[dict[str, str]]:
    """The records of a dBASE file as texts; deleted records keep their place."""
    n, start, width = struct.unpack("<IHH", data[4:12])
    fields, at = [], 32
    while data[at] != 0x0D:
        fields.append((data[at : at + 11].split(b"\0")[0].decode("latin-1"), data[at + 16]))
        at += 32
    out = []
    for i in range(n):
        at, row = start + i * width + 1, {}
        for name, size in fields:
            row[name] = data[at : at + size].decode("utf-8", "replace").strip()
            at += size
        out.append(row)
    return out


def members(content: bytes) -> tuple[bytes, bytes | None]:
    """The only .shp of an archive and the .dbf of its name; none or several are an error. Content that is no archive is a .shp itself."""
    if not zipfile.is_zipfile(io.BytesIO(content)):
        return content, None
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [n for n in z.namelist() if n.lower().endswith(".shp")]
        if len(names) != 1:
            raise FetchError(f"{len(names)} files end in .shp, not one")
        table = [n for n in z.namelist() if n.lower() == names[0][:-4].lower() + ".dbf"]
        return z.read(names[0]), z.read(table[0]) if table else None


def rows_of(content: bytes, file: str) -> pa.RecordBatch:
    shape, table = members(content)
    attributes = attributes_of(table) if table else []
    as_points = lambda r: [{"x": x, "y": y} for x, y in r.tolist()]
    rows = []
    for i, parts in enumerate(shapes_of(shape)):
        for j, (ring, holes) in enumerate(parts):
            rows.append({"file": file, "polygon_id": f"{i}-{j}", "attributes": list((attributes[i] if i < len(attributes) else {}).items()), "ring": as_points(ring), "holes": [as_points(h) for h in holes]})
    return pa.RecordBatch.from_pylist(rows, schema=TYPE)


def polygons_of(files: DataFrame) -> DataFrame:
    """file, polygon_id, attributes, ring, holes from rows (name, content), as binary files or tables of downloads have them."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                yield rows_of(content.as_py(), name.rsplit("/", 1)[-1])

    return files.select("name", "content").mapInArrow(parse, SCHEMA)


def read_shapefiles(spark: SparkSession, path: str, glob: str = "*.zip") -> DataFrame:
    """Polygons of shapefiles, zipped or plain, in any store that Spark reads. A plain one has no attributes."""
    return polygons_of(spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).selectExpr("path AS name", "content"))
