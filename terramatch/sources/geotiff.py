"""A Spark data source for GeoTIFF tiles: spark.read.format("geotiff").option("rows", 256).load(path).

Strips or tiles of single-band images: uncompressed, deflated, LZW or PackBits, with horizontal or floating-point differencing. A partition is a run of
strips of one file, and only the bytes of those strips are read, so a large image is read in parallel and a bounded window at a time.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

#: Fixed values of the format: tags, and the sizes of field types in bytes with their codes for struct.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIP_AT, PER_STRIP, STRIP_BYTES, PREDICTOR, TILE_W, TILE_H, TILE_AT, TILE_BYTES, SAMPLE, SCALE, TIE, NO_DATA = 256, 257, 258, 259, 273, 278, 279, 317, 322, 323, 324, 325, 339, 33550, 33922, 42113
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q"}


def header(f) -> tuple[str, dict[int, tuple]]:
    """Byte order, and the fields of the first image by tag."""
    order = {b"II": "<", b"MM": ">"}[f.read(2)]
    magic, at = struct.unpack(order + "HI", f.read(6))
    if magic != 42:
        raise ValueError("not a classic TIFF")
    f.seek(at)
    (n,) = struct.unpack(order + "H", f.read(2))
    raw, out = f.read(12 * n), {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(order + "HHI", raw, 12 * i)
        code = TYPES.get(kind)
        if not code:
            continue
        size = struct.calcsize(code) * count
        if size <= 4:
            data = raw[12 * i + 8 : 12 * i + 8 + size]
        else:
            f.seek(struct.unpack_from(order + "I", raw, 12 * i + 8)[0])
            data = f.read(size)
        out[tag] = (data.rstrip(b"\0").decode("latin-1"),) if code == "s" else struct.unpack(f"{order}{count}{code}", data)
    return order, out


def blocks(tags: dict[int, tuple]) -> list[tuple[int, int, int, int, int, int]]:
    """(offset, bytes, x, y, width, height) of all strips or tiles."""
    w, h = tags[WIDTH][0], tags[HEIGHT][0]
    if TILE_AT in tags:
        tw, th = tags[TILE_W][0], tags[TILE_H][0]
        across = -(-w // tw)
        return [(o, n, i % across * tw, i // across * th, tw, th) for i, (o, n) in enumerate(zip(tags[TILE_AT], tags[TILE_BYTES], strict=True))]
    rows = tags.get(PER_STRIP, (h,))[0]
    return [(o, n, 0, i * rows, w, min(rows, h - i * rows)) for i, (o, n) in enumerate(zip(tags[STRIP_AT], tags[STRIP_BYTES], strict=True))]


def unpacked_bits(data: bytes) -> bytes:
    """PackBits: a byte n below 128 stands before n + 1 bytes as they are, one over 128 before a byte that comes 257 - n times."""
    out, at = bytearray(), 0
    while at < len(data):
        n = data[at]
        if n < 128:
            out += data[at + 1 : at + n + 2]
            at += n + 2
        else:
            out += data[at + 1 : at + 2] * (257 - n if n > 128 else 0)
            at += 2 if n > 128 else 1
    return bytes(out)


def unpacked_lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, the first bit highest: 256 empties the table, 257 ends. The table is one entry behind the
    writer's, so codes get wider after entries 510, 1022 and 2046."""
    table, out, previous, width, bits, held = [bytes([i]) for i in range(256)] + [b"", b""], [], b"", 9, 0, 0
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            del table[258:]
            previous, width = b"", 9
            continue
        entry = table[code] if code < len(table) else previous + previous[:1]
        out.append(entry)
        if previous:
            table.append(previous + entry[:1])
        previous = entry
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return b"".join(out)


UNPACK = {1: lambda x: x, 5: unpacked_lzw, 8: zlib.decompress, 32946: zlib.decompress, 32773: unpacked_bits}


def pixels(data: bytes, order: str, tags: dict[int, tuple], width: int, height: int) -> np.ndarray:
    """The values of a strip or tile. What is not known is an error, never other values."""
    kind, predictor, bits = tags.get(COMPRESSION, (1,))[0], tags.get(PREDICTOR, (1,))[0], tags[BITS][0]
    if kind not in UNPACK:
        raise ValueError(f"compression {kind} is not supported")
    if bits not in (8, 16, 32, 64) or len(set(tags[BITS])) > 1 or len(tags[BITS]) > 1:
        raise ValueError(f"samples of {tags[BITS]} bits are not supported")
    data, letter = UNPACK[kind](data), {1: "u", 2: "i", 3: "f"}[tags.get(SAMPLE, (1,))[0]]
    if predictor == 3 and letter == "f":
        # bytes of a row are differences, and stand by significance: all highest ones first
        planes = np.cumsum(np.frombuffer(data, dtype=np.uint8, count=width * height * bits // 8).reshape(height, -1), axis=1, dtype=np.uint8)
        return np.ascontiguousarray(planes.reshape(height, bits // 8, width).transpose(0, 2, 1)).view(f">f{bits // 8}").reshape(height, width)
    out = np.frombuffer(data, dtype=f"{order}{letter}{bits // 8}", count=width * height).reshape(height, width)
    if predictor == 1:
        return out
    if predictor == 2 and letter != "f":
        return np.cumsum(out, axis=1, dtype=out.dtype)
    raise ValueError(f"predictor {predictor} is not supported for samples of kind {letter}")


SCHEMA = "tile string, x int, y int, lng double, lat double, value double"


def strips_of(f: BinaryIO, name: str, first: int = 0, last: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of the pixels of strips or tiles first to last of an open file; a pixel without data has a null value."""
    order, tags = header(f)
    w, h = tags[WIDTH][0], tags[HEIGHT][0]
    sx, sy = tags.get(SCALE, (1.0, 1.0, 0.0))[:2]
    i0, j0, _, x0, y0, _ = tags.get(TIE, (0.0,) * 6)
    none = float(tags[NO_DATA][0]) if NO_DATA in tags else None
    for offset, size, bx, by, bw, bh in blocks(tags)[first:last]:
        f.seek(offset)
        grid = pixels(f.read(size), order, tags, bw, bh)[: h - by, : w - bx]
        y, x = np.mgrid[by : by + grid.shape[0], bx : bx + grid.shape[1]].astype(np.int32)
        value = grid.ravel().astype(np.float64)
        gone = None if none is None else np.isnan(value) if np.isnan(none) else value == none
        columns = [pa.array([name] * grid.size), pa.array(x.ravel()), pa.array(y.ravel()), pa.array(x0 + (x.ravel() + 0.5 - i0) * sx), pa.array(y0 - (y.ravel() + 0.5 - j0) * sy), pa.array(value, mask=gone)]
        yield pa.RecordBatch.from_arrays(columns, ["tile", "x", "y", "lng", "lat", "value"])


@dataclass
class Part(InputPartition):
    path: str
    first: int
    last: int


class TiffReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.paths, self.per_part = options["path"], int(options.get("blocks", 64))

    def partitions(self) -> list[Part]:
        root = Path(self.paths.removeprefix("file://"))
        out = []
        for p in sorted(root.glob("*.tif")) if root.is_dir() else [root]:
            with p.open("rb") as f:
                n = len(blocks(header(f)[1]))
            out += [Part(str(p), i, min(n, i + self.per_part)) for i in range(0, n, self.per_part)]
        return out or [Part("", 0, 0)]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with open(partition.path, "rb") as f:
            yield from strips_of(f, os.path.basename(partition.path), partition.first, partition.last)


class GeoTiff(DataSource):
    @classmethod
    def name(cls) -> str:
        return "geotiff"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TiffReader:
        return TiffReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GeoTiff)


def write_tiff(path: str, grid: np.ndarray, x0: float = 0.0, y0: float = 0.0, step: float = 1.0, deflate: bool = True, rows: int = 16) -> None:
    """One tile of a bounded size, in strips."""
    parts = [grid[i : i + rows].astype(grid.dtype.newbyteorder("<")).tobytes() for i in range(0, len(grid), rows)]
    parts = [zlib.compress(p) for p in parts] if deflate else parts
    offsets, at = [], 8
    for p in parts:
        offsets.append(at)
        at += len(p)
    kind = {"u": 1, "i": 2, "f": 3}[grid.dtype.kind]
    fields = [(WIDTH, "I", [grid.shape[1]]), (HEIGHT, "I", [grid.shape[0]]), (BITS, "H", [grid.dtype.itemsize * 8]), (COMPRESSION, "H", [8 if deflate else 1]), (STRIP_AT, "I", offsets), (PER_STRIP, "I", [rows]), (STRIP_BYTES, "I", [len(p) for p in parts]), (SAMPLE, "H", [kind]), (SCALE, "d", [step, step, 0.0]), (TIE, "d", [0.0, 0.0, 0.0, x0, y0, 0.0])]
    codes, table, extra = {v: k for k, v in TYPES.items()}, b"", b""
    after = at + 2 + 12 * len(fields) + 4
    for tag, code, values in fields:
        data = struct.pack(f"<{len(values)}{code}", *values)
        if len(data) > 4:
            place, extra = struct.pack("<I", after + len(extra)), extra + data
        else:
            place = data.ljust(4, b"\0")
        table += struct.pack("<HHI", tag, codes[code], len(values)) + place
    Path(path).write_bytes(b"II" + struct.pack("<HI", 42, at) + b"".join(parts) + struct.pack("<H", len(fields)) + table + b"\0\0\0\0" + extra)
