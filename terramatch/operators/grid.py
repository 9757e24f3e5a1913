"""Grids as relations of (x, y, value): sampling, co-grid joins, mosaics, neighbourhoods, focal means, slope, resampling."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import aligned

#: Kernel radius in rows; lattice steps for small and for large projects, and the area in hectares between them.
FOCAL_RADIUS = 33
FINE_STEP, COARSE_STEP, LARGE_HECTARES = 7, 33, 250_000.0


def lattice_step(hectares: float) -> int:
    return COARSE_STEP if hectares > LARGE_HECTARES else FINE_STEP


def lattice_sample(pixels: DataFrame, step: int, x0: int = 0, y0: int = 0) -> DataFrame:
    """Every step-th column and row, counted from the window's origin."""
    return pixels.filter((F.pmod(F.col("x") - x0, F.lit(step)) == 0) & (F.pmod(F.col("y") - y0, F.lit(step)) == 0))


def crop(pixels: DataFrame, west: int, north: int, east: int, south: int) -> DataFrame:
    """Pixels with west <= x < east and north <= y < south: a range filter that reaches the scan."""
    return pixels.filter((F.col("x") >= west) & (F.col("x") < east) & (F.col("y") >= north) & (F.col("y") < south))


def co_grid(layers: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """x, y and a column a layer, for pixels that all layers have; with strict, layers of other pixels are an error. Equi-joins on one key: layers
    written in buckets of (x, y) don't shuffle."""
    layers = aligned(layers) if strict else layers
    parts = [df.select("x", "y", F.col("value").alias(name)) for name, df in layers.items()]
    return reduce(lambda a, b: a.join(b, ["x", "y"]), parts)


def mosaic(tiles: DataFrame, priority: str = "tile") -> DataFrame:
    """x, y, value, one a pixel: where tiles overlap, the one of least priority wins. A grouped minimum, combined before the shuffle."""
    return tiles.groupBy("x", "y").agg(F.min_by("value", priority).alias("value"))


def raster_sum(rasters: DataFrame) -> DataFrame:
    """Pixelwise sum over all rasters."""
    return rasters.groupBy("x", "y").agg(F.sum("value").alias("value"))


def mask(pixels: DataFrame, inside: DataFrame) -> DataFrame:
    return pixels.join(inside.select("x", "y").distinct(), ["x", "y"], "left_semi")


def without(pixels: DataFrame, outside: DataFrame) -> DataFrame:
    return pixels.join(outside.select("x", "y").distinct(), ["x", "y"], "left_anti")


def united(*sets: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [s.select("x", "y") for s in sets]).distinct()


#: Pixels along a side of the blocks that neighbourhoods are computed in.
BLOCK = 128


def in_blocks(pixels: DataFrame, kernel: Callable[[Block], dict[str, np.ndarray]], out: str, halo: int, halo_x: Column | int | None = None, by: tuple[str, ...] = (), block: int = BLOCK, more: tuple[str, ...] = ()) -> DataFrame:
    """Rows (*by, x, y and the kernel's columns, as in the schema `out`) of the pixels for which the kernel says so.

    A pixel goes to its own block of block x block, and as part of their border to the blocks that lie within the halo: with a halo of 1
    some 3 % more rows move, and with one of 33 about 1.3 times as many on blocks of 256. A block is a bounded array in its task.
    """
    halo_x = F.lit(halo) if halo_x is None else halo_x if isinstance(halo_x, Column) else F.lit(halo_x)
    at = lambda c, h: F.sequence(F.floor((F.col(c) - h) / block), F.floor((F.col(c) + h) / block))
    placed = pixels.withColumn("_hx", halo_x.cast("int")).select(*by, "x", "y", F.col("value").cast("double").alias("value"), *more, F.explode(at("x", F.col("_hx"))).alias("_bx"), F.lit(1).alias("_")).drop("_")
    placed = placed.withColumn("_by", F.explode(at("y", F.lit(halo))))
    keys = [*by, "_bx", "_by"]

    def run(key: tuple, table: pa.Table) -> pa.Table:
        bx, by_ = key[-2].as_py(), key[-1].as_py()
        x, y, value = (np.asarray(table.column(c).combine_chunks()) for c in ("x", "y", "value"))
        b = Block(x.astype(np.int64), y.astype(np.int64), value, bx * block, by_ * block, block, halo, {c: np.asarray(table.column(c).combine_chunks()) for c in more})
        got = kernel(b)
        keep = got.pop("keep", np.ones(b.own.sum(), dtype=bool))
        columns = [pa.array([k.as_py()] * int(keep.sum()), type=k.type) for k in key[:-2]] + [pa.array(b.x[b.own][keep].astype(np.int32)), pa.array(b.y[b.own][keep].astype(np.int32))]
        return pa.Table.from_arrays(columns + [pa.array(v[keep]) for v in got.values()], names=[*by, "x", "y", *got])

    kinds = {f.name: f.dataType.simpleString() for f in pixels.schema}
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in by), "x int, y int", out])
    return placed.groupBy(*keys).applyInArrow(run, schema)


class Block:
    """A block's pixels and those of its border, as arrays: `own` tells which are the block's, `dense` lays values out in the plane."""

    def __init__(self, x: np.ndarray, y: np.ndarray, value: np.ndarray, x0: int, y0: int, size: int, halo: int, more: dict[str, np.ndarray]) -> None:
        self.x, self.y, self.value, self.x0, self.y0, self.size, self.halo, self.more = x, y, value, x0, y0, size, halo, more
        self.own = (x >= x0) & (x < x0 + size) & (y >= y0) & (y < y0 + size)

    def dense(self, values: np.ndarray, halo_x: int | None = None, empty: float = np.nan) -> np.ndarray:
        """size + 2 halo rows by size + 2 halo_x columns; `empty` where there is no pixel. Of several rows of one pixel the last counts."""
        wide = self.halo if halo_x is None else halo_x
        out = np.full((self.size + 2 * self.halo, self.size + 2 * wide), empty, dtype=np.float64)
        i, j = self.y - self.y0 + self.halo, self.x - self.x0 + wide
        ok = (j >= 0) & (j < out.shape[1])
        out[i[ok], j[ok]] = values[ok]
        return out

    def picked(self, plane: np.ndarray) -> np.ndarray:
        """Of a plane of size x size, the values at the block's own pixels, in their order."""
        return plane[self.y[self.own] - self.y0, self.x[self.own] - self.x0]


def shifted(plane: np.ndarray, dx: int, dy: int, halo: int) -> np.ndarray:
    """The inner part of a plane with a border, seen from dx, dy away."""
    n, m = plane.shape[0] - 2 * halo, plane.shape[1] - 2 * halo
    return plane[halo + dy : halo + dy + n, halo + dx : halo + dx + m]


def focal_mean(pixels: DataFrame, radius: int = 1, block: int = BLOCK) -> DataFrame:
    """Mean of the present cells of a square neighbourhood, and their number. A null value is no present cell."""

    def kernel(b: Block) -> dict[str, np.ndarray]:
        plane = b.dense(b.value)
        views = [shifted(plane, dx, dy, radius) for dy in range(-radius, radius + 1) for dx in range(-radius, radius + 1)]
        n = np.sum([~np.isnan(v) for v in views], axis=0)
        total = np.sum([np.nan_to_num(v) for v in views], axis=0)
        return {"mean": b.picked(total / np.maximum(n, 1)), "n": b.picked(n).astype(np.int64), "keep": b.picked(n) > 0}

    return in_blocks(pixels, kernel, "mean double, n long", radius, block=block)


def uniform_3x3(pixels: DataFrame, block: int = BLOCK) -> DataFrame:
    """Pixels whose nine cells are all present and of one class."""

    def kernel(b: Block) -> dict[str, np.ndarray]:
        plane = b.dense(b.value)
        same = np.all([shifted(plane, dx, dy, 1) == shifted(plane, 0, 0, 1) for dy in (-1, 0, 1) for dx in (-1, 0, 1)], axis=0)
        return {"value": b.picked(shifted(plane, 0, 0, 1)), "keep": b.picked(same)}

    found = in_blocks(pixels, kernel, "value double", 1, block=block)
    return found.withColumn("value", F.col("value").cast(pixels.schema["value"].dataType))


def slope_horn(pixels: DataFrame, cell_x: Column | float, cell_y: Column | float, block: int = BLOCK, by: tuple[str, ...] = ()) -> DataFrame:
    """Slope in degrees by Horn's 3x3 gradient, for pixels with all nine cells; for each grid of `by` if given. Cell sizes in metres may depend on the row."""

    def kernel(b: Block) -> dict[str, np.ndarray]:
        plane = b.dense(b.value)
        at = lambda dx, dy: shifted(plane, dx, dy, 1)
        east = at(1, -1) + 2 * at(1, 0) + at(1, 1) - at(-1, -1) - 2 * at(-1, 0) - at(-1, 1)
        south = at(-1, 1) + 2 * at(0, 1) + at(1, 1) - at(-1, -1) - 2 * at(0, -1) - at(1, -1)
        # a missing cell makes both NaN, but for the middle one, which is the pixel itself
        gx, gy = b.picked(east), b.picked(south)
        return {"gx": gx, "gy": gy, "keep": ~np.isnan(gx + gy) & ~np.isnan(b.value[b.own])}

    sized = lambda v: v if isinstance(v, Column) else F.lit(float(v))
    gx, gy = F.col("gx") / (8.0 * sized(cell_x)), F.col("gy") / (8.0 * sized(cell_y))
    return in_blocks(pixels, kernel, "gx double, gy double", 1, block=block, by=by).select(*by, "x", "y", F.degrees(F.atan(F.sqrt(gx * gx + gy * gy))).alias("slope"))


def half_widths(radius: int, ratio: float) -> dict[int, int]:
    """Of an elliptical kernel: dy to the largest |dx| inside."""
    return {dy: math.floor(ratio * math.sqrt(radius**2 - dy**2) + 1e-9) for dy in range(-radius, radius + 1)}


def focal_coverage(pixels: DataFrame, classes: list[int], radius: int = FOCAL_RADIUS, ratio: Column | float = 1.0, block: int = 256, by: tuple[str, ...] = ()) -> DataFrame:
    """x, y and share_<class>: the share of each class among all cells of an elliptical kernel, whether or not the grid has them. `by` names
    columns, as a year, whose values are grids of their own. `ratio`, the number of x pixels to a y pixel, may depend on y.

    By blocks with a border of the kernel's size (see in_blocks), in which running sums along the rows give a kernel's row as a difference of
    two of them: a kernel costs its height and not its area, and a pixel moves once and a half.
    """
    ratio = ratio if isinstance(ratio, Column) else F.lit(float(ratio))
    # the border's width is that of the widest kernel that can reach the pixel: of a row above or below it, where ratio is convex in y
    ends = pixels.withColumn("_y", F.col("y"))
    for name, move in (("_r0", 0), ("_r1", -radius), ("_r2", radius)):
        ends = ends.withColumn("y", F.col("_y") + move).withColumn(name, ratio.cast("double"))
    wide = ends.withColumn("y", F.col("_y")).drop("_y").withColumn("_rx", F.ceil(F.greatest("_r0", "_r1", "_r2") * radius).cast("int") + 1)

    def kernel(b: Block) -> dict[str, np.ndarray]:
        rx = int(b.more["_rx"].max())
        ratios = np.zeros(b.size)
        ratios[b.y[b.own] - b.y0] = b.more["_r0"][b.own]
        dy = np.arange(-radius, radius + 1)
        half = np.floor(ratios[:, None] * np.sqrt(float(radius * radius) - dy * dy) + 1e-9).astype(np.int64)
        cells = (2 * half + 1).sum(axis=1)
        out, columns = {}, np.arange(b.size) + rx
        for c in classes:
            sums = np.zeros((b.size + 2 * radius, b.size + 2 * rx + 1))
            sums[:, 1:] = np.cumsum(b.dense((b.value == c).astype(np.float64), rx, 0.0), axis=1)
            hits = np.zeros((b.size, b.size))
            for i in np.unique(b.y[b.own] - b.y0):
                h = half[i][:, None]
                rows = (i + radius + dy)[:, None]
                hits[i] = (sums[rows, columns + h + 1] - sums[rows, columns - h]).sum(axis=0)
            out[f"share_{c}"] = b.picked(hits / np.maximum(cells, 1)[:, None])
        return out

    return in_blocks(wide, kernel, ", ".join(f"share_{c} double" for c in classes), radius, F.col("_rx"), by, block, ("_r0", "_rx"))


def resample_nearest(pixels: DataFrame, targets: DataFrame, scale_x: float, scale_y: float) -> DataFrame:
    """Each target pixel with the value of the source pixel that its centre falls in: an equi-join on computed indices."""
    at = targets.select("x", "y", F.floor((F.col("x") + 0.5) * scale_x).cast("int").alias("sx"), F.floor((F.col("y") + 0.5) * scale_y).cast("int").alias("sy"))
    return at.join(pixels.select(F.col("x").alias("sx"), F.col("y").alias("sy"), "value"), ["sx", "sy"]).select("x", "y", "value")


def dilate(cells: DataFrame, radius: int) -> DataFrame:
    """Cells within `radius` cells of any of the given ones: a buffer in pixel form. Only distinct cells move."""
    steps = F.sequence(F.lit(-radius), F.lit(radius))
    out = cells.select("x", "y").distinct().select("x", "y", F.explode(steps).alias("dx")).select("*", F.explode(steps).alias("dy"))
    return out.filter(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy") <= radius * radius).select((F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y")).distinct()


def ring(cells: DataFrame, radius: int) -> DataFrame:
    """The leakage zone: the buffer without the cells themselves."""
    return without(dilate(cells, radius), cells)


def strips(pixels: DataFrame, n: int) -> DataFrame:
    """pixels in n ranges of rows."""
    return pixels.repartitionByRange(n, "y", "x")


def chunk_boxes(boxes: DataFrame, most: float) -> DataFrame:
    """Boxes (id, west, south, east, north) cut into squares of at most `most` degrees, clipped to the box."""
    count = lambda a, b: F.greatest(F.ceil(F.round((F.col(b) - F.col(a)) / most, 9)), F.lit(1)).cast("int")
    out = boxes.withColumn("i", F.explode(F.sequence(F.lit(0), count("west", "east") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), count("south", "north") - 1)))
    low = lambda a, k: F.col(a) + F.col(k) * most
    return out.select("id", "i", "j", low("west", "i").alias("west"), low("south", "j").alias("south"), F.least(F.col("east"), low("west", "i") + most).alias("east"), F.least(F.col("north"), low("south", "j") + most).alias("north"))
