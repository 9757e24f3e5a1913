"""Rasters in other projections: for each target cell the place in the source that it stands for, and a sample there, block by block."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geodesy import metres_per_degree, utm_forward, utm_inverse, utm_zone
from ..session import durable
from .grid import BLOCK, slope_horn

#: Degrees around a zone that are projected with it and cropped afterwards.
EXPANSION = 0.05


def sampled(pixels: DataFrame, targets: DataFrame, by: tuple[str, ...] = (), how: str = "bilinear", block: int = BLOCK) -> DataFrame:
    """*by, x, y, value: targets (*by, x, y, and fx, fy, their place in the source, where whole numbers are centres of its pixels) with the source's value
    there: of the four pixels around, weighted, or of the nearest one. A target that lacks a pixel it needs, or whose pixel is null, is left out.

    Targets go to the source's block that their place is in; pixels go to their block and, from a block's first column and row, to the one before. A
    block is a bounded array in its task, and each pixel moves once, but for some in a hundred."""
    if how not in ("bilinear", "nearest"):
        raise ValueError(f"{how} is neither bilinear nor nearest")
    at = lambda c: F.floor(F.col(c) / block)
    to = lambda c: F.explode(F.sequence(F.floor((F.col(c) - 1) / block), at(c)))
    source = pixels.select(*by, "x", "y", F.col("value").cast("double").alias("value")).withColumn("_bx", to("x")).withColumn("_by", to("y"))
    wanted = targets.select(*by, F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), "fx", "fy", F.floor(F.floor("fx") / block).alias("_bx"), F.floor(F.floor("fy") / block).alias("_by"))
    keys = [*by, "_bx", "_by"]

    def run(key: tuple, have: pa.Table, want: pa.Table) -> pa.Table:
        x0, y0 = key[-2].as_py() * block, key[-1].as_py() * block
        column = lambda t, c: np.asarray(t.column(c).combine_chunks())
        plane = np.full((block + 1, block + 1), np.nan)
        plane[column(have, "y") - y0, column(have, "x") - x0] = column(have, "value")
        fx, fy = column(want, "fx") - x0, column(want, "fy") - y0
        j, i = np.floor(fx).astype(np.int64), np.floor(fy).astype(np.int64)
        u, v = fx - j, fy - i
        if how == "nearest":
            value = plane[i + (v >= 0.5), j + (u >= 0.5)]
        else:
            # a pixel without weight may be missing
            part = lambda w, z: np.where(w == 0, 0.0, w * z)
            value = part((1 - u) * (1 - v), plane[i, j]) + part(u * (1 - v), plane[i, j + 1]) + part((1 - u) * v, plane[i + 1, j]) + part(u * v, plane[i + 1, j + 1])
        keep = ~np.isnan(value)
        columns = [pa.array([k.as_py()] * int(keep.sum()), type=k.type) for k in key[:-2]]
        return pa.Table.from_arrays([*columns, pa.array(column(want, "x")[keep]), pa.array(column(want, "y")[keep]), pa.array(value[keep])], names=[*by, "x", "y", "value"])

    kinds = {f.name: f.dataType.simpleString() for f in pixels.schema}
    schema = ", ".join([*(f"{c} {kinds[c]}" for c in by), "x int, y int, value double"])
    return source.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(run, schema)


def utm_targets(pixels: DataFrame, origin: tuple[float, float], step: tuple[float, float], metres: float, block: int = BLOCK) -> DataFrame:
    """zone, x, y, fx, fy: for a raster in degrees (zone, x, y) the cells of a grid of so many metres in its zone, eastwards and southwards, with their place
    in the raster. Blocks of the raster are projected by their outline, and a cell is kept by the block that its centre is in."""
    blocks = pixels.select("zone", F.floor(F.col("x") / block).alias("_bx"), F.floor(F.col("y") / block).alias("_by")).distinct()
    corner = lambda c, k, axis: origin[axis] + (F.col(c) + k) * (block * step[axis])
    places = [utm_forward(corner("_by", b, 1), corner("_bx", a, 0), F.col("zone"), F.lit(False)) for a in (0.0, 0.5, 1.0) for b in (0.0, 0.5, 1.0)]
    span = lambda values: F.explode(F.sequence((F.floor(F.least(*values) / metres) - 2).cast("int"), (F.floor(F.greatest(*values) / metres) + 2).cast("int")))
    cells = blocks.withColumn("x", span([e for e, _ in places])).withColumn("y", span([-n for _, n in places]))
    lat, lng = utm_inverse((F.col("x") + 0.5) * metres, -(F.col("y") + 0.5) * metres, F.col("zone"), F.lit(False))
    placed = cells.withColumns({"fx": (lng - origin[0]) / step[0] - 0.5, "fy": (lat - origin[1]) / step[1] - 0.5})
    own = (F.floor(F.floor("fx") / block) == F.col("_bx")) & (F.floor(F.floor("fy") / block) == F.col("_by"))
    return placed.filter(own).select("zone", "x", "y", "fx", "fy")


def in_utm(pixels: DataFrame, origin: tuple[float, float], step: tuple[float, float], metres: float, how: str = "bilinear", block: int = BLOCK) -> DataFrame:
    """zone, x, y, value: a raster in degrees (zone, x, y, value), warped to grids of so many metres in its zones."""
    return sampled(pixels, utm_targets(pixels, origin, step, metres, block), ("zone",), how, block)


def in_degrees(grids: DataFrame, pixels: DataFrame, origin: tuple[float, float], step: tuple[float, float], metres: float, how: str = "bilinear", block: int = BLOCK) -> DataFrame:
    """x, y, value: pixels of a raster in degrees (zone, x, y) from grids in their zones, the way back of in_utm()."""
    east, north = utm_forward(origin[1] + (F.col("y") + 0.5) * step[1], origin[0] + (F.col("x") + 0.5) * step[0], F.col("zone"), F.lit(False))
    targets = pixels.select("zone", "x", "y", (east / metres - 0.5).alias("fx"), (-north / metres - 0.5).alias("fy"))
    return sampled(grids, targets, ("zone",), how, block).drop("zone")


def zones(pixels: DataFrame, lng: Column, expansion: float = 0.0) -> DataFrame:
    """pixels with their zone; with an expansion, once for each zone that they are in or as near to."""
    around = F.array_distinct(F.array(utm_zone(lng - expansion), utm_zone(lng), utm_zone(lng + expansion)))
    return pixels.withColumn("zone", F.explode(around) if expansion else utm_zone(lng))


def projected_slope(elevation: DataFrame, origin: tuple[float, float], step: tuple[float, float], metres: float | None = None, expansion: float = EXPANSION, block: int = BLOCK) -> DataFrame:
    """x, y, value: slope in degrees of elevations in metres (x, y, value) on a raster in degrees. Each zone, with what lies `expansion` degrees around it, is
    warped to its own projection, where cells are squares of so many metres, by default as high as a pixel; slopes are computed there, warped
    back, and cropped to the zone's own pixels, which makes one raster of all zones.

    A zone is one projection over all its latitude bands, northings running on below the equator, so there is nothing to merge between bands."""
    # pixels that are written once are read four times
    pixels = durable(elevation.select("x", "y", "value"), "elevation")
    lng = origin[0] + (F.col("x") + 0.5) * step[0]
    if metres is None:
        middle = pixels.agg(F.avg(origin[1] + (F.col("y") + 0.5) * step[1]).alias("lat")).select(metres_per_degree(F.col("lat"))[1]).first()[0]
        metres = abs(step[1]) * (middle or 1.0)
    grids = durable(in_utm(zones(pixels, lng, expansion), origin, step, metres, block=block), "utm")
    slopes = slope_horn(grids, metres, metres, block=block, by=("zone",)).withColumnRenamed("slope", "value")
    return in_degrees(slopes, zones(pixels, lng), origin, step, metres, block=block)
