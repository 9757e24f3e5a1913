"""Filters that must find something, and checks of tables against each other."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def found(df: DataFrame, message: str) -> DataFrame:
    """df; an empty one is an error, known from its first row."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def nothing(df: DataFrame, message: str) -> None:
    """An error, with the first row, unless df is empty."""
    row = df.first()
    if row is not None:
        raise ValueError(f"{message}: {', '.join(map(str, row))}")


def listed(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose attribute is one of values, as a filter that reaches the scan; none is an error."""
    return found(df.filter(F.col(column).isin(values)), f"no row has a listed {column}")


def unlike(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose attribute differs from value; a null does."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def matched(pixels: DataFrame, flag: str = "value") -> DataFrame:
    """Pixels that a raster of matches marks: the flag is over 0."""
    return pixels.filter(F.col(flag) > 0)


def columns_beyond(df: DataFrame, others: list[str]) -> list[str]:
    """df's columns that others lack, in df's order."""
    return [c for c in df.columns if c not in set(others)]


def extent(pixels: DataFrame) -> DataFrame:
    """One row: west, east, north, south, the least and largest indices, and the number of pixels."""
    return pixels.agg(F.min("x").alias("west"), F.max("x").alias("east"), F.min("y").alias("north"), F.max("y").alias("south"), F.count("*").alias("n"))


def summary(df: DataFrame, column: str, shares: tuple[float, ...] = (0.25, 0.5, 0.75), by: tuple[str, ...] = ()) -> DataFrame:
    """least, most and exact quantiles q_<percent> of a column, of each group if given."""
    quantiles = [F.percentile(column, F.lit(float(q))).alias(f"q_{round(100 * q)}") for q in shares]
    return df.groupBy(*by).agg(F.min(column).alias("least"), F.max(column).alias("most"), *quantiles)


def aligned(layers: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """layers, if all of them have the same pixels; else an error that names one that differs. A number of pixels and two sums of their hashes a
    layer are compared: one pass over two columns each, and no join."""
    mark: Column = F.xxhash64("x", "y")
    one = lambda name, df: df.agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.bit_xor(mark).alias("a"), F.sum(F.shiftright(mark, 24)).alias("b"))
    rows = reduce(lambda a, b: a.unionByName(b), [one(k, v) for k, v in layers.items()]).collect()
    for r in rows[1:]:
        if r[1:] != rows[0][1:]:
            raise ValueError(f"layer {r.name} has other pixels than {rows[0].name}")
    return layers
