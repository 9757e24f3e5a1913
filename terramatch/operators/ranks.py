"""Positions in a global order without sorting in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import durable


def with_position(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """Adds the row's position, from 0, in the order of unique columns. Ranges are numbered by themselves; their sizes, a row a range,
    are summed in front."""
    parts = durable(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("_range").agg(F.count("*").alias("_n"))
    before = sizes.select("_range", (F.sum("_n").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, 0)) - F.col("_n")).alias("_before"))
    inner = F.row_number().over(W.partitionBy("_range").orderBy(*order)) - 1
    return parts.withColumn("_inner", inner).join(before, "_range").withColumn(name, (F.col("_before") + F.col("_inner")).cast("long")).drop("_range", "_before", "_inner")


def with_running(df: DataFrame, order: list[str], sums: dict[str, str]) -> DataFrame:
    """Adds sums of columns over all rows before a row in the order of unique columns: {new name: column}. Like with_position, range by range."""
    parts = durable(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = parts.groupBy("_range").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    ahead = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    before = totals.select("_range", *[F.coalesce(F.sum(f"_t_{n}").over(ahead), F.lit(0)).alias(f"_b_{n}") for n in sums])
    inner = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    placed = parts.withColumns({f"_i_{n}": F.coalesce(F.sum(c).over(inner), F.lit(0)) for n, c in sums.items()}).join(before, "_range")
    return placed.withColumns({n: F.col(f"_b_{n}") + F.col(f"_i_{n}") for n in sums}).drop("_range", *[f"_{k}_{n}" for n in sums for k in "bi"])
