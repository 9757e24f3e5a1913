"""Granules as a stream: new files are read as they come, each granule once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.writers import append_new


def granule_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def each_once(stream: DataFrame, key: str, time: str, delay: str = "1 day") -> DataFrame:
    """One row a key; state older than the delay is dropped, so it stays bounded."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def counts_by_window(stream: DataFrame, time: str, size: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.window(time, size)).agg(F.count("*").alias("n"))


def append_granules(stream: DataFrame, table: str, key: str, checkpoint: str) -> StreamingQuery:
    """Appends a batch's new granules to a Parquet table and stops when all files are read. A batch that runs again appends nothing."""
    return stream.writeStream.foreachBatch(lambda batch, _: append_new(batch, table, key)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
