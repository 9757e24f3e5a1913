"""Downloads as tables: a row a target, fetched in tasks by a function that the caller gives, each target once, with rules for what is missing or broken."""

from __future__ import annotations

import io
import time
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pieces import MOST_POINTS, chunks, simplified
from .writers import exists, missing_targets

#: Countries left out of the polygons, countries a request, tries, and the first time-out in seconds, which doubles.
LEFT_OUT, BATCH, TRIES, FIRST_TIMEOUT = ("RU", "NO", "SE", "FI", "CA"), 20, 3, 100.0
CONTENTS = "name string, url string, status string, content binary"


class FetchError(RuntimeError):
    """An answer that is neither a file nor "not there"."""


def one_member(content: bytes, suffix: str) -> bytes:
    """The archive's only file with the suffix; none or several are an error."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = [n for n in z.namelist() if n.lower().endswith(suffix)]
        if len(names) != 1:
            raise FetchError(f"{len(names)} files end in {suffix}, not one")
        return z.read(names[0])


def patiently(ask: Callable[[float], tuple[int, bytes]], tries: int = TRIES, timeout: float = FIRST_TIMEOUT, pause: float = 0.0) -> tuple[int, bytes]:
    """ask(timeout), again with twice the time where it takes too long; the last failure is raised."""
    for i in range(tries):
        try:
            return ask(timeout * 2**i)
        except TimeoutError:
            if i == tries - 1:
                raise
            time.sleep(pause)
    raise ValueError("no tries")


def outcome(status: int, content: bytes, archive: bool) -> tuple[str, bytes | None]:
    """("ok", content), ("absent", None) for 404, ("bad_archive", None) for an archive that can't be read; any other answer is an error."""
    if status == 404:
        return "absent", None
    if status != 200:
        raise FetchError(f"answer {status}")
    if archive and not zipfile.is_zipfile(io.BytesIO(content)):
        return "bad_archive", None
    return "ok", content


def contents(targets: DataFrame, fetch: Callable[[str, float], tuple[int, bytes]], archive: bool = False, tries: int = TRIES, timeout: float = FIRST_TIMEOUT) -> DataFrame:
    """name, url, status, content of targets (name, url). fetch(url, timeout) gives a status and a body; a task holds one body at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, url in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                status, content = outcome(*patiently(lambda t, url=url: fetch(url, t), tries, timeout), archive)
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([url]), pa.array([status]), pa.array([content], type=pa.binary())], ["name", "url", "status", "content"])

    return targets.select("name", "url").mapInArrow(run, CONTENTS)


def download(targets: DataFrame, fetch: Callable[[str, float], tuple[int, bytes]], path: str, archive: bool = False, parts: int = 16, **options: float) -> DataFrame:
    """Appends what is not there yet to the Parquet table of contents at path, and gives the table. What was absent or broken has its row without
    content and isn't asked for again; an error leaves the table as it was, since Spark publishes a write as a whole."""
    spark = targets.sparkSession
    wanted = targets.dropDuplicates(["name"])
    if exists(spark, path):
        wanted = missing_targets(wanted, spark.read.schema(CONTENTS).parquet(path))
    contents(wanted.repartition(parts), fetch, archive, **options).write.mode("append").parquet(path)
    return spark.read.schema(CONTENTS).parquet(path)


def in_batches(codes: DataFrame, url: Callable[[list[str]], str], size: int = BATCH, left_out: tuple[str, ...] = LEFT_OUT, code: str = "code") -> DataFrame:
    """name, url: one request for each `size` codes in order, without those left out. A row a code goes through the window."""
    from pyspark.sql import Window as W

    make = F.udf(url, "string")  # a row a request
    placed = codes.select(code).distinct().filter(~F.col(code).isin(*left_out)).withColumn("_batch", F.floor((F.row_number().over(W.orderBy(code)) - 1) / size))
    grouped = placed.groupBy("_batch").agg(F.array_sort(F.collect_list(code)).alias("_codes"))
    return grouped.select(F.array_join("_codes", "-").alias("name"), make("_codes").alias("url"))


def catalogue(polygons: DataFrame, search: Callable[[list[tuple[float, float]], str, str], list[str]], most: float, start: str = "2020-01-01", end: str = "2021-01-01", points: int = MOST_POINTS) -> DataFrame:
    """granule: distinct names that search(outline, start, end) gives for any of the polygons' chunks. Polygons are clipped to squares of `most` degrees, those
    without area left out, and a catalogue is asked with outlines of so many points at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ring in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(search([(p["x"], p["y"]) for p in ring], start, end), type=pa.string())], ["granule"])

    return simplified(chunks(polygons, most), points).select("ring").mapInArrow(run, "granule string").distinct()


def stored(spark: SparkSession, path: str) -> DataFrame:
    """What a table of contents has: rows with content."""
    return spark.read.schema(CONTENTS).parquet(path).filter("status = 'ok'")
