"""Token ids in ORC files: integer run-length encoding, row indexes, and Bloom filters on document ids."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import text_of
from .tokenization import encoder, groups_of


def _encoded(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    block, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        row_ids, texts = batch.column(0), batch.column(1)
        for lo, hi in groups_of(texts):
            offsets, ids = encoder(path).encode(texts.slice(lo, hi - lo), end_id)
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.view(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(hi - lo, block, dtype=np.int32)), row_ids.slice(lo, hi - lo), pa.array(at + offsets[:-1]), pa.array(np.diff(offsets)), lists], ["block", "id", "start_in_block", "n_tokens", "ids"])
            at += len(ids)


def write_tokens(docs: DataFrame, path: str, *, vocabulary: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", stripe_mb: int = 64, index_rows: int = 1000) -> None:
    """Writes a row a document to ORC files in ascending id order: block, id, start_in_block, n_tokens, ids.

    Ids go through a list column of 32-bit integers, which ORC packs by run-length encoding; an index entry is kept for each
    index_rows rows, and each stripe has a Bloom filter on id. A block is the run of documents in one file.

    Scale: one shuffle by ranges of (id, hash of text), so one id with very many rows is split; texts stream through the encoder.
    Memory is bounded by an Arrow batch, and by the encoder's bounded table of words.

    Defined results: a null text is encoded as the empty one, so it has the end id alone; a null id comes first; rows of one id
    stand together, equal rows each with their own ids; an empty table gives files without rows. Ids are whole numbers. Further columns are left out.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    tie = F.xxhash64("text")
    sorted_rows = rows.repartitionByRange(F.col("id").asc_nulls_first(), tie.asc()).sortWithinPartitions(F.col("id").asc_nulls_first(), tie.asc())
    out = sorted_rows.mapInArrow(partial(_encoded, path=vocabulary, end_id=end_id), "block int, id long, start_in_block long, n_tokens long, ids array<int>")
    out.write.option("compression", "lz4").option("orc.stripe.size", stripe_mb << 20).option("orc.row.index.stride", index_rows).option("orc.bloom.filter.columns", "id").option("orc.bloom.filter.fpp", 0.01).orc(path)


def read_tokens(spark: SparkSession, path: str, ids: list[int] | None = None) -> DataFrame:
    """The files' rows. With ids, stripes and row groups without them are skipped by statistics and Bloom filters."""
    df = spark.read.schema("block int, id long, start_in_block long, n_tokens long, ids array<int>").orc(path)
    return df if ids is None else df.filter(F.col("id").isin(ids))


def block_starts(tokens: DataFrame) -> DataFrame:
    """block, and ids in all blocks before it. Reads two columns; a row a file goes through the window."""
    sums = tokens.groupBy("block").agg(F.sum("n_tokens").alias("n"))
    return sums.select("block", (F.sum("n").over(W.orderBy("block").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("block_start"))


def _digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(4)
        raw = memoryview(np.asarray(lists.values)).cast("B")  # little-endian, as ORC's reader gives them on this platform
        cuts = np.asarray(lists.offsets) * 4
        crc = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)), dtype=np.int64, count=len(lists))
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(crc)], ["block", "id", "start_in_block", "n_tokens", "ids_crc32"])


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """From the files: id, start (ids of all documents before it), n_tokens, ids_crc32. The ids themselves never enter a shuffle."""
    tokens = read_tokens(spark, path)
    each = tokens.mapInArrow(_digests, "block int, id long, start_in_block long, n_tokens long, ids_crc32 long")
    return each.join(block_starts(tokens), "block").select("id", (F.col("block_start") + F.col("start_in_block")).alias("start"), "n_tokens", "ids_crc32")
