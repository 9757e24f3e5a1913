"""Importance resampling towards a target corpus (Xie et al., 2023) by inverted postings that are partitioned by bucket."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranks import with_position
from .common import durable, text_of

#: Buckets of features, buckets in a block of postings, consecutive words in a feature at most.
BUCKETS, WIDTH, MOST_WORDS = 10_000, 500, 3
#: A run of documents ends at so many documents or bytes of text; a longer document is a run of its own.
RUN_ROWS, RUN_BYTES = 2048, 4 << 20
#: Bytes of postings of a block that meet their gains in one group; a block with more is dealt to several.
PART_BYTES = 32 << 20
#: A byte of a word in lower case, or a space for one that no word has.
WORD_BYTES = bytes(c if c >= 0x80 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def _byte_step() -> np.ndarray:
    """What a checksum (CRC-32, reflected polynomial 0xEDB88320) becomes by one more zero byte, from its lowest byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


class Checksums:
    """Checksums of joined texts from those of their parts: by zero bytes a checksum changes linearly, so four table lookups append any length."""

    def __init__(self) -> None:
        step, one = _byte_step(), np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
        tables = [one]
        for _ in range(64):
            tables.append((tables[-1] >> 8) ^ step[tables[-1] & 255])
        self.short = np.stack(tables[:64]).ravel()
        self.long = [tables[64].ravel()]  # for 64, 128, 256, ... bytes

    @staticmethod
    def _apply(table: np.ndarray, at: np.ndarray | int, crc: np.ndarray) -> np.ndarray:
        out = table[at + (crc & 255)]
        for j in (1, 2, 3):
            out = out ^ table[at + 256 * j + ((crc >> np.uint32(8 * j)) & 255)]
        return out

    def joined(self, first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Of first and second text together; length: bytes of the second."""
        out, more, k = self._apply(self.short, (length & 63) * 1024, first), length >> 6, 0
        while more.any():
            if k == len(self.long):
                self.long.append(self._apply(self.long[-1], 0, self.long[-1]))
            odd = (more & 1) == 1
            out[odd] = self._apply(self.long[k], 0, out[odd])
            more, k = more >> 1, k + 1
        return out ^ second


def buckets_of(texts: list[bytes], sums: Checksums) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The document and the bucket of each feature of a run of texts, and the words of each text."""
    words = [x.translate(WORD_BYTES).split() for x in texts]
    n = np.array([len(x) for x in words], dtype=np.int64)
    flat = [w for x in words for w in x]
    crc = np.fromiter(map(zlib.crc32, flat), dtype=np.uint32, count=len(flat))
    size = np.fromiter(map(len, flat), dtype=np.int64, count=len(flat))
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), n)
    space, one = np.uint32(zlib.crc32(b" ")), np.ones(1, dtype=np.int64)
    owners, found, run = [owner], [crc], crc
    for k in range(1, MOST_WORDS):
        run = sums.joined(sums.joined(run[:-1], space, one), crc[k:], size[k:])
        inside = owner[k:] == owner[: len(owner) - k]
        owners.append(owner[k:][inside])
        found.append(run[inside])
    return np.concatenate(owners), np.concatenate(found) % np.uint32(BUCKETS), n


def packed(numbers: np.ndarray) -> bytes:
    """Numbers of 32 bits, byte by byte: the higher ones are mostly zero."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


POSTINGS = T.StructType(
    [T.StructField("run", T.LongType()), T.StructField("block", T.IntegerType()), T.StructField("rows", T.IntegerType()), T.StructField("postings", T.BinaryType()), T.StructField("counts", T.ArrayType(T.LongType()))]
    + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("ids", "features", "words")]
)
ARROW = pa.schema([("run", pa.int64()), ("block", pa.int32()), ("rows", pa.int32()), ("postings", pa.binary()), ("counts", pa.list_(pa.int64())), *((c, pa.list_(pa.int64())) for c in ("ids", "features", "words"))])


def _inverted(batches: Iterator[pa.RecordBatch], keep: bool) -> Iterator[pa.RecordBatch]:
    """Of each run of documents a row a block with its postings, (bucket, document) in order and how often, and its buckets' counts; and a row
    of the documents themselves. Without keep the counts alone."""
    sums, task, squeeze, number = Checksums(), TaskContext.get().partitionId() << 32, zstandard.ZstdCompressor(level=1), 0

    def inverted(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        owner, bucket, words = buckets_of(texts, sums)
        keys, times = np.unique(bucket.astype(np.int64) * len(texts) + owner, return_counts=True)
        ends = np.searchsorted(keys, np.arange(0, BUCKETS + 1, WIDTH) * len(texts))
        rows = []
        for block, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
            own = keys[a:b] - block * WIDTH * len(texts)
            counts = np.bincount(own // len(texts), weights=times[a:b], minlength=WIDTH).astype(np.int64)
            postings = squeeze.compress(packed(np.diff(own, prepend=0)) + packed(times[a:b])) if keep else None
            rows.append({"run": task + number, "block": block, "rows": len(texts), "postings": postings, "counts": counts})
        if keep:
            rows.append({"run": task + number, "block": -1, "rows": len(texts), "ids": ids, "features": np.bincount(owner, minlength=len(texts)), "words": words})
        return pa.RecordBatch.from_pylist(rows, schema=ARROW)

    ids, texts, size = [], [], 0
    for batch in batches:
        for i, x in zip(batch.column(0), batch.column(1), strict=True):
            ids.append(i.as_py())
            texts.append(x.as_buffer().to_pybytes())
            size += len(texts[-1])
            if size >= RUN_BYTES or len(texts) == RUN_ROWS:
                yield inverted(ids, texts)
                ids, texts, size, number = [], [], 0, number + 1
    if texts:
        yield inverted(ids, texts)


def gains(s: np.ndarray, t: np.ndarray, all_s: int, all_t: int) -> np.ndarray:
    """Of buckets with s features in the corpus and t in the target."""
    return np.floor(1000 * np.log((t + 1.0) * (all_s + BUCKETS) / ((s + 1.0) * (all_t + BUCKETS)))).astype(np.int64)


def _contributed(batches: Iterator[pa.RecordBatch], all_s: int, all_t: int) -> Iterator[pa.RecordBatch]:
    """run and, for each of its documents, what the buckets of a block add to its weight."""
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        for run, rows, postings, both in zip(*(batch.column(c) for c in ("run", "rows", "postings", "both")), strict=True):
            n = rows.as_py()
            gain = gains(*(np.asarray(both.values.field(c)) for c in ("s", "t")), all_s, all_t)
            data = expand.decompress(postings.as_py())
            keys, times = np.cumsum(unpacked(data[: len(data) // 2])), unpacked(data[len(data) // 2 :])
            # whole numbers far below 2 ** 53, so sums of doubles are exact
            sums = np.bincount(keys % n, weights=gain[keys // n] * times, minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([run.as_py()], type=pa.int64()), pa.array([sums], type=pa.list_(pa.int64()))], ["run", "sums"])


def importance_weights(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: run and place (its own in this frame), id, n_features, words, weight: the sum of its features' gains. A feature is a run of 1 to 3
    words; a bucket's gain is floor(1000 ln) of its smoothed share of the target's features over that of all documents'.

    Documents are inverted where they lie: of some thousand of them a row for each block of 500 buckets with their postings, compressed. These rows
    shuffle by block and meet the block's counts of both corpora, from which the gains are computed there; a block with much to do is
    dealt to several groups, so a frequent bucket, which all documents have, is no task of its own. What a group adds to each document
    is summed by document.

    Defined results: a null or empty text has no features and weight 0; an empty target has none in any bucket; a null id stays null; each row is
    weighed by itself; an empty table gives an empty one. Ids are whole numbers. Further columns are left out.
    """
    bytes_of = lambda df: text_of(text_col).cast("binary").alias("text")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), bytes_of(docs))
    inverted = durable(rows.mapInArrow(partial(_inverted, keep=True), POSTINGS), "postings")
    aimed = target.select(F.lit(None).cast("long").alias("id"), bytes_of(target)).mapInArrow(partial(_inverted, keep=False), POSTINGS)
    zero, count = F.lit(0).cast("long"), F.posexplode("counts").alias("place", "n")
    both = inverted.filter("block >= 0").select("block", count).select("block", "place", F.col("n").alias("s"), zero.alias("t"))
    both = both.unionByName(aimed.select("block", count).select("block", "place", zero.alias("s"), F.col("n").alias("t")))
    # a row a bucket
    both = durable(both.groupBy("block", "place").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "bucket-counts", 1)
    all_s, all_t = both.agg(F.coalesce(F.sum("s"), zero), F.coalesce(F.sum("t"), zero)).first()
    most = inverted.groupBy("block").agg(F.sum(F.octet_length("postings")).alias("n")).agg(F.max("n")).first()[0] or 0
    parts = 1 + most // PART_BYTES
    blocks = both.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("place", "s", "t"))).alias("both")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = inverted.filter("block >= 0").select("run", "block", "rows", "postings", F.pmod(F.xxhash64("run"), F.lit(parts)).cast("int").alias("part"))
    met = dealt.join(blocks.hint("shuffle_hash"), ["block", "part"]).select("run", "rows", "postings", "both")
    added = met.mapInArrow(partial(_contributed, all_s=all_s, all_t=all_t), "run long, sums array<long>").select("run", F.posexplode("sums").alias("place", "weight"))
    own = inverted.filter("block = -1").select("run", F.posexplode(F.arrays_zip("ids", "features", "words")).alias("place", "d"))
    none = F.lit(None).cast("long")
    added = added.select("run", "place", none.alias("id"), none.alias("n_features"), none.alias("words"), "weight")
    own = own.select("run", "place", F.col("d.ids").alias("id"), F.col("d.features").alias("n_features"), F.col("d.words").alias("words"), zero.alias("weight"))
    return own.unionByName(added).groupBy("run", "place").agg(*[F.max(c).alias(c) for c in ("id", "n_features", "words")], F.sum("weight").alias("weight"))


def resample(docs: DataFrame, target: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """A row a document: id_col, n_features, weight, score, rank. The score is the weight plus Gumbel noise in thousandths, from a hash of seed and id; of the N
    documents of at least least_words words the floor(percent * N / 100) highest scores are drawn and ranked from 1, which is sampling
    without replacement in proportion to exp(weight / 1000). Equal scores go to the smaller id, null first; the others' rank is null.

    Scale: as importance_weights(); ranks are numbered range by range.

    Defined results: as for importance_weights(); a null id is hashed as an empty one; rows with one id and text have one score and ranks of their own.
    """
    weighed = importance_weights(docs, target, id_col=id_col, text_col=text_col)
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = durable(weighed.withColumn("score", F.col("weight") + noise).withColumns({"_late": F.col("words") < least_words, "_down": -F.col("score")}), "scores")
    drawn = scored.filter(~F.col("_late")).count() * percent // 100
    placed = with_position(scored, ["_late", "_down", "id", "run", "place"], "_pos")
    return placed.select(F.col("id").alias(id_col), "n_features", "weight", "score", F.when(F.col("_pos") < drawn, F.col("_pos") + 1).alias("rank"))
