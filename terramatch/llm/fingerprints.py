"""I-Match fingerprints: distinct terms of a document within a band of inverse document frequency, hashed for several randomised subsets of the lexicon (Chowdhury et al., 2002; Kołcz et al., 2004)."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import WorkerTable, durable, text_of

#: A term is in the band if from LEAST_SHARE to MOST_SHARE of all documents have it.
LEAST_SHARE, MOST_SHARE = 0.0005, 0.25
#: A term is 62 bits of a hash: 14 of them name its bucket, 48 stand in the bucket's list.
KEPT_BITS, BUCKETS = 2**64 - 4, 1 << 14
#: Term hashes that a task gathers before it makes them distinct.
GATHERED = 4_000_000
#: Subsets of the lexicon: at level j each holds a 2**-j part of it, and there are min(2**j, WIDTH) disjoint ones.
LEVELS, WIDTH = 13, 16
WIDTHS = [min(1 << j, WIDTH) for j in range(LEVELS)]
#: A level tells texts apart by degrees only where its subsets hold few terms of a text: where some of them hold none.
MOST_USED = 0.9
#: Blocks of consecutive documents; the heads of all blocks go to the driver, so their number is bounded.
BLOCK_ROWS, MOST_BLOCKS = 500, 200_000
MOST_WORDS = 250_000


class TermHashes(dict):
    def __missing__(self, word: str) -> int:
        found = xxh3_64_intdigest(word) & KEPT_BITS
        if len(word) <= 64:  # longer ones are not kept
            self[word] = found
        return found


_terms = WorkerTable(TermHashes)


def terms(text: str) -> np.ndarray:
    """Distinct 64-bit hashes of a text's words in lower case."""
    known = _terms.get()
    if len(known) > MOST_WORDS:
        known.clear()
    words = set(text.lower().split())
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of (terms, numbers), sorted, with the sums of their numbers."""
    found, where = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
    total = np.zeros(len(found), dtype=np.int64)
    np.add.at(total, where, np.concatenate([n for _, n in parts]))
    return found, total


def _packed(found: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row a bucket that has terms: six bytes a term, four bytes a number."""
    bucket = (found >> np.uint64(50)).astype(np.int32)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=BUCKETS))
    low = np.ascontiguousarray((found >> np.uint64(2) & np.uint64(2**48 - 1)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])
    lists = [pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer((cuts * width).astype(np.int32)), pa.py_buffer(data)]) for width, data in ((6, low), (4, n.astype("<u4")))]
    return pa.RecordBatch.from_arrays([pa.array(bucket[cuts[:-1]]), *lists], ["bucket", "terms", "n"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms and the numbers of a task's documents that have them, packed by bucket: a task sends a third of the bytes of single rows."""
    seen, held, size = (np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)), [], 0
    for batch in batches:
        for x in batch.column(0):
            held.append(terms(x.as_py()))
            size += len(held[-1])
            if size > GATHERED:
                seen, held, size = _added([seen, np.unique(np.concatenate(held), return_counts=True)]), [], 0
                if len(seen[0]) > GATHERED:
                    yield _packed(*seen)
                    seen = seen[0][:0], seen[1][:0]
    if held:
        seen = _added([seen, np.unique(np.concatenate(held), return_counts=True)])
    if len(seen[0]):
        yield _packed(*seen)


def _within(batches: Iterator[pa.RecordBatch], low: int, high: int) -> Iterator[pa.RecordBatch]:
    """Terms whose sums are from low to high. Rows come sorted by bucket; lists of one bucket are added up as they come, so memory is
    that of its distinct terms."""
    now, parts, size = None, [], 0

    def out() -> pa.RecordBatch:
        found, n = _added(parts)
        inside = (n >= low) & (n <= high)
        return pa.RecordBatch.from_arrays([pa.array(found[inside].view(np.int64))], ["term"])

    for batch in batches:
        for bucket, x, n in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            if bucket != now:
                if parts:
                    yield out()
                now, parts, size = bucket, [], 0
            raw = np.zeros((len(x.as_buffer()) // 6, 8), dtype=np.uint8)
            raw[:, :6] = np.frombuffer(x.as_buffer(), dtype=np.uint8).reshape(-1, 6)
            parts.append(((raw.view("<u8").ravel() | np.uint64(bucket) << np.uint64(48)) << np.uint64(2), np.frombuffer(n.as_buffer(), dtype="<u4").astype(np.int64)))
            size += len(raw)
            if size > GATHERED:
                parts = [_added(parts)]
                size = 0
    if parts:
        yield out()


def idf_band(docs: DataFrame, text_col: str = "text", least_share: float = LEAST_SHARE, most_share: float = MOST_SHARE) -> np.ndarray:
    """Sorted hashes of the terms whose inverse document frequency is in the band. Counts cover all terms of all documents.

    A document with k distinct terms adds k to the counts, and each term of the band takes least_share of all documents, so the
    band has at most mean(k) / least_share terms for a corpus of any size: some 500,000 numbers for documents of 250 distinct words.
    They come to the driver as Arrow batches and go out to the tasks.
    """
    rows = docs.count()
    low, high = max(1, math.ceil(least_share * rows)), max(1, math.floor(most_share * rows))
    counted = docs.select(text_of(text_col).alias("text")).mapInArrow(_counted, "bucket int, terms binary, n binary")
    inside = counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(partial(_within, low=low, high=high), "term long").toArrow()
    return np.sort(inside.column("term").to_numpy().astype(np.int64).view(np.uint64))


def in_band(hashes: np.ndarray, band: np.ndarray) -> np.ndarray:
    if not len(band):
        return np.zeros(len(hashes), dtype=bool)
    return band[np.minimum(np.searchsorted(band, hashes), len(band) - 1)] == hashes


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def fingerprints(texts: list[str], band: np.ndarray) -> np.ndarray:
    """A row a text, a hash of 16 bits a subset; 0 stands for a subset without any of the text's terms.

    A text with no term in the band is fingerprinted by all its terms.
    """
    found = [terms(x) for x in texts]
    owner, flat = np.repeat(np.arange(len(texts)), [len(x) for x in found]), np.concatenate(found) if found else np.empty(0, dtype=np.uint64)
    kept = in_band(flat, band)
    kept |= (np.bincount(owner[kept], minlength=len(texts)) == 0)[owner]
    owner, flat = owner[kept], flat[kept]
    out, at = np.zeros((len(texts), sum(WIDTHS)), dtype=np.uint16), 0
    value = _mixed(flat)
    for level, width in enumerate(WIDTHS):
        part = (_mixed(flat ^ np.uint64(0x5851F42D4C957F2D * (level + 1) % 2**64)) & np.uint64((1 << level) - 1)).astype(np.int64)
        inside = part < width
        slot = owner[inside] * width + part[inside]
        # terms are distinct, so the sum of their scrambled hashes stands for the sorted sequence of them
        total = np.zeros(len(texts) * width, dtype=np.uint64)
        np.add.at(total, slot, value[inside])
        count = np.bincount(slot, minlength=len(total))
        h = (_mixed(total + np.uint64(level + 1)) >> np.uint64(48)).astype(np.uint16)
        out[:, at : at + width] = np.where(count > 0, np.maximum(h, 1), 0).reshape(len(texts), width)
        at += width
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal hashes among the subsets that either text has terms in, at the levels where at most MOST_USED of the subsets
    are such; at the last level if there is no such level. 1 for two texts without terms."""
    used, same = (a > 0) | (b > 0), (a == b) & (a > 0)
    n, hits, at = np.zeros(len(a)), np.zeros(len(a)), 0
    for level, width in enumerate(WIDTHS):
        u, s = used[:, at : at + width].sum(axis=1), same[:, at : at + width].sum(axis=1)
        counts = (u <= MOST_USED * width) | ((level == LEVELS - 1) & (n == 0))
        n, hits, at = n + u * counts, hits + s * counts, at + width
    return np.where(n > 0, hits / np.maximum(n, 1), (a == b).all(axis=1))


def as_text(prints: np.ndarray) -> list[str]:
    """Four hexadecimal digits a subset."""
    return [row.tobytes().hex() for row in prints.astype(">u2")]


def _printed(batches: Iterator[pa.RecordBatch], band: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = fingerprints([x.as_py() for x in batch.column(1)], band)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(as_text(prints))], ["id", "fingerprint"])


def fingerprint_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint, a row a document, without a shuffle of texts.

    Defined results: a null text is the empty one, whose fingerprint is all zeros; equal texts have equal fingerprints; a null id
    stays null; an empty table gives an empty one. Ids are whole numbers. Further columns are left out.
    """
    band = idf_band(docs, text_col)
    return docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).mapInArrow(partial(_printed, band=band), "id long, fingerprint string")


EDITED = "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _with_next(batches: Iterator[pa.RecordBatch], band: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows (block, id, text, is a guest) come sorted; a block ends with its guest, the first document of the next block."""

    def out(ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
        edited = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, texts[1:], strict=False)]
        prints, changed = fingerprints(texts, band), fingerprints(edited, band)
        mine = prints[:-1]
        columns = [pa.array(ids, type=pa.int64()), pa.array([len(x) for x in texts[:-1]], type=pa.int64()), pa.array([sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in edited]), pa.array(as_text(mine)), pa.array(as_text(changed)), pa.array(likeness(mine, changed)), pa.array(likeness(mine, prints[1:]))]
        return pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in EDITED.split(", ")])

    ids, texts, chars, closed = [], [], 0, None
    for batch in batches:
        for block, row_id, text, guest in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if block == closed:  # further rows that are equal to the guest
                continue
            if texts and (guest or chars > 4_000_000 or len(texts) > 1000):
                yield out(ids, [*texts, text])
                ids, texts, chars = [], [], 0
            if guest:
                closed = block
                continue
            ids.append(row_id)
            texts.append(text)
            chars += len(text)
    assert not texts, "a block without a guest"


def fingerprint_with_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all documents and of their edited texts (a half replaced by the start of the next document), and likenesses.

    Scale: ids are cut into blocks of consecutive documents at boundaries taken from a narrow table; texts shuffle once, by block,
    and the first document of a block goes to the block before it as well. At most MOST_BLOCKS boundaries reach the driver; beyond
    MOST_BLOCKS * BLOCK_ROWS documents blocks get longer, with the same results, and a block streams through its task.

    Defined results: as for fingerprint_documents; documents follow one another by id, null first, then by a hash of the text; the
    first follows the last, so a single document follows itself.
    """
    least = -(2**63)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("key"), F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    keys = durable(rows.select("key", "tie"), "keys")
    n = min(MOST_BLOCKS, max(1, -(-keys.count() // BLOCK_ROWS)))
    heads = keys.repartitionByRange(n, "key", "tie").groupBy(F.spark_partition_id()).agg(F.min(F.struct("key", "tie")).alias("h")).select("h.*").toPandas()
    heads = heads.astype(np.int64).sort_values(["key", "tie"], ignore_index=True)
    first, ties = heads.key.to_numpy(), heads.tie.to_numpy()

    @F.pandas_udf("long")
    def place(key: pd.Series, tie: pd.Series) -> pd.Series:
        """The block's number, doubled, and one more for its head."""
        k, t = key.to_numpy(dtype=np.int64), tie.to_numpy(dtype=np.int64)
        block = np.searchsorted(first, k, side="right") - 1
        # among heads of one id, the tie decides
        for i in np.flatnonzero((block > 0) & (first[np.maximum(block, 0)] == k) & (ties[np.maximum(block, 0)] > t)):
            while first[block[i]] == k[i] and ties[block[i]] > t[i]:
                block[i] -= 1
        return pd.Series(2 * block + ((first[block] == k) & (ties[block] == t)))

    placed = rows.withColumn("at", place("key", "tie")).withColumn("block", F.shiftright("at", 1))
    home = F.struct(F.col("block"), F.lit(False).alias("guest"))
    away = F.struct(F.pmod(F.col("block") - 1, F.lit(max(1, len(heads)))).alias("block"), F.lit(True).alias("guest"))
    both = placed.withColumn("to", F.explode(F.when(F.col("at") % 2 == 1, F.array(home, away)).otherwise(F.array(home)))).select("to.block", "id", "text", "to.guest", "key", "tie")
    band = idf_band(docs, text_col)
    # four blocks a partition, so that none gets many more than others
    return both.repartition(max(1, len(heads) // 4), "block").sortWithinPartitions("block", "guest", "key", "tie").select("block", "id", "text", "guest").mapInArrow(partial(_with_next, band=band), EDITED)
