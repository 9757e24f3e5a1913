"""N-gram Jaccard join by MinHash banding, each candidate pair verified on full n-gram sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import WorkerTable, durable, text_of
from .components import components

#: Documents, and n-grams, of a chunk on average: a unit of verification holds two chunks.
CHUNK_DOCS, CHUNK_GRAMS = 512, 500_000
#: n-grams of a unit that are compared at once.
SLICE_GRAMS = 500_000
#: Candidate components of up to so many chunks are compared chunk by chunk, larger ones bucket by bucket. Either way the same pairs
#: count, those that share a band; it only changes how often a document is sent.
MOST_CHUNKS = 32
#: Classes of sizes of sets, by the logarithm, that make up the ratio that two near sets may differ by.
SIZE_CLASSES = 8
#: Words whose hashes a worker keeps; it then starts anew.
MOST_WORDS = 250_000


def choose_bands(threshold: float, recall: float, most_hashes: int = 160) -> tuple[int, int]:
    """(bands, rows): the most rows a band for which bands enough for the recall at the threshold need at most most_hashes."""
    best = (most_hashes, 1)
    for rows in range(1, most_hashes + 1):
        hit = threshold**rows
        bands = 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log1p(-hit))
        if bands * rows <= most_hashes:
            best = (bands, rows)
    return best


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        found = xxh3_64_intdigest(word)
        if len(word) <= 64:  # longer ones are not kept
            self[word] = found
        return found


_words = WorkerTable(WordHashes)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def grams(text: str, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles of a text in lower case; a text of fewer words is one shingle, one without words has none."""
    words = text.lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    known = _words.get()
    if len(known) > MOST_WORDS:
        known.clear()
    h = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(n, len(h))
    out = np.full(len(h) - width + 1, width, dtype=np.uint64)
    for i in range(width):
        out = (out ^ h[i : len(h) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15 + 2 * i)
        out ^= out >> np.uint64(29)
    return np.unique(_mixed(out))


def _signed(batches: Iterator[pa.RecordBatch], n: int, bands: int, rows: int, seed: int) -> Iterator[pa.RecordBatch]:
    rng = np.random.default_rng(seed)
    mul, add = rng.integers(0, 2**31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, bands * rows, dtype=np.uint32)
    turn = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        texts = batch.column(2)
        digests, counts, keys = np.zeros((len(texts), 2), dtype=np.int64), np.zeros(len(texts), dtype=np.int64), []
        for i in range(len(texts)):
            g = grams(texts[i].as_py(), n)
            digests[i] = np.frombuffer(blake2b(g.tobytes(), digest_size=16).digest(), dtype=np.int64)
            counts[i] = len(g)
            if not len(g):
                keys.append(np.empty(0, dtype=np.int64))
                continue
            least = np.full(bands * rows, 2**32 - 1, dtype=np.uint32)
            for at in range(0, len(g), 2048):
                part = g[at : at + 2048].astype(np.uint32)[:, None] * mul
                part += add
                np.minimum(least, part.min(axis=0), out=least)
            key = turn.copy()
            for column in least.reshape(bands, rows).T:
                key = _mixed(key ^ column.astype(np.uint64) + np.uint64(1))
            keys.append(key.view(np.int64))
        ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys) if keys else np.empty(0, dtype=np.int64)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests[:, 0].copy()), pa.array(digests[:, 1].copy()), pa.array(counts), lists], ["id", "text_hash", "a", "b", "n_grams", "bands"])


def _gram_sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [grams(x.as_py(), n).tobytes() for x in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, type=pa.binary())], ["node", "grams"])


def _slices(sets: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n-grams, owners) of sorted sets, for one range of n-gram hashes after another, some SLICE_GRAMS each."""
    sizes = np.array([len(x) for x in sets], dtype=np.int64)
    parts = int(-(-sizes.sum() // SLICE_GRAMS))
    bounds = [np.uint64((i << 64) // parts) for i in range(1, parts)]
    cuts = np.stack([np.concatenate([[0], np.searchsorted(x, bounds), [len(x)]]) for x in sets]).astype(np.int64)
    for j in range(parts):
        yield np.concatenate([x[a:b] for x, a, b in zip(sets, cuts[:, j], cuts[:, j + 1], strict=True)]), np.repeat(np.arange(len(sets)), cuts[:, j + 1] - cuts[:, j])


def _overlaps(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Sizes of the intersections of all sets of left with all of right, or of left with itself; a block of shared n-grams at a time."""
    out = np.zeros((len(left), len(left) if right is None else len(right)), dtype=np.float32)
    for everything, owner in _slices(left if right is None else left + right):
        _, gram, count = np.unique(everything, return_inverse=True, return_counts=True)
        # n-grams get their numbers in the order of the first set that has them, so a block touches few sets
        order = np.flatnonzero(count[gram] > 1)
        values, first = np.unique(gram[order], return_index=True)
        rank = np.empty(len(count), dtype=np.int64)
        rank[values[np.argsort(first, kind="stable")]] = np.arange(len(values))
        column, row = rank[gram[order]], owner[order]
        by_column = np.argsort(column, kind="stable")
        column, row = column[by_column], row[by_column]
        for at in range(0, len(values), 1024):
            lo, hi = np.searchsorted(column, (at, at + 1024))
            present, place = np.unique(row[lo:hi], return_inverse=True)
            block = np.zeros((len(present), 1024), dtype=np.float32)
            block[place, column[lo:hi] - at] = 1
            if right is None:
                out[np.ix_(present, present)] += block @ block.T
            else:
                mine = present < len(left)
                out[np.ix_(present[mine], present[~mine] - len(left))] += block[mine] @ block[~mine].T
    return out


def _unit_links(nodes: np.ndarray, side: np.ndarray, sets: list[np.ndarray], bands: np.ndarray, band: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nodes with links, their numbers of links, a linked or equal node that stands for their component within the unit).

    A pair counts if its sets are near and it shares a band. With band >= 0 the unit is a bucket of that band, and a pair counts
    only if no band before has put the two together: then another unit counts it.
    """
    a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(b):
        b = a
    size = np.array([len(x) for x in sets], dtype=np.float32)
    inter = _overlaps([sets[i] for i in a], None if b is a else [sets[i] for i in b])
    near = (inter >= threshold * (size[a][:, None] + size[b][None, :] - inter).astype(np.float64) - 1e-9) & (inter > 0)
    del inter
    met = np.zeros_like(near)
    for j in range(bands.shape[1] if band < 0 else band):
        met |= bands[a, j][:, None] == bands[b, j][None, :]
    near &= met if band < 0 else ~met
    if b is a:
        np.fill_diagonal(near, False)
    links = near.sum(axis=1) if b is a else np.concatenate([near.sum(axis=1), near.sum(axis=0)])
    la, lb, most = nodes[a].copy(), nodes[b].copy(), np.iinfo(np.int64).max
    while True:
        na = np.minimum(la, np.where(near, lb[None, :], most).min(axis=1))
        nb = na if b is a else np.minimum(lb, np.where(near, na[:, None], most).min(axis=0))
        if (na == la).all() and (nb == lb).all():
            break
        la, lb = na, nb
    both, low = (nodes[a], la) if b is a else (np.concatenate([nodes[a], nodes[b]]), np.concatenate([la, lb]))
    hit = np.flatnonzero(links)
    return both[hit], links[hit], low[hit]


def _verified(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by unit (key, x, y); a unit may go over several batches. What waits for the rest of its unit stays in Arrow."""

    def close(held: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        x, y, side, node = (np.concatenate([np.asarray(r.column(i)) for r in held]) for i in (1, 2, 4, 5))
        # whether there is anything to compare; the other chunk of a unit may have no row
        if len(side) < 2 or x[0] != y[0] and side[0] == side[-1]:
            return None
        sets = [np.frombuffer(g.as_buffer(), dtype=np.uint64) for r in held for g in r.column(6)]
        bands = np.concatenate([np.asarray(r.column(7).flatten()) for r in held]).reshape(len(side), -1)
        out = _unit_links(node, side, sets, bands, held[0].column(3)[0].as_py(), threshold)
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in out], ["node", "links", "low"])

    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        keys = [np.asarray(batch.column(i)) for i in range(3)]
        new = np.ones(batch.num_rows, dtype=bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        starts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(starts, starts[1:], strict=False):
            unit = tuple(int(k[a]) for k in keys)
            if held and unit != last:
                if (out := close(held)) is not None:
                    yield out
                held = []
            held, last = [*held, batch.slice(a, b - a)], unit
    if held and (out := close(held)) is not None:
        yield out


def _units(members: DataFrame, key: str, threshold: float) -> DataFrame:
    """Rows (unit, x, y, side, node, band) of units of verification, from rows (key, node, n, n_all, n_grams, band): a group's chunks, each compared with
    itself and with those whose sets may be near.

    Most groups are one chunk. The nodes of a larger one are laid out by the size of their sets, in classes of which SIZE_CLASSES make up the ratio that
    near sets may differ by, and spread by a hash within a class; chunks are cut from that row. A node is sent to the chunks that hold
    classes within that ratio of its own and to no others: with sizes that spread, a group that grows has more chunks, not more for each node.
    """
    big = (F.col("n") > CHUNK_DOCS) | (F.col("n_all") > CHUNK_GRAMS)
    unit = F.col(key).alias("unit")
    zero = F.lit(0)
    alone = members.filter(~big).select(unit, zero.alias("x"), zero.alias("y"), zero.alias("side"), "node", "band")
    ratio = math.log(1 / threshold) / SIZE_CLASSES if threshold < 1 else 1e-6
    large = members.filter(big).withColumn("_class", F.floor(F.log(F.col("n_grams").cast("double")) / ratio))
    # a row a group and class; half a chunk's weight is a node's that is as heavy
    weight = F.greatest(F.count("*") / float(CHUNK_DOCS), F.sum("n_grams") / float(CHUNK_GRAMS))
    order = W.partitionBy(key).orderBy("_class")
    classes = large.groupBy(key, "_class").agg(weight.alias("_weight")).withColumn("_end", F.sum("_weight").over(order.rowsBetween(W.unboundedPreceding, 0)))
    classes = classes.withColumn("_begin", F.coalesce(F.lag("_end").over(order), F.lit(0.0)))
    # one class more than the ratio has, for rounding
    near = order.rangeBetween(-(SIZE_CLASSES + 1), SIZE_CLASSES + 1)
    classes = classes.withColumns({"_low": F.floor(F.min("_begin").over(near)), "_high": F.ceil(F.max("_end").over(near)) - 1})
    part = F.pmod(F.xxhash64("node"), F.lit(1 << 30)) / float(1 << 30)
    own = large.join(classes, [key, "_class"]).withColumn("own", F.floor(F.col("_begin") + part * (F.col("_end") - F.col("_begin"))))
    other = own.withColumn("other", F.explode(F.sequence(F.least("_low", "own"), F.greatest("_high", "own"))))
    return alone.unionByName(other.select(unit, F.least("own", "other").cast("int").alias("x"), F.greatest("own", "other").cast("int").alias("y"), (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "band"))


def jaccard_links(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, recall: float = 0.9995, seed: int = 8) -> DataFrame:
    """A row a document: id, text_hash, class_id, n_links, n_copies, keeper.

    class_id: the smallest id that links connect the document with. n_links: other distinct n-gram sets at Jaccard >= threshold.
    n_copies: other documents with the same n-gram set. keeper: (id, text_hash) of the document of the class that stays.

    Steps: n-gram sets are signed; equal sets become one node; bands of nodes shuffle on their hashes; buckets with the same
    members are compared once. Nodes that share buckets form candidate components, and each node's full set is sent once to
    its component's unit, where all pairs are compared as blocks of a matrix product. A component of several chunks has a unit
    for each two chunks whose sets may be near by their sizes, so its work is spread; one of over MOST_CHUNKS chunks is compared bucket by bucket, and a pair counts
    in the first band in which it meets. In both ways those pairs count that share a band, so results don't depend on a group's
    size. No pair is a row, and no partner is left out. A pair at the threshold meets with the stated recall, one above it with more.

    Defined results: a null or empty text has no n-grams; such documents are copies of one another and link with nothing else.
    Rows of one id with different sets are documents of their own; the rows of a class with the smallest (id, text hash) are its keeper,
    so equal rows are all of them keepers or none. A null id comes last among keepers. An empty table gives an empty one. Ids are whole numbers.
    """
    bands, rows = choose_bands(threshold, recall)
    text = text_of(text_col)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    signed = durable(source.mapInArrow(partial(_signed, n=n, bands=bands, rows=rows, seed=seed), "id long, text_hash long, a long, b long, n_grams long, bands array<long>"), "signatures")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("first")
    classes = signed.groupBy("a", "b").agg(first, F.count("*").alias("copies"), F.any_value("n_grams").alias("n_grams"), F.any_value("bands").alias("bands"))
    classes = durable(classes, "classes")
    # a node's name is its first id; where no id is given or several sets share one, it is half of the set's digest
    shared = durable(classes.groupBy(F.col("first.id").alias("shared")).count().filter("count > 1 AND shared IS NOT NULL").select("shared"), "shared-ids", 1)
    classes = classes.join(shared, F.col("first.id") == F.col("shared"), "left").withColumn("node", F.when(F.col("shared").isNull(), F.col("first.id")).otherwise(F.col("a")))
    classes = classes.withColumn("node", F.coalesce("node", "a")).drop("shared")

    banded = classes.select("node", "n_grams", F.posexplode("bands").alias("band", "key"))
    mark = F.xxhash64("node")
    buckets = banded.groupBy("key").agg(F.count("*").alias("n"), F.sum("n_grams").alias("n_all"), F.min("band").alias("band"), F.min("node").alias("low"), F.bit_xor(mark).alias("m1"), F.sum(F.shiftright(mark, 20)).alias("m2"))
    kept = buckets.filter("n > 1").groupBy("n", "n_all", "low", "m1", "m2").agg(F.min(F.struct("band", "key")).alias("k")).select("k.*", "n", "n_all", "low")
    members = durable(banded.select("node", "key", "n_grams").join(kept, "key"), "members")
    comps = components(members.select(F.col("node").alias("u"), F.col("low").alias("v")))
    sized = comps.join(classes.select("node", "n_grams"), "node")
    sizes = sized.groupBy("root").agg(F.count("*").alias("n"), F.sum("n_grams").alias("n_all"))
    comps = durable(sized.select("node", "root", "n_grams").join(sizes, "root"), "candidates")
    small = (F.col("n") <= MOST_CHUNKS * CHUNK_DOCS) & (F.col("n_all") <= MOST_CHUNKS * CHUNK_GRAMS)
    units = _units(comps.filter(small).withColumn("band", F.lit(-1)), "root", threshold).unionByName(_units(members.join(comps.filter(~small).select("node"), "node", "left_semi"), "key", threshold))

    wanted = classes.join(comps.select("node"), "node", "left_semi").select("node", _whole(F.col("first.id")).alias("id"), "first.text_hash")
    met = source.withColumn("id", _whole(F.col("id"))).join(wanted, ["id", "text_hash"]).groupBy("node").agg(F.any_value("text").alias("text"))
    sets = durable(met.mapInArrow(partial(_gram_sets, n=n), "node long, grams binary"), "gram-sets")
    sent = units.join(sets, "node").join(classes.select("node", "bands"), "node").select("unit", "x", "y", "band", "side", "node", "grams", "bands")
    checked = sent.repartition("unit", "x", "y").sortWithinPartitions("unit", "x", "y", "side", "node").mapInArrow(partial(_verified, threshold=threshold), "node long, links long, low long")
    checked = durable(checked, "links")
    roots = components(checked.select(F.col("node").alias("u"), F.col("low").alias("v")))
    links = checked.groupBy("node").agg(F.sum("links").alias("n_links"))

    nodes = classes.select("a", "b", "node", "first", "copies").join(roots, "node", "left").join(links, "node", "left").withColumn("root", F.coalesce("root", "node"))
    heads = nodes.groupBy("root").agg(F.min("first").alias("keeper"))
    nodes = nodes.join(heads, "root").select("a", "b", F.coalesce("keeper.id", "root").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), (F.col("copies") - 1).alias("n_copies"), F.struct("keeper.id", "keeper.text_hash").alias("keeper"))
    return signed.select("id", "text_hash", "a", "b").join(nodes, ["a", "b"]).drop("a", "b")


def _whole(row_id: Column) -> Column:
    """An id for equi-joins: null as the least long."""
    return F.coalesce(row_id, F.lit(-(2**63)))


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options: float) -> DataFrame:
    """The rows of docs that stay: one of each class, the one with the smallest id (null last, then the smallest hash of the text).

    Defined results: as for jaccard_links. Documents without words are one class, of which one row stays. Of rows equal in id and
    text the one whose other columns come first as JSON stays. All columns stay as they are; an empty table gives an empty one.
    """
    links = jaccard_links(docs, id_col=id_col, text_col=text_col, **options)
    stay = links.filter(F.col("id").eqNullSafe(F.col("keeper.id")) & (F.col("text_hash") == F.col("keeper.text_hash")))
    stay = durable(stay.select(_whole(F.col("id")).alias("_keep_id"), F.col("text_hash").alias("_keep_hash")).distinct(), "keepers")
    others = F.to_json(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c not in (id_col, text_col)]))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _whole(F.col(id_col).cast("long")).alias("_keep_id"), F.xxhash64(text_of(text_col)).alias("_keep_hash"), others.alias("_order"))
    # rows equal in id and text are one document, of which one row stays; the join's partitioning serves the grouping too
    return rows.join(stay, ["_keep_id", "_keep_hash"]).groupBy("_keep_id", "_keep_hash").agg(F.min_by("row", "_order").alias("row")).select("row.*")
