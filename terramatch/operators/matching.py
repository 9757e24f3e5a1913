"""Matching: band joins of treated and candidate pixels, bounded candidate sets, covariance, one-to-one greedy pairs."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import within
from ..session import bucketed, durable
from .ranks import with_position

#: Share of treated pixels in a repetition, candidates for each, repetitions.
SAMPLE_SHARE, REQUIRED, REPETITIONS = 0.1, 100, 100
#: Candidates in a leaf of the index of free ones at most, leaves in a box.
LEAF_ROWS, BOX_LEAVES = 24, 64
#: A build side of at most so many rows and bytes is sent round; a larger one is shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20
#: Rows that share a treated row's hard attributes and bins at which the walk for candidates looks first, for each candidate wanted; blocks of positions, and
#: buckets of the pool.
LOOKS_EACH, BLOCKS, POOL_BUCKETS = 20, 256, 64


def bytes_of(value: Column, kind: T.DataType) -> Column:
    """About the bytes of a value: 8 for a number, the length of a text, the sum over a list's or record's parts."""
    if isinstance(kind, T.ArrayType):
        fixed = isinstance(kind.elementType, T.StructType) and all(not isinstance(f.dataType, (T.ArrayType, T.StructType, T.StringType)) for f in kind.elementType)
        if fixed or not isinstance(kind.elementType, (T.ArrayType, T.StructType, T.StringType)):
            width = 8 * (len(kind.elementType) if fixed else 1)
            return F.coalesce(F.size(value) * width, F.lit(8))
        return F.coalesce(F.aggregate(value, F.lit(0).cast("long"), lambda a, x: a + bytes_of(x, kind.elementType).cast("long")), F.lit(8))
    if isinstance(kind, T.StructType):
        return reduce(lambda a, b: a + b, [bytes_of(value[f.name], f.dataType) for f in kind], F.lit(8))
    return F.coalesce(F.octet_length(value), F.lit(0)) + 8 if isinstance(kind, (T.StringType, T.BinaryType)) else F.lit(8)


def small(df: DataFrame, most_rows: int | None = None) -> DataFrame:
    """df, written once and marked for broadcast if a bounded look at what was written shows that it has at most most_rows rows and BROADCAST_BYTES bytes: the
    other side is then not shuffled, and df is not computed twice."""
    most_rows, df = BROADCAST_ROWS if most_rows is None else most_rows, durable(df, "build")
    size = reduce(lambda a, b: a + b, [bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema]).cast("long")
    n, total = df.limit(most_rows + 1).agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if n <= most_rows and total <= BROADCAST_BYTES else df


def band_condition(m: str, k: str, widths: dict[str, float]) -> Column:
    return reduce(lambda a, b: a & b, [within(F.col(f"{m}.{c}"), F.col(f"{k}.{c}"), w) for c, w in widths.items()])


def band_semi_join(m: DataFrame, k: DataFrame, hard: list[str], widths: dict[str, float]) -> DataFrame:
    """Rows of m that for at least one row of k have equal hard attributes and lie within all bands: a semi-join on the hard
    attributes with the bands as its residual condition."""
    build = k.select(*hard, *widths).distinct()
    on = reduce(lambda a, b: a & b, [F.col(f"m.{c}") == F.col(f"k.{c}") for c in hard], band_condition("m", "k", widths))
    return m.alias("m").join(small(build).alias("k"), on, "left_semi")


def bin_of(value: Column, width: float) -> Column:
    """The bin of a value, as wide as a band. A negative width is a share of the value: bins are then as wide in logarithms, and one bin holds all that is not over 0.
    Quotients, logarithms and floors keep order."""
    if width > 0:
        return F.floor(value / width)
    step = math.log1p(-width)
    return F.when(value > 0, F.floor(F.least(F.ln(value), F.lit(710.0)) / step)).otherwise(math.floor(-746.0 / step))  # no double has logarithms beyond these


def bins_of(value: Column, width: float) -> Column:
    """The bins that the band of a value meets: from that of its lower end to that of its upper one, so a value within the band, however it is rounded, is in one
    of them. None where the upper end is below the lower one, as a share of a negative value is."""
    half = F.lit(float(width)) if width > 0 else -float(width) * value
    low, high = value - half, value + half
    return F.when(low <= high, F.sequence(bin_of(low, width), bin_of(high, width)))


def band_semi_join_binned(m: DataFrame, k: DataFrame, hard: list[str], widths: dict[str, float], by: str | list[str]) -> DataFrame:
    """The same rows, with a bin of attribute `by`, as wide as its band, in the join's key: a probe meets a bin and not its whole hard group. With several
    attributes in `by` a probe meets a cell of their grid; a row of k goes to up to three bins for each of them.

    k goes to all bins from its band's lower end to its upper one. That splits a hot hard group by bins on both sides, and where both are shuffled,
    adaptive execution splits what is still skewed.
    """
    names = [by] if isinstance(by, str) else list(by)
    if any(not -1 < widths[c] or not widths[c] for c in names):
        raise ValueError("bins need a positive absolute width or a share under 1")
    build, probe, bins = k.select(*hard, *widths).distinct(), m, [f"_bin{i}" for i in range(len(names))]
    for at, c in zip(bins, names, strict=True):
        build, probe = build.withColumn(at, F.explode(bins_of(F.col(c), widths[c]))), probe.withColumn(at, bin_of(F.col(c), widths[c]))
    on = reduce(lambda a, b: a & b, [F.col(f"m.{c}") == F.col(f"k.{c}") for c in [*hard, *bins]], band_condition("m", "k", widths))
    return probe.alias("m").join(small(build).alias("k"), on, "left_semi").drop(*bins)


def best_bin(rows: DataFrame, widths: dict[str, float]) -> str:
    """The attribute whose bins, as wide as its band, split rows into most: by one pass of an approximate count. The first among equals."""
    names = [c for c, w in widths.items() if w > 0]
    found = rows.agg(*[F.approx_count_distinct(F.floor(F.col(c) / widths[c])).alias(c) for c in names]).first()
    return max(names, key=lambda c: found[c])


def halvings(share: float, attributes: int) -> int:
    """How often an attribute's range is halved so that the cells of all attributes together hold about a share of the rows that match:
    the least n with 1 - 2 ** -(n + 1) >= share ** (1 / attributes)."""
    each = share ** (1 / attributes)
    return max(0, math.ceil(round(math.log2(1 / (1 - each)), 9)) - 1)


def sample(k: DataFrame, share: float, seed: int = 0, key: str = "id", order: Column | None = None) -> DataFrame:
    """An exact share of k without replacement, with `draw`, its place in a shuffled order. The order is one of hashes, so it depends on
    seed and key alone, or a given one; numbering runs in ranges."""
    drawn = with_position(k.withColumn("_u", F.xxhash64(F.lit(seed), F.col(key)) if order is None else order), ["_u", key], "draw").drop("_u")
    n = F.round(F.lit(share) * drawn.count()).cast("long")
    return drawn.filter(F.col("draw") < n)


def samples(k: DataFrame, share: float, seeds_of: DataFrame, key: str = "id") -> DataFrame:
    """The samples of all repetitions (iteration, seed) at once: the rows of sample() for each seed, with iteration. All repetitions have the
    same number of rows, so one numbering of all of them gives each its own."""
    n = k.count()
    each = k.join(F.broadcast(seeds_of)).withColumn("_u", F.xxhash64(F.col("seed").cast("int"), F.col(key)))  # a row a repetition
    drawn = with_position(each, ["iteration", "_u", key], "draw").drop("_u")
    before = seeds_of.select("iteration", (F.row_number().over(W.orderBy("iteration")) - 1).alias("_before"))
    placed = drawn.join(F.broadcast(before), "iteration").withColumn("draw", F.col("draw") - F.col("_before") * n).drop("_before")
    return placed.filter(F.col("draw") < F.round(F.lit(share) * n).cast("long"))


def seeds(spark, master: int, n: int = REPETITIONS) -> DataFrame:
    """iteration, seed: distinct seeds for all repetitions from one."""
    return spark.range(n).select(F.col("id").cast("int").alias("iteration"), (F.pmod(F.xxhash64(F.lit(master), "id"), F.lit(1_000_000)) * n + F.col("id")).alias("seed"))


def candidate_pairs(k: DataFrame, m: DataFrame, hard: list[str], widths: dict[str, float], seed: int = 0, required: int = REQUIRED, key: str = "id", by: str | None = None, start: Column | None = None, span: int | None = None) -> DataFrame:
    """k_id, m_id, step, rank: for each row of k its first `required` matches in m, walking m's positions (column pos, from 0) in a circle
    from `start`, by default a hash of seed and key.

    The pool is laid out once, bucketed by hard attributes, bin of attribute `by` if one is named, and block of positions; no round shuffles it again. The walk
    goes in rounds. How far a row goes in the first one follows from the number of pool rows that share its attributes and bins: so far that
    it meets LOOKS_EACH of them for each candidate wanted, or all of them if there are no more, as where matches are sparse. Each further
    round goes as far as all before together, for the rows that still lack candidates. So a row forms at most a few times `required`
    pairs, however many matches it has, or as many as its group has if that is less. span: a first number of positions for all rows instead.
    """
    m = m.select(F.col(key).alias("m_id"), "pos", *hard, *widths)
    n = max(m.count(), 1)
    if by:
        m = m.withColumn("_bin", F.floor(F.col(by) / widths[by]))
    group = [*hard, *(["_bin"] if by else [])]
    # a group's blocks hold about as many of its rows as the first round looks at, so a small group is one block
    sizes = m.groupBy(*group).agg(F.count("*").alias("_n")).withColumn("_length", F.ceil(F.lit(n) / F.least(F.lit(BLOCKS), F.ceil(F.col("_n") / (LOOKS_EACH * required)))))
    sizes = durable(sizes, "group-sizes")
    pool = m.join(sizes.select(*group, "_length"), group).withColumn("_block", F.floor(F.col("pos") / F.col("_length"))).drop("_length")
    pool = bucketed(pool, "pool", [*group, "_block"], POOL_BUCKETS if n > 1_000_000 else 8)
    left = k.select(F.col(key).alias("k_id"), *hard, *widths, F.pmod(F.xxhash64(F.lit(seed), F.col(key)) if start is None else start, F.lit(n)).cast("long").alias("start"), F.lit(0).cast("long").alias("have"))
    if span:
        far = F.lit(min(n, span)).cast("long")
    else:
        left = left.withColumn("_bin", F.explode(bins_of(F.col(by), widths[by]))) if by else left
        left = left.join(sizes, group).groupBy("k_id", *hard, *widths, "start", "have").agg(F.sum("_n").alias("_n"))
        far = F.least(F.lit(n), F.ceil(F.lit(n) * float(LOOKS_EACH * required) / F.col("_n"))).cast("long")
    left = durable(left.withColumns({"low": F.lit(0).cast("long"), "high": far}).drop("_n"), "starts")
    found: DataFrame | None = None
    while True:
        a, b = F.col("start") + F.col("low"), F.col("start") + F.col("high")
        nothing = F.array().cast("array<long>")
        to = lambda v: F.floor(v / F.col("_length"))
        here = F.when(a < n, F.sequence(to(a), to(F.least(b, F.lit(n)) - 1))).otherwise(nothing)
        past = F.when(b > n, F.sequence(to(F.greatest(a - n, F.lit(0))), to(b - n - 1))).otherwise(nothing)
        seeking = left.withColumn("_bin", F.explode(bins_of(F.col(by), widths[by]))) if by else left
        seeking = seeking.join(sizes.select(*group, "_length"), group).withColumn("_block", F.explode(F.array_union(here, past))).drop("_length")
        on = reduce(lambda x, y: x & y, [F.col(f"m.{c}") == F.col(f"k.{c}") for c in [*group, "_block"]], band_condition("m", "k", widths))
        met = pool.alias("m").join(seeking.alias("k"), on)
        met = met.select("k_id", "m_id", "have", "low", "high", F.pmod(F.col("pos") - F.col("start"), F.lit(n)).alias("step")).filter((F.col("step") >= F.col("low")) & (F.col("step") < F.col("high")))
        ranked = met.withColumn("rank", F.col("have") + F.row_number().over(W.partitionBy("k_id").orderBy("step", "m_id")))
        new = durable(ranked.filter(F.col("rank") <= required).select("k_id", "m_id", "step", "rank"), "candidates")
        found = new if found is None else found.unionByName(new)
        on_way = left.filter(F.col("high") < n)
        if on_way.isEmpty():
            return found
        got = new.groupBy("k_id").agg(F.max("rank").alias("_got"))
        left = on_way.join(got, "k_id", "left").withColumn("have", F.coalesce("_got", "have")).drop("_got").filter(F.col("have") < required)
        left = durable(left.withColumns({"low": F.col("high"), "high": F.least(F.lit(n).cast("long"), 2 * F.col("high"))}), "seeking")
        if left.isEmpty():
            return found


def candidate_set(pairs: DataFrame) -> DataFrame:
    """Distinct candidates."""
    return pairs.select(F.col("m_id").alias("id")).distinct()


def misses(k: DataFrame, pairs: DataFrame, key: str = "id") -> DataFrame:
    """Rows of k without a candidate."""
    return k.join(pairs.select(F.col("k_id").alias(key)).distinct(), key, "left_anti")


def scaled(df: DataFrame, widths: dict[str, float]) -> DataFrame:
    """Attributes in units of their tolerances."""
    return df.withColumns({c: F.col(c) / F.lit(float(w)) for c, w in widths.items()})


def covariance(df: DataFrame, columns: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """a, b, cov: sample covariances of all pairs, the upper triangle, from one pass; for each group of `by` if given."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    row = df.groupBy(*by).agg(*[F.covar_samp(columns[i], columns[j]).alias(f"c_{i}_{j}") for i, j in pairs])
    cells = F.array(*[F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"), F.col(f"c_{i}_{j}").alias("cov")) for i, j in pairs])
    return row.select(*by, F.explode(cells).alias("c")).select(*by, "c.*")


def _inverse(rows: pd.DataFrame, columns: list[str]) -> np.ndarray:
    place, out = {c: i for i, c in enumerate(columns)}, np.zeros((len(columns),) * 2)
    for a, b, v in rows[["a", "b", "cov"]].itertuples(index=False):
        out[place[a], place[b]] = out[place[b], place[a]] = np.nan if v is None else v
    if not np.isfinite(out).all() or np.linalg.matrix_rank(out) < len(columns):
        raise ValueError("the covariance of the candidates is singular: a feature is constant, or candidates are fewer than features")
    return np.linalg.inv(out)


def inverse_covariance(df: DataFrame, columns: list[str]) -> np.ndarray:
    """On the driver, from d (d + 1) / 2 numbers. A singular matrix is an error that names it."""
    return _inverse(covariance(df, columns).toPandas(), columns)


def inverse_covariances(df: DataFrame, columns: list[str], by: str) -> dict[int, np.ndarray]:
    """inverse_covariance() of each group of `by`, a repetition: d (d + 1) / 2 numbers each come to the driver."""
    return {int(k): _inverse(rows, columns) for k, rows in covariance(df, columns, (by,)).toPandas().groupby(by)}


def mahalanobis(a: list[Column], b: list[Column], inverse: np.ndarray) -> Column:
    """Squared distance as an expression: code generation covers it and no row goes to Python."""
    d = [x - y for x, y in zip(a, b, strict=True)]
    terms = [float(inverse[i][j] * (1 if i == j else 2)) * d[i] * d[j] for i in range(len(d)) for j in range(i, len(d))]
    return reduce(lambda x, y: x + y, terms)


def _in_leaves(points: np.ndarray) -> list[np.ndarray]:
    """Indexes of points in the order of a k-d tree's leaves, cut at medians of the widest attribute."""
    stack, out = [np.arange(len(points))], []
    while stack:
        rows = stack.pop()
        if len(rows) <= LEAF_ROWS:
            out.append(rows)
            continue
        own = points[rows]
        half = len(rows) // 2
        order = np.argpartition(own[:, np.argmax(own.max(axis=0) - own.min(axis=0))], half)
        stack += [rows[order[half:]], rows[order[:half]]]
    return out


class Free:
    """Points that are still free, for the nearest one by a quadratic form. They lie in leaves of a k-d tree over features in which the form is the plain
    distance, and leaves in boxes of BOX_LEAVES neighbours: a query looks at the boxes, at the leaves of boxes that are near enough, and at the
    points of leaves that are. Equal points are one, with their places in a row. A leaf that is used up is infinitely far."""

    def __init__(self, points: np.ndarray, inverse: np.ndarray) -> None:
        self.points, first, place = np.unique(points, axis=0, return_index=True, return_inverse=True) if len(points) else (points, None, np.zeros(0, dtype=int))
        self.inverse, self.looked = inverse, 0
        by_place = np.argsort(place.ravel(), kind="stable")
        ends = np.cumsum(np.bincount(place.ravel(), minlength=len(self.points)))
        self.places, self.next, self.end = by_place, np.concatenate([[0], ends[:-1]]).astype(np.int64), ends
        self.root = np.linalg.cholesky((inverse + inverse.T) / 2)
        white = self.points @ self.root
        self.leaves = _in_leaves(white) if len(white) else []
        self.leaf_of = np.zeros(len(white), dtype=np.int64)
        for i, rows in enumerate(self.leaves):
            self.leaf_of[rows] = i
        self.low = np.array([white[r].min(axis=0) for r in self.leaves]).reshape(len(self.leaves), -1)
        self.high = np.array([white[r].max(axis=0) for r in self.leaves]).reshape(len(self.leaves), -1)
        at = np.arange(0, len(self.leaves), BOX_LEAVES)
        self.box_low = np.minimum.reduceat(self.low, at) if len(at) else self.low
        self.box_high = np.maximum.reduceat(self.high, at) if len(at) else self.high
        self.left = np.add.reduceat(np.ones(len(self.leaves), dtype=np.int64), at) if len(at) else at

    @staticmethod
    def _bounds(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> np.ndarray:
        off = np.maximum(np.maximum(low - q, q - high), 0)
        return (off * off).sum(axis=1)

    def take(self, q: np.ndarray) -> int:
        """The place of the nearest free point, the smallest among equals; it is free no more. -1 once none is."""
        white, best, where = q @ self.root, math.inf, -1
        boxes = self._bounds(self.box_low, self.box_high, white)
        for b in np.argsort(boxes):
            # bounds are those of rounded numbers
            if boxes[b] * (1 - 1e-9) - 1e-12 > best or not math.isfinite(boxes[b]):
                break
            a, z = b * BOX_LEAVES, min((b + 1) * BOX_LEAVES, len(self.leaves))
            bounds = self._bounds(self.low[a:z], self.high[a:z], white)
            for i in np.argsort(bounds):
                if bounds[i] * (1 - 1e-9) - 1e-12 > best or not math.isfinite(bounds[i]):
                    break
                rows = self.leaves[a + i]
                d = self.points[rows] - q
                far = np.einsum("ij,jk,ik->i", d, self.inverse, d)
                self.looked += len(rows)
                least = float(far.min())
                if least <= best:
                    for j in rows[far == least]:
                        if least < best or where < 0 or self.places[self.next[j]] < self.places[self.next[where]]:
                            best, where = least, int(j)
        if where < 0:
            return -1
        place = int(self.places[self.next[where]])
        self.next[where] += 1
        if self.next[where] == self.end[where]:
            self._drop(where)
        return place

    def _drop(self, point: int) -> None:
        leaf = int(self.leaf_of[point])
        self.leaves[leaf] = self.leaves[leaf][self.leaves[leaf] != point]
        if not len(self.leaves[leaf]):
            self.low[leaf], box = np.inf, leaf // BOX_LEAVES
            self.left[box] -= 1
            if not self.left[box]:
                self.box_low[box] = np.inf


def greedy_places(k: np.ndarray, s: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    """For each row of k in order the nearest row of s that is still free, the first among equals; -1 once none is."""
    free, out = Free(s, inverse), np.full(len(k), -1, dtype=np.int64)
    for i in range(min(len(k), len(s))):
        out[i] = free.take(k[i])
    return out


def greedy_pairs(k: DataFrame, s: DataFrame, hard: list[str], columns: list[str], inverse: np.ndarray | dict[int, np.ndarray], order: str = "draw", key: str = "id", by: str | None = None) -> DataFrame:
    """k_id, s_id, distance: each k in order takes the nearest s of its hard group that no earlier k took. With `by`, all repetitions at once:
    a repetition is part of the group, has an inverse covariance of its own, and comes with the pairs.

    A k only ever takes an s of its own hard group, so groups are independent, given one covariance for all. A group is one task,
    because its steps follow one another; it is bounded by the sample and by `required` candidates a sampled row, and only
    keys and features of it are held. A step looks at near candidates alone (see Free). Equal distances go to the smaller s.
    """

    groups = [*([by] if by else []), *hard]

    def match(of: tuple, ks: pd.DataFrame, ss: pd.DataFrame) -> pd.DataFrame:
        ks, ss = ks.sort_values([order, key]), ss.sort_values(key)
        a, b = ks[columns].to_numpy(float), ss[columns].to_numpy(float)
        matrix = inverse[int(of[0])] if by else inverse
        got = greedy_places(a, b, matrix)
        hit = got >= 0
        d = a[hit] - b[got[hit]]
        out = {"k_id": ks[key].to_numpy()[hit], "s_id": ss[key].to_numpy()[got[hit]], "distance": np.einsum("ij,jk,ik->i", d, matrix, d)}
        return pd.DataFrame(({by: np.full(hit.sum(), of[0])} if by else {}) | out)

    schema = T.StructType([*([T.StructField(by, k.schema[by].dataType)] if by else []), T.StructField("k_id", k.schema[key].dataType), T.StructField("s_id", s.schema[key].dataType), T.StructField("distance", T.DoubleType())])
    left, right = k.select(key, order, *groups, *columns), s.select(key, *groups, *columns)
    return left.groupBy(*groups).cogroup(right.groupBy(*groups)).applyInPandas(match, schema)


def pair_status(k: DataFrame, pairs: DataFrame, candidates: DataFrame, key: str = "id", by: tuple[str, ...] = ()) -> DataFrame:
    """key and status of every sampled row: paired, no_candidate, or unmatched (its candidates all went to others)."""
    done = pairs.select(*by, F.col("k_id").alias(key), F.lit(True).alias("_paired"))
    some = candidates.select(*by, F.col("k_id").alias(key)).distinct().withColumn("_some", F.lit(True))
    out = k.select(*by, key).join(done, [*by, key], "left").join(some, [*by, key], "left")
    return out.select(*by, key, F.when(F.col("_paired"), "paired").when(F.col("_some"), "unmatched").otherwise("no_candidate").alias("status"))


def wide_pairs(pairs: DataFrame, k: DataFrame, s: DataFrame, columns: list[str], key: str = "id", by: tuple[str, ...] = ()) -> DataFrame:
    """Columns of both sides of a pair under k_ and s_."""
    left = k.select(F.col(key).alias("k_id"), *[F.col(c).alias(f"k_{c}") for c in columns])
    right = s.select(F.col(key).alias("s_id"), *[F.col(c).alias(f"s_{c}") for c in columns])
    return pairs.join(left, "k_id").join(right, "s_id").select(*by, *left.columns, *right.columns)
