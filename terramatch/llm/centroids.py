"""Exact k-means over whole numbers by filtering with kd-trees (Kanungo et al., 2002; Pelleg and Moore, 1999)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import durable

DIMENSIONS, CENTROIDS, ROUNDS, SCALE = 64, 40, 5, 256
#: Vectors of one kd-tree, and of a leaf at most, unless all are equal.
TREE_ROWS, LEAF_ROWS = 4096, 32
#: Components beyond this have squared distances that a long does not hold.
MOST = 1 << 26
#: Components up to this have products and sums that doubles hold exactly.
EXACT = 1 << 20


@dataclass
class Tree:
    """Vectors in the order of a kd-tree's leaves. A node covers points[start:end] and has its box and the sum of its vectors; `left` is the first of its
    two children, which are neighbours, or -1."""

    points: np.ndarray
    start: np.ndarray
    end: np.ndarray
    left: np.ndarray
    low: np.ndarray
    high: np.ndarray
    sums: np.ndarray


def build(points: np.ndarray) -> tuple[Tree, np.ndarray]:
    """The tree of vectors, cut at medians of the widest component, and the order of its points."""
    order, spans, left, boxes = np.arange(len(points)), [(0, len(points))], [-1], []
    for a, b in spans:  # which grows
        own = points[order[a:b]]
        low, high = own.min(axis=0), own.max(axis=0)
        boxes.append((low, high, own.sum(axis=0)))
        if b - a > LEAF_ROWS and (high > low).any():
            widest, middle = int(np.argmax(high - low)), (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, widest], middle)]
            left[len(boxes) - 1] = len(spans)
            spans += [(a, a + middle), (a + middle, b)]
            left += [-1, -1]
    start, end = np.array(spans, dtype=np.int64).T
    low, high, sums = (np.stack(x) for x in zip(*boxes, strict=True))
    return Tree(points[order], start, end, np.array(left, dtype=np.int64), low, high, sums), order


def squared(points: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of all pairs, exact."""
    kind = np.float64 if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT else np.int64
    p, c = points.astype(kind), centroids.astype(kind)
    return ((p * p).sum(axis=1)[:, None] - 2 * (p @ c.T) + (c * c).sum(axis=1)).astype(np.int64)


def undominated(low: np.ndarray, high: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Of some centroids those that a point of a box may be nearest to. One is out if it is strictly farther than the one nearest the box's middle from every
    point of the box, which the corner that favours it most decides; a tie stays in."""
    c = centroids[among]
    off = 2 * c - (low + high)
    best = c[np.argmin((off * off).sum(axis=1))]
    corner = np.where(c > best, high, low)
    a, b = c - corner, best - corner
    return among[(a * a).sum(axis=1) <= (b * b).sum(axis=1)]


def filtered(tree: Tree, centroids: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray | None]]:
    """(node, start, end, numbers): whole nodes that one centroid has, with its number alone, and leaves with a number a point."""
    stack = [(0, np.arange(len(centroids)))]
    while stack:
        node, among = stack.pop()
        a, b = int(tree.start[node]), int(tree.end[node])
        among = undominated(tree.low[node], tree.high[node], centroids, among)
        if len(among) == 1:
            yield node, a, b, among
        elif tree.left[node] < 0:
            yield node, a, b, among[np.argmin(squared(tree.points[a:b], centroids[among]), axis=1)]
        else:
            stack += [(int(tree.left[node]), among), (int(tree.left[node]) + 1, among)]


NAMES = ("start", "end", "left", "low", "high", "sums")
TREES = T.StructType([T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("points", T.BinaryType()), T.StructField("width", T.IntegerType()), *(T.StructField(c, T.BinaryType()) for c in NAMES)])


def _planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a tree of TREE_ROWS vectors at most. Points and boxes take as few bytes as they need."""
    for batch in batches:
        for at in range(0, batch.num_rows, TREE_ROWS):
            part = batch.slice(at, TREE_ROWS)
            points = np.asarray(part.column(1).flatten()).reshape(part.num_rows, -1)
            tree, order = build(points)
            width = next(w for w in (2, 4) if np.abs(points).max(initial=0) < 1 << (8 * w - 1))
            narrow = {"low", "high"}
            row = {"ids": part.column(0).take(pa.array(order)).to_pylist(), "points": tree.points.astype(f"<i{width}").tobytes(), "width": width}
            row |= {c: getattr(tree, c).astype(f"<i{width}" if c in narrow else "<i8").tobytes() for c in NAMES}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([("ids", pa.list_(pa.int64())), ("points", pa.binary()), ("width", pa.int32()), *((c, pa.binary()) for c in NAMES)]))


def _trees(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[list, Tree]]:
    for batch in batches:
        for row in batch.to_pylist():
            small, whole = f"<i{row['width']}", "<i8"
            read = lambda c, kind, row=row: np.frombuffer(row[c], dtype=kind).astype(np.int64)
            flat = {c: read(c, whole) for c in ("start", "end", "left")}
            wide = {c: read(c, kind).reshape(-1, dimensions) for c, kind in (("points", small), ("low", small), ("high", small), ("sums", whole))}
            yield row["ids"], Tree(**wide, **flat)


def _summed(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """cluster, place, total: of a task's vectors, for each cluster their number (place -1) and the sums of their components."""
    k, d = centroids.shape
    total = np.zeros((k, d + 1), dtype=np.int64)
    for _, tree in _trees(batches, d):
        for node, a, b, numbers in filtered(tree, centroids):
            if len(numbers) == 1:
                total[numbers[0], 0] += b - a
                total[numbers[0], 1:] += tree.sums[node]
            else:
                total[:, 0] += np.bincount(numbers, minlength=k)
                np.add.at(total[:, 1:], numbers, tree.points[a:b])
    some = np.flatnonzero(total[:, 0])
    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, d + 1).astype(np.int32)), pa.array(np.tile(np.arange(-1, d, dtype=np.int32), len(some))), pa.array(total[some].ravel())], ["cluster", "place", "total"])


def _labelled(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
    for ids, tree in _trees(batches, centroids.shape[1]):
        cluster = np.zeros(len(ids), dtype=np.int32)
        for _, a, b, numbers in filtered(tree, centroids):
            cluster[a:b] = numbers if len(numbers) == b - a else numbers[0]
        off = tree.points - centroids[cluster]
        yield pa.RecordBatch.from_arrays([pa.array(ids, type=pa.int64()), pa.array(cluster), pa.array((off * off).sum(axis=1))], ["id", "cluster", "distance"])


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str, dimensions: int, scale: int) -> DataFrame:
    """id and v, floor(scale * x) of each component: of the vectors with so many components, all finite and within MOST after scaling."""
    x: Column = F.transform(F.col(vector_col), lambda c: c.cast("double") * scale)
    fine = (F.size(vector_col) == dimensions) & F.forall(x, lambda c: F.coalesce(c.between(-float(MOST), float(MOST)), F.lit(False)))
    return rows.filter(F.coalesce(fine, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c).cast("long")).alias("v"))


def centroid_clusters(rows: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", dimensions: int = DIMENSIONS, clusters: int = CENTROIDS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = 2) -> DataFrame:
    """A row a kept vector: id_col, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of its cluster's final centroid.

    Vectors are floor(scale * x), whole numbers, and all that follows is exact. The first centroids are the vectors with the least SHA-256 of seed:id. In each
    round a vector belongs to its nearest centroid, of equals the smaller number, and a centroid moves to the floor of its vectors' mean;
    one without vectors stays.

    Scale: vectors are cut into trees where they lie, once, and the table of trees is read in each round. A tree takes the centroids down from its root,
    leaving behind those that its nodes' boxes rule out: a node that has one left is added whole by its count and sums. A task returns a
    row a cluster and component; centroids, clusters x dimensions numbers, go out with the tasks. No vector is shuffled, so equal
    vectors, however many, are no group; they are a leaf.

    Defined results: vectors of another length, with null, NaN or infinite components or with ones beyond MOST / scale are left out (distances
    of the latter are more than a long holds); fewer vectors than clusters make fewer clusters; a null id is hashed as an empty one; of rows
    with one id, those with smaller vectors come first; repeated rows are vectors of their own; an empty table gives an empty one.
    Ids are whole numbers. Further columns are left out.
    """
    spark = rows.sparkSession
    kept = whole_vectors(rows, id_col, vector_col, dimensions, scale)
    trees = durable(kept.mapInArrow(_planted, TREES), "trees")
    first = kept.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)).orderBy("h", "v").limit(clusters).select("v").collect()
    centroids = np.array([r["v"] for r in first], dtype=np.int64).reshape(-1, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        totals = trees.mapInArrow(partial(_summed, centroids=centroids), "cluster int, place int, total long").groupBy("cluster", "place").agg(F.sum("total").alias("total")).collect()
        sums = np.zeros((len(centroids), dimensions + 1), dtype=np.int64)
        for c, place, total in totals:
            sums[c, place + 1] = total
        some = sums[:, 0] > 0
        centroids[some] = sums[some, 1:] // sums[some, :1]
    found = durable(trees.mapInArrow(partial(_labelled, centroids=centroids), "id long, cluster int, distance long"), "clusters")
    inertia = {r["cluster"]: r["n"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("n")).collect()}
    # a row a cluster
    of = [(c, n, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c, n in sorted(inertia.items())]
    about = spark.createDataFrame(of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle() -> str:
    """DuckDB's statement of op12 over `embeddings`: a pair of tables a round."""
    near = lambda c: f"SELECT vec_id, n, v, arg_min(k, (d, k)) AS k, min(d) AS d FROM (SELECT vec_id, n, v, k, list_sum([(v[i] - c[i]) * (v[i] - c[i]) FOR i IN range(1, {DIMENSIONS + 1})])::BIGINT AS d FROM q, {c}) GROUP BY ALL"
    steps = [
        f"""q AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS n, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {DIMENSIONS})""",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS k, v AS c FROM q ORDER BY k LIMIT {CENTROIDS})",
    ]
    for r in range(ROUNDS):
        steps.append(f"a{r} AS MATERIALIZED ({near(f'c{r}').replace('GROUP BY ALL', 'GROUP BY vec_id, n, v')})")
        mean = f"SELECT k, list(m ORDER BY i) AS c FROM (SELECT k, i, floor(sum(v[i])::DOUBLE / count(*))::BIGINT AS m FROM a{r}, range(1, {DIMENSIONS + 1}) AS p(i) GROUP BY k, i) GROUP BY k"
        steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.k, coalesce(n.c, c{r}.c) AS c FROM c{r} LEFT JOIN ({mean}) AS n ON n.k = c{r}.k)")
    steps.append(f"f AS MATERIALIZED ({near(f'c{ROUNDS}').replace('GROUP BY ALL', 'GROUP BY vec_id, n, v')})")
    return f"""WITH {", ".join(steps)}
SELECT vec_id, f.k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY f.k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256 FROM f JOIN c{ROUNDS} AS c ON c.k = f.k"""


ORACLE = _oracle()
