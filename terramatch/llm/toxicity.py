"""Toxicity by compression distance: zstandard dictionaries trained on toxic and on ordinary text, windows compressed with both, and what the differences of their lengths say of a text (after Frank, Chui and Witten, 2000)."""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WorkerTable, durable, text_of

#: Labelled texts of each class that train the dictionaries, the ones with the least hashes, and windows of one text that may.
TRAIN_ROWS, TRAIN_WINDOWS = 3000, 2000
#: Bytes of a dictionary's own part, of the part that both have, and of the segments that the trainer picks.
PART, BASE, SEGMENT = 1 << 14, 1 << 14, 64
#: Characters of a beginning at least and of a window at most, windows whose difference a worker keeps, parts of the training texts.
LEAST_CHARS, MOST_CHARS, MOST_KEPT, FOLDS = 3, 24, 400_000, 4
#: The level at which the compressor looks for matches in a dictionary.
LEVEL = 9
#: Differences are counted from -EDGE to EDGE bytes; what lies beyond counts as the edge.
EDGE = 24
#: A beginning is one of toxic text when the logarithm of its odds is over EVIDENCE by two standard errors; a text is called toxic from THRESHOLD on.
EVIDENCE, THRESHOLD = 1.0, 0.3

TOKEN = re.compile(rf"[^\W_]{{1,{MOST_CHARS}}}")
#: What follows each window, and ends each dictionary: a match that always pays, without which short windows would be stored as they are.
TAIL = bytes(range(1, 25))


def windows(text: str) -> set[str]:
    """The different words of a whole text in lower case, longer ones in pieces of MOST_CHARS characters."""
    return set(TOKEN.findall(text.lower()))


def laid_out(window: str) -> bytes:
    """For each character four bytes, a code of the window up to it: what two windows share is how they begin, and nothing else."""
    code, out = 0, []
    for c in window:
        code = zlib.crc32(c.encode("utf-8", "surrogatepass"), code)
        out.append(code)
    return array("I", out).tobytes()


def trained(samples: Iterable[str], size: int) -> bytes:
    """Content of a dictionary trained on windows. Where they are too few for the trainer, they are it, as far as they fit."""
    rows = [laid_out(w) for w in samples]
    whole = b"".join(rows)
    if len(whole) > size:
        try:
            return zstandard.train_dictionary(size, rows, k=SEGMENT, d=8).as_bytes()
        except zstandard.ZstdError:
            pass
    return whole[-size:]


class Lengths:
    """How many bytes more a window takes with the dictionary of ordinary text than with the one of toxic text; kept for windows met before."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        params = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=len(TAIL) + 4 * MOST_CHARS, dict_size=PART + BASE, write_content_size=False, write_checksum=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS)

        def compressor(content: bytes):
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=params)
            return zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress

        self.toxic, self.ordinary, self.kept = compressor(toxic), compressor(ordinary), {}

    def of(self, window: str) -> int:
        found = self.kept.get(window)
        if found is None:
            x = laid_out(window) + TAIL
            found = max(-EDGE, min(EDGE, len(self.ordinary(x)) - len(self.toxic(x))))
            if len(self.kept) >= MOST_KEPT:
                self.kept.clear()
            self.kept[window] = found
        return found

    def histogram(self, found: Iterable[str]) -> np.ndarray:
        """For each difference from -EDGE to EDGE, how many windows have it."""
        return np.bincount(np.array([self.of(w) + EDGE for w in found], dtype=np.int64), minlength=2 * EDGE + 1)


def surplus(above: np.ndarray, n: np.ndarray, rate: float) -> np.ndarray:
    """How far a count is over the n * rate that ordinary text has, as the root of its Poisson deviance, signed."""
    expected = np.maximum(n, 1) * rate
    deviance = above * np.log(np.maximum(above, 1e-9) / expected) - (above - expected)
    return np.sign(above - expected) * np.sqrt(2 * np.maximum(deviance, 0))


def beginnings(text: Iterable[str]) -> set[str]:
    return {w[:k] for w in text for k in range(LEAST_CHARS, len(w) + 1)}


def without_near_copies(texts: Iterable[list[str]], least: int = 8, keys: int = 3) -> list[list[str]]:
    """Texts none of which shares one of its `keys` least-hashed long words with one before: a text that was copied with small changes speaks once."""
    met, out = set(), []
    for x in texts:
        own = set(sorted(zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in x if len(w) >= least)[:keys])
        if not own & met:
            met |= own
            out.append(x)
    return out


class Beginnings:
    """In how many texts of either class, fold by fold, each beginning stands that at least two toxic texts have."""

    def __init__(self, toxic: list[list[str]], ordinary: list[list[str]]) -> None:
        met = Counter(b for x in toxic for b in beginnings(x))
        self.place = {b: i for i, b in enumerate(b for b, n in met.items() if n > 1)}
        self.texts = np.array([[len(c[f::FOLDS]) for c in (toxic, ordinary)] for f in range(FOLDS)])
        self.found = np.zeros((FOLDS, 2, len(self.place)), dtype=np.int32)
        for c, texts in enumerate((toxic, ordinary)):
            for i, x in enumerate(texts):
                self.found[i % FOLDS, c, [self.place[b] for b in beginnings(x) & self.place.keys()]] += 1

    def evidence(self, without: int | None = None) -> dict[str, float]:
        """The logarithm of the odds of each beginning, less two standard errors, from all folds but one."""
        used = [f for f in range(FOLDS) if f != without]
        (n, o), (texts, others) = self.found[used].sum(axis=0) + 0.5, self.texts[used].sum(axis=0) + 1
        return dict(zip(self.place, np.log(n / texts) - np.log(o / others) - 2 * np.sqrt(1 / n + 1 / o), strict=True))


def contrasting(toxic: list[list[str]], evidence: dict[str, float]) -> list[str]:
    """What the toxic dictionary is trained on: of each window of toxic texts the beginning for which most speaks, the longest of equals, where that is
    beyond doubt; once a text."""
    speaks = lambda b: (evidence.get(b, -np.inf), len(b))
    best = ({max((w[:k] for k in range(LEAST_CHARS, len(w) + 1)), key=speaks, default="") for w in x} for x in toxic)
    return [b for x in best for b in sorted(x) if speaks(b)[0] > EVIDENCE]


def dictionaries(toxic: list[list[str]], ordinary: list[list[str]], evidence: dict[str, float]) -> tuple[bytes, bytes]:
    """Of toxic and of ordinary text: each a part of its own before one that both have, so that ordinary windows compress alike."""
    common = trained([w for x in ordinary[::2] for w in x], BASE) + TAIL
    return trained(contrasting(toxic, evidence), PART) + common, trained([w for x in ordinary[1::2] for w in x], PART) + common


@dataclass
class Model:
    toxic: bytes
    ordinary: bytes
    threshold: int  # a difference from which on a window counts
    rate: float  # of such windows in ordinary text
    slope: float
    bias: float

    def scores(self, lengths: Lengths, texts: Iterable[str]) -> np.ndarray:
        counts = np.array([lengths.histogram(windows(x)) for x in texts]).reshape(-1, 2 * EDGE + 1)
        return sigmoid(self.slope * surplus(counts[:, EDGE + self.threshold :].sum(axis=1), counts.sum(axis=1), self.rate) + self.bias)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50, shrink: float = 0.05) -> tuple[float, float, float]:
    """Slope, bias and loss of a logistic regression on one number, by Newton's steps."""
    m, w = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(rounds):
        p = sigmoid(m @ w)
        w = w - np.linalg.solve(m.T @ (m * (weight * p * (1 - p))[:, None]) + shrink * np.eye(2), m.T @ (weight * (p - y)) + shrink * w)
    p = np.clip(sigmoid(m @ w), 1e-9, 1 - 1e-9)
    return float(w[0]), float(w[1]), float(-(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum())


def fit_model(toxic: list[list[str]], ordinary: list[list[str]], share: float = 0.5) -> Model | None:
    """From the windows of texts of either class; share: of toxic ones in the population. Thresholds are calibrated on texts that their dictionaries
    have not seen: each of FOLDS parts is measured with dictionaries of the others. Without texts of both classes there is no model."""
    toxic, ordinary = without_near_copies(toxic), without_near_copies(ordinary)
    if not toxic or not ordinary:
        return None
    met, counts, labels = Beginnings(toxic, ordinary), [], []
    for f in range(FOLDS):
        rest = [[x for j, x in enumerate(texts) if j % FOLDS != f] for texts in (toxic, ordinary)]
        lengths = Lengths(*dictionaries(*rest, met.evidence(f)))
        for label, texts in ((1.0, toxic[f::FOLDS]), (0.0, ordinary[f::FOLDS])):
            for x in texts:
                counts.append(lengths.histogram(x))
                labels.append(label)
    counts, y = np.array(counts), np.array(labels)
    # a sample has as many texts of either class as it may; the population has not
    weight = np.where(y > 0, share / len(toxic), (1 - share) / len(ordinary)) * len(y)
    n, best = counts.sum(axis=1), None
    for threshold in range(1, EDGE + 1):
        above = counts[:, EDGE + threshold :].sum(axis=1)
        rate = float((above[y == 0].sum() + 0.5) / (n[y == 0].sum() + 1))
        slope, bias, loss = logistic(surplus(above, n, rate), y, weight)
        if best is None or loss < best[0]:
            best = loss, threshold, rate, slope, bias
    return Model(*dictionaries(toxic, ordinary, met.evidence()), *best[1:])


def held_out(id_col: str) -> Column:
    """Whether a row is kept from training: by the checksum of its id as text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 4 == 2


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each text the windows with the least checksums, as many as may train."""
    for batch in batches:
        some = [" ".join(sorted(windows(x.as_py()), key=lambda w: (zlib.crc32(w.encode("utf-8", "surrogatepass")), w))[:TRAIN_WINDOWS]) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(some, type=pa.string())], ["toxic", "tie", "windows"])


def fit(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> Model | None:
    """A model from at most train_rows labelled texts of each class, those with the least hashes of their ids; no text that held_out() names is
    among them. Only their windows come to the driver, TRAIN_WINDOWS of a text at most."""
    said = labels.select(F.col(id_col).cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic")).filter("id IS NOT NULL AND toxic IN (0, 1)").filter(~held_out("id"))
    known = durable(said.groupBy("id").agg(F.max("toxic").alias("toxic")).withColumn("tie", F.xxhash64("id")), "toxic-labels")
    size = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(size) < 2:
        return None
    drawn = known.filter("toxic = 1").orderBy("tie", "id").limit(train_rows).unionByName(known.filter("toxic = 0").orderBy("tie", "id").limit(train_rows))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    met = rows.join(F.broadcast(drawn), "id").groupBy("toxic", F.xxhash64("text").alias("same")).agg(F.min("tie").alias("tie"), F.min("text").alias("text"))
    table = met.orderBy("tie", "same").limit(2 * train_rows).select("toxic", "tie", "text").mapInArrow(_sampled, "toxic int, tie long, windows string").toArrow()
    found = sorted(zip(table.column(1).to_pylist(), table.column(0).to_pylist(), table.column(2).to_pylist(), strict=True))
    texts = {c: [[sys.intern(w) for w in x.split(" ") if w] for _, label, x in found if label == c] for c in (1, 0)}
    return fit_model(texts[1], texts[0], size[1] / (size[0] + size[1]))


def _scored(batches: Iterator[pa.RecordBatch], model: Model | None, table: WorkerTable) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = (x.as_py() for x in batch.column(1))
        scores = np.zeros(batch.num_rows) if model is None else model.scores(table.get(), texts)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, type=pa.float64())], ["id", "score"])


def score_toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """A row a document: id_col, held_out, score (0 to 1, of its text alone), predicted (1 from the threshold on).

    Scale: one pass over the texts without a shuffle; the model, two dictionaries of PART + BASE bytes and four numbers, goes out with the tasks. A
    worker keeps the differences of MOST_KEPT windows. Training reads the labelled texts that a bounded list of ids names.

    Defined results: a null text is the empty one, which has no windows; equal texts get equal scores; null ids and null labels train nothing; of labels
    that disagree the toxic one counts; without labels of both classes every score is 0. Each row is scored by itself; an empty table gives an empty
    one. Ids are whole numbers. Further columns are left out.
    """
    model = fit(docs, labels, id_col=id_col, text_col=text_col, train_rows=train_rows)
    table = WorkerTable(partial(Lengths, model.toxic, model.ordinary) if model else dict)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"))
    scored = rows.mapInArrow(partial(_scored, model=model, table=table), "id long, score double")
    return scored.select(F.col("id").alias(id_col), held_out("id").alias("held_out"), F.round("score", 6).alias("score"), (F.round("score", 6) >= threshold).cast("int").alias("predicted"))
