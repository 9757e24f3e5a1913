"""Quality classifier: overlapping heuristic labellers, an expectation-maximisation model of their accuracies, and a hashed linear scorer trained on the posterior labels (Dawid and Skene, 1979; Ratner et al., 2016)."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import durable, release_memory, text_of

FEATURE_BITS = 18
#: Documents on which the scorer is trained, the ones with the least hashes of their texts: a random sample of this size for any corpus.
TRAIN_ROWS = 6000
MOST_WORDS = 400_000

SYMBOL = re.compile(r"[#*$%&|<>{}\\^~]")
#: What may hide a word at its ends.
ENDS = "#*$%&|<>{}\\^~.,;:!?\"'()"
LONE = frozenset("|*#$%&<>{}\\^~-+=")
#: Words that insult; fixed values of a labeller.
INSULTS = frozenset("bastard clown coward cretin dimwit dumb dumbass fool freak idiot idiotic idiots imbecile loser losers lowlife moron moronic morons nitwit parasite pig scum scumbag stupid trash vermin".split())
#: Words of contempt; fixed values of a labeller.
CONTEMPT = frozenset("contemptible despicable disgusting filthy hateful loathsome pathetic repulsive revolting sickening useless worthless wretched".split())


#: Frequent words of the language of the two lists above; fixed values.
COMMON = frozenset("the of and to that is for was with are".split())

MARKS = ("", ".", ",", ";", ":", "!", "?")


def with_marks(words: frozenset[str]) -> frozenset[str]:
    return frozenset(w + m for w in words for m in MARKS)


INSULT_FORMS, CONTEMPT_FORMS = with_marks(INSULTS), with_marks(CONTEMPT)


class Text:
    """What the labellers look at; each word once."""

    def __init__(self, text: str) -> None:
        self.text, self.words = text, text.split()
        self.n = max(1, len(self.words))
        self.symbols = len(SYMBOL.findall(text))
        self.marked = sum(1 for w in self.words if SYMBOL.search(w)) if self.symbols else 0
        self.lone = sum(map(LONE.__contains__, self.words)) if self.symbols else 0
        self.upper = sum(map(str.isupper, self.words))
        self.shouts = text.count("!")
        self.distinct = set(self.words)
        self.repeats = sum(map(str.__eq__, self.words, self.words[1:]))
        # texts with many different words have many different pairs
        self.pairs = len(set(zip(self.words, self.words[1:], strict=False))) if 2 * len(self.distinct) < self.n + 2 else self.n
        self.ends = text.count(". ") + text.count(".\n") + text.count("? ") + text.count("! ") + text.endswith((".", "?", "!"))
        lower = self.distinct if text.islower() else set(map(str.lower, self.distinct))
        if self.symbols or "!!" in text:
            lower = {w.strip(ENDS) for w in lower}
        self.insults, self.contempt = len(INSULT_FORMS & lower), len(CONTEMPT_FORMS & lower)
        self.known_language = len(COMMON & lower) > 2


#: Labellers of low quality: each votes when its condition holds. The last one votes for prose.
QUALITY: dict[str, Callable[[Text], bool]] = {
    "marked_words": lambda t: t.marked > 0.15 * t.n,
    "symbols": lambda t: t.symbols > 0.03 * max(1, len(t.text)),
    "lone_symbols": lambda t: t.lone > 0.08 * t.n,
    "capitals": lambda t: t.n >= 5 and t.upper > 0.5 * t.n,
    "shouting": lambda t: t.n >= 5 and t.shouts > 0.25 * t.n,
    "same_word_again": lambda t: t.n >= 10 and t.repeats > 0.2 * t.n,
    "few_pairs": lambda t: t.n >= 20 and t.pairs < 0.5 * t.n,
    "no_words": lambda t: len(t.words) == 0,
    "prose": lambda t: t.ends >= t.n / 60 and t.symbols <= 0.01 * len(t.text) and t.upper <= 0.2 * t.n + 1,
}
TOXICITY: dict[str, Callable[[Text], bool]] = {
    "insults": lambda t: t.insults > 0,
    "contempt": lambda t: t.contempt > 0,
    "dense": lambda t: t.insults + t.contempt >= 2,
    "clean": lambda t: t.insults + t.contempt == 0 and t.known_language,
}
#: Heads whose labellers all abstain where none of them fires: word lists say nothing about a text in another language.
ABSTAIN = {"quality": False, "toxicity": True}
HEADS = {"quality": QUALITY, "toxicity": TOXICITY}
#: The column that says for each head what the given label is.
GIVEN = ("low", "toxic")
#: Documents without a label train the toxicity scorer beside the labelled ones from this posterior on.
SURE = 0.9
#: The labeller of each head that speaks for the good class.
FOR_GOOD = {"quality": "prose", "toxicity": "clean"}


def votes(text: str) -> list[int]:
    """For each head, a bit a labeller."""
    t = Text(text)
    return [sum(1 << i for i, f in enumerate(head.values()) if f(t)) for head in HEADS.values()]


def _number(name: str) -> int:
    return xxh3_64_intdigest(name) & ((1 << FEATURE_BITS) - 1)


def word_features(word: str) -> list[int]:
    """Numbers of a word's features: itself without marks at its ends, its shape, and its first letters."""
    plain = word.strip(".,;:!?\"'()").lower()
    if plain.isalpha() and len(word) - len(plain) < 2:
        shape = ("A" if word.isupper() else "Aa" if word[:1].isupper() else "a") + word[len(plain) :]
    else:
        shape = re.sub(r"(.)\1+", r"\1\1", "".join("A" if c.isupper() else "a" if c.isalpha() else "9" if c.isdigit() else c for c in word[:40]))
    return [_number(plain), _number("shape:" + shape), *(_number(f"start:{plain[:k]}") for k in (3, 4, 5, 6, 7) if len(plain) >= k)]


def text_features(words: list[str], distinct: set[str]) -> list[int]:
    """Numbers of a text's own features: size and repetition, in coarse steps."""
    n, again = len(words), sum(map(str.__eq__, words, words[1:]))
    few = n - len(set(zip(words, words[1:], strict=False))) if 2 * len(distinct) < n + 2 else 0
    return [_number(f"size:{min(n, 64).bit_length()}"), _number(f"again:{round(10 * again / max(1, n))}"), _number(f"few:{round(10 * few / max(1, n))}")]


def features(text: str) -> tuple[int, np.ndarray]:
    """Number of distinct words, and the feature numbers of them all, the text's own at the end."""
    words = text.split()
    distinct = set(words)
    return len(distinct), np.array([*(x for w in sorted(distinct) for x in word_features(w)), *text_features(words, distinct)], dtype=np.int32)


OWN = 3  # features of a text itself


def _voted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = np.array([votes(x.as_py()) for x in batch.column(0)], dtype=np.int32).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["id", "tie", *HEADS])


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [x.as_py() for x in batch.column(0)]
        both, found = np.array([votes(x) for x in texts], dtype=np.int32).reshape(-1, 2), [features(x) for x in texts]
        yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in found], type=pa.int32()), pa.array([x for _, x in found], type=pa.list_(pa.int32())), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), batch.column(1), batch.column(2)], ["distinct", "features", *HEADS, *GIVEN])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class LabelModel:
    """Rates at which labellers fire on bad and on good documents, at which given labels say bad, and the share of bad ones."""

    rates: np.ndarray  # 2 x labellers: good, bad
    bad: float
    given: np.ndarray  # good, bad
    abstain: bool = False  # whether a row in which none fires says nothing

    def posterior(self, fired: np.ndarray, given: np.ndarray | None = None) -> np.ndarray:
        """P(bad) of rows of 0 and 1. given: 1 and 0 where a label says bad or good; NaN where none is given, which counts for nothing."""
        log = [fired @ np.log(r) + (1 - fired) @ np.log(1 - r) for r in self.rates]
        votes = fired.any(axis=1) if self.abstain else 1.0
        odds = votes * (log[1] - log[0]) + np.log(self.bad) - np.log(1 - self.bad)
        if given is not None:
            says = [np.where(given > 0, np.log(g), np.log(1 - g)) for g in self.given]
            odds = odds + np.where(np.isnan(given), 0.0, says[1] - says[0])
        return _sigmoid(odds)


def fired_of(patterns: np.ndarray, labellers: int) -> np.ndarray:
    return (patterns[:, None] >> np.arange(labellers) & 1).astype(float)


def fit_labels(patterns: np.ndarray, counts: np.ndarray, labellers: list[str], for_good: str, rounds: int = 50, given: np.ndarray | None = None, abstain: bool = False) -> LabelModel:
    """Expectation-maximisation over the vote patterns of all documents and their counts. Given labels are one more labeller, which
    votes for few documents.

    It starts from: bad if any labeller of bad fires, or a label says so. A labeller is never believed to be worse than chance, which
    keeps the classes from changing places.
    """
    fired = fired_of(patterns, len(labellers))
    given = np.full(len(patterns), np.nan) if given is None else given
    good = np.array([x == for_good for x in labellers])
    q, weight = np.where(fired[:, ~good].any(axis=1) | (given > 0), 0.9, 0.05), counts / max(1, counts.sum())
    voted, labelled, says = weight * (fired.any(axis=1) | (not abstain)), weight * ~np.isnan(given), np.nan_to_num(given)
    few = 0.0001 * max(labelled.sum(), 1e-9)
    model = LabelModel(np.full((2, len(labellers)), 0.5), 0.5, np.array([0.5, 0.5]), abstain)
    for _ in range(rounds):
        mass = np.array([((1 - q) * voted).sum(), (q * voted).sum()])
        # as if ten thousandths of each class had voted by halves
        rates = np.stack([((1 - q) * voted) @ fired, (q * voted) @ fired])
        rates = np.clip((rates + 0.0005) / (mass[:, None] + 0.001), 1e-4, 1 - 1e-4)
        low, high = np.minimum(*rates), np.maximum(*rates)
        rates = np.stack([np.where(good, high, low), np.where(good, low, high)])
        given_rates = np.array([((1 - q) * labelled) @ says + few / 2, (q * labelled) @ says + few / 2]) / (np.array([((1 - q) * labelled).sum(), (q * labelled).sum()]) + few)
        model = LabelModel(rates, float(np.clip((q * weight).sum(), 1e-3, 0.6)), np.sort(np.clip(given_rates, 1e-3, 1 - 1e-3)), abstain)
        q = model.posterior(fired, given)
    return model


@dataclass
class Scorer:
    """A text's logit: weights of its distinct words' features, over the square root of their number, and of its own features."""

    weights: np.ndarray
    bias: float


def fit_scorer(rows: list[tuple[int, np.ndarray]], target: np.ndarray, rounds: int = 60, step: float = 0.5, shrink: float = 1e-4) -> Scorer:
    """Logistic regression on posterior labels, each the more probable class, by gradient steps with moments (Kingma and Ba, 2015); both
    classes weigh the same."""
    size, target = 1 << FEATURE_BITS, (target > 0.5).astype(float)
    if not rows:
        return Scorer(np.zeros(size), -1.0)
    weight = target / max(target.sum(), 1) + (1 - target) / max((1 - target).sum(), 1)

    def runs() -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
        """A few hundred texts at a time, laid out anew in each round: all of them at once would take several times the rows' memory."""
        for at in range(0, len(rows), 256):
            part = rows[at : at + 256]
            sizes = np.array([len(x) for _, x in part])
            value = np.repeat(np.array([1 / np.sqrt(max(n, 1)) for n, _ in part], dtype=np.float32), sizes)
            value[(np.cumsum(sizes)[:, None] - np.arange(1, OWN + 1)).ravel()] = 1.0
            yield slice(at, at + len(part)), np.concatenate([x for _, x in part]), np.repeat(np.arange(len(part), dtype=np.int32), sizes), value

    weights, bias, m, v, mb, vb = np.zeros(size), 0.0, np.zeros(size), np.zeros(size), 0.0, 0.0
    for i in range(1, rounds + 1):
        g, gb = shrink * weights, 0.0
        for those, flat, owner, value in runs():
            p = _sigmoid(np.bincount(owner, weights=weights[flat] * value, minlength=those.stop - those.start) + bias)
            wrong = (p - target[those]) * weight[those]
            g += np.bincount(flat, weights=wrong[owner] * value, minlength=size)
            gb += float(wrong.sum())
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        weights = weights - step * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-6)
        bias -= step * (mb / (1 - 0.9**i)) / (np.sqrt(vb / (1 - 0.99**i)) + 1e-6)
    return Scorer(weights, bias)


class WordScores(dict):
    """Of a word: the sums of its features' weights, those of the first head as the real part, of the second as the imaginary one."""

    def __init__(self, weights: np.ndarray) -> None:
        self.weights = weights

    def __missing__(self, word: str) -> complex:
        found = complex(sum(self.weights[x] for x in word_features(word)))
        if len(word) <= 64:  # longer ones are not kept
            self[word] = found
        return found


@dataclass
class Classifier:
    labels: dict[str, LabelModel]
    scorers: dict[str, Scorer]

    def __post_init__(self) -> None:
        low, toxic = self.scorers.values()
        self.words = WordScores((low.weights + 1j * toxic.weights).astype(np.complex64))
        self.bias = complex(low.bias, toxic.bias)

    def scores(self, texts: list[str]) -> np.ndarray:
        """P(bad) of the scorers, a column a head."""
        out = np.zeros(len(texts), dtype=complex)
        for i, text in enumerate(texts):
            if len(self.words) > MOST_WORDS:
                self.words.clear()
            words = text.split()
            distinct = set(words)
            # math order is fixed, so that equal texts get equal scores
            out[i] = self.bias + sum(map(self.words.__getitem__, sorted(distinct))) / max(1, len(distinct)) ** 0.5 + complex(sum(self.words.weights[x] for x in text_features(words, distinct)))
        return np.stack([_sigmoid(out.real), _sigmoid(out.imag)], axis=1)


def _known(labels: DataFrame, id_col: str) -> DataFrame:
    """id and, for each head, 1 where a label says bad, 0 where it says good, null where there is none. One row an id; of labels that
    disagree the one for bad counts."""
    said = {"low": 1 - F.col("quality").cast("int") if "quality" in labels.columns else F.lit(None).cast("int"), "toxic": F.col("toxic").cast("int") if "toxic" in labels.columns else F.lit(None).cast("int")}
    rows = labels.select(F.col(id_col).cast("long").alias("id"), *[x.alias(c) for c, x in said.items()]).filter("id IS NOT NULL AND (low IS NOT NULL OR toxic IS NOT NULL)")
    return rows.groupBy("id").agg(*[F.max(c).alias(c) for c in GIVEN])


def fit(docs: DataFrame, labels: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text", train_rows: int = TRAIN_ROWS) -> Classifier:
    """Votes of all documents are counted by pattern (some thousand patterns at most) and given label; the scorers see train_rows
    documents each, drawn by hashes, with their posterior labels.

    labels (id_col, and quality or toxic or both) are a further labeller of expectation-maximisation. Where there are any, the toxicity
    scorer trains on train_rows documents with a label and on those of the other train_rows whose posterior is over SURE: word
    lists know one language only, so without a label a document's posterior says little unless its words are in them.

    Defined results: null ids, null labels and labels of unknown ids count for nothing; with labels of one class only, the toxicity
    scorer trains as without labels; without rows, the scorers keep everything.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text")).withColumn("tie", F.xxhash64("text"))
    voted = durable(rows.select("text", "id", "tie").mapInArrow(_voted, "id long, tie long, quality int, toxicity int"), "votes")
    blank = [F.lit(None).cast("int").alias(c) for c in GIVEN]
    # a row a labelled document, of which there are few
    known = None if labels is None else durable(_known(labels, id_col), "labels")
    said = voted.select(*HEADS, *blank) if known is None else voted.join(known, "id", "left").select(*HEADS, *GIVEN)
    patterns = said.groupBy(*HEADS, *GIVEN).count().toPandas()
    models = {h: fit_labels(patterns[h].to_numpy(dtype=np.int64), patterns["count"].to_numpy(dtype=float), list(HEADS[h]), FOR_GOOD[h], given=patterns[g].to_numpy(dtype=float), abstain=ABSTAIN[h]) for h, g in zip(HEADS, GIVEN, strict=True)}

    def sample(of: DataFrame) -> dict:
        table = of.select("text", *GIVEN).mapInArrow(_featured, "distinct int, features array<int>, quality int, toxicity int, low int, toxic int").toArrow()
        out: dict = {"rows": []}
        for n, lists in zip(table.column("distinct").chunks, table.column("features").chunks, strict=True):
            ends, flat = np.asarray(lists.offsets), np.asarray(lists.values)
            out["rows"] += [(k, flat[a:b]) for k, a, b in zip(n.to_pylist(), ends, ends[1:], strict=False)]
        for h, g in zip(HEADS, GIVEN, strict=True):
            out[h] = models[h].posterior(fired_of(np.asarray(table.column(h)), len(HEADS[h])), table.column(g).to_numpy().astype(float)) if out["rows"] else np.zeros(0)
        return out

    # the documents with the least hashes, as a threshold: no text is sorted
    last = voted.select("tie").distinct().orderBy("tie").limit(train_rows).agg(F.max("tie")).first()[0]
    drawn = sample(rows.filter(F.col("tie") <= F.lit(last)).dropDuplicates(["tie"]).select("text", *blank))
    scorers = {"quality": fit_scorer(drawn["rows"], drawn["quality"])}
    if known is None or tuple(known.agg(F.min("toxic"), F.max("toxic")).first()) != (0, 1):
        scorers["toxicity"] = fit_scorer(drawn["rows"], drawn["toxicity"])
        return Classifier(models, scorers)
    # copies, so that only one sample is held at a time
    sure = [(drawn["rows"][i][0], drawn["rows"][i][1].copy()) for i in np.flatnonzero(drawn["toxicity"] > SURE)]
    sure_p = drawn["toxicity"][drawn["toxicity"] > SURE]
    del drawn
    release_memory()
    # a bounded sample of the labels by a hash of their ids, which is small enough to be sent round
    some = known.filter("toxic IS NOT NULL").orderBy(F.xxhash64("id"), "id").limit(train_rows)
    toxic = sample(rows.join(F.broadcast(some), "id"))
    scorers["toxicity"] = fit_scorer(toxic["rows"] + sure, np.concatenate([toxic["toxicity"], sure_p]))
    del toxic
    release_memory()
    return Classifier(models, scorers)


def _scored(batches: Iterator[pa.RecordBatch], weights: np.ndarray, bias: complex) -> Iterator[pa.RecordBatch]:
    classifier = Classifier({}, {"low": Scorer(weights.real, bias.real), "toxic": Scorer(weights.imag, bias.imag)})
    for batch in batches:
        scores = classifier.scores([x.as_py() for x in batch.column(1)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores[:, 0].copy()), pa.array(scores[:, 1].copy())], ["id", "text_hash", "low_quality", "toxicity"])


def classify(docs: DataFrame, labels: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text", most_low: float = 0.5, most_toxic: float = 0.35, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """A row a document: id, text_hash, low_quality and toxicity (the scorers' probabilities), kept (neither is over its limit).

    Scale: passes over the texts without a shuffle but of vote counts and of bounded samples. One weight table of fixed size (2 MB)
    goes out with the tasks.

    Defined results: a null text is the empty one; equal texts get equal scores; each row is scored by itself; a null id stays
    null; an empty table gives an empty one. Ids are whole numbers. Further columns are left out.
    """
    classifier = fit(docs, labels, id_col=id_col, text_col=text_col, train_rows=train_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("text"), F.xxhash64(text_of(text_col)).alias("text_hash"))
    scored = rows.mapInArrow(partial(_scored, weights=classifier.words.weights, bias=classifier.bias), "id long, text_hash long, low_quality double, toxicity double")
    p = [F.round(h, 6).alias(h) for h in ("low_quality", "toxicity")]
    return scored.select("id", "text_hash", *p, ((F.col("low_quality") <= most_low) & (F.col("toxicity") <= most_toxic)).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame | None = None, *, id_col: str = "doc_id", text_col: str = "text", most_low: float = 0.5, most_toxic: float = 0.35, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of docs that classify() keeps, as they are, repeated ones and null ids too. Only texts go to Python, and nothing is joined.

    Defined results: as for classify(); an empty table gives an empty one.
    """
    classifier = fit(docs, labels, id_col=id_col, text_col=text_col, train_rows=train_rows)
    weights, bias = classifier.words.weights, classifier.bias

    @F.pandas_udf("boolean")
    def good(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Classifier({}, {"low": Scorer(weights.real, bias.real), "toxic": Scorer(weights.imag, bias.imag)})
        for texts in batches:
            scores = scorer.scores(texts.tolist())
            yield pd.Series((scores[:, 0] <= most_low) & (scores[:, 1] <= most_toxic))

    return docs.filter(good(text_of(text_col)))
