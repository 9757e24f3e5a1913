"""The pipeline stage by stage, on the smallest tables."""

import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__
import corpus_pipeline
from terramatch.llm import common, queries

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = queries.documents(spark, DATA)
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = common.durable(stage(spark, docs, DATA), name)
        out.append((name, docs))
    return dict(out)


def texts(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_columns_stay_until_the_last_stage(stages):
    names = list(stages)
    assert all(stages[n].columns == stages["documents"].columns for n in names[:-1]) and "sequence_id" in stages[names[-1]].columns
    assert all(stages[n].schema["n_chars"].dataType == stages["documents"].schema["n_chars"].dataType for n in names[:-1])


def test_clean_documents_pass_the_classifier(spark, stages):
    kept = {r.doc_id for r in stages["quality"].collect()}
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    clean, bad = {r.doc_id for r in labels if r.quality and not r.toxic}, {r.doc_id for r in labels if not r.quality}
    assert len(clean & kept) >= 0.97 * len(clean) and len(bad & kept) <= 0.35 * len(bad)


def test_lines_by_brute_force(stages):
    before, after = texts(stages["quality"]), {i: t for i, t, _ in texts(stages["lines"])}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    found = defaultdict(set)
    for i, t, _ in before:
        for x in t.split("\n"):
            if len(key(x)) >= 40:
                found[key(x)].add(i)
    for i, t, _ in before:
        assert after[i] == "\n".join(x for x in t.split("\n") if not (len(found[key(x)]) >= 5 and max(found[key(x)]) != i))


def test_near_duplicates_by_brute_force(stages):
    before = {i: t for i, t, _ in texts(stages["lines"])}
    sets = {}
    for i, t in before.items():
        w = t.lower().split()
        k = min(5, len(w))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if w else frozenset()
    root = {i: i for i in before}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(before)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0:
                root[max(find(a), find(b))] = min(find(a), find(b))
    assert sorted(i for i, *_ in texts(stages["near_duplicates"])) == sorted({find(i) for i in ids})


def test_mix_takes_rows_up_to_three_times(stages):
    before, after = {i: (t, s) for i, t, s in texts(stages["near_duplicates"])}, Counter(i for i, *_ in texts(stages["mix"]))
    assert set(after) <= set(before) and max(after.values()) <= 3
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    assert sum(size(before[i][0]) * n for i, n in after.items()) == pytest.approx(sum(size(t) for t, _ in before.values()), rel=0.15)


def test_all_that_was_mixed_is_packed(stages):
    pieces = stages["pack"].collect()
    copies = Counter(i for i, *_ in texts(stages["mix"]))
    total = Counter()
    for p in pieces:
        total[p.doc_id] += p.length
    tokens = {p.doc_id: p.doc_tokens for p in pieces}
    assert total == Counter({i: n * tokens[i] for i, n in copies.items()})


def test_it_is_registered_and_repeats(spark, stages):
    assert "pipeline" in __spark_entry__.queries() and {f"op{i}" for i in range(1, 11)} == {q.split("_")[0] for q in queries.QUERIES}
    run = corpus_pipeline.run(spark, DATA)
    assert sorted(map(tuple, run.select("doc_id", "length").collect())) == sorted(map(tuple, stages["pack"].select("doc_id", "length").collect()))


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls in every column, empty and long texts, repeated rows, further columns, and no rows at all."""
    long = " ".join(f"word{i % 997}x{i % 13}," for i in range(20_000))
    rows = [(1, "a b c d e f g", "en", "s1", 13)] * 2 + [(2, None, None, "s1", None), (3, "", "en", None, 0), (None, "a b c d e f g h i", "en", "s2", 1), (None, None, None, None, None), (4, long, "fr", "s2", len(long)), (2, "other text\nof id two", "en", "s1", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS row", "2 AS key", "3 AS size", "4 AS kept", "5 AS id", "6 AS node")
    spark.createDataFrame([(1, 1, 0), (None, 0, 1), (9, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for some in (df, df.limit(0)):
        docs = common.durable(some, "odd")
        for name, stage in corpus_pipeline.STAGES:
            before, docs = docs, common.durable(stage(spark, docs, str(tmp_path)), name)
            if name != "pack":
                assert docs.columns == before.columns, name
                assert name == "mix" or docs.count() <= before.count()
            if some is not df:
                assert docs.count() == 0, name


def test_long_line_and_empty_texts_through_lines(spark):
    shared = "x" * 50
    df = spark.createDataFrame([(i, f"{shared}\n" * (i + 1)) for i in range(6)] + [(9, None)], "doc_id long, text string").selectExpr("*", "length(text) AS n_chars")
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.lines(spark, df, "").collect()}
    assert got[9] == (None, None) and got[5][0] == f"{shared}\n" * 6 and all(got[i] == ("", 0) for i in range(5))
