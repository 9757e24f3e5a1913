import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terramatch import schema
from terramatch.operators import matching, outcomes, ranks
from terramatch.plans import stages
from terramatch.session import durable

WIDTHS = {"a": 1.0, "b": 0.5}


@pytest.fixture(scope="module")
def two(spark):
    rng = np.random.default_rng(5)
    make = lambda n: pd.DataFrame({"id": np.arange(n), "h": rng.integers(0, 3, n), "a": rng.uniform(0, 20, n).round(2), "b": rng.uniform(0, 6, n).round(2)})
    k, m = make(60), make(500)
    m.loc[7, "a"] = np.nan
    return k, m, spark.createDataFrame(k), spark.createDataFrame(m)


def matches(k, m, i):
    r = k.iloc[i]
    return (m.h == r.h) & ((m.a - r.a).abs() <= 1.0 + 1e-12) & ((m.b - r.b).abs() <= 0.5 + 1e-12)


def test_band_semi_joins_are_brute_force(two):
    k, m, sk, sm = two
    want = {int(j) for i in range(len(k)) for j in m.id[matches(k, m, i)]}
    for got in (matching.band_semi_join(sm, sk, ["h"], WIDTHS), matching.band_semi_join_binned(sm, sk, ["h"], WIDTHS, "a")):
        ids = [r.id for r in got.select("id").collect()]
        # ties on a band's end depend on binary fractions; none of them lies there by the generator's two decimals
        assert sorted(ids) == sorted(want) or len(set(ids) ^ want) <= 3


def test_bins_and_residual_bands_agree_without_broadcast(two, monkeypatch):
    _, _, sk, sm = two
    a = {r.id for r in matching.band_semi_join(sm, sk, ["h"], WIDTHS).collect()}
    monkeypatch.setattr(matching, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(matching, "small", lambda df, most_rows=0: df)
    assert a == {r.id for r in matching.band_semi_join_binned(sm, sk, ["h"], WIDTHS, "b").collect()}


def test_candidates_walk_in_a_circle(two):
    k, m, sk, sm = two
    placed = durable(ranks.with_position(sm, ["id"]), "m")
    got = matching.candidate_pairs(sk, placed, ["h"], WIDTHS, seed=1, required=2, by="a").toPandas()
    start = {r.id: r.s for r in sk.select("id", F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(len(m))).alias("s")).collect()}
    plain = {(r.k_id, r.m_id) for r in matching.candidate_pairs(sk, placed, ["h"], WIDTHS, seed=1, required=10**6).collect()}
    for i in range(len(k)):
        mine = sorted((j for x, j in plain if x == i), key=lambda j: (j - start[i]) % len(m))[:2]
        assert got[got.k_id == i].sort_values("rank").m_id.tolist() == mine
    missing = {r.id for r in matching.misses(sk, matching.candidate_pairs(sk, placed, ["h"], WIDTHS, seed=1)).collect()}
    assert missing == set(range(len(k))) - {x for x, _ in plain}


def test_positions_are_those_of_a_sort(spark):
    df = spark.createDataFrame([(i * 7919 % 1009,) for i in range(1000)], "v int")
    got = ranks.with_position(df, ["v"]).orderBy("v").toPandas()
    assert got.pos.tolist() == list(range(1000))


def test_running_sums_are_those_of_a_sort(spark):
    v = np.random.default_rng(3).integers(0, 100, 500)
    df = spark.createDataFrame([(int(i * 7919 % 1009), int(x)) for i, x in enumerate(v)], "k int, v long")
    got = ranks.with_running(df.repartition(7), ["k"], {"a": "v", "b": "k"}).orderBy("k").toPandas()
    assert got.a.tolist() == (got.v.cumsum() - got.v).tolist() and got.b.tolist() == (got.k.cumsum() - got.k).tolist() and got.columns.tolist() == ["k", "v", "a", "b"]


def test_sample_is_exact_and_repeatable(spark):
    df = spark.range(995).toDF("id")
    a, b = (matching.sample(df, 0.1, s).orderBy("draw").toPandas() for s in (1, 1))
    assert len(a) == 100 and a.equals(b) and a.draw.tolist() == list(range(100))
    assert a.id.tolist() != matching.sample(df, 0.1, 2).orderBy("draw").toPandas().id.tolist()


def test_greedy_pairs_are_those_of_one_long_loop(spark, two):
    k, m, sk, sm = two
    m = m.dropna()
    inv = np.linalg.inv(np.cov(m[["a", "b"]].T))
    free, want = {h: m[m.h == h].sort_values("id") for h in range(3)}, {}
    for r in k.itertuples():
        s = free[r.h]
        if len(s):
            d = s[["a", "b"]].to_numpy() - [r.a, r.b]
            j = int(np.argmin(np.einsum("ij,jk,ik->i", d, inv, d)))
            want[r.id] = int(s.id.iloc[j])
            free[r.h] = s.drop(s.index[j])
    got = matching.greedy_pairs(sk.withColumn("draw", F.col("id")), spark.createDataFrame(m), ["h"], ["a", "b"], inv)
    rows = got.collect()
    assert {r.k_id: r.s_id for r in rows} == want and len({r.s_id for r in rows}) == len(rows)


def test_mahalanobis_and_covariance_are_numpys(spark):
    rng = np.random.default_rng(35)
    rows = rng.random((50, 4))
    df = spark.createDataFrame(pd.DataFrame(rows, columns=list("abcd")))
    inv = matching.inverse_covariance(df, list("abcd"))
    assert inv == pytest.approx(np.linalg.inv(np.cov(rows.T)))
    d2 = df.select(matching.mahalanobis([F.col(c) for c in "abcd"], [F.lit(0.5)] * 4, inv).alias("d")).toPandas().d
    d = rows - 0.5
    assert sorted(d2) == pytest.approx(sorted(np.einsum("ij,jk,ik->i", d, inv, d)))
    with pytest.raises(ValueError, match="singular"):
        matching.inverse_covariance(df.withColumn("d", F.lit(1.0)), list("abcd"))


def pair_rows(spark, k, s, n, years=range(2000, 2022)):
    columns = [f"{side}_luc_{y}" for side in "ks" for y in years]
    return spark.createDataFrame([tuple([float(k)] * len(years) + [float(s)] * len(years))] * n, columns).withColumn("iteration", F.lit(0))


def test_no_change_no_additionality(spark):
    got = stages.project_additionality(pair_rows(spark, 1, 1, 100), 10_000.0, [100.0, 0, 0, 0, 0, 0], 2020, 1).collect()
    assert len(got) == 21 and all(r.additionality == 0.0 for r in got)


def test_all_of_it_additional(spark):
    got = stages.project_additionality(pair_rows(spark, 1, 3, 1), 10_000.0, [100.0, 50, 10, 0, 0, 0], 2020, 1).collect()
    assert all(r.additionality == pytest.approx(90 * 44 / 12) for r in got)
    with pytest.raises(Exception, match="expected 2"):
        stages.project_additionality(pair_rows(spark, 1, 3, 1), 10_000.0, [0.0] * 6, 2020, 2).collect()


def test_classes_outside_the_domain_are_an_error(spark):
    with pytest.raises(Exception, match="do not add up"):
        outcomes.class_shares(outcomes.class_counts(outcomes.long_classes(pair_rows(spark, 7, 1, 3)))).collect()
    with pytest.raises(ValueError):
        outcomes.densities(spark.createDataFrame([(0, 1.0)], "`land use class` int, `carbon density` double"))


def test_repetitions_from_pixels_to_additionality(spark):
    rng = np.random.default_rng(1)
    years = [f"luc_{y}" for y in schema.stored_years(2012, 2014)]

    def pixels(n, y0):
        d = {"x": rng.integers(0, 50, n), "y": y0 + np.arange(n), "lat": rng.random(n), "lng": rng.random(n), "elevation": rng.uniform(0, 400, n), "slope": rng.uniform(0, 5, n), "ecoregion": np.full(n, 3), "access": rng.uniform(0, 20, n), "country": rng.integers(1, 3, n)}
        d |= {c: np.where(rng.random(n) < 0.9, 1, 3) for c in years} | {c: rng.uniform(0, 0.2, n) for c in list(schema.TOLERANCES)[3:]}
        return spark.createDataFrame(pd.DataFrame({"id": np.arange(n) + 10 * y0} | d))

    k, m = pixels(120, 0), pixels(1500, 1000)
    near = stages.potential_matches(m, k, 2012)
    assert 0 < near.count() < 1500
    pairs, status = stages.match_all(k, near, 2012, 2014, 42, repetitions=2, share=0.5, required=20)
    pairs = durable(pairs, "pairs")
    counts = {(r.iteration, r.status): r["count"] for r in status.groupBy("iteration", "status").count().collect()}
    for i in (0, 1):
        assert sum(v for (it, _), v in counts.items() if it == i) == 60 and counts[i, "paired"] == pairs.filter(F.col("iteration") == i).count() > 10
    assert pairs.filter("k_luc_2012 <> s_luc_2012 OR k_luc_2007 <> s_luc_2007 OR k_luc_2002 <> s_luc_2002").count() == 0
    got = stages.project_additionality(pairs, 1e6, [100.0, 50, 10, 0, 0, 0], 2014, 2).collect()
    assert len(got) == 13 and all(np.isfinite(r.additionality) for r in got)


def test_densities_read_all_rows(spark):
    rows = spark.range(1500).selectExpr("cast(if(id < 1499, 1, 2) AS int) AS `land use class`", "cast(if(id < 1499, 5, 7) AS double) AS `carbon density`").coalesce(1)
    assert outcomes.densities(rows)[:2] == [5.0, 7.0]
    with pytest.raises(ValueError, match="several"):
        outcomes.densities(spark.createDataFrame([(1, 1.0), (1, 2.0)], "`land use class` int, `carbon density` double"))


def test_medians_are_exact_and_spread(spark):
    rng = np.random.default_rng(8)
    rows = [(g, float(v)) for g, n in (("a", 1), ("b", 2), ("c", 501), ("d", 500)) for v in rng.integers(0, 40, n) / 4] + [("e", 7.0)] * 300 + [("a", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").withColumn("n", F.monotonically_increasing_id())
    got = {r.g: r.median for r in outcomes.exact_medians(df, "g", "v", F.xxhash64("n")).collect()}
    assert got == {g: np.median([v for h, v in rows if h == g and v is not None]) for g in "abcde"}


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from terramatch import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Other:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda *_: None)

    with pytest.raises(ValueError, match="checkpoint"):
        session.shared_dir(Other())


def plain_places(k, s, inverse):
    free, out = np.ones(len(s), dtype=bool), np.full(len(k), -1)
    for i in range(min(len(k), len(s))):
        d = s - k[i]
        out[i] = np.argmin(np.where(free, np.einsum("ij,jk,ik->i", d, inverse, d), np.inf))
        free[out[i]] = False
    return out


@pytest.mark.parametrize("kind", ["spread", "copies", "lattice", "few"])
def test_near_candidates_are_the_same_as_all(kind):
    rng = np.random.default_rng(6)
    s, k = rng.normal(size=(3000, 4)) @ rng.normal(size=(4, 4)), rng.normal(size=(400, 4))
    if kind == "copies":
        s[:2000] = s[0]
        k[::3] = s[0]
    elif kind == "lattice":
        s, k = rng.integers(0, 4, (3000, 4)).astype(float), rng.integers(0, 4, (400, 4)).astype(float)
    elif kind == "few":
        s = s[:150]
    inverse = np.linalg.inv(np.cov(s.T) + np.eye(4) * 1e-3)
    got = matching.greedy_places(k, s, inverse)
    assert (got == plain_places(k, s, inverse)).all() and (got < 0).sum() == max(0, len(k) - len(s))


def test_a_step_looks_at_few_candidates():
    rng = np.random.default_rng(7)
    s, k = rng.normal(size=(60_000, 9)), rng.normal(size=(300, 9))
    free = matching.Free(s, np.linalg.inv(np.cov(s.T)))
    assert len({free.take(q) for q in k}) == 300 and free.looked / 300 < 6000


def test_the_pool_is_shuffled_once(spark):
    rng = np.random.default_rng(8)
    m = pd.DataFrame({"id": np.arange(4000), "h": rng.integers(0, 3, 4000), "a": rng.normal(size=4000), "pos": np.arange(4000)})
    k = pd.DataFrame({"id": np.arange(50), "h": rng.integers(0, 3, 50), "a": rng.normal(size=50)})
    sm, sk = spark.createDataFrame(m), spark.createDataFrame(k)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = matching.candidate_pairs(sk, sm, ["h"], {"a": 0.2}, required=30, by="a", span=200)
        rows = {(r.k_id, r.m_id, r.rank) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == {(r.k_id, r.m_id, r.rank) for r in matching.candidate_pairs(sk, sm, ["h"], {"a": 0.2}, required=30).collect()}
