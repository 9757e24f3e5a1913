"""Band joins by cells against a plain loop over all pairs."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from terramatch.operators import boxes, matching
from terramatch.plans import queries as q

NINE = [f"f{i}" for i in range(9)]


def matches(m: pd.DataFrame, k: pd.DataFrame, hard: list[str], widths: dict[str, float]) -> set[int]:
    out = set()
    for r in m.to_dict("records"):
        for q in k.to_dict("records"):
            half = {c: -w * q[c] if w < 0 else w for c, w in widths.items()}
            if all(r[h] == q[h] for h in hard) and all(q[c] - half[c] <= r[c] <= q[c] + half[c] for c in widths):
                out.add(r["id"])
                break
    return out


def frame(n: int, seed: int) -> pd.DataFrame:
    rng = np.random.default_rng(seed)
    rows = pd.DataFrame(rng.normal(10, 2, (n, 9)), columns=NINE)
    rows.insert(0, "h", rng.choice([0, 0, 0, 1], n))  # a hot group
    rows.insert(0, "id", np.arange(n))
    return rows


@pytest.mark.parametrize("widths", [dict.fromkeys(NINE, 2.5), {**dict.fromkeys(NINE, 2.5), "f0": -0.2, "f4": -0.3, "f8": 40.0}])
def test_nine_attributes(spark, widths):
    m, k = frame(700, 1), frame(300, 2)
    m.loc[5, "f3"] = k.loc[7, "f1"] = np.nan
    sm, sk = spark.createDataFrame(m), spark.createDataFrame(k)
    got = {r.id for r in boxes.kd_semi_join(sm, sk, ["h"], widths).collect()}
    assert got == matches(m, k, ["h"], widths) and 0 < len(got) < 700
    assert got == {r.id for r in matching.band_semi_join(sm, sk, ["h"], widths).collect()}


def test_each_row_once_and_unchanged(spark):
    m, k = frame(50, 3), pd.concat([frame(50, 3)] * 3)
    got = boxes.kd_semi_join(spark.createDataFrame(m), spark.createDataFrame(k), ["h"], dict.fromkeys(NINE, 0.0)).toPandas()
    pd.testing.assert_frame_equal(got.sort_values("id", ignore_index=True), m)


@pytest.mark.parametrize("hard", [["h"], []])
def test_values_on_the_edges_of_bands(spark, hard):
    """Multiples of the width: sums and quotients are rounded to either side of an edge."""
    rng = np.random.default_rng(4)
    widths = {"a": 0.1, "b": 0.3}
    make = lambda n: pd.DataFrame({"id": np.arange(n), "h": rng.integers(0, 2, n), "a": rng.integers(-20, 20, n) * 0.1, "b": rng.integers(-9, 9, n) * 0.3})
    m, k = make(400), make(40)
    sm, sk = spark.createDataFrame(m), spark.createDataFrame(k)
    want = matches(m, k, hard, widths)
    assert {r.id for r in boxes.kd_semi_join(sm, sk, hard, widths).collect()} == want
    if hard:
        assert {r.id for r in matching.band_semi_join_binned(sm, sk, hard, widths, by="a").collect()} == want
        placed = sm.withColumn("pos", F.col("id").cast("long"))
        plain, binned = (matching.candidate_pairs(sk, placed, hard, widths, required=400, by=by).select("k_id", "m_id") for by in (None, "a"))
        assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, binned.collect()))


def test_an_edge_that_rounding_moves(spark):
    m, k = spark.createDataFrame([(1, 0, 0.4)], "id long, h int, a double"), spark.createDataFrame([(1, 0, 0.3)], "id long, h int, a double")
    assert matching.band_semi_join_binned(m, k, ["h"], {"a": 0.1}, by="a").count() == matching.band_semi_join(m, k, ["h"], {"a": 0.1}).count() == 1


def test_empty_sides_and_one_row(spark):
    m, k = spark.createDataFrame(frame(30, 5)), spark.createDataFrame(frame(30, 6))
    widths = dict.fromkeys(NINE, 1.0)
    assert boxes.kd_semi_join(m, k.limit(0), ["h"], widths).count() == boxes.kd_semi_join(m.limit(0), k, ["h"], widths).count() == 0
    assert boxes.kd_semi_join(m, m.filter("id = 3"), ["h"], widths).filter("id = 3").count() == 1


def test_cells_cut_the_work(spark):
    m, k = spark.createDataFrame(frame(4000, 7)), spark.createDataFrame(frame(2000, 8))
    n = boxes.comparisons(m, k, ["h"], dict.fromkeys(NINE, 0.5)).first()
    assert n.probes == 4000 and n.in_cells * 20 < n.in_groups


def test_a_cell_that_a_box_holds_whole_compares_nothing(spark):
    k = pd.DataFrame({"id": [0], "h": [0], "a": [0.0]})
    rng = np.random.default_rng(9)
    some = pd.DataFrame({"id": np.arange(200), "h": 0, "a": rng.uniform(-1, 1, 200)})
    both = pd.concat([k, some])
    cuts = boxes.choose_cuts(some[["a"]].to_numpy() - 0.05, some[["a"]].to_numpy() + 0.05, ["a"], share=0.999)
    wide = pd.DataFrame({"id": [1], "h": [0], "a": [0.0]})
    m, sk = spark.createDataFrame(some), spark.createDataFrame(wide)
    cuts.low[:, 0], cuts.high[:, 0] = np.maximum(cuts.low[:, 0], -2), np.minimum(cuts.high[:, 0], 2)
    assert boxes.comparisons(m, sk, ["h"], {"a": 3.0}, cuts).first().in_cells == 0
    assert boxes.kd_semi_join(m, sk, ["h"], {"a": 3.0}, cuts).count() == 200 and len(both) == 201


def test_cells_of_points_lie_in_cells_of_boxes(spark):
    rows = frame(500, 10)
    cuts = boxes.choose_cuts(rows[NINE].to_numpy() - 1, rows[NINE].to_numpy() + 1, NINE)
    v = [F.col(c) for c in NINE]
    got = spark.createDataFrame(rows).select(cuts.cell(v).alias("cell"), cuts.cells([c - 1 for c in v], [c + 1 for c in v]).alias("cells"), cuts.cells(v, v).alias("own")).collect()
    assert all(r.cell in r.cells and r.own == [r.cell] and len(set(r.cells)) == len(r.cells) for r in got) and len({r.cell for r in got}) > 8


@pytest.mark.parametrize("by", ["a", "b", ["a", "b"]])
def test_bins_of_shares(spark, by):
    """Bands that are a share of the value, with none, negative, tiny, huge and missing values among them: the rows of the plain join."""
    rng = np.random.default_rng(11)
    odd = [0.0, -0.0, -3.0, 5e-324, 1e-300, 1.7e308, np.inf, -np.inf, np.nan]
    make = lambda n: pd.DataFrame({"id": np.arange(n + 81), "h": 0, "a": np.r_[rng.integers(1, 400, n) / 100, np.repeat(odd, 9)], "b": np.r_[rng.integers(1, 90, n) / 10, odd * 9]})
    m, k = make(600), make(60)
    sm, sk = (spark.createDataFrame(x).withColumn("a", F.when(F.col("id") % 50 != 7, F.col("a"))) for x in (m, k))
    widths = {"a": -0.05, "b": -0.1}
    want = sorted(r.id for r in matching.band_semi_join(sm, sk, ["h"], widths).collect())
    got = sorted(r.id for r in matching.band_semi_join_binned(sm, sk, ["h"], widths, by=by).collect())
    assert got == want and 60 < len(want) < len(m)


def test_relative_bands_meet_on_bins(spark):
    """The query's join has cells in its key, and not the hard attributes alone."""
    plan = q.QUERIES["jon04_relative_band"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "_bin0" in plan and "_bin1" in plan


def test_wide_boxes_are_not_written_to_hundreds_of_cells(spark):
    """Boxes that lie on both sides of most cuts, as bands of about a deviation in nine attributes do: some copies each, and the same rows."""
    rng = np.random.default_rng(13)
    make = lambda n: pd.DataFrame(rng.normal(0, 1, (n, 9)), columns=NINE).assign(h=0, id=np.arange(n))
    m, k = make(300), make(1500)
    widths = dict.fromkeys(NINE, 1.2)
    sm, sk = spark.createDataFrame(m), spark.createDataFrame(k)
    cuts = boxes.cuts_for(sk, widths)
    v = [F.col(c) for c in NINE]
    met = sk.select(F.size(cuts.cells([c - 1.2 for c in v], [c + 1.2 for c in v])).alias("n")).agg(F.avg("n")).first()[0]
    assert 1 < met <= boxes.MOST_COPIES
    want = set(m.id[[bool((np.abs(k[NINE].to_numpy() - r) <= 1.2).all(axis=1).any()) for r in m[NINE].to_numpy()]])
    assert {r.id for r in boxes.kd_semi_join(sm, sk, ["h"], widths, cuts).collect()} == want and 0 < len(want) < 300


def test_cuts_are_no_literals_of_the_plan(spark):
    """A literal a cut, and two a cell and attribute, in each later plan filled the driver."""
    m, k = spark.createDataFrame(frame(400, 14)), spark.createDataFrame(frame(400, 15))
    found = boxes.kd_semi_join(m, k, ["h"], dict.fromkeys(NINE, 0.3))
    assert len(found._jdf.queryExecution().analyzed().toJSON()) < 300_000
