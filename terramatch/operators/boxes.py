"""Band joins in several attributes: space is cut into cells by a k-d tree of a sample's quantiles, and both sides meet on cells."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import within
from ..session import durable
from .matching import halvings

#: Rows from which cuts are chosen, boxes of a sample that a cell may hold, cuts on a way at most.
SAMPLE_ROWS, CELL_ROWS, MOST_DEPTH = 20_000, 16, 10
#: Cells that a box may meet on average: where boxes are so wide that a cut leaves most of them on both sides, there are few cuts.
MOST_COPIES = 8
#: The share of probes that is expected to match; with the number of attributes it says how often one is cut.
EXPECTED_SHARE = 0.01


def band(value: Column, width: float) -> tuple[Column, Column]:
    """Ends of a value's band, computed as `within` does. A negative width is a share of the value."""
    half = -float(width) * value if width < 0 else F.lit(float(width))
    return value - half, value + half


def constants(values: list, kind: str) -> Column:
    """Numbers as one constant of the plan, and not as one for each."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast(f"array<{kind}>")


@dataclass
class Cuts:
    """A complete binary tree in rows of a heap: node i has children 2i + 1 and 2i + 2. A value at or over the cut goes right. A node that is not cut has the
    cut infinity, so that all goes left. Cells are the nodes of the last row."""

    names: list[str]
    depth: int
    attribute: list[int]
    cut: list[float]
    low: np.ndarray = field(repr=False)  # of cells, by attribute
    high: np.ndarray = field(repr=False)

    def _constants(self) -> tuple[Column, Column]:
        return constants(self.cut, "double"), constants(self.attribute, "int")

    def _next(self, node: Column, low: Column, high: Column) -> Column:
        cuts, at = self._constants()
        cut, lo, hi = F.get(cuts, node), F.get(low, F.get(at, node)), F.get(high, F.get(at, node))
        left, right = F.array(2 * node + 1), F.array(2 * node + 2)
        return F.when(lo >= cut, right).when(hi >= cut, F.concat(left, right)).otherwise(left)

    def cells(self, low: list[Column], high: list[Column]) -> Column:
        """The cells that a box meets."""
        low, high = (F.array(*[c.cast("double") for c in x]) for x in (low, high))
        if not self.depth:
            return F.array(F.lit(0))
        step = lambda nodes, _: F.flatten(F.transform(nodes, lambda n: self._next(n, low, high)))
        return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.array(F.lit(0)), step)

    def cell(self, values: list[Column]) -> Column:
        """The cell of a point."""
        if not self.depth:
            return F.lit(0)
        (cuts, at), value = self._constants(), F.array(*[v.cast("double") for v in values])
        step = lambda n, _: 2 * n + 1 + (F.get(value, F.get(at, n)) >= F.get(cuts, n)).cast("int")
        return F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.lit(0), step)

    def table(self, spark: SparkSession) -> DataFrame:
        """_cell, _low and _high: a row a cell, with its ends by attribute."""
        first = (1 << self.depth) - 1
        rows = [(first + i, lo.tolist(), hi.tolist()) for i, (lo, hi) in enumerate(zip(self.low, self.high, strict=True))]
        return spark.createDataFrame(rows, "_cell int, _low array<double>, _high array<double>")

    @staticmethod
    def covers(low: list[Column], high: list[Column]) -> Column:
        """Whether a box holds the cell of a row of table() whole."""
        return reduce(lambda a, b: a & b, [(lo <= F.get("_low", F.lit(i))) & (hi >= F.get("_high", F.lit(i))) for i, (lo, hi) in enumerate(zip(low, high, strict=True))])


def choose_cuts(low: np.ndarray, high: np.ndarray, names: list[str], most_depth: int = MOST_DEPTH, cell_rows: int = CELL_ROWS, share: float = EXPECTED_SHARE) -> Cuts:
    """Cuts for boxes, of which a sample is given. A cell of more than cell_rows of them is cut at the median of their middles, in the attribute that leaves
    the fewest boxes on both sides together; an attribute is cut as often as halvings() says and once more. A cell that no cut improves by
    a tenth is left, and so is one whose cut would have a box meet over MOST_COPIES cells on average: wide boxes in many attributes lie on both sides of most
    cuts, and each further row of the tree would write nearly all of them twice."""
    turns = halvings(share, len(names)) + 1
    most = min(most_depth, turns * len(names))
    hull = (low.min(axis=0), high.max(axis=0)) if len(low) else (np.full(len(names), -np.inf), np.full(len(names), np.inf))
    row: list = [(np.arange(len(low)), *hull, np.zeros(len(names), dtype=int))]
    attribute, cut, depth, copies = [], [], 0, len(low)
    while depth < most:
        chosen, below = [], []
        for rows, west, east, used in row:
            best = None
            if len(rows) > cell_rows:
                for d in np.flatnonzero(used < turns):
                    at = float(np.median((low[rows, d] + high[rows, d]) / 2))
                    left, right = rows[low[rows, d] < at], rows[high[rows, d] >= at]
                    if max(len(left), len(right)) < 0.9 * len(rows) and (best is None or len(left) + len(right) < len(best[2]) + len(best[3])):
                        best = int(d), at, left, right
            if best is None or copies + len(best[2]) + len(best[3]) - len(rows) > MOST_COPIES * len(low):
                chosen.append((0, np.inf))
                below += [(rows, west, east, np.full(len(names), turns)), (rows[:0], west, east, used)]
                continue
            d, at, left, right = best
            chosen.append((d, at))
            copies += len(left) + len(right) - len(rows)
            own = np.arange(len(names)) == d
            below += [(left, west, np.where(own, at, east), used + own), (right, np.where(own, at, west), east, used + own)]
        if all(at == np.inf for _, at in chosen):
            break
        row, depth = below, depth + 1
        attribute += [d for d, _ in chosen]
        cut += [float(at) for _, at in chosen]
    return Cuts(names, depth, attribute, cut, np.stack([b[1] for b in row]), np.stack([b[2] for b in row]))


def cuts_for(k: DataFrame, widths: dict[str, float], share: float = EXPECTED_SHARE) -> Cuts:
    """Cuts for the bands of k's rows, from SAMPLE_ROWS of them: a sample decides how evenly work is dealt, and nothing else. The hull is that of all rows."""
    names = list(widths)
    ends = [band(F.col(c).cast("double"), w) for c, w in widths.items()]
    fine = reduce(lambda a, b: a & b, [F.coalesce(~F.isnan(x), F.lit(False)) for e in ends for x in e])
    boxes = k.select(*[e[0].alias(f"l{i}") for i, e in enumerate(ends)], *[e[1].alias(f"h{i}") for i, e in enumerate(ends)]).filter(fine)
    n, flat = len(names), boxes.orderBy(F.xxhash64(*boxes.columns)).limit(SAMPLE_ROWS).toPandas().to_numpy(float).reshape(-1, 2 * len(names))
    cuts = choose_cuts(flat[:, :n], flat[:, n:], names, share=share)
    row = boxes.agg(*[F.min(f"l{i}").alias(f"l{i}") for i in range(n)], *[F.max(f"h{i}").alias(f"h{i}") for i in range(n)]).first()
    if len(flat):  # the sample's hull becomes that of all
        west, east = flat[:, :n].min(axis=0), flat[:, n:].max(axis=0)
        cuts.low = np.where(cuts.low == west, np.array(row[:n]), cuts.low)
        cuts.high = np.where(cuts.high == east, np.array(row[n:]), cuts.high)
    return cuts


def _sides(m: DataFrame, k: DataFrame, hard: list[str], widths: dict[str, float], cuts: Cuts) -> tuple[DataFrame, DataFrame]:
    """m within the hull, with its cell; k's bands, a row a cell that they meet, and one row alone, with _all, where a band holds a cell whole."""
    names = list(widths)
    values = [F.col(c).cast("double") for c in names]
    ends = [band(v, w) for v, w in zip(values, widths.values(), strict=True)]
    low, high = [e[0] for e in ends], [e[1] for e in ends]
    inside = reduce(lambda a, b: a & b, [v.between(float(cuts.low[:, i].min()), float(cuts.high[:, i].max())) for i, v in enumerate(values)])
    probe = m.filter(inside).withColumn("_cell", cuts.cell(values))
    met = k.select(*hard, *names).distinct().withColumn("_cell", F.explode(cuts.cells(low, high))).join(F.broadcast(cuts.table(k.sparkSession)), "_cell")
    # written once, so that the cuts are in no later plan
    build = durable(met.select(*hard, *names, "_cell", F.coalesce(cuts.covers(low, high), F.lit(False)).alias("_all")), "boxes")
    whole = build.filter("_all").groupBy(*hard, "_cell").agg(*[F.first(c).alias(c) for c in names], F.first("_all").alias("_all"))
    rest = build.filter("NOT _all").join(whole.select(*hard, "_cell"), [*hard, "_cell"], "left_anti")
    return probe, whole.select(*build.columns).unionByName(rest)


def kd_semi_join(m: DataFrame, k: DataFrame, hard: list[str], widths: dict[str, float], cuts: Cuts | None = None) -> DataFrame:
    """Rows of m that for at least one row of k have equal hard attributes and lie within all its bands: band_semi_join()'s rows.

    Space is cut in all attributes (see choose_cuts). A row of m has one cell; a row of k goes to each cell that its box of bands meets. They meet on hard
    attributes and cell, so a probe is compared with the boxes of its cell and not with its hard group, and a hot hard group is
    dealt to as many keys as there are cells. In a cell that one box holds whole, that box stands for all and nothing is compared.
    Rows of m outside all boxes' hull are left out while they are read.

    The cuts, at most some thousand numbers, are two constants of the plan, and cells' ends a small table. Both sides shuffle on the key or, where the bands of k are small, adaptive execution
    sends them round. NaN lies in no band; null hard attributes match nothing."""
    cuts = cuts or cuts_for(k, widths)
    probe, build = _sides(m, k, hard, widths, cuts)
    near = reduce(lambda a, b: a & b, [within(F.col(f"m.{c}"), F.col(f"k.{c}"), w) for c, w in widths.items()])
    on = reduce(lambda a, b: a & b, [F.col(f"m.{c}") == F.col(f"k.{c}") for c in [*hard, "_cell"]]) & (F.col("k._all") | near)
    return probe.alias("m").join(build.alias("k"), on, "left_semi").drop("_cell")


def comparisons(m: DataFrame, k: DataFrame, hard: list[str], widths: dict[str, float], cuts: Cuts | None = None) -> DataFrame:
    """One row: probes, in_cells and in_groups, the pairs that a join by cells and one by hard attributes alone may have to compare."""
    cuts = cuts or cuts_for(k, widths)
    probe, build = _sides(m, k, hard, widths, cuts)
    key = [*hard, "_cell"]
    per = probe.groupBy(*key).agg(F.count("*").alias("a")).join(build.filter("NOT _all").groupBy(*key).agg(F.count("*").alias("b")), key)
    one = F.lit(1).alias("_one")
    groups = m.groupBy(*(hard or [one])).agg(F.count("*").alias("a")).join(k.select(*hard, *widths).distinct().groupBy(*(hard or [one])).agg(F.count("*").alias("b")), hard or ["_one"])
    total = lambda df, name: df.agg(F.coalesce(F.sum(F.col("a") * F.col("b")), F.lit(0)).alias(name))
    return m.agg(F.count("*").alias("probes")).crossJoin(total(per, "in_cells")).crossJoin(total(groups, "in_groups"))  # a row each
