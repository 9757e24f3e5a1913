"""Outcomes of matched pairs: class shares, carbon stocks, additionality and leakage, balance, carbon densities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import BIOMASS_FACTOR, CARBON_SHARE, CO2_PER_CARBON, LandUse
from ..session import durable
from .grid import uniform_3x3
from .ranks import with_position


def long_classes(pairs: DataFrame, iteration: Column | None = None) -> DataFrame:
    """iteration, side, year, luc from wide pairs with k_luc_<year> and s_luc_<year>."""
    columns = [c for c in pairs.columns if c[:6] in ("k_luc_", "s_luc_")]
    it = iteration if iteration is not None else F.col("iteration")
    long = pairs.select(it.alias("iteration"), *[F.col(c).cast("double").alias(c) for c in columns]).unpivot("iteration", columns, "name", "luc")
    return long.select("iteration", F.substring("name", 1, 1).alias("side"), F.substring_index("name", "_", -1).cast("int").alias("year"), F.col("luc").cast("int").alias("luc"))


def class_counts(classes: DataFrame) -> DataFrame:
    """iteration, side, year, total, n1..n6: classes outside the domain count in the total only."""
    counts = [F.count_if(F.col("luc") == c.value).alias(f"n{c.value}") for c in LandUse]
    return classes.groupBy("iteration", "side", "year").agg(F.count("*").alias("total"), *counts)


def class_shares(counts: DataFrame, check: bool = True) -> DataFrame:
    """p1..p6. With check, shares that don't add up to 1 (a class outside the domain) are an error."""
    shares = {f"p{c.value}": F.col(f"n{c.value}") / F.col("total") for c in LandUse}
    out = counts.select("iteration", "side", "year", *[v.alias(k) for k, v in shares.items()])
    if not check:
        return out
    total = reduce(lambda a, b: a + b, [F.col(p) for p in shares])
    ok = (total > 0.99) & (total < 1.01)
    return out.withColumn("p1", F.when(ok, F.col("p1")).otherwise(F.raise_error(F.lit("class shares do not add up to 1")).cast("double")))


def densities(rows: DataFrame, luc: str = "land use class", density: str = "carbon density") -> list[float]:
    """Six densities by class from a table of a few rows; a class that is missing has 0, one outside the domain or with several
    densities is an error."""
    out = [0.0] * len(LandUse)
    given = rows.select(F.col(f"`{luc}`").cast("int").alias("luc"), F.col(f"`{density}`").cast("double").alias("density"))
    # a row a class: of one row more than there are classes, one is outside the domain
    for c, n, v in given.groupBy("luc").agg(F.count_distinct("density"), F.max("density")).limit(len(LandUse) + 1).collect():
        if n > 1:
            raise ValueError(f"land use class {c} has several densities")
        out[LandUse(c) - 1] = v
    return out


def carbon_stock(shares: DataFrame, area_m2: float, density: list[float]) -> DataFrame:
    """iteration, side, year, stock in tonnes of carbon dioxide."""
    terms = [F.col(f"p{c.value}") * (area_m2 / 10000.0) * float(density[c.value - 1]) for c in LandUse]
    return shares.select("iteration", "side", "year", (reduce(lambda a, b: a + b, terms) * CO2_PER_CARBON).alias("stock"))


def additionality(stocks: DataFrame, treatment: str = "k", control: str = "s", end: int | None = None) -> DataFrame:
    """year, treatment, control, additionality: means over iterations and their difference. Years that one side lacks are left out."""
    kept = stocks if end is None else stocks.filter(F.col("year") <= end)
    mean = lambda side: F.avg(F.when(F.col("side") == side, F.col("stock")))
    out = kept.groupBy("year").agg(mean(treatment).alias("treatment"), mean(control).alias("control")).dropna()
    return out.withColumn("additionality", F.col("treatment") - F.col("control"))


def assert_iterations(pairs: DataFrame, expected: int) -> DataFrame:
    """pairs, if they come from the expected number of iterations; else an error when they are read."""
    found = pairs.agg(F.count_distinct("iteration").alias("_found"))
    ok = F.when(F.col("_found") == expected, F.col("iteration")).otherwise(F.raise_error(F.lit(f"expected {expected} iterations")).cast("int"))
    return pairs.join(F.broadcast(found)).withColumn("iteration", ok).drop("_found")  # a row of one number


def balance(pairs: DataFrame, features: list[str], by: str = "pair_id") -> DataFrame:
    """by, feature, smd: standardised mean differences of k_<feature> and s_<feature>, to 8 places."""
    aggs = [f(F.col(f"{side}_{c}")).alias(f"{name}_{side}_{i}") for i, c in enumerate(features) for side in "ks" for name, f in (("m", F.avg), ("s", F.stddev_samp))]
    wide = pairs.groupBy(by).agg(*aggs)
    smd = lambda i: F.round(F.abs(F.col(f"m_k_{i}") - F.col(f"m_s_{i}")) / F.sqrt((F.col(f"s_k_{i}") * F.col(f"s_k_{i}") + F.col(f"s_s_{i}") * F.col(f"s_s_{i}")) / 2.0), 8)
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), smd(i).alias("smd")) for i, c in enumerate(features)])
    return wide.select(by, F.explode(rows).alias("r")).select(by, "r.*")


def exact_medians(rows: DataFrame, group: str, value: str, tie: Column) -> DataFrame:
    """group, median: exact, from the global order of (group, value): no task holds a group's values, whose middle one or two are found by their
    positions. tie tells rows of one value apart, so that very many of them spread over tasks. Nulls don't count."""
    placed = durable(with_position(rows.filter(F.col(value).isNotNull() & F.col(group).isNotNull()).select(group, value, tie.alias("_tie")), [group, value, "_tie"]), "positions")
    sizes = placed.groupBy(group).agg(F.min("pos").alias("_first"), F.count("*").alias("_n"))
    middle = placed.join(sizes, group).filter((2 * (F.col("pos") - F.col("_first")) >= F.col("_n") - 2) & (2 * (F.col("pos") - F.col("_first")) <= F.col("_n")))
    low, high = F.floor((F.col("_n") - 1) / 2), F.floor(F.col("_n") / 2)
    inner = middle.filter((F.col("pos") - F.col("_first")).between(low, high))
    return inner.groupBy(group).agg(F.avg(value).alias("median"))


def carbon_density(shots: DataFrame, classes: DataFrame) -> DataFrame:
    """luc, density: the exact median above-ground biomass of shots (x, y, agbd) on pixels whose 3x3 cells agree, as carbon of all pools."""
    met = shots.join(uniform_3x3(classes).withColumnRenamed("value", "luc"), ["x", "y"])
    medians = exact_medians(met, "luc", "agbd", F.xxhash64("x", "y"))
    return medians.select("luc", (F.col("median") * BIOMASS_FACTOR * CARBON_SHARE).alias("density"))


def good_shots(shots: DataFrame, start: str = "2020-01-01", end: str = "2021-01-01") -> DataFrame:
    """Shots of full-power beams, not degraded, of good quality, from start until before end."""
    good = (F.col("beam_type") == "full") & (F.col("degrade_flag") == 0) & (F.col("l4_quality_flag") == 1)
    return shots.filter(good & (F.col("absolute_time") >= F.lit(start).cast("timestamp")) & (F.col("absolute_time") < F.lit(end).cast("timestamp")))
