"""Permanence: net sequestration, releases, schedules, cost interpolation, damage, equivalent permanence. Series have columns year, value.

Windows over a yearly series run in one task: a series has a row a year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Discount a year, years over which a release is averaged, the first year of the cost series, the schedule's horizon.
DISCOUNT, RELEASE_YEARS, FIRST_COST_YEAR, HORIZON = 0.03, 5, 2005, 3999



def checked(condition: Column, value: Column, message: str) -> Column:
    """value, or an error."""
    return F.when(condition, value).otherwise(F.raise_error(F.lit(message)).cast("double"))


def difference(additionality: DataFrame, leakage: DataFrame) -> DataFrame:
    """year, value: additionality less leakage. Series of different years are an error."""
    met = additionality.alias("a").join(leakage.alias("l"), "year", "full")
    both = F.col("a.value").isNotNull() & F.col("l.value").isNotNull()
    return met.select("year", checked(both, F.col("a.value") - F.col("l.value"), "additionality and leakage are not of the same years").alias("value"))


def net_sequestration(additionality: DataFrame, leakage: DataFrame) -> DataFrame:
    """year, net: what a year adds to additionality less leakage; from the second year on."""
    d = difference(additionality, leakage).withColumn("net", F.col("value") - F.lag("value").over(W.orderBy("year"))).withColumn("gap", F.col("year") - F.lag("year").over(W.orderBy("year")))
    return d.filter("gap = 1").select("year", "net")


def at_year(series: DataFrame, year: int, column: str) -> DataFrame:
    """The value of one year as a row; none is an error when it is read."""
    return series.filter(F.col("year") == year).agg(F.max(column).alias(column)).select(checked(F.col(column).isNotNull(), F.col(column), f"{column}: {year} is out of bounds").alias(column))


def release_rate(net: DataFrame, years: int = RELEASE_YEARS) -> DataFrame:
    """year, release: mean yearly change of net over the years before; only where both ends are there."""
    past = net.select((F.col("year") + years).alias("year"), F.col("net").alias("past"))
    return net.join(past, "year").select("year", ((F.col("net") - F.col("past")) / years).alias("release"))


def release_schedule(net: DataFrame, quality: str, first_year: int, current: int, project_end: int, horizon: int = HORIZON) -> DataFrame:
    """est_year, for_year, release. Low quality: the release rate of est_year, whatever for_year. High: 0 until the project ends and in its first
    six years, else the release rate. A rate that the series is too short for is an error."""
    if quality not in ("low", "high"):
        raise ValueError(f"no such quality: {quality}")
    spark = net.sparkSession
    years = spark.range(first_year, current + 1).select(F.col("id").cast("int").alias("est_year")).select("est_year", F.explode(F.sequence(F.lit(first_year), F.lit(horizon))).alias("for_year"))
    rate = release_rate(net).select(F.col("year").alias("est_year"), F.col("release").alias("rate"))
    due = checked(F.col("rate").isNotNull(), F.col("rate"), "the series is too short for a release rate")
    none = (F.col("for_year") <= project_end) | (F.col("est_year") < first_year + RELEASE_YEARS + 1)
    return years.join(rate, "est_year", "left").select("est_year", "for_year", (due if quality == "low" else F.when(none, 0.0).otherwise(due)).alias("release"))


def adjusted_net(net: DataFrame, schedule: DataFrame) -> DataFrame:
    """year, adjusted: net less what earlier years' estimates release in it."""
    owed = schedule.filter("est_year < for_year").groupBy(F.col("for_year").alias("year")).agg(F.sum("release").alias("owed"))
    return net.join(owed, "year", "left").select("year", (F.col("net") - F.coalesce("owed", F.lit(0.0))).alias("adjusted"))


def interpolate_cost(cost: DataFrame, first: int, last: int) -> DataFrame:
    """year, value for first..last: linear between the years given, and along the first or last segment beyond them.
    Repeated rows count once; more than HORIZON segments are an error."""
    given = cost.select(F.col("year").cast("double").alias("y0"), F.col("value").alias("v0")).distinct()
    by = W.orderBy("y0")
    ends = given.select("y0", "v0", F.lead("y0").over(by).alias("y1"), F.lead("v0").over(by).alias("v1"), F.row_number().over(by).alias("i")).filter("y1 IS NOT NULL")
    ends = ends.withColumn("low", F.when(F.col("i") == 1, F.lit(-1e9)).otherwise(F.col("y0"))).withColumn("high", F.when(F.col("i") == F.max("i").over(W.partitionBy()), F.lit(1e9)).otherwise(F.col("y1")))
    years = cost.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    # both sides have a row a year at most; a row more than the bound is read, and is an error
    ends = ends.limit(HORIZON + 1).withColumn("v0", checked(F.count("*").over(W.partitionBy()) <= HORIZON, F.col("v0"), f"the cost series has more than {HORIZON} segments"))
    met = years.join(F.broadcast(ends), (F.col("year") >= F.col("low")) & (F.col("year") < F.col("high")))
    return met.select("year", (F.col("v0") + (F.col("v1") - F.col("v0")) * (F.col("year") - F.col("y0")) / (F.col("y1") - F.col("y0"))).alias("value"))


def release_year(adjusted: DataFrame, schedule: DataFrame) -> DataFrame:
    """year, adjusted, released_by: the first year by which the year's own schedule has released all of adjusted; the year itself where
    there is nothing to release, null if the schedule ends before."""
    own = schedule.filter("for_year > est_year").select(F.col("est_year").alias("year"), "for_year", F.sum(F.abs("release")).over(W.partitionBy("est_year").orderBy("for_year")).alias("released"))
    met = adjusted.join(own, "year", "left").groupBy("year", "adjusted").agg(F.min(F.when(F.col("released") >= F.col("adjusted"), F.col("for_year"))).alias("by"))
    return met.select("year", "adjusted", F.when(F.col("adjusted") <= 0, F.col("year")).otherwise(F.col("by")).cast("int").alias("released_by"))


def damage(schedule: DataFrame, cost: DataFrame, released: DataFrame, discount: float = DISCOUNT) -> DataFrame:
    """year, damage: the discounted cost of what a year's schedule releases from that year until before its release year. Costs or
    schedules that end too early are an error; a release year that is not after the year gives no row."""
    due = released.filter("released_by > year").select("year", "released_by", F.explode(F.sequence(F.col("year"), F.col("released_by") - 1)).alias("for_year"))
    met = due.join(schedule.withColumnRenamed("est_year", "year"), ["year", "for_year"], "left").join(cost.select(F.col("year").alias("for_year"), "value"), "for_year", "left")
    known = F.col("release").isNotNull() & F.col("value").isNotNull()
    term = F.abs("release") * F.col("value") / F.pow(F.lit(1.0 + discount), F.col("for_year") - F.col("year"))
    return met.groupBy("year").agg(F.sum(checked(known, term, "the schedule or the cost series ends too early")).alias("damage"))


def with_permanence(released: DataFrame, damages: DataFrame, costs: DataFrame) -> DataFrame:
    """year, adjusted, released_by, damage, ep, status. ep is (worth - damage) / worth at the year's cost; null with a status where nothing
    was sequestered, where the schedule never releases it all, or where the year's cost is 0."""
    met = released.join(damages, "year", "left").join(costs.select("year", F.col("value").alias("cost")), "year")
    worth = F.col("adjusted") * F.col("cost")
    status = F.when(F.col("adjusted") <= 0, "nothing_sequestered").when(F.col("released_by").isNull(), "never_released").when(F.col("cost") == 0, "no_cost").otherwise("ok")
    return met.select("year", "adjusted", "released_by", "damage", F.when(status == "ok", (worth - F.col("damage")) / worth).alias("ep"), status.alias("status"))


def equivalent_permanence(adjusted: DataFrame, schedule: DataFrame, cost: DataFrame, horizon: int = HORIZON, discount: float = DISCOUNT) -> DataFrame:
    """with_permanence() of each year of adjusted, from given costs."""
    costs = interpolate_cost(cost, FIRST_COST_YEAR, horizon)
    released = release_year(adjusted, schedule)
    return with_permanence(released, damage(schedule, costs, released, discount), costs)
