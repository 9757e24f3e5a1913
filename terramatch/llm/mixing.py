"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis and Spirakis, 2006)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ranks import with_position, with_running
from .common import durable, text_of, word_count

#: Bounds of a document's quality weight. Their ratio bounds how uneven the key ranges below can get.
LEAST_QUALITY, MOST_QUALITY = 0.25, 1.0
#: Documents of a source in one key range, on average.
RANGE_ROWS = 4096


def quality_weight(size: Column, chars: Column) -> Column:
    """A cheap prior: 1 for a text of at least 50 words of 4 to 12 characters each (white space included), else 0.25."""
    return F.when((size >= 50) & chars.between(4 * size, 12 * size), MOST_QUALITY).otherwise(LEAST_QUALITY)


def source_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), most_epochs: float = 3) -> DataFrame:
    """Targets of sources. sizes: source, source_size; adds weight and target.

    Sources by code point, null last, take the weights in turn. All sizes together are shared by weight; a target above
    most_epochs times its source's size stops there and the excess is shared again. The fixed point is found in closed form:
    sources ordered by cap over weight are capped from the front until the common level of the rest is below the next cap.

    A document never goes through it, and where sources are many, as web domains are, no task orders them all: their places and
    running sums come range by range. Three numbers come to the driver.
    """
    turn = F.array(*[F.lit(float(w)) for w in weights])
    placed = with_position(sizes.withColumn("_none", F.col("source").isNull()), ["_none", "source"], "_place")
    placed = placed.withColumn("weight", F.element_at(turn, (F.col("_place") % len(weights) + 1).cast("int")))
    placed = placed.withColumn("cap", F.lit(float(most_epochs)) * F.col("source_size")).withColumn("cap_level", F.col("cap") / F.col("weight"))
    run = durable(with_running(placed, ["cap_level", "_none", "source"], {"_caps": "cap", "_weights": "weight"}), "mix-sources")
    everything, all_weights = run.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    run = run.withColumn("level", (F.lit(float(everything)) - F.col("_caps")) / (F.lit(float(all_weights)) - F.col("_weights")))
    level = run.agg(F.max(F.when(F.col("cap_level") > F.col("level"), F.col("level")))).first()[0]
    target = F.least("cap", F.coalesce(F.col("weight") * F.lit(level).cast("double"), F.col("cap")))
    return run.withColumn("target", F.round(target, 6)).drop("_none", "_place", "_caps", "_weights", "cap", "cap_level", "level")


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, quality: Column | None, seed: int, *more: Column) -> DataFrame:
    """id, source, size, key and more, a row a document, all from the row alone."""
    text = text_of(text_col)
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.length(text).cast("string"))
    rows = docs.select(*more, F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), word_count(text).alias("size"), F.length(text).cast("long").alias("chars"), F.sha2(name, 256).alias("h"), (F.lit(None) if quality is None else quality).cast("double").alias("q"))
    bounded = F.coalesce(F.least(F.greatest(F.col("q"), F.lit(LEAST_QUALITY)), F.lit(MOST_QUALITY)), F.lit(LEAST_QUALITY))
    weight = quality_weight(F.col("size"), F.col("chars")) if quality is None else bounded
    u = (F.conv(F.substring("h", 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(2**52)
    return rows.withColumn("key", -F.log(u) / weight).drop("chars", "h", "q")


def _ranged(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """keyed with its source's plan and its range of keys. With the least quality as rate, no range holds over MOST_QUALITY /
    LEAST_QUALITY times the mean number of documents. The plan has a row a source; it isn't hinted, Spark knows its size."""
    at = F.floor((1 - F.exp(-F.col("key") * LEAST_QUALITY)) * F.col("ranges")).cast("long")
    return keyed.join(plan.withColumnRenamed("source", "of_source"), F.col("source").eqNullSafe(F.col("of_source"))).withColumn("range", at).drop("of_source")


def mix_plan(keyed: DataFrame, weights: Sequence[float], most_epochs: float) -> DataFrame:
    """A row a source: source_size, target, epochs, and where in the order of keys the fractional selection ends: at `last` in `end_range`.

    A source is never sorted as a whole. Keys are cut into ranges of some thousand documents; range sums and their prefix sums tell
    the one range in which a source's budget ends, and only that range's documents are ordered.
    """
    sizes = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows"))
    plan = source_targets(sizes, weights, most_epochs)
    plan = plan.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = plan.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")).withColumn("ranges", F.ceil(F.col("source_rows") / RANGE_ROWS))
    plan = durable(plan, "mix-plan", 1)
    sums = _ranged(keyed, plan).groupBy("source", "range", "rest").agg(F.sum("size").alias("size"))
    sums = sums.withColumn("until", F.sum("size").over(W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, 0)))
    # the first range whose prefix sum exceeds the budget; none where all ranges fit
    ends = sums.filter(F.col("until") > F.col("rest")).groupBy("source").agg(F.min(F.struct("range", (F.col("until") - F.col("size")).alias("before"))).alias("end"))
    plan = plan.join(ends.select(F.col("source").alias("end_source"), F.col("end.range").alias("end_range"), "end.before"), F.col("source").eqNullSafe(F.col("end_source")), "left").drop("end_source")
    plan = durable(plan, "mix-plan", 1)
    # equal rows are one row with a count here, however many they are
    inside = _ranged(keyed, plan).filter(F.col("range") == F.col("end_range")).groupBy("source", "rest", "before", "key", "id", "size").agg(F.count("*").alias("rows"))
    order = W.partitionBy("source").orderBy("key", "id", "size").rowsBetween(W.unboundedPreceding, 0)
    ahead = F.col("before") + F.sum(F.col("size") * F.col("rows")).over(order) - F.col("size") * F.col("rows")
    # as many of them as fit by more than a half
    fit = F.when(F.col("size") == 0, F.when(ahead <= F.col("rest"), F.col("rows")).otherwise(0)).otherwise(F.floor((F.col("rest") - ahead) / F.col("size") + 0.5))
    inside = inside.withColumn("fit", F.least(F.greatest(fit, F.lit(0)), F.col("rows")).cast("long")).filter("fit > 0")
    last = inside.groupBy("source").agg(F.max(F.when(F.col("fit") == F.col("rows"), F.struct("key", "id", "size"))).alias("last"), F.max(F.when(F.col("fit") < F.col("rows"), F.struct(F.struct("key", "id", "size").alias("row"), "fit"))).alias("split"))
    return durable(plan.join(last.withColumnRenamed("source", "last_source"), F.col("source").eqNullSafe(F.col("last_source")), "left").drop("last_source", "before"), "mix-plan", 1)


def _with_copies(keyed: DataFrame, plan: DataFrame) -> DataFrame:
    """keyed with its source's plan and copies, the number of times that the mix takes a row."""
    met, one = _ranged(keyed, plan), F.struct("key", "id", "size")
    inside = F.coalesce(one <= F.col("last"), F.lit(False))
    selected = F.col("end_range").isNull() | (F.col("range") < F.col("end_range")) | ((F.col("range") == F.col("end_range")) & inside)
    # a budget of nothing selects nothing, also where no range exceeds it
    copies = F.col("epochs") + (selected & (F.col("rest") > 0)).cast("long")
    if plan.filter("split IS NOT NULL").isEmpty():
        return met.withColumn("copies", copies)
    # of equal rows at the end of a budget the first ones are taken. They are written with the task that wrote them, which is a value from then on,
    # however the files are cut when they are read; they are numbered task by task, after the rows of the tasks before
    equal = (F.col("range") == F.col("end_range")) & one.eqNullSafe(F.col("split.row"))
    ties = durable(met.filter(equal).withColumn("task", F.spark_partition_id()), "mix-ties")
    tied = ties.withColumn("number", F.row_number().over(W.partitionBy("source", "task").orderBy("task")))
    sizes = ties.groupBy("source", "task").agg(F.count("*").alias("n"))
    sizes = sizes.select(F.col("source").alias("n_source"), F.col("task").alias("n_task"), (F.sum("n").over(W.partitionBy("source").orderBy("task").rowsBetween(W.unboundedPreceding, 0)) - F.col("n")).alias("n_before"))
    tied = tied.join(sizes, F.col("source").eqNullSafe(F.col("n_source")) & (F.col("task") == F.col("n_task")))
    tied = tied.withColumn("copies", F.col("epochs") + (F.col("number") + F.col("n_before") <= F.col("split.fit")).cast("long")).drop("number", "task", "n_source", "n_task", "n_before")
    return met.filter(~F.coalesce(equal, F.lit(False))).withColumn("copies", copies).unionByName(tied)


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", quality: Column | None = None, weights: Sequence[float] = (5, 2, 1), most_epochs: float = 3, seed: int = 20) -> DataFrame:
    """One row a document: id_col, size, source, source_size, target, epochs, copies, taken.

    Every document of a source is taken floor(target / source_size) times; the rest of the target is filled with documents in
    ascending order of -ln(u) / quality, u a hash of seed, id and length, for as long as half a document still fits. Whole
    documents are taken, so a source misses its target by half a document at most.

    Scale: see mix_plan. Documents meet a table of one row a source; no text moves.

    Defined results: a null or empty text has size 0 and takes no words; a null source is a source of its own; a null id is hashed as an
    empty one; of rows with one id and size, as many are taken as fit; an empty table gives an empty one. Further columns are left out.
    """
    keyed = durable(_sized(docs, id_col, text_col, source_col, quality, seed), "mix-keys")
    met = _with_copies(keyed, mix_plan(keyed, weights, most_epochs))
    return met.select(F.col("id").alias(id_col), "size", "source", "source_size", "target", "epochs", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_rows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", quality: Column | None = None, weights: Sequence[float] = (5, 2, 1), most_epochs: float = 3, seed: int = 20) -> DataFrame:
    """The rows of docs, each as many times as mix() takes it; all columns stay.

    Scale: rows are written once beside their keys, so that words are counted once; the plan's steps read the keys alone.

    Defined results: as for mix(). A document without words stays as often as its source is taken whole; where a source has no words at
    all its documents are not taken.
    """
    keyed = durable(_sized(docs, id_col, text_col, source_col, quality, seed, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "mix-rows")
    met = _with_copies(keyed, mix_plan(keyed.drop("row"), weights, most_epochs))
    return met.filter("copies > 0").select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")


#: DuckDB's statement of op1_mix over `documents`.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, length(coalesce(text, '')) AS chars FROM documents),
k AS (
  SELECT *, -ln((('0x' || substr(sha256('20:' || coalesce(doc_id::VARCHAR, '') || ':' || chars), 1, 13))::BIGINT + 0.5) / 4503599627370496)
    / CASE WHEN size >= 50 AND chars BETWEEN 4 * size AND 12 * size THEN 1.0 ELSE 0.25 END AS key FROM d),
s AS (SELECT source, sum(size)::DOUBLE AS source_size, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
o AS (
  SELECT *, 3 * source_size / w AS cap_level,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM s),
t AS (SELECT source, source_size, round(least(3 * source_size, coalesce(w * max(CASE WHEN cap_level > level THEN level END) OVER (), 3 * source_size)), 6) AS target FROM o),
r AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM t),
p AS (
  SELECT k.doc_id, k.size, r.source_size, r.target, r.epochs, r.target - r.epochs * r.source_size AS rest,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - k.size / 2.0 AS middle
  FROM k JOIN r ON k.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target::DOUBLE AS target,
  (size * (epochs + CASE WHEN rest > 0 AND middle <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM p
"""
