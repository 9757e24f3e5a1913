"""From raw documents to packed sequences: quality classifier, line dedup, near duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terramatch.llm import classifier, line_dedup, mixing, near_dup, packing
from terramatch.llm.common import durable
from terramatch.llm.queries import vocabulary
from terramatch.session import ship


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps, as they are. A null text is judged as an empty one; rows without an id or a label are judged by
    their text; an empty table stays empty."""
    return classifier.keep_good(docs, ship(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share, each once; a null text stays null, and a text may become empty. n_chars is counted anew."""
    kept = line_dedup.dedup_lines(docs)
    new = {"text": F.when(F.col("text").isNotNull(), F.col("kept_text")), "n_chars": F.when(F.col("text").isNotNull(), F.length("kept_text")).otherwise(F.col("n_chars")).cast("long")}
    return kept.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one of least id, null last. Documents without words are one class."""
    ship(spark)
    return near_dup.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them; a null source is one of its own. Where no source has words, none is taken."""
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, packed into sequences; a null or empty text is its end id. A document that was taken twice has its pieces twice."""
    ship(spark)
    return packing.pack_documents(docs, vocabulary=vocabulary("word_bpe_49k.json"), end_id=1).withColumnRenamed("id", "doc_id")


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mix", mix), ("pack", pack)]

#: A stage is trained, another one verifies hashed sets, and the last one runs a tokenizer: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = ship(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = durable(docs, name)
    return docs
