"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import centroids, classifier, fingerprints, importance, line_dedup, mixing, near_dup, packing, pii, quality_rules, secrets, token_files, toxicity
from .common import new_path


def vocabulary(name: str) -> str:
    """A file of the public tokenizers; it lies at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/documents.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "tokens")
    token_files.write_tokens(documents(spark, sf_dir), path, vocabulary=vocabulary("byte_bpe_50k.json"), end_id=2)
    return token_files.token_digests(spark, path).withColumnRenamed("id", "doc_id")


def op4_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), vocabulary=vocabulary("word_bpe_49k.json"), end_id=1).withColumnRenamed("id", "doc_id")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = near_dup.jaccard_links(documents(spark, sf_dir))
    return links.select(F.col("id").alias("doc_id"), "class_id", "n_links", "n_copies")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a deployment sets its own key, a secret, in its session
    key = spark.conf.get("terramatch.pii.key", None) or "a key for tests alone"
    return pii.replace_pii(documents(spark, sf_dir).select("doc_id", "text"), key=key)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(documents(spark, sf_dir))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_with_edits(documents(spark, sf_dir)).withColumnRenamed("id", "doc_id")


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.sha2(secrets.joined(F.filter("spans", secrets.is_base)), 256)
    return found.select(F.col("id").alias("doc_id"), *[count(k) for k in secrets.BASE], base.alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op10_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classifier.classify(documents(spark, sf_dir), labels).select(F.col("id").alias("doc_id"), "low_quality", "toxicity", "kept")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_clusters(ship(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_files": op3_token_files,
    "op4_pack": op4_pack,
    "op5_pii": op5_pii,
    "op6_quality_rules": op6_quality_rules,
    "op7_fingerprint": op7_fingerprint,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_secrets": op9_secrets,
    "op10_classifier": op10_classifier,
    "op11_toxicity": op11_toxicity,
    "op12_centroids": op12_centroids,
    "op13_importance": op13_importance,
}

ORACLE_SQL: dict[str, str] = {
    "op1_mix": mixing.ORACLE,
    "op2_line_dedup": line_dedup.ORACLE,
    "op12_centroids": centroids.ORACLE,
}
