"""Line dedup: lines that many documents share go, except in one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_CHARS, durable, row_key, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """A line without white space at its ends, ASCII letters in lower case."""
    return F.translate(F.trim(line, F.lit(WHITE_CHARS)), UPPER, LOWER)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 40, least_docs: int = 5) -> DataFrame:
    """docs with n_lines (before), n_dropped, and kept_text in the text's place under its own name.

    A text is split at \\n. A line's key of at least least_chars code points that occurs in at least least_docs documents loses
    its lines everywhere but in the largest id that has it. All columns of docs stay; columns named n_lines, n_dropped or
    kept_text give way to the results.

    Scale: keys are hashed (128 bits) and made distinct within a document before anything moves, and counts are combined on the map
    side. The lines of a key that a third of all documents share are split by adaptive execution where they meet its keeper. Texts
    move once, as arrays of lines, to meet the positions that go; no join is hinted, so Spark sends a small side round instead.

    Defined results: a null or empty text is one empty line; rows with one id are parts of one document, counted once; a null id
    is one document, smaller than all others; equal rows get equal results; an empty table gives an empty one.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), F.split(text_of(text_col), "\n", -1).alias("lines"), row_key(F.col(id_col), F.col(text_col).cast("string")).alias("key"))
    hashed = lambda x: F.struct(F.xxhash64(F.lit(3), line_key(x)).alias("a"), F.xxhash64(F.lit(5), line_key(x)).alias("b"))
    long_lines = (
        rows.select("id", "key", F.posexplode("lines").alias("at", "line"))
        .filter(F.length(F.trim("line", F.lit(WHITE_CHARS))) >= least_chars)
        .select("id", "key", "at", hashed(F.col("line")).alias("h"))
    )
    long_lines = durable(long_lines.groupBy("h", "id", "key").agg(F.collect_set("at").alias("at")), "line-keys")
    shared = (
        long_lines.groupBy("h", "id").agg(F.lit(1).alias("one"))
        .groupBy("h").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
        .filter(F.col("n") >= least_docs).select("h", "keeper")
    )
    # as a table of its own it meets the lines with a shuffle on both sides, or none: then Spark splits a line that very many documents have
    shared = durable(shared, "shared-lines")
    gone = long_lines.join(shared, "h").filter(F.col("id").isNull() | (F.col("id") != F.col("keeper")))
    gone = gone.groupBy("key").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("gone"))
    met = rows.join(gone, "key", "left")
    # the lines come out of the join as a column, so that picking one by its position costs nothing but the pick
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    text = F.when(F.col("gone").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n"))
    out = met.select(F.col("row"), F.size("lines").cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), text.alias("kept_text"))
    mine = ("n_lines", "n_dropped", "kept_text")
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in mine], *mine)


#: DuckDB's statement of op2_line_dedup over `documents`.
ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
j AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM k LEFT JOIN s ON k.key = s.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id
"""
