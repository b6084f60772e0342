"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, filteraudit, htmltext, jaccard, langid, licenses, linededup, lm, periodic, quality, tokencounts, vectors
from .common import read
from .packing import packed

GOOD = 0.7


def remainder(of: int):
    """crc32 of doc_id as text, modulo."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % of


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from labelled rows that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    field = quality.train(docs, labels.where(remainder(4) != 2))
    scored = quality.score(docs, field).withColumnRenamed("quality_score", "score")
    return scored.select(
        "doc_id",
        F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= GOOD).cast("int").alias("predicted"),
    )


def op2_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all embeddings at cosine 0.9."""
    return vectors.near_duplicates(read(spark, sf_dir, "embeddings"), 0.9)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram tokens of every document over the pieces of a public vocabulary."""
    return tokencounts.token_counts(read(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 ids."""
    pieces = packed(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), 1024)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = langid.learn_profiles(docs.where(remainder(5) != 0))
    found = langid.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(read(spark, sf_dir, "pages"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents whose sets of three-word shingles have Jaccard similarity 0.9."""
    return jaccard.jaccard_groups(read(spark, sf_dir, "documents"), 3, 90)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in every document, numbers, names and units changed or not."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.decontaminate(docs, read(spark, sf_dir, "benchmark")).drop("text")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return licenses.scan(read(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat, or nearly repeat, an earlier one."""
    kept = linededup.dedup_lines(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "text", "n_lines", "n_removed")


def op11_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document by the model and by unigram counts, learned from rows that are not held out."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = lm.score(docs, lm.learn(docs.where(remainder(5) != 1)))
    return found.withColumn("held_out", F.coalesce(remainder(5) == 1, F.lit(False)))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from all documents, step by step, in each of their orders."""
    return filteraudit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).select(
        "part", "filter_order", "step", *filteraudit.COUNTS, "shapley"
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of all documents, a tenth of them with planted ones."""
    docs = periodic.with_planted_runs(read(spark, sf_dir, "documents"))
    return periodic.digest(periodic.periodic_runs(docs))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_vectors": op2_vectors,
    "op3_token_counts": op3_token_counts,
    "op4_packing": op4_packing,
    "op5_langid": op5_langid,
    "op6_html_text": op6_html_text,
    "op7_jaccard": op7_jaccard,
    "op8_decontamination": op8_decontamination,
    "op9_licenses": op9_licenses,
    "op10_line_dedup": op10_line_dedup,
    "op11_lm": op11_lm,
    "op12_filter_audit": op12_filter_audit,
    "op13_periodic_runs": op13_periodic_runs,
}

#: All pairs by brute force; groups by spreading the least id over the links.
OP2_SQL = """
WITH RECURSIVE usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a, usable b
  WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach(id, low) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.id),
least AS (SELECT id, min(low) AS component_id FROM reach GROUP BY id),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least ON id = e.vec_id LEFT JOIN counts c ON c.vec_id = e.vec_id"""

#: Every pair of documents that share a shingle, counted in full.
OP7_SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM words),
grams AS (SELECT r, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.r AS a, b.r AS b, count(*) AS o, any_value(a.n + b.n) AS n
  FROM grams a JOIN grams b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs WHERE 100 * o >= 90 * (n - o)),
reach(r, low) AS (
  SELECT r, doc_id FROM sets
  UNION
  SELECT l.b, reach.low FROM reach JOIN links l ON l.a = reach.r),
least AS (SELECT r, min(low) AS component_id FROM reach GROUP BY r)
SELECT doc_id, len(s) AS n_shingles, component_id FROM sets JOIN least USING (r)"""

ORACLE: dict[str, str] = {
    "op2_vectors": OP2_SQL,
    "op7_jaccard": OP7_SQL,
    "op9_licenses": licenses.twin_sql(),
    "op12_filter_audit": filteraudit.TWIN,
    "op13_periodic_runs": periodic.TWIN,
}
