"""Corpus pipeline: language ID, line dedup, near-duplicate removal, benchmark decontamination, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame; `run` writes each result as Parquet and reads it
again as the next stage's documents. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelmetrics.llm import decontam, jaccard, langid, linededup, packing
from reelmetrics.llm.common import read, saved
from reelmetrics.llm.queries import tokenizer

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least likeness to the nearest language; ordinary text of a learned language has 0.4 and more.
LEAST_SCORE = 0.2
#: Size of the batches that go to Python and back: a batch of texts stands in memory several times on either side.
BATCH, BATCH_LIMIT = "4m", "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage with batches of BATCH, which then holds for the session; a limit that the session has stays."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_LIMIT, None) is None:
            spark.conf.set(BATCH_LIMIT, BATCH)
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language, `lang` as predicted; text without letters or unlike any language goes."""
    found = langid.identify(docs.select(COLUMNS), langid.learn_profiles(docs))
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return kept.withColumn("lang", F.col("lang_pred")).select(COLUMNS)


@in_small_batches
def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines seen before; those that had only such lines go."""
    kept = linededup.dedup_lines(docs.select(COLUMNS)).where("n_removed = 0 or n_removed < n_lines")
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


@in_small_batches
def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group linked by five-word shingles at Jaccard similarity 0.8."""
    return jaccard.one_of_each(docs.select(COLUMNS), 5, 80)


@in_small_batches
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands."""
    return decontam.decontaminate(docs.select(COLUMNS), read(spark, sf_dir, "benchmark")).where("not contaminated").select(COLUMNS)


@in_small_batches
def as_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 ids."""
    pieces = packing.packed(docs, tokenizer("byte_bpe_50k.json"), 1024)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language ID", by_language),
    ("line dedup", without_repeated_lines),
    ("n-gram Jaccard join", one_of_near_copies),
    ("benchmark decontamination", without_benchmark),
    ("packing", as_sequences),
]
#: Rank profiles, edit distances and packing are not SQL: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
