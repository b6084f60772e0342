"""The given test tables seen as an action log.

Every event is one action. Each column is derived from the event row except
the country (customer and nation) and the comment text (documents), which are
looked up. Nothing is sampled: all events, all documents and all parts are
reachable.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelmetrics.functions.text import lexicon_score
from reelmetrics.functions.timing import DAY
from reelmetrics.session import configure
from reelmetrics.sources.files import Folder

# Event type to action.
ACTION_OF_EVENT = {
    "click": "views",
    "view": "first_views",
    "purchase": "likes",
    "signup": "subscribes",
    "error": "comments",
}
# 2024-01-30 23:59:59 UTC, the "now" of the test data.
AS_OF = 1_706_659_199


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; its schema is read from a footer once per application."""
    path = f"{sf_dir}/{name}.parquet"
    known = (spark.sparkContext.applicationId, path)
    if known not in _SCHEMAS:
        _SCHEMAS[known] = spark.read.parquet(path).schema
    return configure(spark).read.schema(_SCHEMAS[known]).parquet(path)


def event_stream(spark: SparkSession, sf_dir: str, max_files: int = 1000) -> DataFrame:
    """The events as a file stream, stored as one file or as a folder of files."""
    reader = spark.readStream.schema(table(spark, sf_dir, "events").schema).option(
        "maxFilesPerTrigger", max_files
    )
    if Folder(spark, sf_dir).has_folder("events.parquet"):
        return reader.parquet(f"{sf_dir}/events.parquet")
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)


def shape_events(events: DataFrame) -> DataFrame:
    """Event rows, batch or stream, as action rows without country."""
    # One short pattern costs half of a JSON parse per row.
    k = F.regexp_extract("props", r'"k"\s*:\s*(\d+)', 1).try_cast("int")
    video = k + 10
    case = F.lit(None).cast("string")
    for event_type, name in ACTION_OF_EVENT.items():
        case = F.when(F.col("event_type") == event_type, name).otherwise(case)
    return events.select(
        "event_id",
        case.alias("action"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("timestamp_seconds"),
        "user_id",
        (F.lit(10) + F.col("user_id") % 70).cast("int").alias("user_age"),
        F.floor(video / 10).cast("int").alias("channel_id"),
        video.alias("video_id"),
        (F.floor("value").cast("int") % 60).alias("seconds_offset"),
        F.col("value").alias("position_seconds"),
    )


def actions(
    spark: SparkSession,
    sf_dir: str,
    kinds: Iterable[str] | None = None,
    since: int | None = None,
    until: int | None = None,
    country: bool = False,
) -> DataFrame:
    """The action log, limited to some actions and to ``since <= time < until``.

    Both limits are stated on the raw columns so that they reach the scan.
    """
    events = table(spark, sf_dir, "events")
    if kinds is not None:
        wanted = set(kinds)
        events = events.where(
            F.col("event_type").isin(*[e for e, a in ACTION_OF_EVENT.items() if a in wanted])
        )
    if since is not None:
        events = events.where(F.col("ts") >= F.timestamp_seconds(F.lit(since)).cast("timestamp_ntz"))
    if until is not None:
        events = events.where(F.col("ts") < F.timestamp_seconds(F.lit(until)).cast("timestamp_ntz"))
    log = shape_events(events)
    return with_country(log, spark, sf_dir) if country else log


def with_country(log: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look up the viewer's country, first the customer and then the nation.

    No broadcast hints: each lookup is a plain table whose size Spark reads
    from the file listing, so it is broadcast below the session's threshold
    and joined by shuffle above it, where adaptive execution splits a hot user.
    """
    customer = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("n_nationkey")
    )
    nation = table(spark, sf_dir, "nation").select(
        "n_nationkey", F.col("n_name").alias("user_country")
    )
    return (
        log.join(customer, "user_id", "left").join(nation, "n_nationkey", "left").drop("n_nationkey")
    )


def document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's score.

    A text shared by many comments is scored once, and only the score is
    joined to them.
    """
    return table(spark, sf_dir, "documents").select(
        "doc_id", lexicon_score(F.col("text")).alias("comment_score")
    )


def scored_comments_of(spark: SparkSession, sf_dir: str, log: DataFrame) -> DataFrame:
    """``scored_comments`` of a few rows: only documents that they cite are scored."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    total = documents.agg(F.count(F.lit(1))).scalar()
    comments = log.where(F.col("action") == "comments").withColumn(
        "doc_id", F.col("event_id") % total
    )
    cited = documents.join(comments.select("doc_id"), "doc_id", "left_semi")
    scores = cited.select("doc_id", lexicon_score(F.col("text")).alias("comment_score"))
    return comments.join(scores, "doc_id", "left")


def scored_comments(log: DataFrame, scores: DataFrame) -> DataFrame:
    """Comment rows of ``log`` with their score; they cycle through all documents."""
    total = scores.agg(F.count(F.lit(1))).scalar()
    comments = log.where(F.col("action") == "comments")
    return comments.withColumn("doc_id", F.col("event_id") % total).join(scores, "doc_id", "left")


def videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part table as video dimension."""
    key = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        key.alias("id"),
        F.floor(key / 10).alias("channel_id"),
        (key * DAY).alias("creation_date"),
        F.col("p_type").alias("category"),
        F.col("p_size").alias("duration_minutes"),
    )


def wire_messages(spark: SparkSession, sf_dir: str, kinds: Iterable[str] | None = None) -> DataFrame:
    """The action log as JSON messages ``(event_id, topic, value)``."""
    log = actions(spark, sf_dir, kinds=kinds, country=True)
    catalog = videos(spark, sf_dir).select(
        F.col("id").alias("video_id"),
        F.struct(
            "channel_id",
            "creation_date",
            "category",
            (F.col("duration_minutes") * 60).alias("duration"),
        ).alias("video_object"),
    )
    is_comment = F.col("action") == "comments"
    if kinds is None or "comments" in set(kinds):
        documents = table(spark, sf_dir, "documents")
        total = documents.agg(F.count(F.lit(1))).scalar()
        # Only comments meet the documents; the other actions need no join.
        comments = log.where(is_comment).withColumn("doc_id", F.col("event_id") % total)
        texts = documents.select("doc_id", F.col("text").alias("comment"))
        others = log.where(~is_comment).withColumn("comment", F.lit(None).cast("string"))
        log = others.unionByName(comments.join(texts, "doc_id", "left").drop("doc_id"))
    else:
        log = log.withColumn("comment", F.lit(None).cast("string"))
    body = F.struct(
        F.col("timestamp_seconds").alias("timestamp"),
        "user_id",
        "user_country",
        "user_age",
        "channel_id",
        "video_id",
        F.when(~is_comment, F.col("video_object")).alias("video_object"),
        F.when(F.col("action").isin("views", "likes"), F.col("seconds_offset")).alias(
            "seconds_offset"
        ),
        "comment",
    )
    return log.join(catalog, "video_id", "left").select(
        "event_id", F.col("action").alias("topic"), F.to_json(body).alias("value")
    )
