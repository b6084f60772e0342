"""Command line: run a job or a serving query of a lake.

    spark-submit reelmetrics/__main__.py --root hdfs:///video bronze likes --servers broker:9092
    spark-submit reelmetrics/__main__.py --root hdfs:///video silver
    spark-submit reelmetrics/__main__.py --root hdfs:///video gold
    spark-submit reelmetrics/__main__.py --root hdfs:///video query top_watched_videos last_week
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from reelmetrics.plans import audit
from reelmetrics.plans.refresh import refresh_gold
from reelmetrics.plans.serving import Dashboard, to_json_rows
from reelmetrics.schemas import TOPICS
from reelmetrics.session import configure
from reelmetrics.sources.stored import LAYOUTS, Lake
from reelmetrics.sources.wire import parse_actions, read_actions_stream, to_bronze
from reelmetrics.streaming import jobs

QUERIES = {
    "top_watched_videos": str,
    "top_watched_channels": str,
    "top_liked_videos": str,
    "top_liked_channels": str,
    "video_history": int,
    "channel_history": int,
    "comments": int,
    "interaction": int,
    "countries": int,
    "ages": int,
    "histogram": int,
    "count": None,
    "counts": None,
    "as_of": None,
    "latest": int,
    "country_shares": int,
    "age_shares": int,
    "top_positive_videos": None,
    "peak": None,
    "channel_views": None,
    "weighted_views": int,
    "rolling_top_videos": str,
    "top_videos_per_category": str,
    "top_channels_per_category": str,
}
#: Queries of a window that ends at --as-of, by default now.
ENDING = {"rolling_top_videos", "top_videos_per_category", "top_channels_per_category"}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="reelmetrics")
    top.add_argument("--root", required=True, help="folder of the lake")
    job = top.add_subparsers(dest="job", required=True)

    bronze = job.add_parser("bronze", help="messages of one topic to the log")
    bronze.add_argument("topic", choices=TOPICS)
    bronze.add_argument("--servers", help="Kafka servers")
    bronze.add_argument("--path", help="folder of message files, instead of Kafka")
    bronze.add_argument("--starting", default="earliest")
    bronze.add_argument("--max-per-trigger", type=int)
    bronze.add_argument("--period", help="run for ever, once per period")

    bronze.add_argument("--once-within", help="drop messages sent again within that time, as '2 hours'")

    load = job.add_parser("load", help="a folder of message files to the log, once per load name")
    load.add_argument("topic", choices=TOPICS)
    load.add_argument("path")
    load.add_argument("name", help="a load of that name that is already in is not added again")
    load.add_argument("--layout", default="video", choices=LAYOUTS)

    job.add_parser("compact", help="fold increments of the rollups and the video dimension")

    silver = job.add_parser("silver", help="log to rollups")
    silver.add_argument("--period", help="run for ever, once per period")

    gold = job.add_parser("gold", help="rollups to serving tables")
    gold.add_argument("--as-of", type=int, help="epoch seconds, default now")
    gold.add_argument("--month-days", type=int, default=30)
    gold.add_argument("--period", help="run for ever, once per period")

    query = job.add_parser("query", help="print a serving query as JSON rows")
    query.add_argument("name", choices=QUERIES)
    query.add_argument("argument", nargs="?", help="level, period, video id or channel id")
    query.add_argument("--as-of", type=int, help="end of a rolling window, default now")

    check = job.add_parser("audit", help="print the error of the published counts")
    check.add_argument("--one-in", type=int, default=1)
    return top


def run_bronze(spark: SparkSession, lake: Lake, args: argparse.Namespace) -> None:
    raw = read_actions_stream(
        spark,
        "text" if args.path else "kafka",
        args.topic,
        path=args.path,
        servers=args.servers,
        starting=args.starting,
        max_per_trigger=args.max_per_trigger,
    )
    jobs.start_ingest(
        raw,
        lake,
        args.topic,
        f"{lake.root}/checkpoints/ingest-{args.topic}",
        args.period,
        once_within=args.once_within,
    ).awaitTermination()


def run_load(lake: Lake, args: argparse.Namespace) -> None:
    """Well-formed messages of the files become log rows; malformed ones stay in the files."""
    lines = lake.spark.read.text(args.path)
    raw = lines.select(F.lit(args.topic).alias("topic"), "value")
    added = lake.bulk_append(to_bronze(parse_actions(raw)), args.topic, args.layout, args.name)
    print(json.dumps({"load": args.name, "added": added}))


def run_query(lake: Lake, name: str, argument: str | None, as_of: int | None = None) -> None:
    kind = QUERIES[name]
    method = getattr(Dashboard(lake), name)
    given = () if kind is None else (kind(argument),)
    ending = {"as_of": as_of} if name in ENDING else {}
    for row in to_json_rows(method(*given, **ending)).toLocalIterator():
        print(row.json)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName("reelmetrics").getOrCreate())
    lake = Lake(spark, args.root).ensure()
    if args.job == "bronze":
        run_bronze(spark, lake, args)
    elif args.job == "silver":
        jobs.start_silver(
            lake.bronze_stream(), lake, f"{lake.root}/checkpoints/silver", args.period
        ).awaitTermination()
    elif args.job == "gold" and args.period:
        jobs.start_gold(
            lake, f"{lake.root}/checkpoints/gold", args.period, month_days=args.month_days
        ).awaitTermination()
    elif args.job == "gold":
        refresh_gold(lake, args.as_of or int(time.time()), args.month_days)
    elif args.job == "query":
        run_query(lake, args.name, args.argument, args.as_of)
    elif args.job == "load":
        run_load(lake, args)
    elif args.job == "compact":
        jobs.compact(lake)
    elif args.job == "audit":
        report = audit.audit_countries(lake, args.one_in)
        for row in to_json_rows(audit.quality.accuracy_summary(report)).toLocalIterator():
            print(row.json)


if __name__ == "__main__":
    main()
