"""Takes in messages, fills all sinks and keeps the statistics current.

    spark-submit --packages <connectors> --py-files crowdpulse.zip crowdpulse/jobs/ingest.py \\
        --source-option kafka.bootstrap.servers=broker:9092 --source-option subscribe=users \\
        --documents-format mongodb --documents-option connection.uri=... \\
        --table-format org.apache.spark.sql.cassandra \\
        --table-option keyspace=analytics --table-option table=users \\
        --tables s3a://bucket/users --checkpoints s3a://bucket/progress

Every query has its own checkpoint. The one that fills the users table also keeps
its statistics and newest users, in the same micro-batches. The job ends when one of them does, and
fails if that one failed, so that a supervisor can start it again.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from crowdpulse.jobs.arguments import add_format, pairs
from crowdpulse.operators.messages import flatten_users, quarantine
from crowdpulse.session import build_session
from crowdpulse.sources.topic import message_stream
from crowdpulse.streaming.run import (
    DRAIN,
    await_all,
    await_any,
    start_fan_out,
    start_shared_fan_out,
    start_sink,
)
from crowdpulse.streaming.sinks import (
    append_sink,
    debug_sink,
    documents,
    keyed_rows,
    keyed_sink,
    quarantine_sink,
)


def parse(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Take in user messages")
    add_format(parser, "source", "kafka")
    add_format(parser, "documents", None)
    add_format(parser, "table", None)
    parser.add_argument("--tables", required=True, help="folder of the users table and snapshots")
    parser.add_argument("--checkpoints", required=True)
    parser.add_argument("--every", type=int, help="seconds between micro-batches of the sinks; else none")
    parser.add_argument("--shared", action="store_true", help="parse once for all sinks")
    parser.add_argument("--debug", action="store_true", help="show rows of every micro-batch")
    parser.add_argument("--drain", action="store_true", help="take in what is there, then end")
    return parser.parse_args(argv)


def start(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    messages = message_stream(spark, args.source_format, pairs(args.source_option))
    users = flatten_users(messages, with_arrival=True)
    tables, progress = args.tables.rstrip("/"), args.checkpoints.rstrip("/")
    sinks = [keyed_sink(f"{tables}/users", tables)]
    for name, fmt, options, prepare in (
        ("documents", args.documents_format, args.documents_option, documents),
        ("table", args.table_format, args.table_option, keyed_rows),
    ):
        if fmt:
            sinks.append(append_sink(fmt, pairs(options), name, prepare))
    if args.debug:
        sinks.append(debug_sink())
    trigger = {"processingTime": f"{args.every} seconds"} if args.every else None
    trigger = DRAIN if args.drain else trigger
    if args.shared:
        queries = [start_shared_fan_out(users, sinks, progress, trigger)]
    else:
        queries = start_fan_out(users, sinks, progress, trigger)

    bad = quarantine_sink(f"{tables}/quarantine")
    queries.append(start_sink(quarantine(messages, with_warnings=True), bad, progress, trigger))
    return queries


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    queries = start(spark, args)
    (await_all if args.drain else await_any)(queries)


def main(argv: Sequence[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session("ingest users")
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
