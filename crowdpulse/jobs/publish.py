"""Publishes a folder of users as stamped JSON envelopes.

    spark-submit --packages <connector> --py-files crowdpulse.zip crowdpulse/jobs/publish.py \\
        --input s3a://bucket/feed --target-option kafka.bootstrap.servers=broker:9092 \\
        --target-option topic=users
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from crowdpulse.jobs.arguments import add_format, pairs
from crowdpulse.operators.publishing import pack_envelopes, stamp_ingestion, to_messages
from crowdpulse.schemas import USERS_PER_ENVELOPE
from crowdpulse.session import build_session, input_bytes, size_shuffles
from crowdpulse.sources.topic import publish

FEED = (
    "user_id STRING, gender STRING, first_name STRING, last_name STRING, country STRING, "
    "age INT, email STRING"
)


def parse(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Publish users")
    parser.add_argument("--input", required=True, help="parquet folder with the feed's columns")
    parser.add_argument("--per-envelope", type=int, default=USERS_PER_ENVELOPE)
    add_format(parser, "target", "kafka")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    size_shuffles(spark, input_bytes(spark, args.input))
    feed = stamp_ingestion(spark.read.schema(FEED).parquet(args.input))
    messages = to_messages(pack_envelopes(feed, args.per_envelope))
    publish(messages, args.target_format, pairs(args.target_option))


def main(argv: Sequence[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session("publish users")
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
