"""Folds the users log into its base, so that reads resolve only the batches after it.

    spark-submit --py-files crowdpulse.zip crowdpulse/jobs/compact.py --tables s3a://bucket/users

Safe beside a running ingest job: it writes a new base and removes only
folders that the base before it had folded in.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from crowdpulse.session import build_session, input_bytes, size_shuffles
from crowdpulse.sources.tables import UsersTable


def parse(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Compact the users table")
    parser.add_argument("--tables", required=True, help="folder the ingest job writes to")
    return parser.parse_args(argv)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    path = f"{args.tables.rstrip('/')}/users"
    size_shuffles(spark, input_bytes(spark, path))
    UsersTable(spark, path).compact()


def main(argv: Sequence[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session("compact users")
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
