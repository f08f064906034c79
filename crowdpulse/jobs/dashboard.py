"""Shows the dashboard's results, again and again.

    spark-submit --py-files crowdpulse.zip crowdpulse/jobs/dashboard.py --tables s3a://bucket/users
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from crowdpulse.functions import refresh_text
from crowdpulse.plans.dashboard import Dashboard
from crowdpulse.schemas import LISTING_DEFAULT, REFRESH_DEFAULT
from crowdpulse.session import build_session
from crowdpulse.streaming.run import every


def parse(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Show user statistics")
    parser.add_argument("--tables", required=True, help="folder the ingest job writes to")
    parser.add_argument("--limit", type=int, default=LISTING_DEFAULT, help="users shown, 5..50")
    parser.add_argument("--refresh", type=int, default=REFRESH_DEFAULT, help="seconds, 5..60")
    parser.add_argument("--ticks", type=int, help="stop after so many refreshes")
    return parser.parse_args(argv)


def show_once(spark: SparkSession, args: argparse.Namespace, echo: Callable[[str], None]) -> None:
    now = spark.range(1).select(refresh_text(F.current_timestamp())).first()[0]
    echo(f"refreshed {now}")
    for name, frame in Dashboard(spark, args.tables).refresh(args.limit).items():
        rows = frame.toPandas()  # each frame is bounded: see Dashboard
        echo(f"\n{name}\n{rows.to_string(index=False) if len(rows) else '(nothing yet)'}")


def run(spark: SparkSession, args: argparse.Namespace, echo: Callable[[str], None] = print) -> None:
    every(args.refresh)  # checks the interval
    shown = 0
    while args.ticks is None or shown < args.ticks:
        if shown:
            time.sleep(args.refresh)
        try:
            show_once(spark, args, echo)
        except (PySparkException, Py4JError) as error:  # such as a snapshot removed while it is read
            echo(f"refresh failed, going on: {error}")
        shown += 1


def main(argv: Sequence[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session("show users")
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
