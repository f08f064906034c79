"""Statistics and newest users kept beside a users table, exact and published together."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdpulse.operators.keyed import last_write
from crowdpulse.operators.listings import latest_of_log, latest_users
from crowdpulse.operators.stats import countries_from_tallies, merged_tallies, tallies
from crowdpulse.schemas import COUNTRY_STATS, LISTING_DEFAULT, LISTING_MAX
from crowdpulse.sources.scratch import children, discard, touch
from crowdpulse.sources.tables import (
    HOUR,
    SNAPSHOTS_KEPT,
    USERS_LOG,
    WRITE_ORDER,
    SnapshotTable,
    UsersTable,
    hour_of,
)

HOUR_FILES = 8

TALLIES = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("age_sum", T.LongType()),
        T.StructField("age_n", T.LongType()),
        T.StructField("last_update", T.TimestampType()),
    ]
)


def country_stats_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, COUNTRY_STATS, keep=SNAPSHOTS_KEPT)


def tallies_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, TALLIES, keep=SNAPSHOTS_KEPT)


def _lost(log: Iterable[int], since: int) -> bool:
    """A batch after `since` may have been folded and removed."""
    return min(log, default=since) > since + 1


class LatestUsers:
    """The newest users, carried from batch to batch.

    A refresh then reads 50 rows, not the table. Exact: a new batch adds keys or
    rewrites them, so the newest of (old newest + batch) are the newest of all.
    """

    def __init__(self, spark: SparkSession, path: str):
        written = T.StructField("written", T.LongType())
        schema = T.StructType([*USERS_LOG.fields, written])
        self.table = SnapshotTable(spark, path, schema, keep=SNAPSHOTS_KEPT)

    def advance(self, users: UsersTable, batch_id: int) -> None:
        before, log = self.table.latest_id(before=batch_id), users.log.complete()
        if before is None or _lost(log, before):
            entries = users.entries()
        else:
            # Reads the stored batches, so the messages are not parsed again.
            entries = users.log.read([i for i in log if before < i <= batch_id])
            old = self.table.read([before]).drop("batch_id")
            entries = entries.unionByName(old.withColumnRenamed("written", "batch_id"))
        newest = latest_of_log(entries, WRITE_ORDER, LISTING_MAX)
        self.table.write(newest.withColumnRenamed("batch_id", "written"), batch_id)

    def read(self, limit: int = LISTING_DEFAULT) -> DataFrame:
        return latest_users(self.table.read_latest(), limit)

    def at(self, batch_id: int, limit: int = LISTING_DEFAULT) -> DataFrame:
        return latest_users(self.table.read([batch_id]).drop("batch_id"), limit)


class Views:
    """Tallies, country statistics and newest users of a users table, below one folder.

    Tallies are kept per hour. A batch of the log touches some hours; these are
    counted again from the table as last written, the others are taken over,
    and all are merged. So a replayed, changed or late row, or a new checkpoint,
    gives what counting the whole table would give, without state per user,
    and the work grows with the touched hours.

    All three are written under the log's batch id before the id is published,
    so a reader that takes the published id sees one state of the table.
    """

    def __init__(self, spark: SparkSession, path: str):
        root = path.rstrip("/")
        self.spark, self.pointer = spark, f"{root}/_published"
        by_hour = T.StructType([HOUR, *TALLIES.fields])
        self.hours = SnapshotTable(spark, f"{root}/hours", by_hour, keep=SNAPSHOTS_KEPT)
        self.tallies = tallies_table(spark, f"{root}/tallies")
        self.countries = country_stats_table(spark, f"{root}/country_stats")
        self.latest = LatestUsers(spark, f"{root}/latest")

    def published(self, before: int | None = None) -> int | None:
        """The id of the newest state that is there as a whole."""
        ids = [int(name) for name in children(self.spark, self.pointer) if name.isdigit()]
        return max([i for i in ids if before is None or i < before], default=None)

    def _touched(self, users: UsersTable, since: int | None, batch_id: int) -> set[int] | None:
        """The hours of the batches after `since`; None means all, where they can't be told."""
        log = users.log.hours()
        if since is None or since not in self.hours.complete() or _lost(log, since):
            return None
        return set().union(*[held for i, held in log.items() if since < i <= batch_id])

    def advance(self, users: UsersTable, batch_id: int) -> None:
        """Brings all views to the log's batch `batch_id`; a batch already published stays as it is."""
        if self.published() is not None and self.published() >= batch_id:
            return
        since = self.published(before=batch_id)
        touched = self._touched(users, since, batch_id)
        resolved = last_write(users.entries(touched), WRITE_ORDER)
        parts = [tallies(resolved.withColumn(HOUR.name, hour_of()), HOUR.name)]
        if touched is not None:
            old = self.hours.read([since]).drop("batch_id")
            parts.append(old.where(~F.col(HOUR.name).isin(touched)) if touched else old)
        # A row per hour, or one per country and gender, needs few files whatever the shuffles' width.
        self.hours.write(reduce(DataFrame.unionByName, parts).coalesce(HOUR_FILES), batch_id)
        self.tallies.write(merged_tallies(self.hours.read([batch_id])).coalesce(1), batch_id)
        self.countries.write(countries_from_tallies(self.tallies.read([batch_id])).coalesce(1), batch_id)
        self.latest.advance(users, batch_id)
        self._publish(batch_id)

    def _publish(self, batch_id: int) -> None:
        touch(self.spark, f"{self.pointer}/{batch_id}")
        ids = sorted(int(name) for name in children(self.spark, self.pointer) if name.isdigit())
        for old in ids[:-SNAPSHOTS_KEPT]:
            discard(self.spark, f"{self.pointer}/{old}")

    def open_names(self, users: UsersTable) -> None:
        """`users` and `country_stats` as names for SQL, as the sinks have filled them up to now.

        The names stand for the files of this moment; opening them again renews them.
        """
        users.current().createOrReplaceTempView("users")
        self.read()["country_stats"].createOrReplaceTempView("country_stats")

    def read(self, limit: int = LISTING_DEFAULT) -> dict[str, DataFrame]:
        """Tallies, country statistics and newest users of one state of the table."""
        at = self.published()
        ids = [] if at is None else [at]
        return {
            "tallies": self.tallies.read(ids).drop("batch_id"),
            "country_stats": self.countries.read(ids).drop("batch_id"),
            "latest_users": self.latest.read(limit) if at is None else self.latest.at(at, limit),
        }
