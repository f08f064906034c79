"""Bounded listings: top countries and latest users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.operators.keyed import last_write
from crowdpulse.schemas import (
    LISTING_DEFAULT,
    LISTING_LABELS,
    LISTING_MAX,
    LISTING_MIN,
    TOP_COUNTRIES,
    USER_COLUMNS,
    USER_KEY,
)


def _check_limit(limit: int) -> int:
    if not LISTING_MIN <= limit <= LISTING_MAX:
        raise ValueError(f"limit must be {LISTING_MIN}..{LISTING_MAX}, got {limit}")
    return limit


def top_countries(stats: DataFrame, limit: int = TOP_COUNTRIES) -> DataFrame:
    return stats.orderBy(F.desc("count_users"), "country").limit(limit)


def top_age_countries(stats: DataFrame, limit: int = TOP_COUNTRIES) -> DataFrame:
    """Missing means come last, and NaN counts as missing (Spark sorts it first)."""
    age = F.when(~F.isnan("avg_age"), F.col("avg_age"))
    return stats.orderBy(F.desc_nulls_last(age), "country").limit(limit)


def latest_users(users: DataFrame, limit: int = LISTING_DEFAULT) -> DataFrame:
    """The newest rows of a table that holds each key once."""
    newest = users.orderBy(F.desc("ingestion_time"), "user_id").limit(_check_limit(limit))
    return newest.select(*USER_COLUMNS)


def latest_of_log(log: DataFrame, order: tuple[str, ...], limit: int = LISTING_DEFAULT) -> DataFrame:
    """The newest rows of a log that may hold a key many times, as last written.

    Resolving the whole log first would shuffle all of it for at most 50 rows.
    Each stamp holds a key, so the newest keys are not older than the last of
    the `limit` newest stamps; that bound reaches the scan, and only keys above it
    are told apart. They are at most `limit` rows, hence the broadcast, and only
    their copies are resolved. Order columns are kept.
    """
    stamps = log.select("ingestion_time").distinct()
    stamps = stamps.orderBy(F.desc("ingestion_time")).limit(_check_limit(limit))
    bound = stamps.agg(F.min("ingestion_time")).first()[0]
    if bound is not None:
        log = log.where(F.col("ingestion_time") >= F.lit(bound))
    newest_keys = log.select(*USER_KEY).distinct().orderBy(F.desc("ingestion_time"), "user_id").limit(limit)
    copies = log.join(F.broadcast(newest_keys), list(USER_KEY), "left_semi")
    return last_write(copies, order)


def user_listing(users: DataFrame) -> DataFrame:
    """The listing's column order and labels."""
    return users.select(*[F.col(name).alias(label) for name, label in LISTING_LABELS.items()])
