"""Users, envelopes and messages derived from the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.functions import epoch_to_time
from crowdpulse.operators.publishing import pack_envelopes, stamp_ingestion, to_messages
from crowdpulse.schemas import POLL_SECONDS, USER_COLUMNS, USERS_PER_ENVELOPE

# The first poll of the fixture, 2024-01-01 00:00:00 UTC.
START = 1704067200


# Only the columns used, stated so that no job has to read footers for them.
COLUMNS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT",
    "nation": "n_nationkey INT, n_name STRING",
    "events": "event_id BIGINT, props STRING",
    "documents": "text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def poll_stamp(key: str) -> Column:
    """Ten neighbouring keys share a stamp, and stamps are ten seconds apart."""
    poll = F.expr(f"{key} div {USERS_PER_ENVELOPE}")
    return F.lit(START) + poll * F.lit(POLL_SECONDS)


def user_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as API users with their stamp.

    The join to nation carries no hint: Spark broadcasts nation while its size
    is below the threshold and else joins by shuffle.
    """
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    male = F.col("c_custkey") % 2 == 0
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey, "left")
    feed = joined.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.when(male, "male").otherwise("female").alias("gender"),
        F.col("c_name").alias("first_name"),
        F.lit(None).cast("string").alias("last_name"),
        F.col("n_name").alias("country"),
        (F.lit(18) + F.col("c_custkey") % 60).cast("int").alias("age"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        poll_stamp("c_custkey").alias("_stamp"),
    )
    return stamp_ingestion(feed, F.col("_stamp")).drop("_stamp")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same users as rows of the users table."""
    feed = user_feed(spark, sf_dir)
    return feed.select(
        "user_id",
        "gender",
        F.col("first_name").alias("full_name"),
        "country",
        "age",
        "email",
        epoch_to_time(F.col("ingestion_timestamp")).alias("ingestion_time"),
    ).select(*USER_COLUMNS)


def messages(feed: DataFrame) -> DataFrame:
    """A feed as JSON envelopes of at most ten users."""
    return to_messages(pack_envelopes(feed))


def flat_messages(rows: DataFrame) -> DataFrame:
    """Users as flat JSON records, one per message."""
    record = F.struct(
        F.col("user_id").cast("long").alias("id"),
        F.col("full_name").alias("name"),
        "email",
        "age",
        "country",
    )
    return rows.select(F.to_json(record).cast("binary").alias("value"))
