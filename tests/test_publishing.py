"""Envelopes: size, losslessness, hot stamps; and the cadence of polls."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crowdpulse.operators.cadence import poll_at_cadence
from crowdpulse.operators.messages import flatten_users
from crowdpulse.operators.publishing import pack_envelopes, stamp_ingestion, to_messages
from crowdpulse.sources.topic import message_batch, publish, publish_to_files

FEED = (
    "user_id STRING, gender STRING, first_name STRING, last_name STRING, country STRING, "
    "age INT, email STRING, ingestion_timestamp BIGINT"
)

texts = st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=8))
people = st.lists(
    st.tuples(
        texts, texts, st.text(st.sampled_from('ab"\\\n\té🙂{'), max_size=6), texts, texts,
        st.one_of(st.none(), st.integers(-5, 130)), texts, st.sampled_from([0, 7, 1704067200]),
    ),
    max_size=40,
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=people)
def test_round_trip_gives_the_same_users(spark, rows):
    feed = spark.createDataFrame(rows, FEED).repartition(3)
    names = ("user_id", "gender", "full_name", "country", "age", "email", "ingestion_timestamp")
    got = flatten_users(to_messages(pack_envelopes(feed)), names).collect()
    want = [
        (uid, gender, " ".join(p for p in (first, last) if p is not None), country, age, email, stamp)
        for uid, gender, first, last, country, age, email, stamp in rows
    ]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_hot_stamp_is_cut_into_envelopes(spark):
    rows = spark.range(0, 1005, 1, 4).select(
        F.col("id").cast("string").alias("user_id"), F.lit("male").alias("gender"),
        F.lit("A").alias("first_name"), F.lit("B").alias("last_name"), F.lit("FR").alias("country"),
        F.lit(1).alias("age"), F.lit("e").alias("email"), F.lit(5).cast("long").alias("ingestion_timestamp"),
    )
    sizes = [len(r.results) for r in pack_envelopes(rows).collect()]
    assert sum(sizes) == 1005 and max(sizes) == 10
    assert len(sizes) <= 1005 // 10 + 4


def test_stamp_is_epoch_seconds(spark):
    rows = stamp_ingestion(spark.range(3), F.lit(1704067200))
    assert rows.schema["ingestion_timestamp"].dataType.simpleString() == "bigint"
    assert {r.ingestion_timestamp for r in rows.collect()} == {1704067200}
    assert stamp_ingestion(spark.range(3)).select("ingestion_timestamp").distinct().count() == 1


def test_published_messages_are_json_envelopes_without_key(spark, folder):
    rows = spark.createDataFrame([("u", "male", "É", None, "FR", 3, "e", 9)], FEED)
    publish(to_messages(pack_envelopes(rows)), "parquet", {"path": folder("topic")})
    row = spark.read.parquet(folder("topic")).first()
    assert row.key is None
    body = json.loads(bytes(row.value).decode("utf-8"))
    assert body["ingestion_timestamp"] == 9
    assert body["results"][0]["name"] == {"first": "É"}


def test_file_topic_has_growing_offsets_per_partition(spark, folder):
    rows = [(f"u{i}", "male", "A", "B", "FR", 1, "e", i // 10) for i in range(200)]
    feed = spark.createDataFrame(rows, FEED)
    for start in (0, 1 << 40):
        publish_to_files(to_messages(pack_envelopes(feed)), folder("topic"), first_offset=start)
    topic = message_batch(spark, "parquet", {"path": folder("topic")})
    assert topic.count() == topic.select("partition", "offset").distinct().count()
    assert topic.where("offset >= (1L << 40)").count() * 2 == topic.count()


def test_polls_are_full_and_evenly_spaced(spark):
    # Uneven partitions: 1 row, 200 rows, none, 56 rows.
    rows = spark.range(257).repartition(6, F.when(F.col("id") == 0, 1).when(F.col("id") < 201, 2).otherwise(3))
    polled = poll_at_cadence(rows, start=100, per_poll=10, seconds=10)
    counts = {r.ingestion_timestamp: r["count"] for r in polled.groupBy("ingestion_timestamp").count().collect()}
    assert sorted(counts) == [100 + 10 * i for i in range(26)]
    assert sorted(counts.values()) == [7] + [10] * 25
    assert counts[350] == 7
    assert polled.select("id").distinct().count() == 257


class Recorder:
    """Stands in for a reader, to see which options a connector would get."""

    def format(self, fmt):
        self.fmt, self.given = fmt, {}
        return self

    def options(self, **given):
        self.given = given
        return self


def test_kafka_reader_starts_at_the_earliest_message_and_tolerates_loss():
    from crowdpulse.sources.topic import _reader

    reader = _reader(Recorder(), "kafka", {"subscribe": "users", "startingOffsets": "latest"})
    assert reader.given == {"subscribe": "users", "startingOffsets": "latest", "failOnDataLoss": "false"}
    reader = _reader(Recorder(), "kafka", {"subscribe": "users"})
    assert reader.given["startingOffsets"] == "earliest"
