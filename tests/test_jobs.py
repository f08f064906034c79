"""The programs end to end on file topics."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from crowdpulse.jobs import compact, dashboard, ingest, publish
from crowdpulse.schemas import USERS
from crowdpulse.session import (
    INPUT_PER_PARTITION,
    MOST_PARTITIONS,
    input_bytes,
    size_shuffles,
)
from crowdpulse.sources.scratch import shared_root
from crowdpulse.sources.tables import UsersTable
from crowdpulse.sources.topic import message_batch, publish_to_files
from crowdpulse.streaming.views import country_stats_table


@pytest.fixture
def topic(spark, folder):
    spark.range(0, 95, 1, 3).select(
        F.concat(F.lit("u"), "id").alias("user_id"),
        F.lit("male").alias("gender"),
        F.lit("A").alias("first_name"),
        F.lit("B").alias("last_name"),
        F.concat(F.lit("C"), (F.col("id") % 4).cast("string")).alias("country"),
        F.lit(30).alias("age"),
        F.lit("e").alias("email"),
    ).write.parquet(folder("feed"))
    args = publish.parse(
        ["--input", folder("feed"), "--target-format", "parquet", "--target-option", f"path={folder('published')}"]
    )
    publish.run(spark, args)
    messages = message_batch(spark, "parquet", {"path": folder("published")}).select("key", "value")
    stamp = F.get_json_object(F.col("value").cast("string"), "$.ingestion_timestamp").cast("long")
    publish_to_files(messages.withColumn("ingestion_timestamp", stamp), folder("topic"))
    return folder("topic")


@pytest.mark.parametrize("more", [["--shared"], ["--debug"]])
def test_ingest_then_dashboard(spark, topic, folder, more):
    args = ingest.parse(
        ["--source-format", "parquet", "--source-option", f"path={topic}",
         "--documents-format", "json", "--documents-option", f"path={folder('documents')}",
         "--table-format", "parquet", "--table-option", f"path={folder('external')}",
         "--tables", folder("tables"), "--checkpoints", folder("progress"), "--drain", *more]
    )
    for _ in range(2):
        ingest.run(spark, args)
    stored = spark.read.json(folder("documents"))
    assert stored.count() == 95 and set(stored.columns) - {"batch_id"} == set(USERS.names)
    external = spark.read.schema(USERS).parquet(folder("external"))
    assert external.dropDuplicates(["user_id"]).count() == 95
    assert UsersTable(spark, f"{folder('tables')}/users").current().count() == 95
    compact.run(spark, compact.parse(["--tables", folder("tables")]))
    assert UsersTable(spark, f"{folder('tables')}/users").current().count() == 95
    stats = country_stats_table(spark, f"{folder('tables')}/country_stats").read_latest()
    assert {r.country: r.count_users for r in stats.collect()} == {"C0": 24, "C1": 24, "C2": 24, "C3": 23}

    shown = []
    dashboard.run(spark, dashboard.parse(["--tables", folder("tables"), "--ticks", "1"]), shown.append)
    text = "\n".join(shown)
    assert shown[0].startswith("refreshed ")
    assert "30.0 ans" in text and "Nom Complet" in text and "C3" in text


def test_dashboard_outlives_a_failed_refresh(spark, folder, monkeypatch):
    real, calls, shown = dashboard.show_once, [], []

    def once(*args):
        calls.append(1)
        if len(calls) == 1:
            spark.read.parquet(folder("gone")).count()
        real(*args)

    monkeypatch.setattr(dashboard, "show_once", once)
    monkeypatch.setattr(dashboard.time, "sleep", lambda seconds: None)
    dashboard.run(spark, dashboard.parse(["--tables", folder("t"), "--ticks", "2"]), shown.append)
    assert shown[0].startswith("refresh failed") and shown[1].startswith("refreshed ")


def test_sinks_take_an_interval(spark, topic, folder):
    args = ingest.parse(
        ["--source-format", "parquet", "--source-option", f"path={topic}", "--every", "1",
         "--tables", folder("tables"), "--checkpoints", folder("progress")]
    )
    queries = ingest.start(spark, args)
    try:
        for query in queries[:2]:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert UsersTable(spark, f"{folder('tables')}/users").current().count() == 95


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Cluster:
        conf = {}
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="share"):
        shared_root(Cluster)


def test_dashboard_checks_its_controls(spark, folder):
    with pytest.raises(ValueError):
        dashboard.run(spark, dashboard.parse(["--tables", folder("t"), "--refresh", "2"]))
    with pytest.raises(ValueError):
        dashboard.run(spark, dashboard.parse(["--tables", folder("t"), "--limit", "60", "--ticks", "1"]))


def test_shuffle_partitions_follow_the_input(spark, folder):
    key = "spark.sql.shuffle.partitions"
    own = int(spark.conf.get(key))
    try:
        assert size_shuffles(spark, 1) == own
        assert size_shuffles(spark, 100 * INPUT_PER_PARTITION + 1) == 101
        assert spark.conf.get(key) == "101"
        assert size_shuffles(spark, 1 << 60) == MOST_PARTITIONS
    finally:
        assert size_shuffles(spark, 0) == own
    spark.range(10).write.parquet(folder("ten"))
    assert input_bytes(spark, folder("ten")) > 0
