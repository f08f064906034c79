"""Sinks, restart, failure, replay and the views kept beside the users table."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from crowdpulse.operators import stats
from crowdpulse.operators.messages import flatten_users, quarantine
from crowdpulse.operators.publishing import pack_envelopes, to_messages
from crowdpulse.plans.dashboard import Dashboard
from crowdpulse.schemas import USERS
from crowdpulse.sources.tables import BatchFolders, UsersTable
from crowdpulse.sources.topic import message_batch, message_stream, publish_to_files
from crowdpulse.streaming.run import (
    DRAIN,
    await_all,
    await_any,
    drain,
    every,
    start_fan_out,
    start_shared_fan_out,
    start_sink,
)
from crowdpulse.streaming.sinks import (
    Sink,
    append_sink,
    debug_sink,
    keyed_sink,
    quarantine_sink,
    stored,
)
from crowdpulse.streaming.views import Views

ONE_FILE = {"maxFilesPerTrigger": "1"}


def feed(spark, first, last, age=20, country=None):
    return spark.range(first, last, 1, 2).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"),
        F.when(F.col("id") % 2 == 0, "male").otherwise("female").alias("gender"),
        F.lit("A").alias("first_name"),
        F.col("id").cast("string").alias("last_name"),
        (F.lit(country) if country else F.concat(F.lit("C"), (F.col("id") % 7).cast("string"))).alias("country"),
        (F.lit(age) + F.col("id") % 30).cast("int").alias("age"),
        F.lit("e").alias("email"),
        F.expr("1704067200 + id div 10 * 10").alias("ingestion_timestamp"),
    )


def publish(spark, rows, path, first_offset=0):
    publish_to_files(to_messages(pack_envelopes(rows)), path, first_offset=first_offset)


@pytest.fixture
def topic(spark, folder):
    """Two publications, so that one file per trigger gives several micro-batches."""
    publish(spark, feed(spark, 0, 60), folder("topic"))
    publish(spark, feed(spark, 60, 110), folder("topic"), first_offset=1 << 40)
    return folder("topic")


def users_of(spark, topic, options=ONE_FILE):
    return flatten_users(message_stream(spark, "parquet", {"path": topic, **options}), with_arrival=True)


def batch_users(spark, topic):
    return flatten_users(message_batch(spark, "parquet", {"path": topic}))


def stored_rows(spark, df, path):
    folders = BatchFolders(spark, path, df.schema)
    return folders.read(folders.complete())


def test_append_sink_goes_on_where_it_stopped(spark, topic, folder):
    users = users_of(spark, topic)
    sink = append_sink("parquet", {"path": folder("out")})
    counts = []
    for more in (None, None, feed(spark, 110, 125)):
        if more is not None:
            publish(spark, more, topic, first_offset=1 << 50)
        drain(users, [sink], folder("progress"))
        counts.append(spark.read.parquet(folder("out")).count())
    assert counts == [110, 110, 125]


def test_replay_counts_twice_in_append_and_once_in_keyed(spark, topic, folder):
    users = users_of(spark, topic)
    sinks = [append_sink("json", {"path": folder("out")}), keyed_sink(folder("users"))]
    drain(users, sinks, folder("progress"))
    publish(spark, feed(spark, 0, 60, age=50), topic, first_offset=1 << 50)
    drain(users, sinks, folder("progress"))
    assert spark.read.json(folder("out")).count() == 170
    current = UsersTable(spark, folder("users")).current()
    assert current.count() == 110
    assert current.where("age >= 50").count() == 60


@pytest.mark.parametrize("compacted", [False, True])
def test_a_new_checkpoint_overwrites_and_hides_nothing(spark, folder, compacted):
    path, sink = folder("users"), keyed_sink(folder("users"), folder("views"))
    table = UsersTable(spark, path)
    for number, (first, last, progress) in enumerate([(0, 20, "one"), (20, 50, "two"), (50, 60, "one")]):
        # Several files, so several micro-batches; the first checkpoint comes back at the end.
        topic = folder(f"topic-{progress}")
        for start in range(first, last, 10):
            publish(spark, feed(spark, start, start + 10), topic, first_offset=start << 20)
        drain(users_of(spark, topic), [sink], folder(progress))
        if compacted:
            table.compact()
        assert table.current().count() == last
    newest = Views(spark, folder("views")).latest.read(5).collect()
    assert [r.user_id for r in newest] == ["u50", "u51", "u52", "u53", "u54"]


def test_debug_sink_shows_few_rows_of_each_batch(spark, topic, folder):
    shown = []
    sink = debug_sink(rows=5, echo=shown.append, copy_to=folder("copy"))
    users = users_of(spark, topic)
    drain(users, [sink], folder("progress"))
    assert len(shown) > 1
    assert all(len(text.splitlines()) <= 2 + 5 for text in shown)
    assert stored_rows(spark, users, folder("copy")).count() == 110


def test_quarantine_and_table_split_the_stream(spark, folder, messages):
    junk = messages("{bad", "", None).select("value", F.lit(0).cast("long").alias("ingestion_timestamp"))
    keyless = feed(spark, 0, 40).withColumn("user_id", F.when(F.col("user_id") != "u7", F.col("user_id")))
    publish(spark, keyless, folder("topic"))
    publish_to_files(junk.withColumn("key", F.lit(None).cast("binary")), folder("topic"), first_offset=1 << 40)
    source = message_stream(spark, "parquet", {"path": folder("topic")})
    bad = quarantine(source)
    drain(bad, [quarantine_sink(folder("bad"))], folder("progress"))
    drain(flatten_users(source, with_arrival=True), [keyed_sink(folder("users"))], folder("progress"))
    stored = stored_rows(spark, bad, folder("bad")).select(F.explode("reasons.reason").alias("reason"))
    reasons = stored.groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in reasons} == {"no user_id": 1, "malformed": 1, "empty message": 2}
    assert UsersTable(spark, folder("users")).current().count() == 39


def test_fan_out_queries_have_their_own_progress(spark, topic, folder):
    users = users_of(spark, topic)
    append = append_sink("parquet", {"path": folder("out")})
    drain(users, [append], folder("progress"))
    drain(users, [append, keyed_sink(folder("users"))], folder("progress"))
    assert spark.read.parquet(folder("out")).count() == 110
    assert UsersTable(spark, folder("users")).current().count() == 110


def test_shared_fan_out_feeds_all_sinks(spark, topic, folder):
    users = users_of(spark, topic)
    sinks = [append_sink("json", {"path": folder("out")}), keyed_sink(folder("users"))]
    for _ in range(2):
        await_all([start_shared_fan_out(users, sinks, folder("progress"), DRAIN)])
    assert spark.read.schema(users.schema).json(folder("out")).count() == 110
    assert UsersTable(spark, folder("users")).entries().count() == 110


def failing(sink, at_batch):
    """A sink that dies once, after its write and before the commit."""
    left = [1]

    def write(batch, batch_id):
        sink.write(batch, batch_id)
        if batch_id == at_batch and left:
            left.pop()
            raise RuntimeError("on purpose")

    return Sink(sink.name, write)


def test_failure_after_the_write_leaves_no_duplicates(spark, topic, folder):
    users = users_of(spark, topic)
    sink = failing(keyed_sink(folder("users"), folder("views")), at_batch=1)
    with pytest.raises(StreamingQueryException):
        drain(users, [sink], folder("progress"))
    drain(users, [sink], folder("progress"))
    assert UsersTable(spark, folder("users")).entries().count() == 110
    newest = [r.user_id for r in Views(spark, folder("views")).latest.read(5).collect()]
    assert newest == ["u100", "u101", "u102", "u103", "u104"]


def test_first_failure_stops_the_other_queries_and_is_raised(spark, topic, folder):
    users = users_of(spark, topic)
    dying = failing(keyed_sink(folder("users"), name="dying"), at_batch=0)
    going = append_sink("parquet", {"path": folder("out")}, name="going")
    queries = start_fan_out(users, [going, dying], folder("progress"))
    with pytest.raises(StreamingQueryException):
        await_any(queries, poll_seconds=0.1)
    assert not any(query.isActive for query in queries)


def test_failed_drain_stops_the_other_queries(spark, topic, folder):
    users = users_of(spark, topic)
    dying = failing(keyed_sink(folder("users"), name="dying"), at_batch=0)
    endless = start_sink(users, append_sink("parquet", {"path": folder("out")}, "endless"), folder("progress"))
    with pytest.raises(StreamingQueryException):
        await_all([endless, start_sink(users, dying, folder("progress"), DRAIN)])
    assert not endless.isActive


def test_append_mode_refuses_an_unbounded_aggregate(spark, topic, folder):
    from pyspark.errors import AnalysisException

    counted = stats.gender_counts(users_of(spark, topic))
    with pytest.raises(AnalysisException):
        start_sink(counted, append_sink("parquet", {"path": folder("out")}), folder("progress"), DRAIN)


def same_views(spark, views, path):
    """The published views are what counting the whole table gives."""
    current = UsersTable(spark, path).current()
    state = views.read(50)
    key = lambda row: [(value is not None, value) for value in row]
    assert sorted(state["country_stats"].collect(), key=key) == sorted(stats.country_stats(current).collect(), key=key)
    assert sorted(state["tallies"].collect(), key=key) == sorted(stats.tallies(current).collect(), key=key)
    newest = current.orderBy(F.desc("ingestion_time"), "user_id").limit(50)
    assert state["latest_users"].collect() == newest.collect()


def test_kept_views_equal_the_whole_table(spark, topic, folder):
    drain(users_of(spark, topic), [keyed_sink(folder("users"), folder("views"))], folder("progress"))
    views = Views(spark, folder("views"))
    assert len(views.countries.complete()) > 1
    same_views(spark, views, folder("users"))
    want = stats.country_stats(batch_users(spark, topic)).collect()
    assert sorted(views.countries.read_latest().collect()) == sorted(want)


def total_of(views):
    return views.read()["tallies"].agg(F.sum("n")).first()[0]


def test_replays_changes_late_rows_and_new_checkpoints_are_counted_exactly(spark, folder):
    sink, views = keyed_sink(folder("users"), folder("views")), Views(spark, folder("views"))
    late = feed(spark, 0, 9, country="old").withColumn("ingestion_timestamp", F.lit(1_600_000_000).cast("long"))
    deliveries = [
        (feed(spark, 0, 80), "one", 80),
        (feed(spark, 20, 40), "one", 80),
        (feed(spark, 20, 40, age=70, country="moved"), "two", 80),
        (late.withColumn("age", F.lit(None).cast("int")), "two", 89),
        (feed(spark, 0, 5).withColumn("country", F.lit(None).cast("string")), "three", 89),
    ]
    for number, (rows, progress, total) in enumerate(deliveries):
        topic = folder(f"topic-{progress}")
        publish(spark, rows, topic, first_offset=number << 40)
        drain(users_of(spark, topic), [sink], folder(progress))
        assert total_of(views) == total
        same_views(spark, views, folder("users"))
        if number % 2:
            UsersTable(spark, folder("users")).compact()


def test_views_catch_up_with_batches_they_missed(spark, folder):
    publish(spark, feed(spark, 0, 30), folder("topic"))
    drain(users_of(spark, folder("topic")), [keyed_sink(folder("users"))], folder("progress"))
    table, views = UsersTable(spark, folder("users")), Views(spark, folder("views"))
    for first in (30, 60):  # compacted and removed before the views came
        table.append(users_batch(spark, folder(f"more-{first}"), first, first + 30), 1 + first)
        table.compact()
    publish(spark, feed(spark, 90, 95), folder("topic"), first_offset=1 << 40)
    drain(users_of(spark, folder("topic")), [keyed_sink(folder("users"), folder("views"))], folder("progress"))
    assert total_of(views) == 95
    same_views(spark, views, folder("users"))


def users_batch(spark, topic, first, last):
    publish(spark, feed(spark, first, last), topic)
    return flatten_users(message_batch(spark, "parquet", {"path": topic}), with_arrival=True)


def test_a_refresh_during_a_commit_shows_one_state(spark, folder, monkeypatch):
    """Read after each step of a commit: all old, until the last step makes all new."""
    table, views = UsersTable(spark, folder("users")), Views(spark, folder("views"))
    table.append(users_batch(spark, folder("first"), 0, 20), 0)
    views.advance(table, 0)
    seen = []

    def look(step):
        def looked(*args):
            step(*args)
            state = Views(spark, folder("views")).read(50)
            seen.append((state["tallies"].agg(F.sum("n")).first()[0], state["latest_users"].count(),
                         state["country_stats"].agg(F.sum("count_users")).first()[0]))
        return looked

    for part in (views.hours, views.tallies, views.countries, views.latest.table):
        monkeypatch.setattr(part, "write", look(part.write))
    monkeypatch.setattr(views, "_publish", look(views._publish))
    table.append(users_batch(spark, folder("second"), 20, 45), 1)
    views.advance(table, 1)
    assert seen == [(20, 20, 20)] * 4 + [(45, 45, 45)]


def test_documents_outlive_new_checkpoints_and_the_shared_form(spark, folder):
    options = {"path": folder("documents")}
    sinks, counts = [append_sink("json", options), keyed_sink(folder("users"))], []
    for number, (first, last) in enumerate([(0, 30), (30, 60), (60, 80)]):
        topic = folder(f"topic-{number}")
        publish(spark, feed(spark, first, last), topic)
        users = users_of(spark, topic)
        if number < 2:
            drain(users, sinks, folder(f"progress-{number}"))
        else:
            await_all([start_shared_fan_out(users, sinks, folder("progress-2"), DRAIN)])
        plain = spark.read.schema(users.schema).json(folder("documents")).count()
        counts.append((stored(spark, "json", options, users.schema).count(), plain))
    assert counts == [(30, 30), (60, 60), (80, 80)]


@pytest.mark.parametrize("after_write", [True, False])
def test_a_batch_taken_up_after_another_query_is_stored_once(spark, folder, after_write):
    """A query dies after or before its write; another writes; the first comes back."""
    path = folder("bad")
    sink, left = quarantine_sink(path), [1]

    def write(batch, batch_id):
        if left:
            left.pop()
            if after_write:
                sink.write(batch, batch_id)
            else:
                folders = BatchFolders(batch.sparkSession, path, batch.schema)
                folders.own_id(batch_id)
            raise RuntimeError("on purpose")
        sink.write(batch, batch_id)

    for name, first in (("one", 0), ("two", 10)):
        publish(spark, feed(spark, first, first + 10), folder(name))
    one, two = users_of(spark, folder("one")), users_of(spark, folder("two"))
    with pytest.raises(StreamingQueryException):
        drain(one, [Sink("bad", write)], folder("progress-one"))
    drain(two, [sink], folder("progress-two"))
    drain(one, [Sink("bad", write)], folder("progress-one"))
    drain(two, [sink], folder("progress-two"))
    assert stored_rows(spark, one, path).count() == 20


def test_dashboard_frames_come_from_one_state(spark, topic, folder):
    users = users_of(spark, topic)
    drain(users, [keyed_sink(folder("users"), folder("views"))], folder("progress"))
    frames = Dashboard(spark, folder("views")).refresh(limit=7)
    everyone = batch_users(spark, topic)
    per_country = stats.country_stats(everyone)
    kept = Views(spark, folder("views")).countries.read_latest()
    assert sorted(kept.collect()) == sorted(per_country.collect())
    kpis = frames["kpis"].first()
    assert (kpis.total_users, kpis.countries) == (110, 7)
    assert kpis.avg_age == pytest.approx(stats.avg_age_kpi(per_country).first().avg_age)
    assert kpis.avg_age_text == f"{kpis.avg_age:.1f} ans"
    assert [r.country for r in frames["top_countries"].collect()][0] in {"C0", "C1", "C2", "C3", "C4"}
    assert {r.gender: r["count"] for r in frames["gender_share"].collect()} == {"male": 55, "female": 55}
    listing = frames["latest_users"].collect()
    assert len(listing) == 7 and listing[0]["ID"] == "u100"
    assert listing[0]["Date d'ingestion"] == dt.datetime(2024, 1, 1, 0, 1, 40)


def test_dashboard_over_nothing(spark, folder):
    frames = Dashboard(spark, folder("views")).refresh()
    assert frames["kpis"].first().total_users == 0
    assert frames["latest_users"].count() == 0


@pytest.mark.parametrize("seconds", [4, 61])
def test_refresh_interval_is_checked(seconds):
    with pytest.raises(ValueError):
        every(seconds)


def test_refresh_interval():
    assert every() == {"processingTime": "10 seconds"}


def test_schema_of_users_from_stream(spark, topic):
    assert batch_users(spark, topic).schema.simpleString() == USERS.simpleString()
