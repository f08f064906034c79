"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Batch queries read the tables directly. Streaming queries first publish the
users as a topic of parquet files with the Kafka columns, drain it through the
real sources and sinks, and return what was stored.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.functions import epoch_to_time, refresh_text, utc_ntz
from crowdpulse.operators import listings, stats
from crowdpulse.operators.cadence import poll_at_cadence
from crowdpulse.operators.keyed import first_arrival, last_write
from crowdpulse.operators.messages import flatten_users, judged, parse_flat, text_of
from crowdpulse.plans import fixture
from crowdpulse.plans.dashboard import Dashboard
from crowdpulse.schemas import USER_COLUMNS
from crowdpulse.session import input_bytes, size_shuffles
from crowdpulse.sources.scratch import discard, new_folder
from crowdpulse.sources.tables import BatchFolders, UsersTable, create_tables
from crowdpulse.sources.topic import message_batch, message_stream, publish, publish_to_files
from crowdpulse.streaming.run import (
    DRAIN,
    await_all,
    await_any,
    drain,
    failures,
    start_fan_out,
    start_shared_fan_out,
)
from crowdpulse.streaming.sinks import Sink, append_sink, debug_sink, keyed_sink, stored
from crowdpulse.streaming.views import Views, country_stats_table

log = logging.getLogger(__name__)

Query = Callable[[SparkSession, str], DataFrame]

# Offsets of a second publication start here, above all of the first.
SECOND_ROUND = 1 << 60

STORED = ("user_id", "country", "age")


def _edge(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as zone-free UTC, the form the test tables use."""
    return df.withColumns({name: utc_ntz(F.col(name)) for name in columns})


def _users_edge(df: DataFrame) -> DataFrame:
    return _edge(df.select(*USER_COLUMNS), "ingestion_time")


def _stats_edge(df: DataFrame) -> DataFrame:
    return _edge(df, "last_update")


# --- staged topics ----------------------------------------------------------


def _topic(spark: SparkSession, feed: DataFrame) -> str:
    path = new_folder(spark, "topic")
    publish_to_files(fixture.messages(feed), path)
    return path


def _stream(spark: SparkSession, topic: str) -> DataFrame:
    return message_stream(spark, "parquet", {"path": topic})


@contextmanager
def _staged(spark: SparkSession, sf_dir: str) -> Iterator[tuple[str, str]]:
    """A topic of all users and a folder for progress, both gone once drained."""
    topic = _topic(spark, fixture.user_feed(spark, sf_dir))
    progress = new_folder(spark, "progress")
    try:
        yield topic, progress
    finally:
        discard(spark, topic)
        discard(spark, progress)


def _user_stream(spark: SparkSession, topic: str) -> DataFrame:
    return flatten_users(_stream(spark, topic), with_arrival=True)


# --- sources and parsing ----------------------------------------------------


def src_message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_folder(spark, "users")
    with _staged(spark, sf_dir) as (topic, progress):
        users = _user_stream(spark, topic)
        drain(users, [append_sink("parquet", {"path": out})], progress)
    return _users_edge(stored(spark, "parquet", {"path": out}, users.schema))


def scan_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    users_table = UsersTable(spark, new_folder(spark, "users"))
    with _staged(spark, sf_dir) as (topic, _):
        messages = message_batch(spark, "parquet", {"path": topic})
        users_table.append(flatten_users(messages, with_arrival=True), 0)
    return _users_edge(users_table.current())


def scan_country_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    snapshots = country_stats_table(spark, new_folder(spark, "country-stats"))
    snapshots.write(stats.country_stats(fixture.users(spark, sf_dir)), 0)
    return _stats_edge(snapshots.read_latest())


def ddl_users_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables declared twice, filled by SQL from what the stream has stored, and read by name."""
    location, root = new_folder(spark, "declared"), new_folder(spark, "tables")
    database = "tables_" + location[-12:]
    create_tables(spark, database, location)
    create_tables(spark, database, location)
    with _staged(spark, sf_dir) as (topic, progress):
        views = _kept_views(spark, topic, progress, root)
    views.open_names(UsersTable(spark, f"{root}/users"))
    for name in ("users", "country_stats"):
        spark.sql(f"INSERT INTO {database}.{name} SELECT * FROM {name}")
    counted = f"SELECT sum(count_users) FROM {database}.country_stats"
    return _users_edge(spark.sql(f"SELECT * FROM {database}.users WHERE ({counted}) > 0"))


def src_cadence(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = fixture.table(spark, sf_dir, "customer").select("c_custkey")
    polled = poll_at_cadence(keys, fixture.START)
    return polled.groupBy("ingestion_timestamp").agg(F.count("*").alias("n_users"))


def decode_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = fixture.flat_messages(fixture.users(spark, sf_dir))
    return flat.select(F.get_json_object(text_of(), "$.name").alias("name"))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixture.table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k INT")["k"].alias("k"))


def parse_flat_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_flat(fixture.flat_messages(fixture.users(spark, sf_dir)))


def flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users_edge(flatten_users(fixture.messages(fixture.user_feed(spark, sf_dir))))


def stamp_ingestion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stamp as it comes out of the envelope's JSON text."""
    messages = fixture.messages(fixture.user_feed(spark, sf_dir))
    return flatten_users(messages, ("user_id", "ingestion_timestamp"))


def ingestion_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = fixture.user_feed(spark, sf_dir)
    stamped = feed.select(
        "user_id",
        "ingestion_timestamp",
        epoch_to_time(F.col("ingestion_timestamp")).alias("ingestion_time"),
    )
    return _edge(stamped, "ingestion_time")


def full_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-part names all the way through the JSON text."""
    feed = fixture.user_feed(spark, sf_dir)
    name = F.split("first_name", "#")
    two_parts = feed.withColumns({"first_name": name[0], "last_name": name[1]})
    parsed = flatten_users(fixture.messages(two_parts), ("user_id", "full_name"))
    return parsed.select(F.col("user_id").cast("long").alias("c_custkey"), "full_name")


def quarantine_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes with faults, mixed with documents that are no envelopes.

    Every fiftieth key is missing, the stamps of some polls are in milliseconds,
    and ages that end in 7 are sent as text: those users are stored, with a warning.
    """
    feed = fixture.user_feed(spark, sf_dir)
    key, stamp = F.col("user_id"), F.col("ingestion_timestamp")
    holed = feed.withColumns(
        {
            "user_id": F.when(key.cast("long") % 50 != 0, key),
            "ingestion_timestamp": F.when(stamp % 400 == 0, stamp * 1000).otherwise(stamp),
        }
    )
    envelopes = fixture.messages(holed).select(
        F.regexp_replace(text_of(), r'"age":([0-9]*7)\}', r'"age":"$1"}').cast("binary").alias("value")
    )
    documents = fixture.table(spark, sf_dir, "documents")
    mixed = envelopes.unionAll(documents.select(F.col("text").cast("binary").alias("value")))
    bad = F.col("reasons.reason")
    usable = F.array_repeat(F.lit("usable"), F.greatest(F.col("n_users") - F.size(bad), F.lit(0)))
    told = F.concat(bad, usable, F.col("warnings.reason"))
    reasons = judged(mixed).select(F.explode(told).alias("reason"))
    return reasons.groupBy("reason").agg(F.count("*").alias("n"))


# --- publishing -------------------------------------------------------------


def publish_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as `key`, `value`; read back; users and envelopes counted per stamp."""
    path = new_folder(spark, "published")
    publish(fixture.messages(fixture.user_feed(spark, sf_dir)), "parquet", {"path": path})
    envelope = F.from_json(text_of(), "results ARRAY<STRUCT<email: STRING>>, ingestion_timestamp BIGINT")
    published = message_batch(spark, "parquet", {"path": path}).select(envelope.alias("e"))
    sized = published.select(
        epoch_to_time(F.col("e.ingestion_timestamp")).alias("ingestion_time"),
        F.size("e.results").alias("n"),
    )
    per_stamp = sized.groupBy("ingestion_time").agg(
        F.sum("n").alias("n_users"), (F.max("n") <= 10).alias("within_size")
    )
    return _edge(per_stamp, "ingestion_time")


# --- aggregates and listings ------------------------------------------------


def _on_users(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(fixture.users(spark, sf_dir))


def _on_stats(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return _on_users(lambda users: operator(stats.country_stats(users)))


def _rounded(df: DataFrame, column: str) -> DataFrame:
    """Sums of doubles depend on their order in the last digits."""
    return df.withColumn(column, F.round(column, 6))


def kpi_avg_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_on_stats(stats.avg_age_kpi)(spark, sf_dir), "avg_age")


def kpi_empty_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean-age tile over all users, and over those of no country: there are none, so no tile."""
    users = fixture.users(spark, sf_dir)
    nowhere = users.where("country IS NULL").withColumn("country", F.lit("none"))
    tiles = [
        stats.avg_age_kpi(stats.country_stats(rows)).select(F.lit(scope).alias("scope"), "avg_age")
        for scope, rows in (("everywhere", users), ("nowhere", nowhere))
    ]
    return _rounded(reduce(DataFrame.unionAll, tiles), "avg_age")


def gender_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.gender_share(stats.gender_counts(fixture.users(spark, sf_dir)))


def latest_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users_edge(listings.latest_users(fixture.users(spark, sf_dir)))


def user_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings.user_listing(latest_users(spark, sf_dir))


def refresh_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _users_edge(fixture.users(spark, sf_dir))
    return rows.select("user_id", refresh_text(F.col("ingestion_time")).alias("t"))


# --- keyed tables -----------------------------------------------------------


def _two_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users published, then published a year older at higher offsets."""
    feed = fixture.user_feed(spark, sf_dir)
    topic = _topic(spark, feed)
    again = feed.withColumn("age", F.col("age") + 1)
    publish_to_files(fixture.messages(again), topic, first_offset=SECOND_ROUND)
    messages = message_batch(spark, "parquet", {"path": topic})
    return flatten_users(messages, with_arrival=True)


def users_last_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users_edge(last_write(_two_rounds(spark, sf_dir)))


def dedup_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _users_edge(first_arrival(_two_rounds(spark, sf_dir)))


# --- streaming sinks --------------------------------------------------------


def sink_debug(spark: SparkSession, sf_dir: str) -> DataFrame:
    copy = new_folder(spark, "debug")
    with _staged(spark, sf_dir) as (topic, progress):
        users = _user_stream(spark, topic).select(*STORED)
        drain(users, [debug_sink(echo=log.debug, copy_to=copy)], progress)
    return _batches(spark, users, copy)


def sink_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as JSON lines."""
    out = new_folder(spark, "documents")
    with _staged(spark, sf_dir) as (topic, progress):
        users = _user_stream(spark, topic)
        drain(users, [append_sink("json", {"path": out})], progress)
    return stored(spark, "json", {"path": out}, users.schema).select(*STORED)


def sink_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "users")
    with _staged(spark, sf_dir) as (topic, progress):
        drain(_user_stream(spark, topic), [keyed_sink(path)], progress)
    return UsersTable(spark, path).current().select(*STORED)


def _three_sinks(spark: SparkSession, sf_dir: str, start) -> DataFrame:
    """Rows stored by a debug, an append and a keyed sink on one stream."""
    paths = {name: new_folder(spark, name) for name in ("debug", "append", "keyed")}
    sinks = [
        debug_sink(echo=log.debug, copy_to=paths["debug"]),
        append_sink("json", {"path": paths["append"]}),
        keyed_sink(paths["keyed"]),
    ]
    with _staged(spark, sf_dir) as (topic, progress):
        users = _user_stream(spark, topic)
        start(users, sinks, progress)
    kept = {
        "debug": _batches(spark, users, paths["debug"]),
        "append": stored(spark, "json", {"path": paths["append"]}, users.schema),
        "keyed": UsersTable(spark, paths["keyed"]).current(),
    }
    counts = [
        rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("sink"), "n")
        for name, rows in kept.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def sink_fanout_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three queries, each with its own checkpoint."""
    return _three_sinks(spark, sf_dir, drain)


def sink_shared_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query that reads and parses once for all three."""

    def start(users: DataFrame, sinks: list[Sink], progress: str) -> None:
        await_all([start_shared_fan_out(users, sinks, progress, DRAIN)])

    return _three_sinks(spark, sf_dir, start)


def _batches(spark: SparkSession, like: DataFrame, path: str) -> DataFrame:
    folders = BatchFolders(spark, path, like.schema)
    return folders.read(folders.complete()).drop("batch_id")


def restart_no_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sink that dies after its write and before its commit, then two restarts.

    The first restart runs the lost batch again, the second finds nothing new.
    """
    path = new_folder(spark, "users")
    sink = keyed_sink(path)
    failures = iter([True])

    def write_then_die(batch: DataFrame, batch_id: int) -> None:
        sink.write(batch, batch_id)
        if next(failures, False):
            raise RuntimeError("stopped between write and commit, on purpose")

    with _staged(spark, sf_dir) as (topic, progress):
        users = _user_stream(spark, topic)
        try:
            drain(users, [Sink(sink.name, write_then_die)], progress)
        except StreamingQueryException:
            log.info("first run stopped as intended")
        drain(users, [sink], progress)
        drain(users, [sink], progress)
    return UsersTable(spark, path).entries().select(*STORED)


def _third(feed: DataFrame, number: int) -> DataFrame:
    return feed.where(F.col("user_id").cast("long") % 3 == number)


def sink_new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and users after each of three deliveries: a query each, new checkpoints, one for both."""
    documents, users_path = new_folder(spark, "documents"), new_folder(spark, "users")
    sinks = [append_sink("json", {"path": documents}), keyed_sink(users_path)]
    feed, counts = fixture.user_feed(spark, sf_dir), []
    for number in range(3):
        topic, progress = _topic(spark, _third(feed, number)), new_folder(spark, "progress")
        users = _user_stream(spark, topic)
        if number < 2:
            drain(users, sinks, progress)
        else:
            await_all([start_shared_fan_out(users, sinks, progress, DRAIN)])
        rows = {
            "documents": stored(spark, "json", {"path": documents}, users.schema),
            "users": UsersTable(spark, users_path).current(),
        }
        for name, kept in rows.items():
            # Counted now: the next delivery changes what is stored.
            n = F.lit(kept.count()).alias("n")
            counts.append(spark.range(1).select(F.lit(number).alias("delivery"), F.lit(name).alias("sink"), n))
        discard(spark, topic)
        discard(spark, progress)
    return reduce(DataFrame.unionAll, counts)


def sink_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One of two sinks dies after its first write: the other is stopped, both go on after a restart."""
    documents, users_path = new_folder(spark, "documents"), new_folder(spark, "users")
    going, sink = append_sink("json", {"path": documents}), keyed_sink(users_path)

    def write_then_die(batch: DataFrame, batch_id: int) -> None:
        sink.write(batch, batch_id)
        raise RuntimeError("stopped between write and commit, on purpose")

    with _staged(spark, sf_dir) as (topic, progress):
        users = _user_stream(spark, topic)
        queries = start_fan_out(users, [going, Sink(sink.name, write_then_die)], progress)
        try:
            await_any(queries)
        except StreamingQueryException:
            log.info("stopped as intended")
        active = sum(query.isActive for query in queries)
        failed = [name.split("-")[0] for name in failures(queries)]
        drain(users, [going, sink], progress)
    kept = {
        "append": stored(spark, "json", {"path": documents}, users.schema),
        "keyed": UsersTable(spark, users_path).entries(),
    }
    counts = [
        rows.agg(F.count("*").alias("n")).select(
            F.lit(name).alias("sink"), F.lit(name in failed).alias("failed"), F.lit(active).alias("active"), "n"
        )
        for name, rows in kept.items()
    ]
    return reduce(DataFrame.unionAll, counts)


# --- views kept beside the users table --------------------------------------


def _kept_views(spark: SparkSession, topic: str, progress: str, root: str) -> Views:
    drain(_user_stream(spark, topic), [keyed_sink(f"{root}/users", root)], progress)
    return Views(spark, root)


def country_stats_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    with _staged(spark, sf_dir) as (topic, progress):
        views = _kept_views(spark, topic, progress, new_folder(spark, "tables"))
    return _stats_edge(views.countries.read_latest())


def country_stats_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a topic that is published again in between: the replay changes nothing."""
    root = new_folder(spark, "tables")
    with _staged(spark, sf_dir) as (topic, progress):
        _kept_views(spark, topic, progress, root)
        replay = fixture.messages(fixture.user_feed(spark, sf_dir))
        publish_to_files(replay, topic, first_offset=SECOND_ROUND)
        views = _kept_views(spark, topic, progress, root)
    return _stats_edge(views.countries.read_latest())


def statistics_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country statistics after changed, late and replayed rows, a new checkpoint and a compaction.

    A third of the users comes first. With a new checkpoint come all of them, the
    first third a year older; a last run moves every fifth user to another
    country and brings stamps an hour before all others.
    """
    root = new_folder(spark, "tables")
    feed = fixture.user_feed(spark, sf_dir)
    key = F.col("user_id").cast("long")
    older = feed.withColumn("age", F.col("age") + F.when(key % 3 == 0, 1).otherwise(0))
    moved = older.where(key % 5 == 0).withColumn("country", F.lit("ELSEWHERE"))
    late = older.where(key % 5 == 1).withColumn("ingestion_timestamp", F.col("ingestion_timestamp") - 86_400)
    for rows in (_third(feed, 0), older, moved.unionByName(late)):
        topic, progress = _topic(spark, rows), new_folder(spark, "progress")
        views = _kept_views(spark, topic, progress, root)
        UsersTable(spark, f"{root}/users").compact()
        discard(spark, topic)
        discard(spark, progress)
    return _stats_edge(views.read()["country_stats"])


def tallies_of_odd_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept tallies over users without an age, a country or a gender, one hot country, and repeats.

    A fifth of the users is published a second time at higher offsets.
    """
    root, feed = new_folder(spark, "tables"), fixture.user_feed(spark, sf_dir)
    key = F.col("user_id").cast("long")
    odd = feed.withColumns(
        {
            "age": F.when(key % 13 != 0, F.col("age")),
            "country": F.when(key % 3 == 0, F.lit("HOT")).when(key % 11 != 0, F.col("country")),
            "gender": F.when(key % 7 != 0, F.col("gender")),
        }
    )
    topic, progress = _topic(spark, odd), new_folder(spark, "progress")
    publish_to_files(fixture.messages(odd.where(key % 5 == 0)), topic, first_offset=SECOND_ROUND)
    views = _kept_views(spark, topic, progress, root)
    discard(spark, topic)
    discard(spark, progress)
    return _stats_edge(views.read()["tallies"])


def dashboard_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic -> users table with its views -> the KPI row."""
    root = new_folder(spark, "tables")
    with _staged(spark, sf_dir) as (topic, progress):
        _kept_views(spark, topic, progress, root)
    return _rounded(Dashboard(spark, root).refresh()["kpis"], "avg_age")


def dashboard_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic -> users table with its newest rows carried along -> the listing."""
    root = new_folder(spark, "tables")
    with _staged(spark, sf_dir) as (topic, progress):
        _kept_views(spark, topic, progress, root)
    return _edge(Dashboard(spark, root).refresh()["latest_users"], "Date d'ingestion")


def dashboard_charts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the charts of one refresh: ten countries by users, ten by mean age, the genders."""
    root = new_folder(spark, "tables")
    with _staged(spark, sf_dir) as (topic, progress):
        _kept_views(spark, topic, progress, root)
    frames = Dashboard(spark, root).refresh()
    value = {"top_countries": "count_users", "top_age_countries": "avg_age", "gender_share": "share"}
    label = {"gender_share": "gender"}
    charts = [
        frames[name].select(
            F.lit(name).alias("chart"),
            F.col(label.get(name, "country")).alias("label"),
            F.round(F.col(column).cast("double"), 6).alias("value"),
        )
        for name, column in value.items()
    ]
    return reduce(DataFrame.unionAll, charts)


_QUERIES: dict[str, Query] = {
    "src_message_stream": src_message_stream,
    "scan_users": scan_users,
    "scan_country_stats": scan_country_stats,
    "ddl_users_schema": ddl_users_schema,
    "src_cadence": src_cadence,
    "decode_value": decode_value,
    "json_props": json_props,
    "parse_flat_users": parse_flat_users,
    "flatten_users": flatten,
    "stamp_ingestion": stamp_ingestion,
    "ingestion_time": ingestion_time,
    "full_name": full_name,
    "quarantine": quarantine_reasons,
    "publish_envelopes": publish_envelopes,
    "kpi_total_users": _on_users(stats.total_users),
    "gender_counts": _on_users(stats.gender_counts),
    "gender_share": gender_share,
    "country_stats": lambda spark, sf_dir: _stats_edge(
        _on_users(stats.country_stats)(spark, sf_dir)
    ),
    "kpi_countries": _on_stats(stats.countries_kpi),
    "kpi_avg_age": kpi_avg_age,
    "kpi_avg_age_text": _on_stats(stats.avg_age_text_kpi),
    "kpi_empty_guard": kpi_empty_guard,
    "top_countries": _on_stats(
        lambda rows: listings.top_countries(rows).select("country", "count_users")
    ),
    "top_age_countries": _on_stats(
        lambda rows: listings.top_age_countries(rows).select("country", "avg_age")
    ),
    "latest_users": latest_users,
    "user_listing": user_listing,
    "refresh_text": refresh_stamp,
    "users_last_write": users_last_write,
    "dedup_users": dedup_users,
    "sink_debug": sink_debug,
    "sink_append": sink_append,
    "sink_keyed": sink_keyed,
    "sink_fanout_counts": sink_fanout_counts,
    "sink_shared_counts": sink_shared_counts,
    "restart_no_duplicates": restart_no_duplicates,
    "country_stats_stream": country_stats_stream,
    "country_stats_latest": country_stats_latest,
    "dashboard_kpis": dashboard_kpis,
    "dashboard_latest": dashboard_latest,
    "dashboard_charts": dashboard_charts,
    "sink_new_checkpoint": sink_new_checkpoint,
    "sink_failure": sink_failure,
    "statistics_exact": statistics_exact,
    "tallies_of_odd_rows": tallies_of_odd_rows,
}


# Queries that shuffle whole users: they pack envelopes or resolve keys.
_WIDE = {
    "src_message_stream",
    "scan_users",
    "flatten_users",
    "stamp_ingestion",
    "full_name",
    "quarantine",
    "publish_envelopes",
    "users_last_write",
    "dedup_users",
    "sink_debug",
    "sink_append",
    "sink_keyed",
    "sink_fanout_counts",
    "sink_shared_counts",
    "restart_no_duplicates",
    "country_stats_stream",
    "country_stats_latest",
    "dashboard_kpis",
    "dashboard_latest",
    "dashboard_charts",
    "sink_new_checkpoint",
    "sink_failure",
    "ddl_users_schema",
    "statistics_exact",
    "tallies_of_odd_rows",
}


def _sized(query: Query, wide: bool) -> Query:
    """Sets the width of the session's shuffles for this query."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        size_shuffles(spark, input_bytes(spark, f"{sf_dir}/customer.parquet") if wide else 0)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    name: _sized(query, name in _WIDE) for name, query in _QUERIES.items()
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes -> users -> country statistics -> top ten countries."""
    messages = fixture.messages(fixture.user_feed(spark, sf_dir))
    users = flatten_users(messages, ("country", "age", "ingestion_time"))
    return _stats_edge(listings.top_countries(stats.country_stats(users)))
