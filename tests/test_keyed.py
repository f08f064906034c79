"""Last write, first arrival, the users table and snapshots."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from crowdpulse.operators.keyed import first_arrival, last_write
from crowdpulse.operators.listings import latest_of_log
from crowdpulse.schemas import ARRIVAL, COUNTRY_STATS, USERS
from crowdpulse.sources.tables import USERS_LOG, SnapshotTable, UsersTable, create_tables
from crowdpulse.streaming.views import LatestUsers

T0 = dt.datetime(2024, 1, 1)


def entry(user, age, offset, pos=0, partition=0, minutes=0, country="FR"):
    when = T0 + dt.timedelta(minutes=minutes)
    return (user, "male", "n", country, age, "e", when, partition, offset, pos)


def log_of(spark, *entries):
    return spark.createDataFrame(list(entries), USERS_LOG)


def ages(rows):
    return {(r.user_id, r.ingestion_time): r.age for r in rows.collect()}


def test_last_and_first_copy_per_key(spark):
    log = log_of(spark, entry("a", 1, 5), entry("a", 2, 7), entry("a", 3, 7, pos=1),
                 entry("a", 9, 1, minutes=1), entry("b", 4, 6))
    assert ages(last_write(log)) == {("a", T0): 3, ("a", T0 + dt.timedelta(minutes=1)): 9, ("b", T0): 4}
    assert ages(first_arrival(log))[("a", T0)] == 1
    assert last_write(log).columns == log.columns


def test_last_write_equals_the_aggregate_form(spark):
    log = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("user_id"),
        F.lit("m").alias("gender"), F.lit("n").alias("full_name"), F.lit("c").alias("country"),
        F.col("id").cast("int").alias("age"), F.lit("e").alias("email"),
        F.timestamp_seconds(F.col("id") % 2).alias("ingestion_time"),
        F.pmod(F.hash("id"), F.lit(3)).alias("partition"), (F.col("id") * 7 % 3001).alias("offset"),
        F.lit(0).alias("pos"),
    )
    log.createOrReplaceTempView("log")
    aggregate = spark.sql(
        "SELECT user_id, ingestion_time, max_by(age, struct(partition, offset, pos)) age "
        "FROM log GROUP BY user_id, ingestion_time"
    )
    assert ages(last_write(log)) == ages(aggregate)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    plan = last_write(log_of(spark, entry("a", 1, 1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert plan.count("WindowGroupLimit") == 2


def test_latest_of_a_log_resolves_copies(spark):
    log = log_of(spark, *[entry(f"u{i}", i, i, minutes=i) for i in range(20)],
                 *[entry("u19", 100 + i, 50 + i, minutes=19) for i in range(5)])
    got = latest_of_log(log, ARRIVAL, 5)
    assert {r.user_id: r.age for r in got.collect()} == {"u19": 104, "u18": 18, "u17": 17, "u16": 16, "u15": 15}


def test_users_table_upserts_across_batches(spark, folder):
    table = UsersTable(spark, folder("users"))
    assert table.current().count() == 0
    table.append(log_of(spark, entry("a", 1, 90), entry("b", 2, 91), entry(None, 3, 92)), 0)
    table.append(log_of(spark, entry("a", 5, 3, partition=1)), 1)
    assert ages(table.current()) == {("a", T0): 5, ("b", T0): 2}
    assert table.current().schema.names == USERS.names
    # The same micro-batch again replaces itself.
    table.append(log_of(spark, entry("a", 5, 3, partition=1)), 1)
    assert table.entries().count() == 3


def test_compaction_changes_no_result_and_later_writes_still_win(spark, folder):
    table = UsersTable(spark, folder("users"))
    table.append(log_of(spark, entry("a", 1, 1), entry("b", 2, 2)), 0)
    table.append(log_of(spark, entry("a", 3, 3)), 1)
    before = ages(table.current())
    table.compact()
    assert ages(table.current()) == before
    assert table.entries().count() == 2
    table.append(log_of(spark, entry("b", 7, 4)), 2)
    want = {("a", T0): 3, ("b", T0): 7}
    assert ages(table.current()) == want
    # The next round removes what the first one had folded in, and no more.
    assert table.log.complete() == [0, 1, 2]
    for _ in range(2):
        table.compact()
        assert ages(table.current()) == want
        assert (table.log.complete(), table.base.complete()) == ([2], [1, 2])


def test_compaction_and_reads_open_only_the_hours_they_need(spark, folder):
    table = UsersTable(spark, folder("users"))
    hours = [0, 60, 120]
    table.append(log_of(spark, *[entry("a", 1, i, minutes=m) for i, m in enumerate(hours)]), 0)
    table.compact()
    table.append(log_of(spark, entry("a", 9, 9, minutes=60), entry("b", 3, 10, minutes=61)), 1)
    first = min(table.hours())
    assert table.hours() == {first, first + 1, first + 2}
    some = table.entries({first + 1})
    opened = [path.split("/users/")[1] for path in some.inputFiles()]
    assert {path.split("/part-")[0] for path in opened} == {
        f"base/batch_id=0/hour={first + 1}", f"log/batch_id=1/hour={first + 1}"
    }
    assert {r.user_id: r.age for r in table.current({first + 1}).collect()} == {"a": 9, "b": 3}
    want = ages(table.current())
    table.compact()
    assert table.base.hours() == {0: {first, first + 1, first + 2}, 1: {first + 1}}
    assert ages(table.current()) == want and len(want) == 4
    table.append(log_of(spark, entry("c", 5, 11, minutes=120)), 2)
    table.compact()
    # What the compaction before had replaced is gone, hours without new rows stay where they are.
    assert table.base.hours() == {0: {first, first + 2}, 1: {first + 1}, 2: {first + 2}}
    assert len(ages(table.current())) == 5


def test_newest_users_are_bounded_before_keys_meet(spark, folder):
    table = UsersTable(spark, folder("users"))
    table.append(log_of(spark, *[entry(f"u{i}", i, i, minutes=i) for i in range(90)]), 0)
    plan = latest_of_log(table.entries(), ("batch_id", *ARRIVAL), 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == plan.count("GreaterThanOrEqual(ingestion_time,2024-01-01")


def test_old_snapshots_are_removed(spark, folder):
    table = SnapshotTable(spark, folder("stats"), COUNTRY_STATS, keep=2)
    for batch_id in range(5):
        table.write(spark.createDataFrame([("FR", batch_id, 2.0, T0)], COUNTRY_STATS), batch_id)
    assert table.complete() == [3, 4]
    assert table.read_latest().first().count_users == 4


def test_unfinished_batches_are_not_read(spark, folder):
    table = SnapshotTable(spark, folder("stats"), COUNTRY_STATS)
    assert table.read_latest().count() == 0
    row = spark.createDataFrame([("FR", 1, 2.0, T0)], COUNTRY_STATS)
    table.write(row, 0)
    table.write(row.withColumn("count_users", F.lit(9)), 1)
    assert table.read_latest().first().count_users == 9
    os.rename(f"{folder('stats')}/batch_id=1/_SUCCESS", f"{folder('stats')}/batch_id=1/_gone")
    assert table.latest_id() == 0
    assert table.read_latest().first().count_users == 1


def test_newest_users_are_carried_from_batch_to_batch(spark, folder):
    users, latest = UsersTable(spark, folder("users")), LatestUsers(spark, folder("latest"))
    batches = [
        [entry(f"u{i}", i, i, minutes=i) for i in range(60)],
        [entry("u59", 500, 100, minutes=59), entry("old", 1, 101, minutes=-5)],
        [entry("new", 7, 200, minutes=90)],
    ]
    for batch_id, rows in enumerate(batches):
        for _ in range(2):  # a batch that is run again
            users.append(log_of(spark, *rows), batch_id)
            latest.advance(users, batch_id)
    want = [("new", 7), ("u59", 500)] + [(f"u{i}", i) for i in range(58, 10, -1)]
    assert [(r.user_id, r.age) for r in latest.read(50).collect()] == want


def test_tables_are_declared_once(spark, folder):
    for _ in range(2):
        create_tables(spark, "declared", folder("declared"))
    assert spark.table("declared.users").schema.simpleString() == USERS.simpleString()
    assert spark.table("declared.country_stats").schema.simpleString() == COUNTRY_STATS.simpleString()
