"""The physical plans this package relies on at scale."""

from __future__ import annotations

import re

import pytest

from crowdpulse.operators import listings, stats
from crowdpulse.operators.messages import flatten_users
from crowdpulse.operators.publishing import pack_envelopes
from crowdpulse.plans import fixture

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan_of(df):
    df.collect()
    return plan_of(df).split("== Initial Plan ==")[0]


def shuffles(plan):
    return len(re.findall(r"Exchange hashpartitioning|Exchange SinglePartition", plan))


@pytest.fixture
def users(spark):
    return fixture.users(spark, SF_DIR)


@pytest.fixture
def messages(spark):
    return fixture.messages(fixture.user_feed(spark, SF_DIR))


def test_scans_read_only_the_columns_used(users):
    plan = plan_of(stats.gender_counts(users))
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan
    assert "c_name" not in plan and "n_name" not in plan


def test_a_predicate_reaches_the_scan(users):
    plan = plan_of(users.where("full_name = 'Customer#000000007'"))
    assert "EqualTo(c_name,Customer#000000007)" in plan


def test_nation_is_broadcast_by_its_size_only(spark, users):
    assert "BroadcastHashJoin" in plan_of(users)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "100b")
        assert "SortMergeJoin" in plan_of(fixture.users(spark, SF_DIR).select("country", "age"))
    finally:
        spark.conf.set(key, before)


def test_grouping_is_partial_before_its_one_shuffle(users):
    plan = plan_of(stats.country_stats(users))
    assert shuffles(plan) == 1
    assert plan.index("Exchange hashpartitioning") < plan.index("partial_count")


def test_share_reuses_the_grouping_and_needs_no_window(users):
    plan = final_plan_of(stats.gender_share(stats.gender_counts(users)))
    assert "ReusedExchange" in plan and "Window" not in plan


@pytest.mark.parametrize(
    "listing",
    [
        lambda users: listings.latest_users(users),
        lambda users: listings.top_countries(stats.country_stats(users)),
        lambda users: listings.top_age_countries(stats.country_stats(users)),
    ],
)
def test_listings_take_the_top_without_a_full_sort(users, listing):
    plan = plan_of(listing(users))
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_packing_shuffles_once(spark):
    plan = plan_of(pack_envelopes(fixture.user_feed(spark, SF_DIR)))
    assert shuffles(plan) == 1


def test_flattening_is_narrow_and_parses_once(spark, messages, tmp_path):
    messages.write.parquet(str(tmp_path / "m"))
    plan = plan_of(flatten_users(spark.read.parquet(str(tmp_path / "m"))))
    assert shuffles(plan) == 0
    assert plan.count("from_json(") == 1
    assert "ReadSchema: struct<value:binary>" in plan


def test_the_whole_batch_path_stays_in_the_jvm(messages):
    users = flatten_users(messages, ("country", "age", "ingestion_time"))
    plan = plan_of(listings.top_countries(stats.country_stats(users)))
    assert "Python" not in plan and "Arrow" not in plan
