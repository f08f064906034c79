"""Traps of the aggregates and listings, on small literal frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from crowdpulse.functions import epoch_now, full_name, one_decimal, refresh_text, utc_ntz
from crowdpulse.operators import listings, stats
from crowdpulse.schemas import COUNTRY_STATS, LISTING_LABELS, USERS
from crowdpulse.sources.tables import conform

T0 = dt.datetime(2024, 1, 1)
NAN = float("nan")


def person(i, country="FR", age=30, gender="male", minutes=0):
    return (f"u{i}", gender, f"n{i}", country, age, "e", T0 + dt.timedelta(minutes=minutes))


@pytest.fixture
def people(spark):
    return spark.createDataFrame(
        [
            person(1, "FR", 10, "male", 1),
            person(2, "FR", 20, "female", 5),
            person(3, "FR", None, "female", 2),
            person(4, "DE", 40, None, 3),
            person(5, None, 99, "male", 4),
        ],
        USERS,
    )


@pytest.fixture
def edge_stats(spark):
    rows = [("A", 1, 10.0, T0), ("B", 5, 40.0, T0), ("C", 5, None, T0), ("D", 2, NAN, T0)]
    return spark.createDataFrame(rows, COUNTRY_STATS)


def test_country_stats_count_ageless_users_and_skip_no_country(people):
    rows = {r.country: (r.count_users, r.avg_age) for r in stats.country_stats(people).collect()}
    assert rows == {"FR": (3, 15.0), "DE": (1, 40.0)}


def test_last_update_is_the_newest_stamp(people):
    rows = stats.country_stats(people).where("country = 'FR'").collect()
    assert rows[0].last_update == T0 + dt.timedelta(minutes=5)


def test_mean_age_weighs_countries_not_users(people):
    assert stats.avg_age_kpi(stats.country_stats(people)).first().avg_age == 27.5


def test_missing_means_are_skipped(edge_stats):
    row = stats.country_kpis(edge_stats).first()
    assert (row.countries, row.avg_age) == (4, 25.0)


def test_no_rows_give_zero_users_and_no_kpi(spark):
    nobody = spark.createDataFrame([], USERS)
    assert stats.total_users(nobody).first().total_users == 0
    assert stats.country_kpis(stats.country_stats(nobody)).count() == 0
    assert stats.countries_kpi(stats.country_stats(nobody)).count() == 0


def test_gender_counts_and_shares_keep_unknown(people):
    rows = stats.gender_share(stats.gender_counts(people)).collect()
    assert {r.gender: (r["count"], r.share) for r in rows} == {
        "male": (2, 0.4),
        "female": (2, 0.4),
        None: (1, 0.2),
    }


def test_tallies_give_the_same_as_the_users(people):
    tallies = stats.tallies(people)
    per_country = stats.countries_from_tallies(tallies)
    assert sorted(per_country.collect()) == sorted(stats.country_stats(people).collect())
    genders = stats.genders_from_tallies(tallies).collect()
    assert set(genders) == set(stats.gender_counts(people).collect())
    row = stats.kpis_from_tallies(tallies).first()
    assert tuple(row) == (5, 2, 27.5, "27.5 ans")


def test_tallies_of_nobody_show_no_country_kpis(spark):
    row = stats.kpis_from_tallies(stats.tallies(spark.createDataFrame([], USERS))).first()
    assert tuple(row) == (0, None, None, None)


def test_top_countries_break_ties_by_name(edge_stats):
    assert [r.country for r in listings.top_countries(edge_stats, 3).collect()] == ["B", "C", "D"]


def test_top_ages_put_missing_last(edge_stats):
    assert [r.country for r in listings.top_age_countries(edge_stats).collect()] == ["B", "A", "C", "D"]


def test_latest_users_are_the_newest(spark):
    rows = spark.createDataFrame([person(i, minutes=i // 2) for i in range(40)], USERS)
    got = [r.user_id for r in listings.latest_users(rows, 5).collect()]
    assert got == ["u38", "u39", "u36", "u37", "u34"]


@pytest.mark.parametrize("limit", [4, 51])
def test_listing_size_is_checked(people, limit):
    with pytest.raises(ValueError):
        listings.latest_users(people, limit)


def test_listing_labels(people):
    assert listings.user_listing(people).columns == list(LISTING_LABELS.values())


@pytest.mark.parametrize(
    "value, text",
    [(2.25, "2.2"), (0.35, "0.3"), (0.25, "0.2"), (2.35, "2.4"), (47.4115, "47.4"), (40.0, "40.0"),
     (1234567.85, "1234567.9"), (-0.75, "-0.8"), (None, None)],
)
def test_one_decimal(spark, value, text):
    frame = spark.createDataFrame([(value,)], "x DOUBLE")
    assert frame.select(one_decimal(F.col("x"))).first()[0] == text
    if value is not None:
        assert f"{value:.1f}" == text


def test_text_and_time(spark):
    frame = spark.createDataFrame([("Ana", None, dt.datetime(2024, 5, 6, 7, 8, 9))], "a STRING, b STRING, t TIMESTAMP")
    row = frame.select(
        full_name(F.col("a"), F.col("b")), refresh_text(F.col("t")), utc_ntz(F.col("t"))
    ).first()
    assert tuple(row) == ("Ana", "2024-05-06 07:08:09", dt.datetime(2024, 5, 6, 7, 8, 9))
    now = spark.range(1).select(epoch_now()).first()[0]
    assert abs(now - dt.datetime.now(dt.timezone.utc).timestamp()) < 60


def test_conform_narrows_counts_and_refuses_overflow(spark):
    from pyspark.errors import ArithmeticException
    from pyspark.sql import types as T

    narrow = T.StructType([T.StructField("count_users", T.IntegerType())])
    fits = spark.createDataFrame([(7,)], "count_users BIGINT")
    assert conform(fits, narrow).schema == narrow
    with pytest.raises(ArithmeticException):
        conform(spark.createDataFrame([(1 << 31,)], "count_users BIGINT"), narrow).collect()
