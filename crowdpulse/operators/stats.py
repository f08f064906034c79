"""Counts, country statistics, KPIs and shares.

Every grouping here has a partial step before its shuffle, so a country or a
gender that holds a third of all rows still sends one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.functions import age_text


def total_users(users: DataFrame) -> DataFrame:
    """Counts rows, that is one per (user_id, ingestion_time); 0 for no rows."""
    return users.agg(F.count("*").alias("total_users"))


def gender_counts(users: DataFrame) -> DataFrame:
    return users.groupBy("gender").agg(F.count("*").alias("count"))


def gender_share(counts: DataFrame) -> DataFrame:
    """Part of the total per gender; the total is a scalar subquery, not a window in one task."""
    total = counts.agg(F.sum("count")).scalar()
    return counts.select("gender", "count", (F.col("count") / total).alias("share"))


def country_stats(users: DataFrame) -> DataFrame:
    """One row per country; users without a country belong to no row."""
    return (
        users.where("country IS NOT NULL")
        .groupBy("country")
        .agg(
            F.count("*").alias("count_users"),
            F.avg("age").alias("avg_age"),
            F.max("ingestion_time").alias("last_update"),
        )
    )


def _without_nan(value: str) -> Column:
    return F.when(~F.isnan(value), F.col(value))


def country_kpis(stats: DataFrame) -> DataFrame:
    """Number of countries and the unweighted mean of their mean ages.

    No row at all when there is no country: the tiles are then absent, not 0.
    """
    return stats.agg(
        F.count("*").alias("countries"),
        F.avg(_without_nan("avg_age")).alias("avg_age"),
    ).where("countries > 0")


def countries_kpi(stats: DataFrame) -> DataFrame:
    return country_kpis(stats).select("countries")


def avg_age_kpi(stats: DataFrame) -> DataFrame:
    return country_kpis(stats).select("avg_age")


def avg_age_text_kpi(stats: DataFrame) -> DataFrame:
    return avg_age_kpi(stats).select(age_text(F.col("avg_age")).alias("avg_age_text"))


# --- tallies: one small aggregate from which every KPI of a refresh derives ---


def tallies(users: DataFrame, *per: str) -> DataFrame:
    """Users per (country, gender), and further columns, with the parts of a mean that can be merged.

    `count_users * avg_age` could not be merged: ages may be missing.
    """
    return users.groupBy(*per, "country", "gender").agg(
        F.count("*").alias("n"),
        F.sum("age").alias("age_sum"),
        F.count("age").alias("age_n"),
        F.max("ingestion_time").alias("last_update"),
    )


def merged_tallies(rows: DataFrame) -> DataFrame:
    """Tallies of parts of the users as tallies of all."""
    return rows.groupBy("country", "gender").agg(
        F.sum("n").alias("n"),
        F.sum("age_sum").alias("age_sum"),
        F.sum("age_n").alias("age_n"),
        F.max("last_update").alias("last_update"),
    )


def genders_from_tallies(rows: DataFrame) -> DataFrame:
    return rows.groupBy("gender").agg(F.sum("n").alias("count"))


def countries_from_tallies(rows: DataFrame) -> DataFrame:
    """The same rows as `country_stats` over the users themselves."""
    return (
        rows.where("country IS NOT NULL")
        .groupBy("country")
        .agg(
            F.sum("n").alias("count_users"),
            F.try_divide(F.sum("age_sum"), F.sum("age_n")).alias("avg_age"),
            F.max("last_update").alias("last_update"),
        )
    )


def kpis_from_tallies(rows: DataFrame) -> DataFrame:
    """The KPI row of one refresh: total, countries, mean age and its text."""
    per_country = rows.groupBy("country").agg(
        F.sum("n").alias("n"),
        F.try_divide(F.sum("age_sum"), F.sum("age_n")).alias("avg_age"),
    )
    known = F.col("country").isNotNull()
    row = per_country.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_users"),
        F.nullif(F.count("country"), F.lit(0)).alias("countries"),
        F.avg(F.when(known, F.col("avg_age"))).alias("avg_age"),
    )
    return row.withColumn("avg_age_text", age_text(F.col("avg_age")))
