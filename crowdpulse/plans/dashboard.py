"""All results of one dashboard refresh, taken from one state of the users table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crowdpulse.operators.listings import top_age_countries, top_countries, user_listing
from crowdpulse.operators.stats import gender_share, genders_from_tallies, kpis_from_tallies
from crowdpulse.schemas import LISTING_DEFAULT
from crowdpulse.streaming.views import Views


class Dashboard:
    """Reads the published views of a users table, all under one id.

    Each frame is bounded (KPIs, ten countries, genders, at most 50 users) and
    comes from a few stored rows, so a refresh costs the same at any table size.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.views = Views(spark, path)

    def refresh(self, limit: int = LISTING_DEFAULT) -> dict[str, DataFrame]:
        state = self.views.read(limit)
        return {
            "kpis": kpis_from_tallies(state["tallies"]),
            "top_countries": top_countries(state["country_stats"]),
            "top_age_countries": top_age_countries(state["country_stats"]),
            "gender_share": gender_share(genders_from_tallies(state["tallies"])),
            "latest_users": user_listing(state["latest_users"]),
        }
