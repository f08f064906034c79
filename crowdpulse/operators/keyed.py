"""Keyed tables kept as append logs: last write wins, first arrival wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.schemas import ARRIVAL, USER_KEY


def _first_by(rows: DataFrame, order: list[Column]) -> DataFrame:
    """One copy per key. The limit of one is applied before the shuffle too, so that
    a key written over and over sends a single row per task."""
    place = F.row_number().over(Window.partitionBy(*USER_KEY).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def last_write(log: DataFrame, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """The latest copy per key."""
    return _first_by(log, [F.desc(name) for name in order])


def first_arrival(log: DataFrame, order: tuple[str, ...] = ARRIVAL) -> DataFrame:
    """The earliest copy per key."""
    return _first_by(log, [F.asc(name) for name in order])
