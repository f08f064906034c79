"""Text built from columns. Everything stays a JVM expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crowdpulse.schemas import AGE_UNIT


def full_name(first: Column, last: Column) -> Column:
    """First and last name; a missing part leaves no stray blank."""
    return F.concat_ws(" ", first, last)


def one_decimal(value: Column) -> Column:
    """One decimal, ties decided on the exact double (2.25 -> 2.2, 0.35 -> 0.3).

    `format_number` rounds that way; `format_string` and `bround` do not. Its
    thousands comma is taken out again.
    """
    return F.replace(F.format_number(value, 1), F.lit(","), F.lit(""))


def age_text(value: Column) -> Column:
    """An age as shown on a KPI tile; NULL stays NULL."""
    return F.concat(one_decimal(value), F.lit(AGE_UNIT))


def refresh_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
