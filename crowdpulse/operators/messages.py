"""From binary messages to user rows.

All steps are narrow: no shuffle, one JSON parse per message, and they run
unchanged on a batch or on a stream.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.functions import epoch_to_time, full_name
from crowdpulse.schemas import (
    ARRIVAL,
    COORDINATES,
    CORRUPT,
    FLAT_USER,
    USER_COLUMNS,
    USER_KEY,
    envelope_schema,
)


def text_of(value: str = "value") -> Column:
    """A binary message value read as UTF-8."""
    return F.col(value).cast("string")


def parse_flat(messages: DataFrame) -> DataFrame:
    """One row per message, always: what does not parse becomes NULL fields."""
    record = messages.select(F.from_json(text_of(), FLAT_USER).alias("record"))
    return record.select(*[F.col(f"record.{name}").alias(name) for name in FLAT_USER.names])


def _explode(messages: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One row per user, and one row with NULL `pos` for a message without users.

    The outer form of the generator matters: for the inner form Catalyst infers
    a non-empty filter and pushes it below the projection, where it parses the
    JSON text again, twice.
    """
    carried = [name for name in COORDINATES if name in messages.columns]
    envelope = F.from_json(text_of(), envelope_schema(columns))
    parsed = messages.select(*carried, envelope.alias("envelope"))
    return parsed.select(
        *carried,
        F.col("envelope.ingestion_timestamp").alias("ingestion_timestamp"),
        F.posexplode_outer("envelope.results").alias("pos", "user"),
    )


def _user_column(name: str) -> Column:
    if name == "full_name":
        return full_name(F.col("user.name.first"), F.col("user.name.last"))
    if name == "ingestion_time":
        return epoch_to_time(F.col("ingestion_timestamp"))
    if name == "ingestion_timestamp":
        return F.col(name)
    path = {"user_id": "login.uuid", "country": "location.country", "age": "dob.age"}
    return F.col(f"user.{path.get(name, name)}")


def _user_columns(columns: Iterable[str]) -> list[Column]:
    return [_user_column(name).alias(name) for name in columns]


def flatten_users(
    messages: DataFrame,
    columns: Iterable[str] = USER_COLUMNS,
    with_arrival: bool = False,
) -> DataFrame:
    """One row per element of each envelope's `results`.

    Ask for few `columns` and the parser builds only those. `with_arrival` adds
    the message's partition and offset and the user's place in the envelope.
    """
    columns = tuple(columns)
    arrival = ARRIVAL if with_arrival else ()
    users = _explode(messages, columns).where("pos IS NOT NULL")
    return users.select(*_user_columns(columns), *arrival)


def usable(users: DataFrame) -> DataFrame:
    """Rows a keyed table can hold: no NULL in the key."""
    return users.dropna(subset=list(USER_KEY))


def judged(messages: DataFrame) -> DataFrame:
    """One row per message: its users, the `reasons` why some cannot be stored, `warnings`, and its text.

    `reasons` holds (pos, reason) per user without a whole key; for a message
    that yields no user at all it holds one entry without `pos`. `warnings` holds
    the same for users that are stored, but without an age, although one was sent:
    it is no whole number that fits. A field that is absent or null is none.
    """
    carried = [name for name in COORDINATES if name in messages.columns]
    envelope = F.from_json(text_of(), envelope_schema((*USER_KEY, "age_as_sent"), corrupt=True))
    parsed = messages.select(*carried, text_of().alias("value"), envelope.alias("envelope"))
    users, stamp = F.col("envelope.results"), F.col("envelope.ingestion_timestamp")
    n_users = F.coalesce(F.size(users), F.lit(0))
    n_users = F.greatest(n_users, F.lit(0))
    of_message = (
        F.when(F.trim(F.coalesce("value", F.lit(""))) == "", "empty message")
        .when(F.col(f"envelope.{CORRUPT}").isNotNull(), "malformed")
        .otherwise("no users")
    )
    of_stamp = F.when(stamp.isNull(), "no ingestion_time").when(
        epoch_to_time(stamp).isNull(), "bad ingestion_time"
    )

    def of_user(user: Column, pos: Column) -> Column:
        reason = F.when(user["login"]["uuid"].isNull(), "no user_id").otherwise(of_stamp)
        return F.struct(pos.alias("pos"), reason.alias("reason"))

    def of_age(user: Column, pos: Column) -> Column:
        sent = user["dob"]["age"]
        whole = (F.schema_of_variant(sent) == "BIGINT") & F.try_variant_get(sent, "$", "int").isNotNull()
        bad = sent.isNotNull() & ~F.is_variant_null(sent) & ~whole
        kept = of_user(user, pos)["reason"].isNull()
        return F.struct(pos.alias("pos"), F.when(kept & bad, "bad age").alias("reason"))

    def told(entries: Column) -> Column:
        return F.filter(entries, lambda entry: entry["reason"].isNotNull())

    per_user, warnings = told(F.transform(users, of_user)), told(F.transform(users, of_age))
    whole = F.array(F.struct(F.lit(None).cast("int").alias("pos"), of_message.alias("reason")))
    reasons = F.when(n_users == 0, whole).otherwise(per_user)
    # A generator of one row, for the reason given at `_explode`.
    none = F.slice(whole, 1, 0)
    warnings = F.coalesce(warnings, none).alias("warnings")
    verdict = F.array(F.struct(n_users.alias("n_users"), reasons.alias("reasons"), warnings))
    return parsed.select(*carried, "value", F.inline_outer(verdict))


def quarantine(messages: DataFrame, with_warnings: bool = False) -> DataFrame:
    """Messages with anything a keyed table cannot hold: the reasons, and the text once.

    The usable rows and the reasons together account for every message. With
    `with_warnings` also messages whose users are all stored, some without the
    age that was sent.
    """
    found = F.size("reasons") > 0
    if with_warnings:
        found = found | (F.size("warnings") > 0)
    return judged(messages).where(found).drop("n_users")
