"""Record layouts: messages, flat records, envelopes and the two analytics tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# Layout of a message as Spark's Kafka source delivers it.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# ---------------------------------------------------------------------------
# These names, types, labels and bounds are the public contract.
FLAT_USER = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("country", T.StringType()),
    ]
)

USERS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("email", T.StringType()),
        T.StructField("ingestion_time", T.TimestampType()),
    ]
)
USER_KEY = ("user_id", "ingestion_time")

# `count_users` is BIGINT where the contract says INT: a country may hold more
# than 2^31 rows, and the ANSI cast would then fail the job. `conform` in
# sources.tables narrows it when a sink really needs an INT column.
COUNTRY_STATS = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("count_users", T.LongType()),
        T.StructField("avg_age", T.DoubleType()),
        T.StructField("last_update", T.TimestampType()),
    ]
)

LISTING_LABELS = {
    "user_id": "ID",
    "full_name": "Nom Complet",
    "gender": "Genre",
    "age": "Âge",
    "country": "Pays",
    "email": "Email",
    "ingestion_time": "Date d'ingestion",
}

USERS_PER_ENVELOPE = 10
POLL_SECONDS = 10
TOP_COUNTRIES = 10
AGE_UNIT = " ans"
LISTING_MIN, LISTING_MAX, LISTING_DEFAULT = 5, 50, 10
REFRESH_MIN, REFRESH_MAX, REFRESH_DEFAULT = 5, 60, 10
# ---------------------------------------------------------------------------

USER_COLUMNS = tuple(USERS.fieldNames())

# Where a message came from; `pos` is the place of a user inside its envelope.
COORDINATES = ("topic", "partition", "offset")
ARRIVAL = ("partition", "offset", "pos")

CORRUPT = "_corrupt_record"

# Paths inside one element of the envelope's `results` list.
_ELEMENT_PATHS = {
    "user_id": [("login", "uuid", T.StringType())],
    "gender": [("gender", None, T.StringType())],
    "full_name": [("name", "first", T.StringType()), ("name", "last", T.StringType())],
    "country": [("location", "country", T.StringType())],
    "age": [("dob", "age", T.IntegerType())],
    # The same field as it was sent, whatever its type.
    "age_as_sent": [("dob", "age", T.VariantType())],
    "email": [("email", None, T.StringType())],
}


def envelope_schema(columns: Iterable[str] = USER_COLUMNS, corrupt: bool = False) -> T.StructType:
    """JSON schema of an envelope holding only what `columns` needs.

    Catalyst prunes the outer struct of `from_json` but not the structs inside
    the `results` array, so the parser is told here which fields to build.
    """
    element: dict[str, T.DataType] = {}
    for column in columns:
        for outer, inner, dtype in _ELEMENT_PATHS.get(column, ()):
            if inner is None:
                element[outer] = dtype
            else:
                element.setdefault(outer, T.StructType()).add(inner, dtype)
    if not element:  # the list still has to be exploded
        element["login"] = T.StructType().add("uuid", T.StringType())
    item = T.StructType([T.StructField(name, dtype) for name, dtype in element.items()])
    schema = T.StructType(
        [
            T.StructField("results", T.ArrayType(item)),
            T.StructField("ingestion_timestamp", T.LongType()),
        ]
    )
    return schema.add(CORRUPT, T.StringType()) if corrupt else schema
