"""Where a stream of user rows goes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from crowdpulse.operators.messages import usable
from crowdpulse.schemas import USER_COLUMNS
from crowdpulse.sources.tables import BatchFolders, UsersTable
from crowdpulse.streaming.views import Views

FILE_FORMATS = ("parquet", "json", "orc", "csv")


def _as_is(rows: DataFrame) -> DataFrame:
    return rows


def documents(users: DataFrame) -> DataFrame:
    """The columns of the contract, for stores outside Spark."""
    return users.select(*USER_COLUMNS)


def keyed_rows(users: DataFrame) -> DataFrame:
    """The same, without rows that lack a key column."""
    return documents(usable(users))


@dataclass(frozen=True)
class Sink:
    """A named target of an append stream.

    `write` stores one micro-batch. With `stream_format` set, a query of its own
    uses that streaming writer instead. `prepare` shapes the rows before either.
    """

    name: str
    write: Callable[[DataFrame, int], None]
    stream_format: str | None = None
    options: dict[str, str] = field(default_factory=dict)
    prepare: Callable[[DataFrame], DataFrame] = _as_is


def debug_sink(
    rows: int = 20,
    echo: Callable[[str], None] = print,
    copy_to: str | None = None,
    name: str = "debug",
) -> Sink:
    """Shows the first rows of every micro-batch, untruncated.

    Spark's console format brings each whole micro-batch to the driver before it
    prints 20 rows of it; this takes only the rows it shows. `copy_to` keeps
    what passed through, one folder per batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if copy_to:
            folders = BatchFolders(batch.sparkSession, copy_to, batch.schema)
            own = folders.own_id(batch_id)
            folders.write(batch, own)
            batch = folders.read([own]).drop("batch_id")
        shown = batch.limit(rows).toPandas()
        echo(f"batch {batch_id}\n{shown.to_string(index=False)}")

    return Sink(name, write)


def append_sink(
    fmt: str,
    options: dict[str, str],
    name: str = "append",
    prepare: Callable[[DataFrame], DataFrame] = _as_is,
) -> Sink:
    """Appends every row to a file folder or, by its connector's format, to a store.

    A file folder holds one folder per micro-batch, numbered by its ledger, in a
    query of its own as in a shared one. Spark's file sink numbers them by the
    checkpoint alone: with a new one it skips what it thinks is stored, and its log
    hides folders that it didn't write. `stored` reads the finished ones.
    A keyed store such as Cassandra overwrites a row whose key comes again.
    """
    if fmt in FILE_FORMATS:
        return Sink(name, _file_writer(fmt, options), prepare=prepare)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format(fmt).options(**options).mode("append").save()

    return Sink(name, write, stream_format=fmt, options=options, prepare=prepare)


def _folders(spark: SparkSession, fmt: str, options: dict[str, str], schema: T.StructType) -> BatchFolders:
    rest = {key: value for key, value in options.items() if key != "path"}
    return BatchFolders(spark, options["path"], schema, fmt, rest)


def _file_writer(fmt: str, options: dict[str, str]) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        folders = _folders(batch.sparkSession, fmt, options, batch.schema)
        folders.write(batch, folders.own_id(batch_id))

    return write


def stored(spark: SparkSession, fmt: str, options: dict[str, str], schema: T.StructType) -> DataFrame:
    """The rows that an append sink to files has finished, each micro-batch once."""
    folders = _folders(spark, fmt, options, schema)
    return folders.read(folders.complete()).drop("batch_id")


def keyed_sink(path: str, views_path: str | None = None, name: str = "keyed") -> Sink:
    """Upserts into a users table; with `views_path` it also keeps its views: see Views."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table = UsersTable(batch.sparkSession, path)
        own = table.log.own_id(batch_id)
        table.append(batch, own)
        if views_path:
            Views(batch.sparkSession, views_path).advance(table, own)

    return Sink(name, write)


def quarantine_sink(path: str, name: str = "quarantine") -> Sink:
    """Stores quarantined messages, one folder per batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        folders = BatchFolders(batch.sparkSession, path, batch.schema)
        folders.write(batch, folders.own_id(batch_id))

    return Sink(name, write)

