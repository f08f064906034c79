"""The users table and snapshot tables, as folders of batches.

A batch is one folder `batch_id=<n>`, overwritten whole when a micro-batch is
run again, and read only once its `_SUCCESS` marker is there. A ledger beside
the folders says which query's micro-batch has which number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdpulse.operators.keyed import last_write
from crowdpulse.operators.messages import usable
from crowdpulse.schemas import ARRIVAL, COUNTRY_STATS, USER_COLUMNS, USERS
from crowdpulse.sources.scratch import children, discard, glob, touch


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the order and types of `schema`; a value that does not fit is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def create_tables(spark: SparkSession, database: str, location: str) -> None:
    """Declares both tables; running it again changes nothing."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name, schema in (("users", USERS), ("country_stats", COUNTRY_STATS)):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) "
            f"USING parquet LOCATION '{location}/{name}'"
        )


class BatchFolders:
    """Numbered batches below one folder, of parquet unless another file format is given."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        fmt: str = "parquet",
        options: dict[str, str] | None = None,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.fmt, self.options = fmt, options or {}

    def own_id(self, batch_id: int) -> int:
        """The number of a running query's micro-batch, above those of all batches before it.

        Every new checkpoint counts its micro-batches from 0 again, so they are
        told apart by the query id, which Spark keeps in the checkpoint. The ledger
        holds (number, query, micro-batch); an entry is made before anything is
        written, so a micro-batch that runs again finds its number and replaces
        itself. If others wrote since, it does so only where it had been
        finished; what it had not finished is removed, and it gets a new number, so
        that no batch appears below those already read. Only a query's last
        micro-batch can run again, so the ledger keeps one entry per query. One
        query at a time may write to a table. Outside a query the number stands
        as it is.
        """
        query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if query is None:
            return batch_id
        folder = f"{self.path}/_ledger"
        entries = [name.split(".") for name in children(self.spark, folder)]
        known = {(owner, int(batch)): int(number) for number, owner, batch in entries}
        finished = self.complete()
        newest = max([-1, *known.values(), *finished])
        before = known.get((query, batch_id))
        if before is not None and (before in finished or before == newest):
            return before
        if before is not None:
            self.remove(before)
        number = newest + 1
        touch(self.spark, f"{folder}/{number}.{query}.{batch_id}")
        for (owner, batch), old in known.items():
            if owner == query:
                discard(self.spark, f"{folder}/{old}.{owner}.{batch}")
        return number

    def folder(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def write(self, df: DataFrame, batch_id: int) -> None:
        writer = conform(df, self.schema).write.format(self.fmt).options(**self.options)
        writer.mode("overwrite").save(self.folder(batch_id))

    def complete(self) -> list[int]:
        """Ids of the finished batches: one listing, one entry per batch."""
        found = glob(self.spark, f"{self.path}/batch_id=*/_SUCCESS")
        return sorted(int(path.split("/")[-2].split("=")[1]) for path in found)

    def remove(self, batch_id: int) -> None:
        discard(self.spark, self.folder(batch_id))

    def _load(self, paths: list[str], *more: T.StructField) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType()), *more])
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).format(self.fmt).options(**self.options)
        return reader.option("basePath", self.path).load(paths)

    def read(self, batch_ids: list[int]) -> DataFrame:
        """The rows of these batches, with their `batch_id`."""
        return self._load([self.folder(batch_id) for batch_id in batch_ids])


HOUR = T.StructField("hour", T.LongType())


def hour_of(time: str = "ingestion_time") -> Column:
    """Whole hours since 1970."""
    return F.expr(f"unix_seconds({time}) div 3600")


class HourFolders(BatchFolders):
    """Batches split by the hour of `ingestion_time`, so that a reader opens only the hours it needs.

    Writing stays narrow: a task makes a file per hour it holds, and a stream's
    tasks hold neighbouring stamps.
    """

    def write(self, df: DataFrame, batch_id: int) -> None:
        rows = conform(df, self.schema).withColumn(HOUR.name, hour_of())
        rows.write.partitionBy(HOUR.name).mode("overwrite").parquet(self.folder(batch_id))

    def hours(self) -> dict[int, set[int]]:
        """The hours of each finished batch, from the folders' names."""
        found = {batch_id: set() for batch_id in self.complete()}
        for path in glob(self.spark, f"{self.path}/batch_id=*/hour=*"):
            batch, hour = path.split("/")[-2:]
            if int(batch.split("=")[1]) in found:
                found[int(batch.split("=")[1])].add(int(hour.split("=")[1]))
        return found

    def read_hours(self, wanted: list[tuple[int, int]]) -> DataFrame:
        """The rows of these (batch id, hour), with `batch_id`."""
        paths = [f"{self.folder(batch_id)}/hour={hour}" for batch_id, hour in wanted]
        return self._load(paths, HOUR).drop(HOUR.name)

    def read(self, batch_ids: list[int]) -> DataFrame:
        return self._load([self.folder(batch_id) for batch_id in batch_ids], HOUR).drop(HOUR.name)


class SnapshotTable(BatchFolders):
    """Each batch is the whole table; the newest finished one counts.

    With `keep`, a write removes all but that many: a refresh every ten seconds
    would else make every listing longer for ever.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType, keep: int | None = None
    ):
        super().__init__(spark, path, schema)
        self.keep = keep

    def write(self, df: DataFrame, batch_id: int) -> None:
        super().write(df, batch_id)
        if self.keep:
            for old in self.complete()[: -self.keep]:
                self.remove(old)

    def latest_id(self, before: int | None = None) -> int | None:
        ids = [i for i in self.complete() if before is None or i < before]
        return ids[-1] if ids else None

    def read_latest(self) -> DataFrame:
        newest = self.latest_id()
        return self.read([] if newest is None else [newest]).drop("batch_id")


ARRIVAL_FIELDS = [
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("pos", T.IntegerType()),
]
USERS_LOG = T.StructType([*USERS.fields, *ARRIVAL_FIELDS])
SNAPSHOTS_KEPT = 100
WRITE_ORDER = ("batch_id", *ARRIVAL)


class UsersTable:
    """Users keyed by (user_id, ingestion_time): an append log read as last written.

    Within a key the later micro-batch wins, and inside a micro-batch the later
    message of a topic partition does. A key's hour never changes, so hours
    are resolved apart from each other: a reader of some hours opens no others.
    `compact` folds the log's new batches, hour by hour, into bases; an hour is its
    newest base and the batches after the last compaction.
    """

    def __init__(self, spark: SparkSession, path: str):
        root = path.rstrip("/")
        with_batch = USERS_LOG.fields + [T.StructField("written", T.LongType())]
        self.log = HourFolders(spark, f"{root}/log", USERS_LOG)
        self.base = HourFolders(spark, f"{root}/base", T.StructType(with_batch))

    def append(self, users: DataFrame, batch_id: int) -> None:
        self.log.write(usable(users), batch_id)

    def hours(self) -> set[int]:
        """All hours that hold rows."""
        return set().union(*self.base.hours().values(), *self.log.hours().values())

    def _newest_bases(self, bases: dict[int, set[int]]) -> dict[int, int]:
        """For each hour the batch that holds its newest base."""
        return {hour: batch_id for batch_id in sorted(bases) for hour in bases[batch_id]}

    def entries(self, hours: set[int] | None = None) -> DataFrame:
        """Stored copies, each with its write order in `batch_id` and the arrival columns.

        With `hours` only theirs. What an older base or a folded batch still holds is not read.
        """
        bases = self.base.hours()
        folded = max(bases, default=-1)
        newest = self._newest_bases(bases)
        wanted = [(batch_id, hour) for hour, batch_id in newest.items() if hours is None or hour in hours]
        base = self.base.read_hours(sorted(wanted)).drop("batch_id").withColumnRenamed("written", "batch_id")
        if hours is None:
            tail = self.log.read([i for i in self.log.complete() if i > folded])
        else:
            found = self.log.hours().items()
            tail = self.log.read_hours(
                [(i, hour) for i, held in found if i > folded for hour in sorted(held & hours)]
            )
        return tail.unionByName(base) if wanted else tail

    def current(self, hours: set[int] | None = None) -> DataFrame:
        """The rows as last written, of all hours or of some."""
        return last_write(self.entries(hours), WRITE_ORDER).select(*USER_COLUMNS)

    def compact(self) -> None:
        """Folds the batches since the last compaction into new bases of the hours they hold.

        Hours without new rows keep their base, so the work grows with what is
        new, not with the table. What the compaction before has replaced is
        removed: one round late, so that a read that began on it still finds its files.
        """
        log, bases = self.log.hours(), self.base.hours()
        folded = max(bases, default=None)
        fresh = [i for i in log if folded is None or i > folded]
        if not fresh:
            return
        touched = set().union(*[log[i] for i in fresh])
        resolved = last_write(self.entries(touched), WRITE_ORDER)
        self.base.write(resolved.withColumnRenamed("batch_id", "written"), max(fresh))
        if folded is None:
            return
        for batch_id in log:
            if batch_id <= folded:
                self.log.remove(batch_id)
        newest = self._newest_bases(bases)
        for batch_id, held in bases.items():
            live = {hour for hour in held if newest[hour] == batch_id}
            if not live and batch_id < folded:
                self.base.remove(batch_id)
            for hour in held - live if live else ():
                discard(self.base.spark, f"{self.base.folder(batch_id)}/hour={hour}")
