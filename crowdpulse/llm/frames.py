"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from crowdpulse.sources.scratch import ensure_checkpoint_dir

BATCH_BYTES = 4 << 20
_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"
ROWS_READ = 256
_READ_LIMIT = "spark.sql.parquet.columnarReaderBatchSize"


def cut(df: DataFrame) -> DataFrame:
    """The rows, written once to the cluster's checkpoint folder, with no lineage left.

    A lost executor then costs a read of shared files, and what follows joins
    plain scans, whose skewed partitions Spark may split.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def free(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files that no plan needs; it waits for the driver's collector."""
    spark.sparkContext._jvm.System.gc()


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """At most one partition per hundred thousand of `rows`, so that small tables make few files."""
    return df.coalesce(1 + rows // 100_000)


def picked(df: DataFrame, **columns: str) -> DataFrame:
    """Only these columns, as name=SQL type; others, whatever their names, don't take part."""
    return df.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in columns.items()])


def batched(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """`df.mapInArrow(function, schema)` for rows with whole texts, in batches of about BATCH_BYTES.

    Spark counts a batch by rows, 10,000 of them, whatever their texts, and executor and Python worker
    each hold it, with room to grow, and keep much of that afterwards. The limit is set in the session,
    since Spark plans only when the result is read; a limit that the session has already is left.
    """
    spark = df.sparkSession
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, str(BATCH_BYTES))
    return df.mapInArrow(function, schema)


@contextmanager
def few_rows_read(spark: SparkSession) -> Iterator[None]:
    """What runs inside reads Parquet files ROWS_READ rows at once.

    Spark takes 4,096, whatever their length, and keeps a column of them in one array, which it doubles as it fills. Of
    whole texts that is many MB in one piece, for which the heap grows and then stays large. The limit holds for
    what is planned and run inside only; one that the session has already is left.
    """
    if spark.conf.get(_READ_LIMIT, None) is not None:
        yield
        return
    spark.conf.set(_READ_LIMIT, str(ROWS_READ))
    try:
        yield
    finally:
        spark.conf.unset(_READ_LIMIT)


def numbered(rows: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """The rows with their place `at` in their group, from 0, and the group's number of rows `n`.

    Rows are dealt out by ranges of (group, order), so a group that holds a third
    of all rows is spread like the rest; only a count per group and range is
    summed up, which is at most one row per range beyond one per group.
    """
    sorted_rows = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(F.col(group), *order)
    # Written, so that no lost task can number its rows in another order.
    placed = cut(sorted_rows.withColumn("_id", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_id", 33))
    counts = placed.groupBy(group, "_part").agg(F.count("*").alias("_n"), F.min("_id").alias("_from"))
    parts = Window.partitionBy(group)
    before = parts.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumns(
        {"_before": F.coalesce(F.sum("_n").over(before), F.lit(0)), "n": F.sum("_n").over(parts)}
    )
    place = F.col("_before") + F.col("_id") - F.col("_from")
    joined = placed.join(counts.drop("_n"), [group, "_part"])
    return joined.withColumn("at", place).drop("_id", "_part", "_before", "_from")


def rows_of(values: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """A list column, one array a row."""
    offsets = np.zeros(len(values) + 1, dtype=np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    flat = np.concatenate(values) if values else np.empty(0, dtype=kind.to_pandas_dtype())
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))
