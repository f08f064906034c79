"""Reading and publishing messages, on Kafka or on files with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.functions import epoch_to_time
from crowdpulse.schemas import MESSAGE

# Start at the earliest message, go on when old ones are gone,
# and publish with full acknowledgement and three retries.
KAFKA_READ = {"startingOffsets": "earliest", "failOnDataLoss": "false"}
KAFKA_WRITE = {"kafka.acks": "all", "kafka.retries": "3"}

# A backlog of files is taken in by micro-batches of at most 1 TiB.
FILE_READ = {"maxBytesPerTrigger": str(1 << 40)}


def _reader(reader, fmt: str, options: dict[str, str] | None):
    reader = reader.format(fmt)
    if fmt == "kafka":
        return reader.options(**{**KAFKA_READ, **(options or {})})
    return reader.schema(MESSAGE).options(**(options or {}))


def message_stream(spark: SparkSession, fmt: str, options: dict[str, str] | None = None) -> DataFrame:
    """An unbounded message scan.

    For Kafka at scale set `minPartitions` (a topic with few partitions else
    limits the parse to few tasks) and `maxOffsetsPerTrigger`.
    """
    options = dict(options or {})
    if fmt != "kafka" and "maxFilesPerTrigger" not in options:
        options = {**FILE_READ, **options}
    return _reader(spark.readStream, fmt, options).load()


def message_batch(spark: SparkSession, fmt: str, options: dict[str, str] | None = None) -> DataFrame:
    return _reader(spark.read, fmt, options).load()


def publish(messages: DataFrame, fmt: str, options: dict[str, str] | None = None) -> None:
    """Writes `key` and `value`; at least once, since a task may be run again."""
    defaults = KAFKA_WRITE if fmt == "kafka" else {}
    writer = messages.select("key", "value").write.format(fmt)
    writer.options(**{**defaults, **(options or {})}).mode("append").save()


def publish_to_files(
    messages: DataFrame,
    path: str,
    topic: str = "users",
    first_offset: int = 0,
    partitions: int = 8,
) -> None:
    """Stands in for a broker: adds what it would assign, and appends to a parquet folder.

    Offsets grow inside each topic partition. The step is narrow and written at
    once, so every row keeps the one offset its committed task gave it.
    """
    stamp = F.col("ingestion_timestamp")
    row = messages.select(
        "key",
        "value",
        F.lit(topic).alias("topic"),
        F.pmod(F.hash(stamp), F.lit(partitions)).alias("partition"),
        (F.lit(first_offset) + F.monotonically_increasing_id()).alias("offset"),
        epoch_to_time(stamp).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    row.write.mode("append").parquet(path)
