"""Session settings for the jobs."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """A session with the defaults above; `settings` wins over them.

    `spark.sql.shuffle.partitions` is left to the submitter: choose it for the
    cluster, or for the data with `size_shuffles`.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


# Users as parquet are about a fifth of their shuffled JSON text.
INPUT_PER_PARTITION = 32 << 20
MOST_PARTITIONS = 50_000

_PARTITIONS = "spark.sql.shuffle.partitions"
_OWN_PARTITIONS = "spark.crowdpulse.own.shuffle.partitions"


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file or folder, from the file system's own records."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(context._jsc.hadoopConfiguration())
    return system.getContentSummary(target).getLength()


def size_shuffles(spark: SparkSession, size: int) -> int:
    """Shuffle partitions for a query that shuffles `size` bytes of input; 0 for one that does not.

    Adaptive execution merges small partitions but cannot add any for an
    aggregate or a window, so a whole table needs more of them before planning.
    A query that shuffles a row per group does not: every map task would index
    partitions that stay empty. The session's own number is the least, and what
    a size of 0 returns to.
    """
    own = int(spark.conf.get(_OWN_PARTITIONS, None) or spark.conf.get(_PARTITIONS))
    spark.conf.set(_OWN_PARTITIONS, own)
    wanted = max(own, min(-(-size // INPUT_PER_PARTITION), MOST_PARTITIONS))
    spark.conf.set(_PARTITIONS, wanted)
    return wanted
