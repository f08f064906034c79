"""Batch form of a poller that takes a fixed number of records at a fixed interval."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.schemas import POLL_SECONDS, USERS_PER_ENVELOPE
from crowdpulse.sources.scratch import ensure_checkpoint_dir


def poll_at_cadence(
    rows: DataFrame,
    start: int,
    per_poll: int = USERS_PER_ENVELOPE,
    seconds: int = POLL_SECONDS,
) -> DataFrame:
    """Stamps rows as polled `per_poll` at a time, `seconds` apart, from epoch `start`.

    Needs a gapless number per row. Rows are numbered inside their partition and
    written to the checkpoint folder, so that a lost executor cannot renumber
    them; then each partition is shifted by the sizes of those before it. The
    rows themselves are never shuffled, however they are spread.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    numbered = rows.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_id", 33)  # the id holds the partition above 33 bits of row number
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # One row per partition: bounded by the number of tasks, so one window task and a broadcast do.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift")
    )
    number = F.col("_shift") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(shifts), "_part")
        .withColumn("_number", number)
        .withColumn("ingestion_timestamp", F.expr(f"{start} + _number div {per_poll} * {seconds}"))
        .select(*rows.columns, "ingestion_timestamp")
    )
