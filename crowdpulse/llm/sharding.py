"""Shards of bounded size by extendible hashing.

A document's hash is a string of bits. The directory is indexed by its first
bits; a bucket is a prefix, and only a bucket whose documents exceed the limit
is split, on one more bit, until every shard fits. The sizes of all prefixes up
to a depth are summed in one pass, so which buckets are split is known at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.frames import cut

LIMIT = 4 << 20
# Bits by which cells are finer than a bucket of average size, and bits of each round after the first.
FINER, FURTHER = 6, 16
MOST_BITS = 60


def _prefix(of: str, width: int, bits: int) -> Column:
    """The first `bits` of a number of `width` bits."""
    if not bits:
        return F.lit(0).cast("long")
    return F.shiftrightunsigned(F.col(of), width - bits)


def _ancestors(start: int, end: int) -> Column:
    """(bits, bucket) of every prefix of `start` to `end` bits of the column `prefix` of `end` bits."""
    slots = [
        F.struct(F.lit(bits).alias("bits"), _prefix("prefix", end, bits).alias("bucket"))
        for bits in range(start, end + 1)
    ]
    return F.explode(F.array(*slots))


def _buckets(cells: DataFrame, start: int, end: int, limit: int) -> DataFrame:
    """The buckets among prefixes of `start` to `end` bits: bits, bucket, shard_bytes, open.

    `cells` has prefix (of `end` bits), bytes and rows. A prefix is split if its
    documents exceed the limit and are not one; a bucket is a prefix that is not, below one
    that is. Cells that would have to be split further are `open`.
    """
    # Neighbouring cells lie in one task, so their common prefixes are summed before the shuffle.
    spread = cells.repartitionByRange("prefix").select("bytes", "rows", _ancestors(start, end).alias("at"))
    sums = spread.groupBy("at.bits", "at.bucket").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("rows"))
    sums = cut(sums.withColumn("full", (F.col("shard_bytes") > limit) & (F.col("rows") > 1)))
    split = sums.where("full").select((F.col("bits") + 1).alias("bits"), F.col("bucket").alias("above"))
    below = sums.withColumn("above", F.shiftrightunsigned("bucket", 1))
    found = below.where(F.col("bits") > start).join(split, ["bits", "above"], "left_semi")
    found = found.unionByName(below.where(F.col("bits") == start)).where(~F.col("full") | (F.col("bits") == end))
    return found.select("bits", "bucket", "shard_bytes", F.col("full").alias("open"))


def shard(documents: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, shard, depth, shard_bytes) per row of `documents`.

    n_bytes is the length of the text in UTF-8 (null: 0), shard the bucket's
    prefix as a bit string, depth its number of bits, shard_bytes what its
    documents have together, at most `limit`. A document alone over the limit
    is a shard of its own, at the first depth where it stands alone.
    Repeated rows share a hash unless copies of one row exceed the limit; they
    are then told apart by a number given to the written rows. Null doc_ids
    are hashed with their text like others. Only doc_id and text are read.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = cut(
        documents.select(
            F.col("doc_id").cast("long"),
            F.octet_length(text).cast("long").alias("n_bytes"),
            F.xxhash64(F.col("doc_id").cast("long"), text).alias("hash"),
        )
    )
    # Copies of a row can't be split by their hash, so a share of their number joins it.
    heavy = rows.groupBy("hash").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n"))
    heavy = heavy.where((F.col("n") > 1) & (F.col("b") > limit)).select("hash")
    numbered = rows.withColumn("number", F.monotonically_increasing_id())
    again = numbered.join(cut(heavy).withColumn("heavy", F.lit(True)), "hash", "left")
    own = F.when(F.col("heavy"), F.xxhash64("hash", "number")).otherwise(F.col("hash"))
    rows = cut(again.select("doc_id", "n_bytes", own.alias("hash")))

    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    start, end = 0, min(MOST_BITS, (total // limit).bit_length() + FINER)
    placed, todo = None, rows.withColumn("prefix", _prefix("hash", 64, end))
    while True:
        cells = cut(todo.groupBy("prefix").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows")))
        buckets = cut(_buckets(cells, start, end, limit))
        # A cell lies in one bucket; the rows then find theirs by their cell.
        own = cells.select("prefix", _ancestors(start, end).alias("at")).select("prefix", "at.*")
        own = cut(own.join(buckets, ["bits", "bucket"]).select("prefix", "bits", "bucket", "shard_bytes", "open"))
        named = todo.join(own, "prefix")
        more = end < MOST_BITS and not buckets.where("open").isEmpty()
        fits = (named.where("NOT open") if more else named).drop("prefix", "open", "hash")
        placed = fits if placed is None else placed.unionByName(fits)
        if not more:
            break
        start, end = end + 1, min(MOST_BITS, end + FURTHER)
        todo = cut(named.where("open").select("doc_id", "n_bytes", "hash"))
        todo = todo.withColumn("prefix", _prefix("hash", 64, end))
    bits = F.lpad(F.bin("bucket"), 64, "0")
    return placed.select(
        "doc_id",
        "n_bytes",
        F.when(F.col("bits") == 0, F.lit("")).otherwise(F.right(bits, F.col("bits"))).alias("shard"),
        F.col("bits").alias("depth"),
        "shard_bytes",
    )
