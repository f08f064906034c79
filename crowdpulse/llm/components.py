"""Connected components of a table of links, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.frames import cut, dealt
from crowdpulse.sources.scratch import discard, new_folder


def _state(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v")
    row = edges.agg(
        F.count("*"), F.sum((mixed % 1_000_003).cast("long")), F.bit_xor(mixed)
    ).first()
    return tuple(row)


def _star(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Every link (u, v) of a node u becomes (v, smallest neighbour of u)."""
    tied = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.where("u != v").distinct()


def _stored(edges: DataFrame) -> tuple[DataFrame, str]:
    """The rows written and read again, and their folder.

    A checkpoint keeps the planner's guess of its size, which for a join is the
    product of both sides: round by round it would grow to millions of digits.
    """
    folder = new_folder(edges.sparkSession, "links")
    edges.write.parquet(folder)
    return edges.sparkSession.read.schema(edges.schema).parquet(folder), folder


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every node of `links` (columns a, b): label is the smallest id reachable.

    Large-star and small-star steps take turns until every node is tied to its
    label alone. No step makes more links than it was given, smallest
    neighbours are aggregated before the shuffle, and each round is written to
    the shared folder, so joins read plain tables and Spark may split the
    partition of a hub. Self links and null ends count for nothing.
    """
    greater, lesser = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges, folder = _stored(links.where("a != b").select(greater, lesser).distinct())
    before, now = None, _state(edges)
    while now != before:
        rows = now[0]
        edges = dealt(edges, rows)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        least = cut(dealt(least, 2 * rows))
        # Large star: neighbours above a node go to the smallest around it.
        large = cut(dealt(_star(both.where("v > u"), least), rows))
        # Small star: neighbours below a node, and the node itself, do so too.
        least = cut(dealt(large.groupBy("u").agg(F.min("v").alias("m")), rows))
        own = least.select("u", F.col("m").alias("v"))
        edges, done = _stored(dealt(_star(large, least).unionByName(own).distinct(), rows))
        discard(edges.sparkSession, folder)
        folder = done
        before, now = now, _state(edges)
    labels = edges.select(F.col("u").alias("id"), F.col("v").alias("label"))
    return labels.unionByName(labels.select(F.col("label").alias("id"), "label").distinct())
