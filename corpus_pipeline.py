"""A training-data pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.llm.frames import cut, numbered
from crowdpulse.llm.near_dedup import near_duplicates
from crowdpulse.llm.packing import pack
from crowdpulse.llm.quality_model import quality_scores
from crowdpulse.llm.quality_rules import rules
from crowdpulse.llm.queries import table, tokenizer, trusted
from crowdpulse.llm.secrets import redact
from crowdpulse.sources.scratch import discard, new_folder


def _unused(docs: DataFrame, name: str) -> str:
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    return name


def _keys(docs: DataFrame) -> DataFrame:
    """(id, h, g) of each row: its doc_id and two hashes of its text."""
    text = F.col("`text`").cast("string")
    return docs.select(
        F.col("`doc_id`").cast("long").alias("id"),
        F.xxhash64(text).alias("h"),
        F.xxhash64(F.lit(1), text).alias("g"),
    )


def _identified(docs: DataFrame) -> tuple[DataFrame, str, bool]:
    """`docs` with a number for each different (doc_id, text), its column, and whether rows repeat.

    The number is the doc_id, so labels still find their documents, unless
    that is null or stands with several texts: then the text of smallest hash keeps
    it and the others get numbers above all doc_ids, by (doc_id, hash).
    """
    name = _unused(docs, "row_number")
    own = F.col("`doc_id`").cast("long")
    keys = cut(_keys(docs).groupBy("id", "h", "g").agg(F.count("*").alias("n")))
    repeated = not keys.where("n > 1").isEmpty()
    known = keys.where("id IS NOT NULL")
    first = F.min(F.struct("h", "g")).alias("first")
    several = known.groupBy("id").agg(first, F.count("*").alias("texts")).where("texts > 1")
    later = known.join(several, "id").where(F.struct("h", "g") != F.col("first"))
    odd = cut(keys.where("id IS NULL").unionByName(later.select(*keys.columns)).drop("n"))
    if odd.isEmpty():
        return docs.withColumn(name, own), name, repeated
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).first()["top"]
    order = [F.col("id").asc_nulls_last(), F.col("h"), F.col("g")]
    placed = numbered(odd.withColumn("all", F.lit(0)), "all", order)
    extra = placed.select(*[F.col(c).alias(_unused(docs, c)) for c in ("id", "h", "g")], (top + 1 + F.col("at")).alias(name))
    text = F.col("`text`").cast("string")
    same = (
        own.eqNullSafe(F.col(_unused(docs, "id")))
        & (F.xxhash64(text) == F.col(_unused(docs, "h")))
        & (F.xxhash64(F.lit(1), text) == F.col(_unused(docs, "g")))
    )
    # Joined by hash: sorting would carry whole texts.
    joined = docs.join(extra.hint("shuffle_hash"), same, "left")
    number = F.coalesce(F.col(name), own).alias(name)
    return joined.select(*[F.col(f"`{column}`") for column in docs.columns], number), name, repeated


def _texts(docs: DataFrame, number: str) -> DataFrame:
    """What the operators read: the number in place of the doc_id, and the text."""
    return docs.select(F.col(number).alias("doc_id"), F.col("`text`").cast("string").alias("text"))


def _decided(docs: DataFrame, number: str, kept: DataFrame) -> DataFrame:
    """The rows of `docs` whose number is among the doc_ids of `kept`."""
    ids = kept.select(F.col("doc_id").alias(_unused(docs, "kept_number"))).distinct()
    same = F.col(number) == F.col(ids.columns[0])
    return docs.join(ids.hint("shuffle_hash"), same, "left_semi").drop(number)


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the quality model accepts; of a doc_id with several texts only those."""
    docs, number, _ = _identified(docs)
    scores = quality_scores(_texts(docs, number), table(spark, sf_dir, "labels"))
    return _decided(docs, number, scores.where("predicted = 1"))


def clean_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text passes the quality rules, whose target are those labelled as good."""
    docs, number, _ = _identified(docs)
    judged = rules(_texts(docs, number), trusted(table(spark, sf_dir, "labels")))
    return _decided(docs, number, judged.where("kept"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, of the smallest doc_id (null last).

    Every row counts as a document of its own, also without a doc_id. Of
    equal rows one stays, and texts without words are equal only to themselves.
    """
    docs, number, repeated = _identified(docs)
    if repeated:
        docs = docs.dropDuplicates([number])
    return _decided(docs, number, near_duplicates(_texts(docs, number)).where("kept"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark and their length counted again."""
    return redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, each with its place in a training sequence."""
    return pack(docs, tokenizer("word_bpe_49k.json"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", good_text),
    ("quality rules", clean_text),
    ("MinHash near-dedup", one_of_each),
    ("secret scans", without_secrets),
    ("best-fit packing", packed),
]

#: No stage's model, components or packing can be stated in SQL; the tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the table documents of `sf_dir`; its folder is the caller's to remove."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        folder = new_folder(spark, name.replace(" ", "-").lower())
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
        if before:
            discard(spark, before)
        before = folder
    return docs
