"""The operators' queries over the test tables, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from crowdpulse.llm.byte_pairs import digests as byte_pair_digests
from crowdpulse.llm.chat import ROTATE_SQL, rotate
from crowdpulse.llm.fingerprints import compare_neighbours
from crowdpulse.llm.html_text import extract
from crowdpulse.llm.merkle import manifest
from crowdpulse.llm.near_dedup import near_duplicates
from crowdpulse.llm.packing import pack
from crowdpulse.llm.piece_digests import digests
from crowdpulse.llm.quality_model import quality_scores
from crowdpulse.llm.quality_rules import rules
from crowdpulse.llm.secrets import scan
from crowdpulse.llm.sharding import shard
from crowdpulse.llm.spelling import variants


def tokenizer(name: str) -> str:
    """Where the public tokenizers' files are installed; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trusted(labels: DataFrame) -> DataFrame:
    """Documents that are labelled as good text."""
    return labels.where("quality = 1 and toxic = 0").select("doc_id")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_neighbours(table(spark, sf_dir, "documents"))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules(table(spark, sf_dir, "documents"), trusted(table(spark, sf_dir, "labels")))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pair_digests(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_sharding": op3_sharding,
    "op4_secrets": op4_secrets,
    "op5_chat": op5_chat,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_pieces": op7_pieces,
    "op8_fingerprints": op8_fingerprints,
    "op9_rules": op9_rules,
    "op10_html": op10_html,
    "op11_manifest": op11_manifest,
    "op12_spelling": op12_spelling,
    "op13_byte_pairs": op13_byte_pairs,
}

ORACLE: dict[str, str] = {"op5_chat": ROTATE_SQL}
