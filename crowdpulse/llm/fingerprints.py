"""Document fingerprints from prefix polynomial hashes.

prefix[i] is the hash of the first i code points, a polynomial in a fixed base
modulo a prime. The difference of two entries, divided by a power of the base,
is the hash of the span between them: any two spans, of one text or of two,
are compared in constant time, and the longest common extension of two places
is found by binary search.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.frames import numbered, picked
from crowdpulse.llm.shingles import mix

PRIME = (1 << 31) - 1
BASES = (1_000_003_757, 1_999_999_973)
SPAN = 16
SAMPLE = 64


def _fold(x: np.ndarray) -> np.ndarray:
    """Modulo 2**31 - 1 for values below 2**62, without divisions."""
    prime, bits = np.uint64(PRIME), np.uint64(31)
    x = (x & prime) + (x >> bits)
    x = (x & prime) + (x >> bits)
    return np.where(x >= prime, x - prime, x)


class _Powers:
    """Powers of each base, and of its inverse, grown by doubling."""

    def __init__(self) -> None:
        self.tables = [np.ones(1, dtype=np.uint64) for _ in range(2 * len(BASES))]

    def upto(self, n: int) -> list[np.ndarray]:
        factors = [f for base in BASES for f in (base, pow(base, -1, PRIME))]
        while len(self.tables[0]) < n:
            have = len(self.tables[0])
            for at, factor in enumerate(factors):
                step = np.uint64(pow(factor, have, PRIME))
                self.tables[at] = np.concatenate([self.tables[at], _fold(self.tables[at] * step)])
        return self.tables


_POWERS = _Powers()


class PrefixHash:
    """Hashes of all spans of one text."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
        points = points.astype(np.uint64) + np.uint64(1)
        self.length = len(points)
        self.prefix = []
        tables = _POWERS.upto(self.length + 1)
        for up in tables[::2]:
            sums = np.zeros(self.length + 1, dtype=np.uint64)
            np.cumsum(_fold(points * up[: self.length]), out=sums[1:])
            self.prefix.append(_fold(sums))

    def spans(self, starts: np.ndarray, lengths) -> np.ndarray:
        """64-bit hashes of the spans of these lengths from these places."""
        tables, prime = _POWERS.upto(self.length + 1), np.uint64(PRIME)
        parts = []
        for prefix, down in zip(self.prefix, tables[1::2]):
            parts.append(_fold((prefix[starts + lengths] + prime - prefix[starts]) * down[starts]))
        return parts[0] << np.uint64(31) | parts[1]

    def span(self, start: int, length: int) -> int:
        """As `spans`, of one span; plain integers are quicker than arrays of one."""
        tables, parts = _POWERS.upto(self.length + 1), []
        for prefix, down in zip(self.prefix, tables[1::2]):
            sums = int(prefix[start + length]) - int(prefix[start])
            parts.append(sums * int(down[start]) % PRIME)
        return parts[0] << 31 | parts[1]

    def common(self, start: int, other: PrefixHash, place: int) -> int:
        """Length of the longest common extension of two places, by binary search."""
        low, high = 0, min(self.length - start, other.length - place)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span(start, middle) == other.span(place, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def fingerprint(self) -> str:
        """Length, hash of the whole text, and the SAMPLE smallest hashes of its spans.

        Spans of SPAN code points are taken from every place; a shorter text
        is one span. Equal texts have equal fingerprints.
        """
        n = self.length
        whole = self.span(0, n)
        if not n:
            return f"0.{whole:016x}."
        starts = np.arange(max(1, n - SPAN + 1))
        hashes = mix(self.spans(starts, min(n, SPAN))) >> np.uint64(32)
        if len(hashes) > 8 * SAMPLE:
            # Spans repeat, so cut well above the sample and look again if too few differ.
            cut = np.uint64((1 << 32) * 4 * SAMPLE // len(hashes))
            low = np.unique(hashes[hashes < cut])
            hashes = low if len(low) >= SAMPLE else hashes
        sample = np.unique(hashes)[:SAMPLE].astype(">u4")
        return f"{n}.{whole:016x}.{sample.tobytes().hex()}"


def likeness(one: str, other: str) -> float:
    """0 to 1: the share of spans that two texts have in common, estimated from fingerprints.

    1 exactly if the fingerprints are equal. The smallest hashes of the union
    of both samples are a sample of the spans of both texts; those in both
    samples are common ones.
    """
    if one == other:
        return 1.0
    a, b = (np.frombuffer(bytes.fromhex(x.rpartition(".")[2]), dtype=">u4") for x in (one, other))
    union = np.union1d(a, b)
    # A text of few spans has all of them in its sample.
    union = union[: max(SAMPLE, 1)]
    common = len(np.intersect1d(np.intersect1d(a, b), union))
    jaccard = common / len(union) if len(union) else 0.0
    longest = max(int(one.partition(".")[0]), int(other.partition(".")[0]))
    return min(2 * jaccard / (1 + jaccard), 1 - 1 / (2 * longest + 2))


def edited(text: str, following: str) -> str:
    """The last third of the code points, rounded down, replaced by as many of the next text's first."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("prefix_edited", pa.int64()),
        ("prefix_next", pa.int64()),
    ]
)
_RESULT_DDL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, prefix_edited long, "
    "prefix_next long"
)


def _row(doc_id, text, hashes, print_, next_text, next_hashes, next_print) -> tuple:
    changed = edited(text, next_text)
    changed_hashes = PrefixHash(changed)
    changed_print = changed_hashes.fingerprint()
    return (
        doc_id,
        len(text),
        sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
        print_,
        changed_print,
        likeness(print_, changed_print),
        likeness(print_, next_print),
        hashes.common(0, changed_hashes, 0),
        hashes.common(0, next_hashes, 0),
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, each with the one after it; copies from the next range only lend theirs."""
    held, rows = None, []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(_RESULT)
        arrays = [pa.array(c, type=f.type) for c, f in zip(columns, _RESULT)]
        return pa.RecordBatch.from_arrays(arrays, schema=_RESULT)

    for batch in batches:
        keys = (batch.column(name).to_pylist() for name in ("range", "lent", "doc_id"))
        for number, lent, doc_id, text in zip(*keys, batch.column("text")):
            if lent and (held is None or held[0] != number):
                continue
            value = text.as_py() or ""
            hashes = PrefixHash(value)
            known = (value, hashes, hashes.fingerprint())
            if held is not None and held[0] == number:
                rows.append(_row(held[1], *held[2], *known))
            held = None if lent else (number, doc_id, known)
            if len(rows) >= 1000:
                yield flush()
                rows.clear()
    yield flush()


#: Bytes of input in a range, about; the session's width is the least number of ranges.
RANGE_BYTES = 256 << 20
# Spark says so much, or more, of rows that it knows no size of.
UNKNOWN = 1 << 56

Key = tuple[bool, int, int]  # no doc_id; minus the doc_id; hash of the text


def _order_key(doc_id: int | None, text_hash: int) -> Key:
    """Ascends as rows follow each other: doc_ids descend, null last, then texts by their hash."""
    return doc_id is None, 0 if doc_id is None else -doc_id, text_hash


def _bounds(docs: DataFrame, parts: int) -> list[Key]:
    """The first key of each of about equal ranges; as many rows come to the driver as there are ranges.

    Keys hold the text's hash, so rows that share a doc_id, or have none, are
    spread over ranges like the others; only equal rows are not.
    """
    keys = docs.select(F.lit(0).alias("all"), "doc_id", F.xxhash64("text").alias("h"))
    placed = numbered(keys, "all", [F.col("doc_id").desc_nulls_last(), F.col("h")])
    number = F.expr(f"at * {parts} div n")
    heads = placed.groupBy(number.alias("range")).agg(F.min_by(F.struct("doc_id", "h"), "at").alias("head"))
    return sorted({_order_key(*row["head"]) for row in heads.collect()})


def compare_neighbours(documents: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of each row's text and of its edited text, with likenesses.

    The next document of a row is the one with the next lower doc_id, after
    the last the first. Rows of one doc_id follow each other by their text's
    hash; rows without a doc_id come last, likewise. A null text is empty; the
    likeness of two empty texts is 1, of an empty and another one 0. A single
    row is its own next. prefix_edited and prefix_next are the lengths of the
    longest common prefixes. Only doc_id and text are read.

    Every text is shuffled once, to its range of (doc_id, hash), and sorted
    there; ranges are of RANGE_BYTES of input. The first row of the next range
    comes along as a lent copy, so no join and no window over all rows is needed.
    """
    docs = picked(documents, doc_id="long", text="string")
    spark = documents.sparkSession
    if parts is None:
        size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        size = size if size < UNKNOWN else 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    bounds = _bounds(docs, parts)
    # The first key of each range goes also to the range before, the first range's to the last.
    lends: dict[Key, int] = {key: (at - 1) % len(bounds) for at, key in enumerate(bounds)}

    @F.pandas_udf("array<struct<range:int,lent:boolean>>")
    def places(ids, hashes):
        import pandas as pd

        # As text, since a null among them would make the numbers floats.
        known = ids.notna().tolist()
        out = []
        for there, doc_id, text_hash in zip(known, ids.tolist(), hashes.tolist()):
            key = _order_key(int(doc_id) if there else None, text_hash)
            place = [{"range": bisect_right(bounds, key) - 1, "lent": False}]
            if key in lends:
                place.append({"range": lends[key], "lent": True})
            out.append(place)
        return pd.Series(out)

    hashed = docs.withColumn("h", F.xxhash64("text"))
    placed = hashed.select("doc_id", "text", "h", F.explode(places(F.col("doc_id").cast("string"), "h")).alias("place"))
    placed = placed.select("place.*", "doc_id", "text", "h")
    order = ["range", "lent", F.col("doc_id").desc_nulls_last(), "h", F.col("text").asc_nulls_first()]
    ranged = placed.repartitionById(parts, F.col("range")).sortWithinPartitions(*order).drop("h")
    return ranged.mapInArrow(_compare, _RESULT_DDL)
