"""Near-duplicate documents by MinHash bands and odd sketches.

Two documents are linked if the Jaccard similarity of their sets of distinct
five-word shingles reaches a threshold. The steps:

1. Equal sets form a class; one representative stands for it.
2. Of each representative's MinHash sample, four values at a time make a band
   key. Documents that share a key share a bucket, so a pair at the threshold
   of 0.85 is missed with probability (1 - 0.85**4)**24, about 2e-8.
3. The whole sample is folded into a parity bitmap (an odd sketch): the bits
   that differ between two of them estimate how many MinHash values differ.
   Pairs estimated clearly below the threshold are not compared further.
4. In each bucket all members are compared with one pivot, the member found in
   the fullest buckets; links are confirmed on the whole shingle sets.
5. Only buckets that these links leave in several components are looked at again,
   by prefixes: shingles are ordered from the rarest on, and a pair that reaches
   the threshold shares one early in both sets. Pairs that share none, among them
   those of a template whose texts each differ in words of their own, are never
   listed. Where such lists are long, each row is first compared with one of its
   list, so that a group's stragglers join it before pairs are listed, and only
   pairs of different components are. They are estimated; each document's nearest
   partner is confirmed first, then what still lies in different components.

No step expands the copies of a class or lists all pairs of a bucket. A document
in very many pairs is spread over tasks by its partners.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.components import components
from crowdpulse.llm.frames import batched, cut, dealt, free, picked, rows_of
from crowdpulse.llm.shingles import mix, random_words, shingle_sets

HASHES = 384
BANDS = 24
BAND_ROWS = 4
SKETCH_BITS = 2048
# How far below the threshold an estimate may lie: more than four deviations.
MARGIN = 0.08
# A task meets at most so many rows of one shingle, or partners of one document.
BLOCK_ROWS = 256
# Documents with more partners than that are broadcast up to this number, else joined.
MOST_BROADCAST = 100_000
# Lists of one shingle that would give more pairs of different components per row are thinned out first.
LISTED_PER_ROW = 16

_FACTOR = random_words(HASHES, 11) | np.uint64(1)
_SHIFT = random_words(HASHES, 12)
_FOLD = random_words(HASHES, 13)
_BAND = random_words(BANDS, 14)
_SIGNATURE = "doc_id long, n_shingles long, set_key binary, bands array<long>, sketch array<long>"


def minhash(shingles: np.ndarray) -> np.ndarray:
    """For each hash function the least value over a non-empty set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 512):
        part = shingles[None, at : at + 512] * _FACTOR[:, None]
        part += _SHIFT[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return least


def band_keys(sample: np.ndarray) -> np.ndarray:
    rows = sample[: BANDS * BAND_ROWS].reshape(BANDS, BAND_ROWS)
    keys = _BAND.copy()
    for i in range(BAND_ROWS):
        keys = mix(keys ^ rows[:, i])
    return keys.view(np.int64)


def odd_sketch(sample: np.ndarray) -> np.ndarray:
    """Bit b is set if an odd number of (place, value) pairs of the sample fall on b."""
    at = (mix(sample ^ _FOLD) % np.uint64(SKETCH_BITS)).astype(np.int64)
    parity = (np.bincount(at, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(parity).view(np.int64)


def differing_bits(similarity: float) -> int:
    """Bits in which two sketches differ on average at this share of equal MinHash values."""
    changed = 2 * HASHES * (1 - similarity)
    return int(SKETCH_BITS / 2 * (1 - np.exp(-2 * changed / SKETCH_BITS)))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, keys, bands, sketches = [], [], [], []
        for shingles in shingle_sets(batch.column("text").to_pylist()):
            sizes.append(len(shingles))
            if len(shingles):
                sample = minhash(shingles)
                keys.append(blake2b(shingles.tobytes(), digest_size=16).digest())
                bands.append(band_keys(sample))
                sketches.append(odd_sketch(sample))
            else:
                keys.append(None)
                bands.append(np.empty(0, dtype=np.int64))
                sketches.append(np.empty(0, dtype=np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(sizes, type=pa.int64()),
                pa.array(keys, type=pa.binary()),
                rows_of(bands, pa.int64()),
                rows_of(sketches, pa.int64()),
            ],
            names=["doc_id", "n_shingles", "set_key", "bands", "sketch"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One set of a kind per document, whose rows lie in one partition."""
    seen: set[bytes] = set()
    for batch in batches:
        ids, sets = [], []
        texts = shingle_sets(batch.column("text").to_pylist())
        for doc_id, shingles in zip(batch.column("doc_id").to_pylist(), texts):
            raw = shingles.tobytes()
            key = blake2b(raw, digest_size=16, salt=doc_id.to_bytes(8, "little", signed=True)).digest()
            if key not in seen:
                seen.add(key)
                ids.append(doc_id)
                sets.append(shingles.view(np.int64))
        columns = [pa.array(ids, pa.int64()), rows_of(sets, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "shingles"])


def _looked_up(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The written pairs (a, b) with the columns of `rows` (id) for both, their names ending in _a and _b.

    A row with more than BLOCK_ROWS partners is copied once per so many of them,
    so that no task of a join holds all the pairs of one document. The other rows
    stand there once and take no part in finding those. Both sides are looked up
    in the same rows by the same keys, so that Spark shuffles the rows once.
    """
    parts = F.ceil(F.count("*") / BLOCK_ROWS).alias("parts")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    hot = cut(ends.groupBy("id").agg(parts).where("parts > 1"))
    many, keys, joined = hot.count(), ["id"], pairs
    values = [c for c in rows.columns if c != "id"]
    if many:
        hot, keys = F.broadcast(hot) if many <= MOST_BROADCAST else hot, ["id", "part"]
        copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("parts") - 1))
        more = rows.join(hot, "id").withColumn("part", copies).drop("parts")
        rows = rows.withColumn("part", F.lit(0).cast("long")).unionByName(more)
    for side, other in (("a", "b"), ("b", "a")):
        joined = joined.withColumnRenamed(side, "id")
        if many:
            part = F.pmod(F.xxhash64(other), F.coalesce("parts", F.lit(1)))
            joined = joined.join(hot, "id", "left").withColumn("part", part).drop("parts")
        own = rows.select(*keys, *[F.col(c).alias(f"{c}_{side}") for c in values])
        joined = joined.join(own, keys).drop("part").withColumnRenamed("id", side)
    return joined


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the written pairs (a, b) whose whole shingle sets are similar enough."""
    both = _looked_up(pairs, sets.select("id", "shingles"))
    shared = F.size(F.array_intersect("shingles_a", "shingles_b"))
    union = F.size("shingles_a") + F.size("shingles_b") - shared
    counted = both.select("a", "b", shared.alias("shared"), union.alias("total"))
    return counted.where(F.col("shared") * 100 >= F.col("total") * percent).select("a", "b").distinct()


def _differ(left: str, right: str) -> F.Column:
    pieces = F.zip_with(left, right, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(pieces, F.lit(0), lambda total, bits: total + bits)


def _close(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Those of the written pairs (a, b) that sketches and sizes allow to be links, with their differing `bits`."""
    both = _looked_up(pairs, nodes.select("id", "sketch", F.col("n_shingles").alias("n")))
    close = both.where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent).select(
        "a", "b", _differ("sketch_a", "sketch_b").alias("bits")
    )
    # A document with several texts has a sketch for each.
    close = close.where(F.col("bits") <= differing_bits(percent / 100 - MARGIN))
    return close.groupBy("a", "b").agg(F.min("bits").alias("bits"))


def _prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(token, id, n, rest, lead, apart): the rarest shared shingles of each of the written sets (id, text, n, shingles).

    Each set is ordered from its rarest shingle in all these sets on; those that no
    other set has come first and take no part. rest counts a shingle and those
    after it. Beyond the prefix too few are left for a link with any set, and
    after the `lead` ones for a link with any set as large or larger. `apart` is
    small for a set whose shingles many others have.
    """
    tokens = sets.select("id", "text", "n", F.explode("shingles").alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("f")).where("f > 1")
    own = Window.partitionBy("id", "text")
    after = F.row_number().over(own.orderBy("f", "token"))
    placed = tokens.join(shared, "token").withColumn(
        "place", F.col("n") - F.count("*").over(own) + after - 1
    )
    placed = placed.withColumn("rest", F.col("n") - F.col("place")).withColumn(
        "apart", F.col("n") - F.sum(1 - 1 / F.col("f")).over(own)
    )
    return placed.where(F.col("rest") * 100 >= F.col("n") * percent).select(
        "token", "id", "n", "rest",
        (F.col("rest") * (100 + percent) >= F.col("n") * 2 * percent).alias("lead"),
        "apart",
    )


def _lists(prefixes: DataFrame, labels: DataFrame) -> tuple[DataFrame, int, int]:
    """The rows of the tokens that may link different labels, with label and the token's `size`; how many
    these rows are, and how many pairs of different labels stand in their lists."""
    rows = prefixes.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    rows = cut(rows)
    alike = rows.groupBy("token", "label").agg(F.count("*").alias("n"), F.max("lead").alias("lead"))
    live = alike.groupBy("token").agg(
        F.sum("n").alias("size"), F.sum(F.col("n") * F.col("n")).alias("same"), F.max("lead").alias("lead")
    )
    pairs = F.col("size").cast("double") * F.col("size") - F.col("same")
    live = live.select("token", "size", (pairs / 2).alias("pairs"), "lead").where("lead AND pairs > 0")
    live = cut(live.drop("lead"))
    held = live.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("pairs"), F.lit(0.0))).first()
    return rows.join(live.drop("pairs"), "token"), int(held[0]), int(held[1])


def _one_each(lists: DataFrame, turn: int) -> DataFrame:
    """Different pairs (a, b) of each row with one row of its list, if labels differ.

    That one is drawn, anew for each token and turn, from the rows that are least
    `apart` from others: such a row links with most of a group's stragglers.
    """
    chance = F.pmod(F.xxhash64("id", "token", F.lit(turn)), F.lit(1 << 20)) / (1 << 20)
    lot = F.struct(((1 + F.col("apart")) * (1 + chance)).alias("draw"), "id", "label")
    drawn = lists.groupBy("token").agg(F.min(lot).alias("lot"))
    # Written, so that the join reads plain tables and Spark may split the rows of a token in very many sets.
    drawn = cut(drawn.select("token", F.col("lot.id").alias("other"), F.col("lot.label").alias("label_other")))
    pairs = lists.join(drawn, "token").where("label != label_other")
    return pairs.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()


def _cross_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """Different pairs (a, b) of sets of two labels that the prefixes allow to be links."""
    chunks = F.ceil(F.col("size") / BLOCK_ROWS).cast("long")
    rows = lists.withColumn("chunk", F.pmod(F.xxhash64("id"), chunks)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1))
    )
    rows = rows.select("token", "chunk", "other", "id", "label", "n", "rest", "lead")
    first = rows.where("lead").toDF("token", "one", "two", "a", "label_a", "n_a", "rest_a", "lead")
    second = rows.toDF("token", "two", "one", "b", "label_b", "n_b", "rest_b", "lead_b")
    pairs = first.drop("lead").join(second.drop("lead_b"), ["token", "one", "two"])
    pairs = pairs.where("label_a != label_b AND (n_a < n_b OR (n_a = n_b AND a < b))")
    # The first shingle that both have leaves as many as the shorter rest, which must do for a link.
    needed = (F.col("n_a") + F.col("n_b")) * percent
    pairs = pairs.where(F.least("rest_a", "rest_b") * (100 + percent) >= needed)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """`labels` (id, label) after further links (a, b)."""
    tied = labels.select(F.col("id").alias("a"), F.col("label").alias("b"))
    return components(tied.unionByName(links))


def _links_between(
    sets: DataFrame, nodes: DataFrame, labels: DataFrame, opened: DataFrame, percent: int
) -> DataFrame:
    """`labels` (id, label) after all links between sets of `opened` (id) with different labels."""
    # Written, so that no later step shuffles the rows of other documents, or hashes a set once per shingle.
    nodes = cut(nodes.join(opened, "id"))
    text, n = F.xxhash64("shingles").alias("text"), F.size("shingles").alias("n")
    sets = cut(sets.join(opened, "id").select("id", text, n, "shingles"))
    prefixes = cut(_prefixes(sets, percent))
    lists, rows, held = _lists(prefixes, labels)
    turn, before = 0, 2 * held + 1
    # As long as that takes a fiftieth of them away; what is left is listed whole.
    while held > LISTED_PER_ROW * rows and 50 * held < 49 * before:
        close = cut(_close(cut(_one_each(lists, turn)), nodes, percent))
        links = cut(_confirmed(close.select("a", "b"), sets, percent))
        if links.isEmpty():
            break
        labels = cut(_joined(labels, links))
        turn, before = turn + 1, held
        lists, rows, held = _lists(prefixes, labels)
    pairs = cut(_cross_pairs(lists, percent))
    close = cut(_close(pairs, nodes, percent))
    rows = close.count()
    if not rows:
        return labels
    nearest = [
        close.groupBy(side).agg(F.min(F.struct("bits", other))[other].alias(other)).select("a", "b")
        for side, other in (("a", "b"), ("b", "a"))
    ]
    tried = cut(dealt(nearest[0].union(nearest[1]).distinct(), rows))
    links = cut(_confirmed(tried, sets, percent))
    labels = cut(_joined(labels, links))
    left = labels.toDF("a", "label_a")
    right = labels.toDF("b", "label_b")
    rest = close.select("a", "b").join(tried, ["a", "b"], "left_anti")
    rest = rest.join(left, "a", "left").join(right, "b", "left")
    rest = rest.where(F.coalesce("label_a", "a") != F.coalesce("label_b", "b")).select("a", "b")
    more = cut(_confirmed(cut(dealt(rest, rows)), sets, percent))
    return labels if more.isEmpty() else _joined(labels, more)


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Written: `members`, the rows with n_shingles, set_key and the class_id of their set; `classes` (set_key, id);
    and `nodes`, one row per class with its bands and sketch.

    On return nothing holds the rows' own bands and sketches any longer.
    """
    signatures = cut(batched(docs, _signatures, _SIGNATURE))
    usable = signatures.where("set_key is not null and doc_id is not null")
    classes = cut(usable.groupBy("set_key").agg(F.min("doc_id").alias("id")))
    # One row per class: copies of a row under one doc_id are equal, so distinct takes them away.
    nodes = cut(
        usable.withColumnRenamed("doc_id", "id")
        .join(classes, ["set_key", "id"])
        .dropDuplicates(["set_key", "id"])
        .drop("set_key")
    )
    members = cut(
        signatures.drop("bands", "sketch").join(
            classes.withColumnRenamed("id", "class_id"), "set_key", "left"
        )
    )
    return members, classes, nodes


def _buckets(nodes: DataFrame) -> DataFrame:
    """(key, id, size), written, of the band keys that several nodes have."""
    member = nodes.select("id", F.explode("bands").alias("key"))
    sizes = member.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return cut(member.join(cut(sizes), "key"))


def near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per document.

    `percent` is the threshold: 100 * intersection >= percent * union; the
    bands are laid out for 80 and more. component_id is the smallest doc_id
    reachable over links, kept says that it is the row's own. Null and
    wordless texts have no shingles and are linked with nothing. Rows that
    share a doc_id are one document with several texts, so they get one
    component; rows without a doc_id have no component and are kept. Only
    doc_id and text are read, so further columns may have any name.
    """
    if percent < 80:
        raise ValueError("the bands find pairs of 80 % similarity and more")
    docs = picked(documents, doc_id="long", text="string")
    members, classes, nodes = _classes(docs)
    buckets = _buckets(nodes)
    rows = buckets.count()
    free(documents.sparkSession)
    mass = cut(dealt(buckets.groupBy("id").agg(F.sum("size").alias("mass")), rows))
    # Written without bands and without documents that share no bucket, so that lookups shuffle these only.
    nodes = cut(nodes.drop("bands").join(mass.select("id"), "id"))
    weighed = buckets.join(mass, "id")
    pivots = weighed.groupBy("key").agg(F.max(F.struct("mass", "id"))["id"].alias("pivot"))
    stars = buckets.join(cut(dealt(pivots, rows)), "key").where("id != pivot")
    stars = stars.select(F.col("id").alias("a"), F.col("pivot").alias("b")).distinct()
    close = cut(_close(cut(dealt(stars, rows)), nodes, percent).select("a", "b"))
    free(documents.sparkSession)
    # Whole sets are made once more, only for documents that share a bucket with others.
    wanted = mass.select(F.col("id").alias("doc_id"))
    sets = docs.join(wanted.hint("shuffle_hash"), "doc_id", "left_semi")
    # Copies under one doc_id would multiply its pairs. They lie in one partition, so no second shuffle.
    sets = sets.select("doc_id", "text").distinct()
    sets = cut(batched(sets, _sets, "id long, shingles array<long>"))
    links = cut(_confirmed(close, sets, percent))
    free(documents.sparkSession)

    # Rows of one document with several texts tie their classes together.
    tied = members.where("doc_id is not null and class_id is not null")
    least = tied.groupBy("doc_id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("z"))
    same = tied.join(least.where("a != z"), "doc_id").select("a", F.col("class_id").alias("b"))
    links = links.unionByName(same)

    labels = cut(components(links))
    # The one pair of a bucket of two has been compared above.
    labelled = buckets.where("size > 2").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    split = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"))
    open_keys = cut(dealt(split.where("x != y").select("key"), rows))
    opened = labelled.join(open_keys, "key", "left_semi").select("id").distinct()
    opened = cut(dealt(opened, rows))
    free(documents.sparkSession)
    final = _links_between(sets, nodes, labels, opened, percent)
    free(documents.sparkSession)
    classes = classes.join(final, "id", "left").select(
        "set_key", F.coalesce("label", "id").alias("label")
    )
    # A document's component does not depend on which of its texts is asked.
    out = members.drop("class_id").join(cut(classes), "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
