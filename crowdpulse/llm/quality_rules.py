"""Quality rules by hashed n-grams, in Spark's own functions only.

Words and pairs of neighbouring words are hashed into BUCKETS. Two multinomials
are counted: over a trusted target and over the whole raw corpus. A document's
verdict is the mean, over all its n-grams, of the log ratio of the two: text
unlike the target has n-grams that the corpus holds more often than the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.frames import cut

BUCKETS = 1 << 16
# Added to every bucket's count: an n-gram of a few documents says little about the target.
SMOOTH = 10.0
THRESHOLD = -0.15
LEAST_WORDS = 10
REPEAT_PERCENT = 20
WIDTH = 5

_SPLIT = r"[ \t-\r]+"


def words_of(text: Column) -> Column:
    """Runs of characters other than space and 0x09 to 0x0D; none of a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), _SPLIT), lambda word: word != "")


def _given(value: Column, use) -> Column:
    """`use(value)` with `value` worked out once, however often a lambda inside names it."""
    return F.transform(F.array(value), use)[0]


def _bucket(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(BUCKETS)).cast("int")


def _places(last: Column) -> Column:
    """0 to `last`, nothing if that is negative."""
    empty = F.array().cast("array<int>")
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(empty)


def _windows(words: Column) -> Column:
    """A hash for each WIDTH neighbouring words."""

    def hashed(hashes: Column) -> Column:
        places = _places(F.size(hashes) - WIDTH)
        return F.transform(places, lambda i: F.xxhash64(*[hashes[i + j] for j in range(WIDTH)]))

    return _given(F.transform(words, lambda word: F.xxhash64(word)), hashed)


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of WIDTH words found at least twice in the text."""

    def covered(places: Column) -> Column:
        steps = F.transform(
            places,
            lambda at, i: F.when(
                i + 1 < F.size(places), F.least(F.lit(WIDTH), F.get(places, i + 1) - at)
            ).otherwise(F.lit(WIDTH)),
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda total, n: total + n)

    def marked(pairs: Column) -> Column:
        again = F.filter(
            pairs,
            lambda pair, i: (F.get(pairs, i - 1)["h"].eqNullSafe(pair["h"]))
            | (F.get(pairs, i + 1)["h"].eqNullSafe(pair["h"])),
        )
        return _given(F.sort_array(F.transform(again, lambda pair: pair["at"])), covered)

    def counted(windows: Column) -> Column:
        pairs = F.transform(windows, lambda h, at: F.struct(h.alias("h"), at.alias("at")))
        differ = F.size(F.array_distinct(windows)) == F.size(windows)
        return F.when(differ, F.lit(0).cast("long")).otherwise(
            _given(F.sort_array(pairs), marked)
        )

    return _given(_windows(words), counted)


def _grams(texts: DataFrame, *keep: str) -> DataFrame:
    """A row with its bucket (from 0) for each word, and for each pair of neighbours."""
    words = texts.select(*keep, words_of(F.col("text")).alias("words"))
    # Each word with the one after it, null at the end; joined by codegen, unlike lambdas.
    follower = F.slice("words", F.lit(2), F.size("words"))
    both = F.arrays_zip(F.col("words").alias("word"), follower.alias("next"))
    word, after = F.col("both.word"), F.col("both.next")
    pair = F.when(after.isNotNull(), _bucket(word, after))
    split = words.select(*keep, F.explode(both).alias("both"))
    grams = split.select(*keep, F.explode(F.array(_bucket(word), pair)).alias("bucket"))
    return grams.where("bucket is not null")


def ratio_table(documents: DataFrame, trusted: DataFrame) -> DataFrame:
    """(bucket, ratio): log ratio of target to corpus, both smoothed, in millionths.

    Whole numbers add up to the same sum in any order. The table has BUCKETS
    rows whatever the corpus; a corpus or target without words gives 0
    throughout.
    """
    ids = trusted.select(F.col("doc_id").cast("long")).where("doc_id is not null").distinct()
    ids = ids.select("doc_id", F.lit(1).cast("long").alias("found"))
    # Joined by hash: sorting would carry whole texts.
    texts = documents.join(ids.hint("shuffle_hash"), "doc_id", "left")
    texts = texts.select("text", F.coalesce("found", F.lit(0)).alias("aim"))
    counted = _grams(texts, "aim").groupBy("bucket")
    counted = counted.agg(F.count("*").alias("raw"), F.sum("aim").alias("aim"))
    spine = documents.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    both = cut(spine.join(counted, "bucket", "left").na.fill(0))
    both = both.select(
        "*",
        both.agg(F.sum("raw")).scalar().alias("raw_total"),
        both.agg(F.sum("aim")).scalar().alias("aim_total"),
    )

    # The corpus' count at the target's size, so both multinomials are smoothed alike.
    expected = F.col("raw") * F.col("aim_total") / F.col("raw_total")
    ratio = F.when(
        (F.col("raw_total") > 0) & (F.col("aim_total") > 0),
        F.log((F.col("aim") + SMOOTH) / (expected + SMOOTH)),
    ).otherwise(F.lit(0.0))
    return both.select("bucket", F.round(ratio * 1_000_000).cast("long").alias("ratio"))


def rules(documents: DataFrame, trusted: DataFrame) -> DataFrame:
    """Per row of `documents` the counts of the base rules, the verdict and what comes of both.

    n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words are of the
    whole text; base_failed tells of too few words or too many in repeated
    windows; log_ratio is the verdict's mean, kept is false if the base failed
    or the mean lies below THRESHOLD. `trusted` holds the doc_id of the documents
    that make the target; if it is empty, every text passes the verdict. A
    null text has no words and fails.
    Rows without a doc_id, and repeated rows, are judged like others. Only
    doc_id and text are read.
    """
    docs = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # Rows of equal id and text have one verdict, and their n-grams' mean is that of one row.
    docs = docs.withColumn("text_hash", F.xxhash64("text"))
    # The table has a fixed number of rows, so it may be broadcast.
    table = F.broadcast(ratio_table(docs, trusted))
    grams = _grams(docs, "doc_id", "text_hash").join(table, "bucket")
    verdicts = grams.groupBy("doc_id", "text_hash").agg(
        (F.sum("ratio") / F.count("*") / 1_000_000).alias("log_ratio")
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.regexp_like(line, F.lit("[^ \t-\r]")))
    repeats = _given(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))

    def judged(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda n, w: n + F.length(w)).alias(
                "word_chars"
            ),
            symbols.cast("long").alias("n_symbols"),
            repeats.cast("long").alias("n_dup_lines"),
            repeated_words(words).alias("n_repeat_words"),
        )

    counted = docs.select(
        "doc_id", "text_hash", _given(words_of(F.col("text")), judged).alias("counts")
    )
    same = counted["doc_id"].eqNullSafe(verdicts["doc_id"]) & (
        counted["text_hash"] == verdicts["text_hash"]
    )
    counted = counted.join(verdicts, same, "left").select(
        counted["doc_id"], "counts.*", F.coalesce("log_ratio", F.lit(0.0)).alias("log_ratio")
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT
    )
    return counted.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("log_ratio") >= THRESHOLD)
    )
