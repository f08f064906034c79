"""Quality scores: random Fourier features of text statistics, ridge scores, isotonic calibration."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.frames import batched, cut, few_rows_read, picked, rows_of

STATISTICS = (
    "log_chars log_words word_mean word_deviation upper_letters upper_words title_words symbols "
    "stops marks digits spaces lines distinct_words adjacent_repeats repeated_pairs repeated_fives "
    "top_word short_words tail_marks repeated_lines byte_entropy wordless_words"
).split()
FEATURES = 256
ROWS_PER_SUM = 50_000
ROWS_AT_ONCE = 1_000
RIDGES = (1e-3, 1e-2, 1e-1, 1.0, 10.0)
FOLDS = (0, 1, 3)  # remainders of crc32(doc_id) mod 4 to learn from; 2 is held out
HELD_OUT = 2
ACCEPT = 0.7
GRID = 1000  # raw scores are calibrated in steps of a thousandth

_LETTERS = np.array([chr(b).isalpha() and b < 128 for b in range(256)])
_UPPER = np.array([b < 128 and chr(b).isupper() for b in range(256)])
_DIGIT = np.array([b < 128 and chr(b).isdigit() for b in range(256)])
_SPACE = np.array([b in b" \t\n\r\x0b\x0c" for b in range(256)])
_SYMBOL = np.array([b in b"#*$%&|<>{}[]\\^~_=+@/" for b in range(256)])


def _repeats(hashes: np.ndarray, width: int) -> float:
    """Share of windows of this many words that are not the first of their kind."""
    n = len(hashes) - width + 1
    if n < 2:
        return 0.0
    mixed = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + n]
    return 1 - len(np.unique(mixed)) / n


def statistics(text: str) -> np.ndarray:
    """One number for each of STATISTICS, of the whole text; zeros for an empty one."""
    out = np.zeros(len(STATISTICS))
    words = text.split()
    if not words:
        out[0] = np.log1p(len(text))
        return out
    data = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    n, total = len(words), int(data.sum())
    letters = max(1, int(data[_LETTERS].sum()))
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=n)
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=n).view(np.uint64)
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line and not line.isspace()]
    shares = data[data > 0] / total
    out[:] = (
        np.log1p(len(text)),
        np.log1p(n),
        min(sizes.mean(), 50.0),
        min(sizes.std(), 50.0),
        data[_UPPER].sum() / letters,
        sum(map(str.isupper, words)) / n,
        sum(map(str.istitle, words)) / n,
        data[_SYMBOL].sum() / total,
        data[ord(".")] / n,
        (data[ord("!")] + data[ord("?")]) / n,
        data[_DIGIT].sum() / total,
        data[_SPACE].sum() / total,
        len(lines) / n,
        len(counts) / n,
        float((hashes[1:] == hashes[:-1]).mean()) if n > 1 else 0.0,
        _repeats(hashes, 2),
        _repeats(hashes, 5),
        max(counts.values()) / n,
        float((sizes <= 3).mean()),
        sum(not word[-1].isalnum() for word in words) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        float(-(shares * np.log(shares)).sum()),
        sum(not any(map(str.isalpha, word)) for word in set(words)) / n,
    )
    return out


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [statistics(text.as_py() or "") for text in batch.column("text")]
        columns = [batch.column("doc_id"), rows_of(values, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "stats"])


@dataclass
class Features:
    """cos(w . z + b) for fixed random w and b, z the standardised statistics, and a constant."""

    mean: np.ndarray
    scale: np.ndarray

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(20_11)
        d = len(self.mean)
        weights = rng.normal(size=(d, FEATURES)) / np.sqrt(d)
        shift = rng.uniform(0, 2 * np.pi, size=FEATURES)
        out = np.ones((len(stats), FEATURES + 1))
        # A few rows at a time: a batch's waves are 20 MB, and each step would hold as much again.
        # Shares of equal size, since the product of a single row is rounded in another way.
        shares = -(-len(stats) // ROWS_AT_ONCE) or 1
        for some, waves in zip(np.array_split(stats, shares), np.array_split(out[:, :-1], shares)):
            z = np.clip((some - self.mean) / self.scale, -5, 5)
            waves[:] = np.sqrt(2 / FEATURES) * np.cos(z @ weights + shift)
        return out


def _stacked(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def _sums(features: Features):
    """Per partition and fold, row by row, the sums of f f', f y and y y."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = FEATURES + 2
        total = {fold: np.zeros((size, size)) for fold in FOLDS}
        for batch in batches:
            if not batch.num_rows:
                continue
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            both = np.hstack([features(_stacked(batch.column("stats"))), label[:, None]])
            for number in FOLDS:
                some = both[fold == number]
                total[number] += some.T @ some
        rows = [(fold, at, total[fold][at]) for fold in FOLDS for at in range(size)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows], pa.int32()),
                rows_of([r[2] for r in rows], pa.float64()),
            ],
            names=["fold", "at", "sums"],
        )

    return sums


def _added(rows):
    total = np.sum(np.stack(rows["sums"].to_list()), axis=0)
    return rows.iloc[:1].assign(sums=[total])


def ridge(sums: np.ndarray, strength: float) -> np.ndarray:
    """Weights that the normal equations give; the constant is not shrunk."""
    size = len(sums) - 1
    shrink = np.full(size, strength)
    shrink[-1] = 1e-9
    return np.linalg.solve(sums[:size, :size] + np.diag(shrink), sums[:size, size])


def squared_error(weights: np.ndarray, sums: np.ndarray) -> float:
    full = np.append(weights, -1.0)
    return float(full @ sums @ full)


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest non-decreasing values, by pooling neighbours that violate the order."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u, x, m = blocks[-1]
            blocks[-1] = [(u * x + v * w) / (x + w), x + w, m + n]
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


@dataclass
class Model:
    features: Features
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def score(self, stats: np.ndarray) -> np.ndarray:
        raw = np.clip(self.features(stats) @ self.weights, -1, 2)
        level = np.interp(raw, self.knots, self.levels)
        # The steps of the calibration keep the order of the raw scores inside them.
        return np.round(np.clip(0.998 * level + 0.002 * (raw + 1) / 3, 0, 1), 6)


def _crc(column: str) -> F.Column:
    return F.crc32(F.col(column).cast("string")) % 4


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """A model of labels.quality from the rows that are not held out.

    All labelled rows take part. What comes to the driver has a fixed size: the
    summed normal equations of the folds, and counts per thousandth of score.
    Labels other than 0 and 1 don't count; a document labelled several times
    counts as good if any label says so. Without labels every score is about
    a half; with one class only, near that class.
    """
    known = picked(labels, doc_id="long", quality="int").where("quality in (0, 1)")
    known = known.groupBy("doc_id").agg(F.max("quality").alias("label"))
    rows = stats.join(known, "doc_id").withColumn("fold", _crc("doc_id").cast("int"))
    rows = cut(rows.where(F.col("fold") != HELD_OUT))
    columns = [F.col("stats")[i] for i in range(len(STATISTICS))]
    moments = rows.agg(
        F.count("*"), *[F.avg(c) for c in columns], *[F.stddev_pop(c) for c in columns]
    ).first()
    d = len(STATISTICS)
    mean = np.array([x or 0.0 for x in moments[1 : d + 1]])
    scale = np.array([x or 0.0 for x in moments[d + 1 :]])
    features = Features(mean, np.where(scale > 1e-9, scale, 1.0))

    parts = max(1, -(-moments[0] // ROWS_PER_SUM))
    schema = "fold int, at int, sums array<double>"
    partial = rows.coalesce(parts).mapInArrow(_sums(features), schema)
    summed = partial.groupBy("fold", "at").applyInPandas(_added, schema).collect()
    size = FEATURES + 2
    by_fold = {fold: np.zeros((size, size)) for fold in FOLDS}
    for row in summed:
        by_fold[row["fold"]][row["at"]] = row["sums"]
    total = sum(by_fold.values())

    def out_of_fold(strength: float) -> float:
        return sum(
            squared_error(ridge(total - by_fold[f], strength), by_fold[f]) for f in FOLDS
        )

    strength = min(RIDGES, key=out_of_fold)
    held = {fold: ridge(total - by_fold[fold], strength) for fold in FOLDS}

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fold = batch.column("fold").to_numpy(zero_copy_only=False)
            waves = features(_stacked(batch.column("stats")))
            score = np.zeros(len(fold))
            for number, weights in held.items():
                score[fold == number] = waves[fold == number] @ weights
            step = np.round(np.clip(score, -1, 2) * GRID).astype(np.int32)
            columns = [pa.array(step), batch.column("label")]
            yield pa.RecordBatch.from_arrays(columns, names=["step", "label"])

    counted = (
        rows.mapInArrow(raw, "step int, label int")
        .groupBy("step")
        .agg(F.count("*").alias("n"), F.sum("label").alias("good"))
        .orderBy("step")
        .collect()
    )
    if not counted:
        return Model(features, ridge(total, strength), np.zeros(1), np.full(1, 0.5))
    n = np.array([r["n"] for r in counted], dtype=float)
    good = np.array([r["good"] for r in counted], dtype=float)
    levels = isotonic(good / n, n)
    knots = np.array([r["step"] for r in counted]) / GRID
    return Model(features, ridge(total, strength), knots, levels)


def quality_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of `documents`, its whole text read.

    held_out tells that crc32(doc_id as text) mod 4 is HELD_OUT; those rows'
    labels are not learnt. score is between 0 and 1, higher for label 1;
    predicted is 1 from ACCEPT on. A null text is scored as an empty one. Rows
    without a doc_id are scored and count as not held out; repeated rows get
    equal scores. Of `documents` only doc_id and text are read.
    """
    docs = picked(documents, doc_id="long", text="string")
    with few_rows_read(documents.sparkSession):
        stats = cut(batched(docs, _statistics, "doc_id long, stats array<double>"))
    model = fit(stats, labels)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            score = model.score(_stacked(batch.column("stats")))
            columns = [batch.column("doc_id"), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score"])

    scored = stats.mapInArrow(scores, "doc_id long, score double")
    return scored.select(
        "doc_id",
        F.coalesce(_crc("doc_id") == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )
