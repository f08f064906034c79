"""Spelling variants: words one edit apart, found by k-d trees over their letter counts.

Words are counted over all documents. Their letter-count vectors are dealt out
to cells, the leaves of one k-d tree per word length, and every word is sent as
a question to the cells of its own length and of the next that its range
meets. A cell builds its own tree, prunes its boxes, and tests the order of
letters of what is left. Each pair of near words is thus met in one place for each direction.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.frames import cut, picked
from crowdpulse.llm.letter_trees import LetterTree, WordTree, codes, vectors

#: Shortest word, and least number of occurrences.
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A form is at least so many times as frequent as its variant.
TIMES = 2
#: One (document, word) in so many loses a letter.
ONE_IN = 97
#: Words from which the cells are fitted, about, chosen by hash; every word is indexed.
FITTED = 50_000
#: Words in a cell, about.
CELL = 16_000
_HELD = 300_000
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_POINT, _SAME, _SHORTER = 0, 1, 2


def _words_of(doc_id: int | None, text: str) -> Iterator[tuple[str, int]]:
    """The words of one text after its deletions, with their numbers."""
    seed = zlib.crc32(b":" if doc_id is None else f"{doc_id}:".encode())
    # Lowering bytes of UTF-8 changes A to Z only.
    for run, n in Counter(_RUN.findall(text.encode().lower().decode())).items():
        h = zlib.crc32(run.encode(), seed)
        if h % ONE_IN == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_LETTERS:
            yield run, n


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n) of all words with LEAST_LETTERS letters that occur LEAST_COUNT times.

    Each task sums what it reads, so a word of every text is one row a task.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            columns = [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                for word, n in _words_of(doc_id.as_py(), text.as_py() or ""):
                    held[word] += n
                if len(held) > _HELD:
                    yield out()
                    held.clear()
        yield out()

    rows = picked(documents, doc_id="long", text="string").mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


class Cells:
    """For each word length the cells of a k-d tree fitted to a sample of all words."""

    def __init__(self, sample: list[str], cell: int):
        by_length: dict[int, list[str]] = {}
        for word in sample:
            by_length.setdefault(len(word), []).append(word)
        self.trees = {n: LetterTree(vectors(codes(words)), cell) for n, words in by_length.items()}

    def reached(self, words: list[str], more: int, less: int) -> tuple[np.ndarray, np.ndarray]:
        """(index, cell) of equally long words; without `more` and `less` the cell that holds each."""
        length = len(words[0]) + more - less
        if length not in self.trees:
            return np.arange(len(words)), np.full(len(words), length << 32)
        index, cells = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for leaf, rows in self.trees[length].reach(vectors(codes(words)), more, less):
            index.append(rows)
            cells.append(np.full(len(rows), length << 32 | leaf))
        return np.concatenate(index), np.concatenate(cells)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield rows, [words[i] for i in rows]


def _dealt(words: DataFrame, cells: Cells) -> DataFrame:
    """Each word as a point of one cell and as a question to the cells in its range."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, own in _by_length(batch.column("word").to_pylist()):
                for kind, more, less in ((_POINT, 0, 0), (_SAME, 1, 1), (_SHORTER, 1, 0)):
                    index, cell = cells.reached(own, more, less)
                    taken = batch.take(pa.array(rows[index]))
                    kinds = pa.array(np.full(len(index), kind, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell, pa.int64()), kinds, taken.column("word"), taken.column("n")],
                        names=["cell", "kind", "word", "n"],
                    )

    return words.mapInArrow(deal, "cell long, kind int, word string, n long")


_PAIRS = "word string, n long, near string, near_n long"


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of near words from rows in order of (cell, kind): a cell's points come first.

    A cell's points are held; its questions pass by in batches.
    """
    cell, tree, points, counts = None, None, [], []
    for batch in batches:
        where, kinds = batch.column("cell").to_numpy(), batch.column("kind").to_numpy()
        turns = np.flatnonzero((np.diff(where) != 0) | (np.diff(kinds) != 0)) + 1
        bounds = [0, *turns.tolist(), len(where)]
        for low, high in zip(bounds, bounds[1:]):
            if low == high:
                continue
            part = batch.slice(low, high - low)
            words, n = part.column("word").to_pylist(), part.column("n").to_numpy()
            if where[low] != cell:
                cell, tree, points, counts = where[low], None, [], []
            if kinds[low] == _POINT:
                points += words
                counts.append(n)
                continue
            if not points:
                continue
            if tree is None:
                tree, counts = WordTree(points), [np.concatenate(counts)]
            asked, found = tree.near(words)
            for a, b in [(asked, found)] if len(asked) else []:
                ours = [words[i] for i in a], n[a]
                theirs = [points[i] for i in b], counts[0][b]
                yield _pairs(*ours, *theirs)
                if kinds[low] == _SHORTER:
                    yield _pairs(*theirs, *ours)


def _pairs(words: list[str], n: np.ndarray, near: list[str], near_n: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(words, pa.string()), pa.array(n), pa.array(near, pa.string()), pa.array(near_n)]
    return pa.RecordBatch.from_arrays(columns, names=["word", "n", "near", "near_n"])


def near_words(words: DataFrame, fitted: int = FITTED, cell: int = CELL) -> DataFrame:
    """(word, n, near, near_n) of distinct words one inserted, deleted or replaced letter apart, both ways.

    Words are of Latin-1 letters, each once. The cells are fitted to about
    `fitted` words chosen by their hash, the only rows that come to the driver;
    they decide how even the cells are, never what is found.
    """
    total = words.count()
    chosen = F.pmod(F.xxhash64("word"), F.lit(max(1, total))) < fitted
    sample = [row.word for row in words.where(chosen).select("word").collect()]
    cells = Cells(sample, max(8, cell * len(sample) // max(1, total)))
    partitions = 1 + 2 * total // cell
    dealt = _dealt(words, cells).repartition(partitions, "cell").sortWithinPartitions("cell", "kind")
    return dealt.mapInArrow(_answered, _PAIRS)


def _rooted(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to their end; the steps double each round, forms being more frequent."""
    links = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = cut(links.join(onward, "root", "left"))
        links = further.select("word", F.coalesce("next", "root").alias("root"))
        if further.where("next IS NOT NULL").isEmpty():
            return links


def variants(documents: DataFrame, fitted: int = FITTED, cell: int = CELL) -> DataFrame:
    """One row per word of the documents: word, form, root, n, n_near, form_n.

    Words are runs of letters, lowered from A to Z only, after deletions by a hash of
    (doc_id, run); they have LEAST_LETTERS letters and LEAST_COUNT occurrences.
    The form is the near word of largest n (ties: first in code-point order) if
    it has TIMES as many; the root is the last of a chain of forms. Null texts
    have no words, a null doc_id is written as nothing, repeated rows count
    again, and an empty table gives no row. Only doc_id and text take part.
    """
    words = cut(word_counts(documents))
    near = near_words(words, fitted, cell)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    grouped = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = F.when(-F.col("best.less") >= TIMES * F.col("n"), F.col("best.near"))
    judged = cut(
        words.join(grouped, "word", "left")
        .withColumn("form", formed)
        .select(
            "word",
            "form",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("form").isNotNull(), -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _rooted(judged.where("form IS NOT NULL"))
    rooted = judged.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
