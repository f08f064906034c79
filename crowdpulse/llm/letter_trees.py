"""K-d trees over letter-count vectors, and exact tests of one edit between words of single bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Places of a vector: one for each letter a to z, the rest for all other letters together.
DIMENSIONS = 32
#: Words in a leaf of a tree that is searched to its end.
LEAF = 32
_PAIR_BYTES = 1 << 24

_BIN = np.array([c - 97 if 97 <= c < 123 else 26 + c % (DIMENSIONS - 26) for c in range(256)], dtype=np.int64)


def codes(words: list[str]) -> np.ndarray:
    """The letters of equally long words, one row each; all are of Latin-1."""
    flat = np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8)
    return flat.reshape(len(words), -1)


def vectors(letters: np.ndarray) -> np.ndarray:
    """How often each letter stands in each row; at most 100, which keeps all differences of one."""
    n = len(letters)
    at = np.arange(n)[:, None] * DIMENSIONS + _BIN[letters]
    counts = np.bincount(at.ravel(), minlength=n * DIMENSIONS).reshape(n, DIMENSIONS)
    return np.minimum(counts, 100).astype(np.int8)


def _signatures(vector: np.ndarray) -> np.ndarray:
    """Two bits a place: once or more, twice or more."""
    bits = np.concatenate([vector >= 1, vector >= 2], axis=1)
    return np.packbits(bits, axis=1).view(np.uint64).ravel()


class LetterTree:
    """A k-d tree of vectors: each inner node splits one place's counts as evenly as can be.

    One inserted letter adds one to one count; a replaced one adds one and takes
    one, or leaves the vector as it is. So a search needs the boxes that lie within so
    many `more` and so many `less` of its vector, which is at most two in L1.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        self.points, self.leaves = points, []
        self.nodes: list[tuple] = []
        self._grow(np.arange(len(points)), leaf)

    def _grow(self, rows: np.ndarray, leaf: int) -> int:
        me = len(self.nodes)
        self.nodes.append(())
        place, most, low = -1, -1, None
        if len(rows) > leaf:
            own = self.points[rows]
            evenness = []
            for most_there in range(max(1, min(3, int(own.max())))):
                below = (own <= most_there).sum(axis=0)
                evenness.append(np.minimum(below, len(rows) - below))
            best = np.array(evenness)
            most, place = divmod(int(best.argmax()), DIMENSIONS)
            if best.max() > 0:
                low = own[:, place] <= most
        if low is None:
            self.nodes[me] = (-1, len(self.leaves), 0, 0)
            self.leaves.append(rows)
        else:
            left = self._grow(rows[low], leaf)
            self.nodes[me] = (place, most, left, self._grow(rows[~low], leaf))
        return me

    def reach(self, queries: np.ndarray, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
        """Each leaf with the queries whose range meets its box."""
        n = len(queries)
        zero = np.zeros(n, dtype=np.int64)
        wide = (np.full(DIMENSIONS, -1), np.full(DIMENSIONS, 1000))
        stack = [(0, np.arange(n), zero, zero, *wide)]
        while stack:
            node, rows, up, down, low, high = stack.pop()
            if not len(rows):
                continue
            place, most, left, right = self.nodes[node]
            if place < 0:
                yield most, rows
                continue
            have = queries[rows, place].astype(np.int64)
            fewer = down + np.maximum(have - most, 0) - np.maximum(have - high[place], 0)
            ok, bound = fewer <= less, high.copy()
            bound[place] = most
            stack.append((left, rows[ok], up[ok], fewer[ok], low, bound))
            extra = up + np.maximum(most + 1 - have, 0) - np.maximum(low[place] - have, 0)
            ok, bound = extra <= more, low.copy()
            bound[place] = most + 1
            stack.append((right, rows[ok], extra[ok], down[ok], bound, high))


class WordTree:
    """Equally long words, searched for those one edit away from others."""

    def __init__(self, words: list[str]):
        self.letters = codes(words)
        points = vectors(self.letters)
        self.signatures = _signatures(points)
        self.tree = LetterTree(points, LEAF)

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(word, point) by index: one letter replaced, or, for words one letter shorter, inserted."""
        letters = codes(words)
        longer = self.letters.shape[1] - letters.shape[1]
        queries = vectors(letters)
        signatures = _signatures(queries)
        asked, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        step = max(1, _PAIR_BYTES // self.letters.shape[1])
        for leaf, rows in self.tree.reach(queries, 1, 1 - longer):
            points = self.tree.leaves[leaf]
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                mine, theirs = signatures[some][:, None], self.signatures[points][None, :]
                fits = np.bitwise_count(theirs & ~mine) <= 1
                fits &= np.bitwise_count(mine & ~theirs) <= 1 - longer
                q, p = np.nonzero(fits)
                q, p = some[q], points[p]
                for start in range(0, len(q), step):
                    a, b = q[start : start + step], p[start : start + step]
                    near = (_inserted if longer else _replaced)(letters[a], self.letters[b])
                    asked.append(a[near])
                    found.append(b[near])
        return np.concatenate(asked), np.concatenate(found)


def _replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def _inserted(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """What both begin with and what both end with is together all of the shorter word."""
    n, width = short.shape
    end = np.ones((n, 1), dtype=bool)
    head = np.concatenate([short != long[:, :width], end], axis=1).argmax(axis=1)
    tail = np.concatenate([(short != long[:, 1:])[:, ::-1], end], axis=1).argmax(axis=1)
    return head + tail >= width
