"""Word shingles of texts as 64-bit hashes, vectorised over the bytes of a block of texts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

WIDTH = 5
BLOCK_BYTES = 1 << 18

_SEED = 0x5EED
_BASE = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(n: int, seed: int) -> np.ndarray:
    """`n` fixed 64-bit numbers."""
    start = np.uint64((seed * 0xD1B54A32D192ED03 + 1) & 0xFFFFFFFFFFFFFFFF)
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _BASE + start)


_BYTE = random_words(256, _SEED)
_PLACE = random_words(WIDTH, _SEED + 1) | np.uint64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            for name, base in (("up", _BASE), ("down", inverse)):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def blocks(texts: Sequence[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(Number of the first text, encoded texts) with about BLOCK_BYTES each; null texts are empty."""
    first, size, held = 0, 0, []
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        if held and size + len(raw) > BLOCK_BYTES:
            yield first, held
            first, size, held = i, 0, []
        held.append(raw)
        size += len(raw)
    if held:
        yield first, held


def word_hashes(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts in order, and the number of words of each text.

    A word is a run of bytes other than space and 0x09 to 0x0D, A to Z lowered.
    """
    data = _LOWER[np.frombuffer(b" ".join([b"", *raws, b""]), dtype=np.uint8)]
    space = _SPACE[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    up, down = _POWERS.upto(len(data))
    sums = np.cumsum(_BYTE[data] * up, dtype=np.uint64)
    words = mix((sums[ends - 1] - sums[starts - 1]) * down[starts])
    offsets = np.cumsum([1 + len(raw) for raw in raws])
    upto = np.searchsorted(starts, offsets, side="left")
    return words, np.diff(upto, prepend=0)


def shingle_sets(texts: Sequence[str | None]) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Five consecutive words make a shingle. Fewer words make one shingle
    together; a text without words has none.
    """
    for _, raws in blocks(texts):
        words, counts = word_hashes(raws)
        n = len(words)
        if n >= WIDTH:
            spans = words[: n - WIDTH + 1] * _PLACE[0]
            for j in range(1, WIDTH):
                spans = spans + words[j : n - WIDTH + 1 + j] * _PLACE[j]
            spans = mix(spans)
        at = 0
        for count in counts.tolist():
            if count >= WIDTH:
                yield np.unique(spans[at : at + count - WIDTH + 1])
            elif count:
                short = words[at : at + count] * _PLACE[:count]
                yield mix(short.sum(dtype=np.uint64, keepdims=True) + np.uint64(count))
            else:
                yield np.empty(0, dtype=np.uint64)
            at += count
