"""Token ids of whole texts by the `tokenizers` library, one distinct word at a time.

A tokenizer whose pre-tokenizer drops white space gives a text the ids of its
white-space separated words in order. So each distinct word is encoded once
and kept; a text's ids are joined from what is kept.
"""

from __future__ import annotations

import os
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np

_UNSPLIT = ("\x1c", "\x1d", "\x1e", "\x1f")  # white space for Python, not for the tokenizer
# Punctuation that ends a word: a letter or digit before it always ends a piece there.
_TAIL = re.compile(r"(?<=[^\W_])[.,!?;:*$%&#|]+(?=\s|$)")
# Texts with no other punctuation have white space, if anything else, before such a run.
_OTHER = re.compile(r"[^\w\s.,!?;:*$%&#|]|_")
_PLAIN_TAIL = re.compile(r"[.,!?;:*$%&#|]+(?=\s|$)")
KEPT_WORDS = 600_000
_GROUP_CHARS = 1 << 19
_BATCH = 500


class WordTokenizer:
    """Ids as little-endian unsigned 32-bit bytes.

    Between texts it keeps the ids of up to KEPT_WORDS words; then it starts
    anew and encodes again what comes, but for words it has just looked up.
    """

    def __init__(self, path: str):
        # Spark runs a task per core; threads below it would only compete.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.kept: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _learn(self, fresh: set[str]) -> None:
        letters = [word for word in fresh if word.isalpha()]
        for at in range(0, len(letters), _BATCH):
            # A run of letters is one piece, and its last id says that a word ends.
            some = letters[at : at + _BATCH]
            data = self.whole([" ".join(some)])[0]
            ids = np.frombuffer(data, dtype="<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):
                self.kept.update(zip(some, self.whole(some)))
                continue
            low = 0
            for word, high in zip(some, (cuts * 4).tolist()):
                self.kept[word] = data[low:high]
                low = high
        others = [word for word in fresh if word not in self.kept]
        self.kept.update(zip(others, self.whole(others)))

    @staticmethod
    def _words(text: str) -> list[str]:
        # Lowering is the tokenizer's own next step, unless it would first compose
        # characters or lower a letter by its place in the word.
        if unicodedata.is_normalized("NFC", text) and "\u03a3" not in text:
            text = text.lower()
        tail = _TAIL if _OTHER.search(text) else _PLAIN_TAIL
        return tail.sub(r" \g<0>", text).split()

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, without special ones."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > _GROUP_CHARS:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        odd = [any(mark in text for mark in _UNSPLIT) for text in texts]
        words = [[] if alone else self._words(text) for text, alone in zip(texts, odd)]
        # One look for each word; what is not kept stays empty until it is learnt.
        get, nothing = self.kept.get, repeat(b"")
        found = [list(map(get, parts, nothing)) for parts in words]
        gaps = [_empty(ids) for ids in found]
        fresh = {parts[at] for parts, places in zip(words, gaps) for at in places}
        fresh = fresh.difference(self.kept)
        if len(self.kept) + len(fresh) > KEPT_WORDS:
            self.kept, fresh = {}, {parts[at] for parts, places in zip(words, gaps) for at in places}
        self._learn(fresh)
        for text, alone, parts, ids, places in zip(texts, odd, words, found, gaps):
            for at in places:
                ids[at] = self.kept[parts[at]]
            yield self.whole([text])[0] if alone else b"".join(ids)


def _empty(ids: list[bytes]) -> list[int]:
    """Where nothing stands."""
    places, at = [], -1
    try:
        while True:
            at = ids.index(b"", at + 1)
            places.append(at)
    except ValueError:
        return places


_OPEN: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so that its words are kept from task to task."""
    if path not in _OPEN:
        _OPEN[path] = WordTokenizer(path)
    return _OPEN[path]
