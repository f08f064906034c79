"""Byte-level pair encoding by an index from each pair to all its places.

Texts are cut into words as the library cuts them. The words not seen before of
many texts are laid into one array of symbols, with a barrier after each. An
index maps every pair that can be merged to all its places there, and the
active ranks are applied in ascending order, each to all its places at once.
A merge changes the pairs on both its sides, whose places are entered into
their lists; places that an earlier merge has used up are told by their
symbols and passed over. That gives what merging word by word gives, because a
pair always ranks behind the merges that make its two parts, which is checked
when a vocabulary is read.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from crowdpulse.llm.frames import picked, rows_of

# White space as the pattern below sees it (Unicode's White_Space).
_SPACE = "\t-\r \x85\xa0  -     　"
# Numbers that are not decimal digits, among the characters of _FAMILIAR.
_NUMBERS = "".join(chr(i) for i in range(0x250) if unicodedata.category(chr(i)) in ("No", "Nl"))
# The words of a text of familiar characters, as the byte-level pattern has them; letters come first
# because they are most frequent, and no other kind of word begins as they do.
_WORD = re.compile(
    rf" ?[^\W\d_{_NUMBERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[\d{_NUMBERS}]+| ?(?:[^{_SPACE}\w]|_)+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
# Texts with other characters, whose kind may differ between versions of Unicode, are cut by the library.
_UNFAMILIAR = re.compile("[^\0-\u024f\u2010-\u2027\u20ac]")
#: Words whose ids are kept from batch to batch; twice as many for a while.
KEPT_WORDS = 400_000
#: Longer words hardly come again.
LONG = 64
#: Symbols that are indexed together, about.
INDEXED = 1 << 19
_GROUP_CHARS = 1 << 22
_SHIFT = 20


def _byte_letters() -> dict[str, int]:
    """The character that stands for each byte in the file: itself if visible, else one from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


class BytePairCodec:
    """Encodes and decodes as the library does with a byte-level vocabulary file.

    It covers files with the byte-level pattern, no normalisation, no prefix
    space, and special strings that are taken as they stand; others are
    refused. Special strings in a text get their own ids, as in the library.
    """

    def __init__(self, path: str):
        from tokenizers import pre_tokenizers

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        odd = ("unk_token", "dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if (
            model["type"] != "BPE"
            or spec["normalizer"]
            or spec["post_processor"]
            or before.get("type") != "ByteLevel"
            or before.get("add_prefix_space")
            or not before.get("use_regex", True)
            or any(model.get(name) for name in odd)
            or any(t[flag] for t in spec["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized"))
        ):
            raise ValueError("a byte-level vocabulary without normalisation or prefix space is needed")
        self.cutter = pre_tokenizers.ByteLevel(add_prefix_space=False)
        self.letters = _byte_letters()
        vocabulary = model["vocab"]
        self.bytes_of = {i: self._bytes(piece) for piece, i in vocabulary.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of.update({i: text.encode() for text, i in self.special.items()})
        longest_first = sorted(self.special, key=len, reverse=True)
        self.specials = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.special else None
        self._read_merges(vocabulary, model["merges"])
        self.older: dict[str, str] = {}
        self.kept = {text: f",{i}" for text, i in self.special.items()}

    def _bytes(self, piece: str) -> bytes:
        return bytes([self.letters[c] for c in piece])

    def _read_merges(self, vocabulary: dict[str, int], merges: list) -> None:
        self.first = np.array([vocabulary[c] for c, _ in sorted(self.letters.items(), key=lambda x: x[1])])
        self.barrier, self.dead = 1 << _SHIFT - 1, (1 << _SHIFT) - 1
        made_at: dict[int, int] = {}
        self.merges: list[tuple[int, int, int]] = []
        self.rank: dict[int, int] = {}
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, new = vocabulary[left], vocabulary[right], vocabulary[left + right]
            made_at.setdefault(new, rank)
            self.merges.append((a, b, new))
            self.rank.setdefault(a << _SHIFT | b, rank)
        for rank, (a, b, _) in enumerate(self.merges):
            if max(made_at.get(a, -1), made_at.get(b, -1)) >= rank:
                raise ValueError("a pair ranks before a merge that makes its part")
        if len(self.rank) != len(self.merges) or max(vocabulary.values()) >= self.barrier:
            raise ValueError("each pair needs one rank, and ids must be small")
        pairs = np.fromiter(self.rank, dtype=np.int64, count=len(self.rank))
        order = np.argsort(pairs)
        self.pairs_sorted = pairs[order]
        self.ranks_sorted = np.fromiter(self.rank.values(), dtype=np.int64, count=len(pairs))[order]

    # --- words -----------------------------------------------------------

    def words(self, text: str) -> list[str]:
        """The words of a text without special strings; merges never cross their ends."""
        if not _UNFAMILIAR.search(text):
            return _WORD.findall(text)
        return [self._bytes(word).decode() for word, _ in self.cutter.pre_tokenize_str(text)]

    def _words_and_specials(self, text: str) -> list[str]:
        if not self.specials or not any(special in text for special in self.special):
            return self.words(text)
        out: list[str] = []
        for part in self.specials.split(text):
            out += [part] if part in self.special else self.words(part)
        return out

    # --- merging ---------------------------------------------------------

    def _places(self, symbols: np.ndarray) -> dict[int, list[int]]:
        """For each rank all places where its pair begins, ascending."""
        if not len(self.merges):
            return {}
        pairs = symbols[:-1] << _SHIFT | symbols[1:]
        at = np.searchsorted(self.pairs_sorted, pairs)
        at[at == len(self.pairs_sorted)] = 0
        places = np.flatnonzero(self.pairs_sorted[at] == pairs)
        ranks = self.ranks_sorted[at[places]]
        order = np.argsort(ranks, kind="stable")
        ranks, places = ranks[order], places[order]
        cuts = np.flatnonzero(np.diff(ranks)) + 1
        heads = ranks[np.concatenate(([0], cuts))].tolist() if len(ranks) else []
        return dict(zip(heads, [part.tolist() for part in np.split(places, cuts)]))

    def merge_all(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word, all words merged together rank by rank."""
        if not words:
            return []
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        barriers = np.cumsum(sizes + 1) - 1
        symbols = np.full(int(barriers[-1]) + 1, self.barrier, dtype=np.int64)
        inside = np.ones(len(symbols), dtype=bool)
        inside[barriers] = False
        symbols[inside] = self.first[np.frombuffer(b"".join(words), dtype=np.uint8)]

        where = self._places(symbols)
        active = list(where)
        heapq.heapify(active)
        n, dead, rank_of = len(symbols), self.dead, self.rank.get
        symbol = symbols.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while active:
            rank = heapq.heappop(active)
            left, right, new = self.merges[rank]
            places = where.pop(rank)
            if left == right:
                places.sort()  # of overlapping places the leftmost is merged
            for at in places:
                if symbol[at] != left:
                    continue
                gone = after[at]
                if symbol[gone] != right:
                    continue
                symbol[at], symbol[gone] = new, dead
                follower, leader = after[gone], before[at]
                after[at], before[follower] = follower, at
                if leader >= 0:
                    found = rank_of(symbol[leader] << _SHIFT | new)
                    if found is not None:
                        if found in where:
                            where[found].append(leader)
                        else:
                            where[found] = [leader]
                            heapq.heappush(active, found)
                found = rank_of(new << _SHIFT | symbol[follower])
                if found is not None:
                    if found in where:
                        where[found].append(at)
                    else:
                        where[found] = [at]
                        heapq.heappush(active, found)
        merged = np.array(symbol, dtype=np.int64)
        merged = merged[merged != dead]
        ends = np.flatnonzero(merged == self.barrier)
        starts = np.concatenate(([0], ends[:-1] + 1))
        return [merged[a:b] for a, b in zip(starts.tolist(), ends.tolist())]

    def _learn(self, words: set[str]) -> None:
        """Keeps the ids of these words, as text, after decoding them."""
        block: list[str] = []
        size = 0
        for word in words:
            block.append(word)
            size += len(word) + 1
            if size > INDEXED:
                self.kept.update(self._ids_as_text(block))
                block, size = [], 0
        self.kept.update(self._ids_as_text(block))

    def _ids_as_text(self, words: list[str]) -> Iterator[tuple[str, str]]:
        pieces, data = self.bytes_of, [word.encode() for word in words]
        for word, want, found in zip(words, data, self.merge_all(data)):
            found = found.tolist()
            if b"".join([pieces[i] for i in found]) != want:
                raise ValueError(f"decoding does not give {word!r} back")
            yield word, "".join([f",{i}" for i in found])

    # --- texts -----------------------------------------------------------

    def as_text(self, texts: Iterable[str]) -> Iterator[str]:
        """Per text its ids in decimal, a comma before each."""
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > _GROUP_CHARS:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[str]:
        rows = [self._words_and_specials(text) for text in texts]
        for text, words in zip(texts, rows):
            if "".join(words) != text:
                raise ValueError("the words of a text are not the whole text")
        if len(self.kept) > KEPT_WORDS:
            self.older, self.kept = self.kept, {text: f",{i}" for text, i in self.special.items()}
        fresh = set().union(*rows).difference(self.kept)
        again = {word: self.older[word] for word in fresh if word in self.older}
        self.kept.update(again)
        fresh.difference_update(again)
        self._learn(fresh)
        kept = self.kept.__getitem__
        for words in rows:
            yield "".join(map(kept, words))
        for word in fresh:
            if len(word) > LONG:
                del self.kept[word]

    def encode(self, text: str) -> list[int]:
        """The ids of a text; an empty one has none."""
        found = next(self.as_text([text]))
        return [int(i) for i in found[1:].split(",")] if found else []

    def decode(self, ids: Iterable[int]) -> str:
        """The text of any ids; bytes that are no character become replacement characters."""
        return b"".join([self.bytes_of.get(i, b"") for i in ids]).decode("utf-8", "replace")


_OPEN: dict[str, BytePairCodec] = {}


def byte_pair_codec(path: str) -> BytePairCodec:
    """One per Python worker, so that its words are kept from task to task."""
    if path not in _OPEN:
        _OPEN[path] = BytePairCodec(path)
    return _OPEN[path]


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    return (text.as_py() or "" for text in batch.column("text"))


def encode(documents: DataFrame, path: str) -> DataFrame:
    """Per row doc_id and the ids of its whole text, as the library gives them.

    A null text is empty; an empty one has no ids. Rows are read one by one, so
    repeated rows repeat their result and an empty table gives an empty one.
    Only doc_id and text take part.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_pair_codec(path)
        for batch in batches:
            ids = [np.array(row[1:].split(",") if row else [], dtype=np.int32) for row in codec.as_text(_texts(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows_of(ids, pa.int32())], names=["doc_id", "ids"])

    return picked(documents, doc_id="long", text="string").mapInArrow(encoded, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Per row doc_id and the text of its ids; null ids give an empty text."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_pair_codec(path)
        for batch in batches:
            texts = [codec.decode(ids.as_py() or ()) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return picked(encoded, doc_id="long", ids="array<int>").mapInArrow(decoded, "doc_id long, text string")


def digests(documents: DataFrame, path: str) -> DataFrame:
    """Per row the number of ids of its whole text, and digests of the ids and of the decoded text.

    ids_sha256 is of the decimal ids joined by commas. What each word decodes
    to is checked when the word is first met; a text's decoded words are
    joined. Rows of nulls, empty texts, repeats and other columns are as in
    `encode`.
    """

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_pair_codec(path)
        for batch in batches:
            counts, ids, decoded = [], [], []
            for found, text in zip(codec.as_text(_texts(batch)), _texts(batch)):
                counts.append(found.count(","))
                ids.append(sha256(found[1:].encode()).hexdigest())
                decoded.append(sha256(text.encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts, pa.int64()),
                    pa.array(ids, pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return picked(documents, doc_id="long", text="string").mapInArrow(digested, schema)
