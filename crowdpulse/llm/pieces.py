"""Byte-pair pieces of a sentencepiece model, by backtracking over Aho-Corasick matches.

The library merges, again and again, the two neighbours whose join has the
best score. A list of pieces is its result exactly if every piece is its own
result and no two neighbours would have been merged otherwise. So pieces are
laid from left to right, longest match first; a piece is accepted if the pair
with its left neighbour is compatible, which is found by merging the two
pieces' text again; where no match is accepted the last piece is taken back,
and a bit field keeps the positions from which nothing leads on.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterable, Iterator

SPACE = "▁"
_NORMAL, _UNKNOWN, _USER_DEFINED, _BYTE = 1, 2, 4, 6
KEPT_WORDS = 450_000
_WORD, _TAIL = re.compile(r"\w"), ".,!?;:*$%&#|"
KEPT_PAIRS = 1_000_000
# Longer stretches hardly come again.
LONG = 64


class PieceCodec:
    """Encodes and decodes as the library does with a byte-pair model.

    It covers models with byte fallback, no normalisation other than spaces as
    SPACE and one SPACE before the text, and no user-defined pieces; others
    are refused.
    """

    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        norm, kinds = model.normalizer_spec, {piece.type for piece in model.pieces}
        if (
            model.trainer_spec.model_type != 2
            or not model.trainer_spec.byte_fallback
            or model.trainer_spec.treat_whitespace_as_suffix
            or norm.precompiled_charsmap
            or norm.remove_extra_whitespaces
            or not (norm.add_dummy_prefix and norm.escape_whitespaces)
            or _USER_DEFINED in kinds
        ):
            raise ValueError("a byte-pair model with byte fallback and no normalisation is needed")
        self.text = [piece.piece for piece in model.pieces]
        self.score = [piece.score for piece in model.pieces]
        self.id = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.byte = {}
        for i, piece in enumerate(model.pieces):
            if piece.type == _BYTE:
                self.byte[int(piece.piece[3:5], 16)] = i
        self.byte_of = {i: value for value, i in self.byte.items()}
        self.control = {i for i, p in enumerate(model.pieces) if p.type == 3}
        self.unknown = {i for i, p in enumerate(model.pieces) if p.type == _UNKNOWN}
        self.unknown_surface = model.trainer_spec.unk_surface
        # Equal scores are merged by place, which pairs of pieces don't tell.
        often = Counter(self.score[i] for i in self.id.values())
        tied = [p for p, i in self.id.items() if often[self.score[i]] > 1]
        if any(piece.strip(SPACE) for piece in tied):
            raise ValueError("pieces other than spaces share a score")
        # Only pieces that merging their own text gives back can be a result.
        self.matches = ahocorasick.Automaton()
        for piece, i in self.id.items():
            if self.merge(piece) == [i]:
                self.matches.add_word(piece, i)
        self.matches.make_automaton()
        self.single = {piece for piece in self.id if len(piece) == 1}
        # Of each piece the longest shorter one that it begins with.
        self.size = [len(text) for text in self.text]
        self.shorter = [-1] * len(self.text)
        for piece, i in self.id.items():
            heads = (piece[:n] for n in range(len(piece) - 1, 0, -1))
            self.shorter[i] = next((self.id[h] for h in heads if h in self.matches), -1)
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, str] = {}
        self.cut = re.compile(self._boundaries())

    def _boundaries(self) -> str:
        """A pattern of the stretches of a text that no piece crosses.

        A stretch ends before a SPACE that follows another character if no
        piece has one inside, around characters that no piece holds, and between a
        letter or digit and punctuation that follows none in any piece.
        """
        if any(SPACE in piece.lstrip(SPACE) for piece in self.id):
            return r"(?s).+"
        alone = "".join(re.escape(c) for c in "\n\t" if not any(c in p for p in self.id))
        stretch = rf"{SPACE}+[^{SPACE}{alone}]*|[^{SPACE}{alone}]+"
        if alone:
            stretch += f"|[{alone}]"
        inside = {p[at] for p in self.id for at in range(1, len(p)) if _WORD.match(p[at - 1])}
        tail = "".join(re.escape(c) for c in _TAIL if c not in inside)
        return rf"{SPACE}*\w+(?=[{tail}])|{stretch}" if tail else stretch

    def merge(self, text: str) -> list[int]:
        """The pieces that merging gives: best score first, leftmost among equals."""
        parts: list[str | None] = list(text)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(left: int, right: int) -> None:
            joined = parts[left] + parts[right]
            if joined in self.id:
                heapq.heappush(queue, (-self.score[self.id[joined]], left, joined))

        for at in range(n - 1):
            offer(at, at + 1)
        while queue:
            _, left, joined = heapq.heappop(queue)
            if parts[left] is None or after[left] >= n:
                continue
            right = after[left]
            if parts[left] + parts[right] != joined:
                continue
            parts[left], parts[right] = joined, None
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
                offer(left, after[right])
            if before[left] >= 0:
                offer(before[left], left)
        out: list[int] = []
        for part in parts:
            if part is not None:
                known = self.id.get(part)
                out += [known] if known is not None else self._bytes(part)
        return out

    def _bytes(self, text: str) -> list[int]:
        return [self.byte[b] for b in text.encode("utf-8", "surrogatepass")]

    def compatible(self, left: int, right: int) -> bool:
        """Merging the text of both gives the same two pieces."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) > KEPT_PAIRS:
                self.pairs.clear()
            known = self.merge(self.text[left] + self.text[right]) == [left, right]
            self.pairs[key] = known
        return known

    def backtrack(self, text: str) -> list[int]:
        """The pieces of a stretch of characters that are all pieces themselves."""
        n, size, shorter = len(text), self.size, self.shorter
        # Matches come by their end, so the longest from each position is the last to stay.
        longest = {end + 1 - size[i]: i for end, i in self.matches.iter(text)}
        pairs, compatible = self.pairs, self.compatible
        dead = 0  # bit p: nothing leads from position p to the end
        out: list[int] = []
        at, last, piece = 0, -1, longest[0]
        while at < n:
            while piece >= 0:
                end = at + size[piece]
                if not (dead and dead >> end & 1):
                    if last < 0:
                        break
                    fits = pairs.get(last << 32 | piece)
                    if fits or fits is None and compatible(last, piece):
                        break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                at, last = end, piece
                if at < n:
                    piece = longest[at]
            else:
                dead |= 1 << at
                piece = out.pop()
                at -= size[piece]
                last = out[-1] if out else -1
                piece = shorter[piece]
        return out

    def _stretch(self, text: str) -> list[int]:
        if SPACE * 2 in text:
            return self.merge(text)
        if self.single.issuperset(text):
            return self.backtrack(text)
        out: list[int] = []
        run = 0
        for at, c in enumerate(text):
            if c not in self.single:
                if run < at:
                    out += self.backtrack(text[run:at])
                out += self._bytes(c)
                run = at + 1
        if run < len(text):
            out += self.backtrack(text[run:])
        return out

    def _with_tail(self, stretch: str) -> list[int]:
        """As `_stretch`; a word already known and its punctuation are joined if the pair fits."""
        stem = stretch.rstrip(".,")
        known = self.words.get(stem) if stem and len(stem) < len(stretch) else None
        if known and SPACE * 2 not in stretch:
            left = [int(i) for i in known[1:].split(",")]
            right = self._stretch(stretch[len(stem) :])
            if {left[-1], right[0]}.isdisjoint(self.byte_of) and self.compatible(left[-1], right[0]):
                return left + right
        return self._stretch(stretch)

    def _learn(self, stretches: set[str]) -> None:
        """Keeps the ids of these stretches as text, after decoding them."""
        for stretch in stretches:
            ids = self._with_tail(stretch)
            if self.join(ids) != stretch.replace(SPACE, " "):
                raise ValueError(f"decoding does not give {stretch!r} back")
            self.words[stretch] = "".join([f",{i}" for i in ids])

    def encode(self, text: str) -> list[int]:
        """The ids of a text; an empty one has none."""
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        return [i for stretch in self.cut.findall(text) for i in self._stretch(stretch)]

    def join(self, ids: Iterable[int]) -> str:
        """The text of pieces inside a text: spaces are kept, bytes are read as UTF-8."""
        out: list[str] = []
        held = bytearray()
        for i in [*ids, None]:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(_lenient(bytes(held)))
                held.clear()
            if i in self.unknown:
                out.append(self.unknown_surface)
            elif i is not None and i not in self.control:
                out.append(self.text[i].replace(SPACE, " "))
        return "".join(out)

    def decode(self, ids: Iterable[int]) -> str:
        """The text of a whole list of ids: one leading space is the library's own."""
        return self.join(ids).removeprefix(" ")

    def digests(self, texts: Iterable[str]) -> Iterator[tuple[int, str, str]]:
        """Per text the number of ids, the ids in decimal joined by commas, and the decoded text.

        Stretches come again and again, so what each one gives is kept. Every
        stretch decodes to its own text, and pieces of bytes never reach over
        its ends, so the parts decoded make up the whole.
        """
        for text in texts:
            if not text:
                yield 0, "", ""
                continue
            stretches = self.cut.findall(SPACE + text.replace(" ", SPACE))
            if len(self.words) > KEPT_WORDS:
                self.words.clear()
            fresh = set(stretches).difference(self.words)
            if fresh:
                self._learn(fresh)
            ids = "".join(map(self.words.__getitem__, stretches))
            for stretch in fresh:
                if len(stretch) > LONG:
                    del self.words[stretch]
            decoded = "".join(stretches).replace(SPACE, " ").removeprefix(" ")
            yield ids.count(","), ids[1:], decoded


def _lenient(data: bytes) -> str:
    """UTF-8 with one replacement character for each byte that belongs to no character."""
    out, at = [], 0
    while at < len(data):
        for width in (1, 2, 3, 4):
            try:
                out.append(data[at : at + width].decode("utf-8"))
            except UnicodeDecodeError:
                continue
            at += width
            break
        else:
            out.append("�")
            at += 1
    return "".join(out)


_OPEN: dict[str, PieceCodec] = {}


def piece_codec(path: str) -> PieceCodec:
    """One per Python worker, so that its words are kept from task to task."""
    if path not in _OPEN:
        _OPEN[path] = PieceCodec(path)
    return _OPEN[path]
