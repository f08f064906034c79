"""Best-fit packing of documents into sequences by bin completion.

Documents become pieces of at most one sequence; blocks of some thousand
sequences are then packed independently, each by branch and bound: the largest
piece left opens a sequence, undominated fillings around it are enumerated, a
branch is cut once its waste leaves no way to beat the incumbent, and the
incumbent at the start is the best-fit decreasing packing. What lies in the
underfilled sequences of all blocks is then packed once more, until it is one block.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.frames import batched, cut, picked
from crowdpulse.llm.tokens import word_tokenizer

LENGTH = 4096
END_ID = 1
# A block holds about so many tokens, and of very short pieces so many.
BLOCK_TOKENS, BLOCK_PIECES = 1 << 22, 1 << 16
# Sequences filled to less than this share are opened again with those of other blocks.
FILLED = 0.97
# Branches tried beyond the first descent, per block; the incumbent stands when they are used up.
BRANCHES = 2_000
FILLINGS, FIRST, SECOND = 6, 24, 8

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = "id long, length long, block long, place long, offset long, filled long"


def _cut_documents(path: str, length: int):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_tokenizer(path).encode
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            rows = []
            texts = (text.as_py() or "" for text in batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encode(texts)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at : at + 4 * length]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = list(zip(*rows)) or [[]] * 5
            arrays = [pa.array(column, type=kind) for column, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return pieces


def best_fit(lengths: list[int], room: int) -> list[list[int]]:
    """Best-fit decreasing: each length goes where the least room is left that holds it."""
    bins: list[list[int]] = []
    spaces: list[tuple[int, int]] = []
    for length in sorted(lengths, reverse=True):
        at = bisect_left(spaces, (length, -1))
        if at < len(spaces):
            space, number = spaces.pop(at)
        else:
            space, number = room, len(bins)
            bins.append([])
        bins[number].append(length)
        insort(spaces, (space - length, number))
    return bins


def _without_waste(counts: dict[int, int], sizes: list[int], space: int, most: int) -> list[tuple]:
    """Up to `most` fillings of two or three lengths that leave nothing."""
    there = np.array(sizes)
    present = np.zeros(space + 1, dtype=bool)
    present[there] = True
    found: list[tuple] = []
    for at in range(len(sizes) - 1, -1, -1):
        a = sizes[at]
        left = space - a
        if 3 * a < space or len(found) >= most:
            break  # the first is the largest of the three
        if left <= a and present[left] and (left < a or counts[a] > 1):
            found.append((a, left))
        # The larger of the other two: at least half of what is left, no more than the first.
        low, high = bisect_left(sizes, -(-left // 2)), bisect_left(sizes, min(a, left - 1) + 1)
        if low < high:
            seconds = there[low:high]
            for b in seconds[present[left - seconds]].tolist()[::-1]:
                filling = (a, b, left - b)
                if all(filling.count(x) <= counts[x] for x in filling):
                    found.append(filling)
                if len(found) >= most:
                    break
    return sorted(found, key=lambda f: (len(f), tuple(-x for x in f)))


def fillings(counts: dict[int, int], sizes: list[int], space: int, most: int) -> list[tuple]:
    """Undominated ways to fill `space` from the lengths left (ascending `sizes`), least waste first.

    A filling is dominated if another one takes, in place of some of its
    lengths together, a single length at least as large: that leaves easier
    lengths for later. So one length that fills the space alone is the only
    filling to try, and among fillings with equal waste fewer, larger lengths
    come first. Fillings without waste of two and three lengths are looked up,
    from the largest first length on, until there are `most`. If there are fewer, up
    to two lengths are tried, FIRST and SECOND of each at most, and what
    remains is filled greedily with the largest lengths that fit.
    """
    top = bisect_left(sizes, space + 1)
    if not top:
        return [()]
    if sizes[top - 1] == space:
        return [(space,)]
    exact = _without_waste(counts, sizes[:top], space, most)
    if len(exact) >= most:
        return exact
    found: dict[tuple, int] = dict.fromkeys(exact, 0)

    def completed(chosen: list[int], left: int) -> None:
        taken = list(chosen)
        at = bisect_left(sizes, left + 1) - 1
        while at >= 0 and left > 0:
            size = sizes[at]
            free = counts[size] - taken.count(size)
            if free > 0 and size <= left:
                taken.append(size)
                left -= size
                at = min(at, bisect_left(sizes, left + 1) - 1)
            else:
                at -= 1
        found.setdefault(tuple(sorted(taken, reverse=True)), left)

    for first in range(top - 1, max(-1, top - 1 - FIRST), -1):
        a = sizes[first]
        left = space - a
        at = min(bisect_left(sizes, left + 1) - 1, first)
        if at < 0:
            completed([a], left)
            continue
        for second in range(at, max(-1, at - SECOND), -1):
            b = sizes[second]
            if b == a and counts[a] < 2:
                continue
            completed([a, b], left - b)
        if min(found.values(), default=1) == 0 and len(found) >= most:
            break
    ranked = sorted(found, key=lambda f: (found[f], len(f), tuple(-x for x in f)))
    kept: list[tuple] = []
    for filling in ranked:
        if not any(_dominates(other, filling) for other in kept):
            kept.append(filling)
        if len(kept) == most:
            break
    return kept or [()]


def _dominates(one: tuple, other: tuple) -> bool:
    """The lengths of `other` can be put into those of `one`, seen as small bins."""
    spaces = sorted(one)
    for length in other:
        at = bisect_left(spaces, length)
        if at == len(spaces):
            return False
        spaces[at] -= length
        spaces.sort()
    return True


def complete_bins(lengths: list[int], room: int, branches: int = BRANCHES) -> list[list[int]]:
    """As few bins of `room` as the search finds; every length is in exactly one bin."""
    incumbent = best_fit(lengths, room)
    total = sum(lengths)
    least = -(-total // room)
    if len(incumbent) == least:
        return incumbent
    counts: dict[int, int] = {}
    for length in lengths:
        counts[length] = counts.get(length, 0) + 1
    sizes = sorted(counts)

    def take(length: int, times: int) -> None:
        had = counts[length]
        counts[length] = had + times
        if had == 0:
            insort(sizes, length)
        elif had + times == 0:
            sizes.pop(bisect_left(sizes, length))

    # Depth first: each level holds the fillings not tried yet and the one now in place.
    path: list[list] = []
    waste, tried = 0, 0
    allowed = (len(incumbent) - 1) * room - total
    while True:
        if not sizes:
            bins = [level[1] for level in path]
            if len(bins) < len(incumbent):
                incumbent = [list(b) for b in bins]
                allowed = (len(incumbent) - 1) * room - total
            if len(incumbent) == least:
                return incumbent
            options = []
        else:
            largest = sizes[-1]
            take(largest, -1)
            options = [
                (largest, *f) for f in fillings(counts, sizes, room - largest, FILLINGS)
            ]
            take(largest, 1)
            options = [o for o in options if waste + room - sum(o) <= allowed]
        path.append([options[::-1], None])
        while path:
            level = path[-1]
            if level[1] is not None:
                for length in level[1]:
                    take(length, 1)
                waste -= room - sum(level[1])
                level[1] = None
            if level[0] and waste + room - sum(level[0][-1]) <= allowed:
                level[1] = level[0].pop()
                for length in level[1]:
                    take(length, -1)
                waste += room - sum(level[1])
                break
            tried += 1
            path.pop()
        if not path or tried > branches:
            return incumbent


def _pack_block(room: int):
    def pack(rows):
        rows = rows.sort_values(["length", "id"], kind="stable")
        rows = rows.reset_index(drop=True)
        where: dict[int, list[int]] = {}
        for at, length in enumerate(rows["length"].tolist()):
            where.setdefault(length, []).append(at)
        place = np.zeros(len(rows), dtype=np.int64)
        offset = np.zeros(len(rows), dtype=np.int64)
        total = np.zeros(len(rows), dtype=np.int64)
        for number, lengths in enumerate(complete_bins(rows["length"].tolist(), room)):
            filled = 0
            for length in lengths:
                at = where[length].pop()
                place[at], offset[at], total[at] = number, filled, sum(lengths)
                filled += length
        return rows.assign(place=place, offset=offset, filled=total)

    return pack


def _packed_rounds(partial: DataFrame, length: int) -> DataFrame:
    """(id, sequence_id, offset) of all pieces (id, length) shorter than a sequence.

    Round by round the pieces are dealt over blocks; after each, what lies in
    sequences that are not FILLED goes on to the next, until there is one block, or
    what is left would not fill half as many (long pieces, of which no two fit).
    """
    done, first = None, 0
    blocks = _blocks(partial)
    while True:
        dealt = partial.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("long"))
        packed = cut(dealt.groupBy("block").applyInPandas(_pack_block(length), _PACKED))
        number = F.lit(first) + F.col("block") * F.lit(1 << 17) + F.col("place")
        again = F.col("filled") < FILLED * length
        partial, first = packed.where(again), first + blocks * (1 << 17)
        fewer = _blocks(partial) if blocks > 1 else 0
        last = 2 * fewer > blocks or blocks == 1
        kept = packed if last else packed.where(~again)
        kept = kept.select("id", number.alias("sequence_id"), "offset")
        done = kept if done is None else done.unionByName(kept)
        if last:
            return done
        partial, blocks = partial.select("id", "length"), fewer


def _blocks(pieces: DataFrame) -> int:
    size = pieces.agg(F.count("*").alias("pieces"), F.sum("length").alias("tokens")).first()
    return max(1, round((size.tokens or 0) / BLOCK_TOKENS), round(size.pieces / BLOCK_PIECES))


def pack(documents: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Every row of `documents` (columns doc_id and text; others don't take part)
    becomes its token ids and END_ID; a null or empty text is END_ID alone.
    Rows longer than `length` are cut into pieces of `length` and a rest.
    Repeated rows, and rows with a null doc_id, are packed each for itself.
    Sequence ids name round, block and place; offsets are gapless from 0.

    Pieces are dealt over blocks of about BLOCK_TOKENS by a number given to the
    written rows, so blocks are equally large also where rows are equal, and
    the blocks' underfilled sequences are packed together in further rounds. Full
    pieces need no partner and skip the search.
    """
    docs = picked(documents, doc_id="long", text="string")
    pieces = cut(batched(docs, _cut_documents(tokenizer, length), _PIECES))
    pieces = pieces.withColumn("id", F.monotonically_increasing_id())
    partial = pieces.where(F.col("length") < length)
    placed = _packed_rounds(partial.select("id", "length"), length)
    packed = partial.join(placed, "id")
    # Full pieces get negative numbers, which no block uses.
    full = pieces.where(F.col("length") >= length).select(
        "*", (-1 - F.col("id")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
