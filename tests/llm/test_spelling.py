from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from crowdpulse.llm.letter_trees import WordTree
from crowdpulse.llm.queries import table
from crowdpulse.llm.spelling import near_words, variants


def _lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def _deletions(word):
    return {word[:i] + word[i + 1 :] for i in range(len(word))}


def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and short in _deletions(long)


def _near_map(words):
    """Words that share themselves or a deletion, tested pair by pair."""
    buckets = {}
    for word in words:
        for key in _deletions(word) | {word}:
            buckets.setdefault(key, set()).add(word)
    near = {word: set() for word in words}
    for group in buckets.values():
        for a in group:
            near[a] |= {b for b in group if a != b and _near(a, b)}
    return near


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = _lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    n = {word: k for word, k in counts.items() if len(word) >= 5 and k >= 3}
    near = _near_map(n)
    form = {}
    for word in n:
        best = min(near[word], key=lambda w: (-n[w], w), default=None)
        form[word] = best if best is not None and n[best] >= 2 * n[word] else None
    out = set()
    for word in n:
        root = word
        while form[root] is not None:
            root = form[root]
        out.add((word, form[word], root, n[word], len(near[word]), n.get(form[word])))
    return out


def _found(frame):
    rows = frame.collect()
    found = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(found) == len(rows)
    return found


def test_variants_equal_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = variants(docs)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert want and _found(found) == want


@pytest.mark.parametrize("cell", [10, 40, 5_000])
def test_many_cells_lose_no_pair(spark, cell):
    """Few letters, so that many words are near, lie at the same vector, or across cells."""
    chance = random.Random(4)
    words = {"".join(chance.choices("abcé×", k=chance.randint(5, 9))) for _ in range(1_500)}
    words |= {"a" * k for k in (5, 6, 7, 150, 151)} | {"a" * 150 + "b"}
    frame = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    near = {(r.word, r.near) for r in near_words(frame, fitted=700, cell=cell).collect()}
    assert near == {(a, b) for a, others in _near_map(words).items() for b in others}


def test_chains_ties_and_odd_rows(spark):
    rows = (
        [(i, "Color colour COLOUR coloor") for i in range(4)]
        + [(i, "colour " * 40) for i in range(3)]
        + [(None, "naïve naive naïve Étude étude"), (None, None), (5, ""), (6, " \n"), (7, "x" * 60_000)] * 3
        + [(8, "tests testa teste " * 3 + "testx " * 8 + "testy " * 8)]
        + [(9, " ".join(f"w{chr(97 + i % 26)}rds" for i in range(20_000)))]
    )
    docs = spark.createDataFrame([(*row, 1, "k") for row in rows], "doc_id long, text string, n int, `word` string")
    assert _found(variants(docs)) == brute(rows)
    assert variants(docs.limit(0)).count() == 0


def test_one_edit_by_letter_order():
    tree = WordTree(["abcde", "abdce", "abcdf", "bbcde"])
    asked, found = tree.near(["abcde"])
    assert set(zip(asked.tolist(), found.tolist())) == {(0, 2), (0, 3)}
    asked, found = tree.near(["abce", "bcde", "edcb"])
    assert set(zip(asked.tolist(), found.tolist())) == {(0, 0), (0, 1), (1, 0), (1, 3)}
