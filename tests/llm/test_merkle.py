from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest

from crowdpulse.llm.merkle import Block, manifest, versions
from crowdpulse.llm.queries import table


def _hash(parts):
    return sha256("".join(parts).encode()).hexdigest()


def _leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return _hash("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def _found(row):
    marked = zlib.crc32(b"" if row["doc_id"] is None else str(row["doc_id"]).encode()) % 2 == 0
    return row["text"].replace("\n", "") if marked and row["text"] is not None else row["text"]


def _climb(nodes, proofs):
    """The root of `nodes`, each (digest, indices below it); appends to the proofs of those below."""
    while len(nodes) > 1:
        level = []
        for i in range(0, len(nodes), 3):
            run = nodes[i : i + 3]
            for at, (_, below) in enumerate(run):
                for k in below:
                    proofs[k].append(([d for d, _ in run[:at]], [d for d, _ in run[at + 1 :]]))
            level.append((_hash(d for d, _ in run), [k for _, below in run for k in below]))
        nodes = level
    return nodes[0]


def brute(rows):
    rows = sorted(
        rows,
        key=lambda r: (
            r["source"] is not None,
            (r["source"] or "").encode(),
            r["doc_id"] is not None,
            r["doc_id"] or 0,
            _leaf(r, r["text"]),
            _leaf(r, _found(r)),
        ),
    )
    proofs, trees, subroot_of = [[] for _ in rows], {}, {}
    for k, row in enumerate(rows):
        trees.setdefault(row["source"], []).append((_leaf(row, row["text"]), [k]))
    subroots = []
    for source, leaves in trees.items():
        top = _climb(leaves, proofs)
        subroot_of[source] = top[0]
        subroots.append(top)
    root = _climb(subroots, proofs)[0] if subroots else None
    out = []
    for k, row in enumerate(rows):
        node = _leaf(row, _found(row))
        for before, after in proofs[k]:
            node = _hash([*before, node, *after])
        proof = _hash(d for before, after in proofs[k] for d in [*before, *after])
        out.append(
            (row["doc_id"], _leaf(row, row["text"]), subroot_of[row["source"]], root, proof, node, node == root)
        )
    return out


def _key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def _same(found, rows):
    assert sorted(map(tuple, found.collect()), key=_key) == sorted(brute(rows), key=_key)


def test_manifest_equals_brute_force(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = manifest(docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    _same(found, [r.asDict() for r in docs.collect()])
    assert {r.verified for r in found.collect()} == {True, False}


def test_odd_rows(spark):
    rows = [
        (1, "a", "en", 3, "a\nb", 0),
        (1, "a", "en", 3, "a\nb", 1),
        (1, "a", "en", 4, "a\nc", 1),
        (None, "a", None, None, "x\n", 1),
        (None, None, None, None, None, 1),
        (7, None, "de", 1, "", 1),
        (8, "", "de", 1, "é\n" * 50_000, 1),
        (9, "=", "de", 1, "z", 1),
        (10, "é", "de", 1, "z\n", 1),
        (11, "z", "de", 1, "z\n", 1),
    ]
    schema = "doc_id long, source string, lang string, n_chars long, text string, grp int"
    docs = spark.createDataFrame(rows, schema).withColumnsRenamed({"grp": "node"})
    _same(manifest(docs), [r.asDict() for r in docs.collect()])
    assert manifest(docs.limit(0)).count() == 0
    one = docs.where("doc_id = 9")
    _same(manifest(one), [r.asDict() for r in one.collect()])
    (row,) = manifest(one).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == _hash([])


def test_trees_of_many_blocks(spark):
    """Blocks of nine leaves, a source that holds most rows, and many sources: several rounds each."""
    rows = [(i, "hot" if i % 3 else f"s{i}", "en", i, f"t{i}\n", ) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")

    def last_marked(text):
        from pyspark.sql import functions as F

        return F.when(F.expr("crc32(cast(cast(doc_id as string) as binary)) % 2 = 0"), F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)

    found = versions(docs, last_marked, height=2).collect()
    want = {r[0]: r for r in brute([r.asDict() for r in docs.collect()])}
    assert len(found) == len(want)
    for row in found:
        _, leaf, subroot, root, proof, folded, _ = want[row.doc_id]
        assert (row.leaf, row.subroot, row.root) == (leaf, subroot, root)
        assert (_hash(row.siblings), row.copied[-1]) == (proof, folded)


@pytest.mark.parametrize("size", [1, 2, 3, 4, 9, 10, 27])
def test_versions_share_all_other_nodes(size):
    leaves = [_hash([str(i)]) for i in range(size)]
    block = Block(leaves, True, 3, 3)
    for _ in range(20):
        at, new = random.Random(size).randrange(size), _hash(["new"])
        fresh = Block([*leaves[:at], new, *leaves[at + 1 :]], True, 3, 3)
        copied = block.version(at, new)
        assert copied == [level[at // 3 ** (k + 1)] for k, level in enumerate(fresh.levels[1:])]
        for k, level in enumerate(fresh.levels[1:]):
            others = [i for i in range(len(level)) if i != at // 3 ** (k + 1)]
            assert [level[i] for i in others] == [block.levels[k + 1][i] for i in others]
