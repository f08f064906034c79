"""A Merkle manifest of documents, with a persistent version of the tree per tampered leaf.

Every document is a leaf; per source the leaves, in order, are joined in runs of
ARITY, level by level, to the source's subroot, and the subroots likewise to
the root. A tree is stored in blocks of ARITY ** HEIGHT consecutive leaves,
aligned so that every run of HEIGHT levels lies inside one block. The blocks
are built by one task each; their top nodes are the leaves of the next
blocks, and so on, so no task holds a whole tree however large a source is.

A tampered leaf makes a version of its tree: only the nodes above the leaf are
copied, all others are shared with the original. Inside the leaf's block the
copies are made from the block's nodes, above it along the block's path, which
the next blocks have given.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.frames import cut, numbered, picked

#: Nodes that are joined to one.
ARITY = 3
#: Levels in a block: at most 2,187 leaves, some 300 KB.
HEIGHT = 7

_STEP = "array<struct<before:string,after:string>>"


def leaf_hash(*fields: Column) -> Column:
    """Hex SHA-256 of the fields in order: `-` for null, else the number of UTF-8 bytes, `:`, the value."""

    def part(field: Column) -> Column:
        text = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(part, fields)).cast("binary"), 256)


def _join(run: list[str]) -> str:
    return sha256("".join(run).encode()).hexdigest()


class Block:
    """The nodes of one block, by level from its leaves to its top node."""

    def __init__(self, leaves: list[str], alone: bool, arity: int, height: int):
        """`alone`: the whole tree is this block, and ends at one node; else all levels are made."""
        self.arity, self.levels = arity, [leaves]
        while len(self.levels[-1]) > 1 if alone else len(self.levels) <= height:
            below = self.levels[-1]
            self.levels.append([_join(below[i : i + arity]) for i in range(0, len(below), arity)])

    @property
    def top(self) -> str:
        return self.levels[-1][0]

    def path(self, at: int) -> list[tuple[str, str]]:
        """Per level below the top, the leaf's side of it: the run's nodes before and after, as text."""
        out = []
        for level in self.levels[:-1]:
            start = at - at % self.arity
            out.append(("".join(level[start:at]), "".join(level[at + 1 : start + self.arity])))
            at //= self.arity
        return out

    def version(self, at: int, leaf: str) -> list[str]:
        """The nodes copied for another leaf at this place, from its parent to the top; the rest is shared."""
        copied, node = [], leaf
        for level in self.levels[:-1]:
            start = at - at % self.arity
            run = level[start : start + self.arity]
            run[at - start] = node
            node = _join(run)
            copied.append(node)
            at //= self.arity
        return copied


def _block_of(nodes: DataFrame, leaves: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"at div {leaves}"))


def _of_group(table: pa.Table, arity: int, height: int) -> tuple[Block, list[int]]:
    """The block of one group's rows, and their order in it."""
    at = table.column("at").to_pylist()
    order = sorted(range(len(at)), key=at.__getitem__)
    nodes = [table.column("node")[i].as_py().hex() for i in order]
    alone = table.column("n")[0].as_py() <= arity**height
    return Block(nodes, alone, arity, height), order


def _tops(nodes: DataFrame, arity: int, height: int) -> DataFrame:
    """The top node of each block, numbered as the leaves of the next blocks."""

    def top(key: tuple, table: pa.Table) -> pa.Table:
        block, _ = _of_group(table, arity, height)
        n = -(-table.column("n")[0].as_py() // arity**height)
        values = [key[0].as_py(), key[1].as_py(), n, bytes.fromhex(block.top)]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
        return pa.table([pa.array([v], kind) for v, kind in zip(values, kinds)], names=["grp", "at", "n", "node"])

    blocks = nodes.select("grp", "block", "at", "n", "node").groupBy("grp", "block")
    return cut(blocks.applyInArrow(top, "grp string, at long, n long, node binary"))


def climb(nodes: DataFrame, arity: int = ARITY, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """Of numbered nodes (group, at, n, node): each one's path up its tree, and each tree's root.

    Returns (group, at, path) and (group, root). One round per HEIGHT levels,
    until every tree has ended; each round's nodes are 2,187 times fewer.
    """
    leaves = arity**height

    def paths(key: tuple, table: pa.Table, above: pa.Table) -> pa.Table:
        block, order = _of_group(table, arity, height)
        rest = above.column("path")[0].as_py() if above.num_rows else []
        at = [table.column("at")[i].as_py() for i in order]
        own = [[{"before": b, "after": a} for b, a in block.path(i)] + rest for i in range(len(at))]
        group = pa.array([key[0].as_py()] * len(at), pa.string())
        return pa.table([group, pa.array(at, pa.int64()), pa.array(own, _PATH)], names=["grp", "at", "path"])

    blocks = _block_of(nodes.select("grp", "at", "n", "node"), leaves)
    upper = _tops(blocks, arity, height)
    ended = upper.where("n = 1").select("grp", F.lower(F.hex("node")).alias("root"))
    going = upper.where("n > 1")
    if going.isEmpty():
        above, roots = nodes.sparkSession.createDataFrame([], f"grp string, at long, path {_STEP}"), ended
    else:
        above, more = climb(going, arity, height)
        roots = ended.unionByName(more)
    above = above.withColumnRenamed("at", "block")
    found = blocks.groupBy("grp", "block").cogroup(above.groupBy("grp", "block"))
    return found.applyInArrow(paths, f"grp string, at long, path {_STEP}"), roots


_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
_VERSION = "doc_id long, leaf string, new_leaf string, siblings array<string>, copied array<string>"


def versions(
    documents: DataFrame, tampered: Callable[[Column], Column], arity: int = ARITY, height: int = HEIGHT
) -> DataFrame:
    """One row per document: its leaf, its proof, and the version of the tree that its tampered text makes.

    `tampered` gives a row's text as it is found later (the same where nothing
    changed). Columns: doc_id, leaf, new_leaf, siblings (the path's other nodes
    up to the root, one string a level and side, joined where there are two),
    copied (the version's own nodes from the leaf's parent to its root),
    subroot, root, source.

    Leaves ascend by doc_id, null first, then by leaf and new leaf, so repeated
    rows are leaves beside each other. A null source is a source of its own,
    before all others. A lone leaf is its subroot, a lone subroot the root. An
    empty table gives no row. Only doc_id, source, lang, n_chars and text take
    part, whatever other columns there are.
    """
    leaves = arity**height
    rows = picked(documents, doc_id="long", source="string", lang="string", n_chars="long", text="string")
    fields = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    # Groups are never null, and sort as the sources' UTF-8 bytes do, null first.
    group = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    hashed = rows.select(
        group.alias("grp"),
        "doc_id",
        F.unhex(leaf_hash(*fields, F.col("text"))).alias("node"),
        F.unhex(leaf_hash(*fields, tampered(F.col("text")))).alias("new"),
    )
    # Dealing out by ranges reads its input twice; texts are read and hashed once.
    order = [F.col("doc_id").asc_nulls_first(), F.col("node"), F.col("new")]
    leaf_rows = _block_of(cut(numbered(cut(hashed), "grp", order)), leaves)

    block_paths, subroots = climb(_tops(leaf_rows, arity, height), arity, height)
    subroots = cut(subroots)
    sources = numbered(
        subroots.select(F.lit("").alias("grp"), F.col("grp").alias("source"), F.unhex("root").alias("node")),
        "grp",
        [F.col("source")],
    )
    sources = cut(sources)
    source_paths, root = climb(sources, arity, height)
    above_source = (
        sources.join(source_paths, ["grp", "at"])
        .join(F.broadcast(root), "grp")  # one row: the subroots are one group
        .select(
            F.col("source").alias("grp"), F.lower(F.hex("node")).alias("subroot"), "root", F.col("path").alias("rest")
        )
    )
    above = cut(
        block_paths.join(above_source, "grp").select(
            "grp", F.col("at").alias("block"), F.concat("path", "rest").alias("path"), "subroot", "root"
        )
    )

    def follow(key: tuple, table: pa.Table, upper: pa.Table) -> pa.Table:
        block, order = _of_group(table, arity, height)
        steps = [(step["before"], step["after"]) for step in upper.column("path")[0].as_py()]
        taken = table.take(order)
        new_leaves = [value.as_py().hex() for value in taken.column("new")]
        siblings, copied = [], []
        for at, new in enumerate(new_leaves):
            siblings.append([side for step in [*block.path(at), *steps] for side in step if side])
            nodes = block.version(at, new)
            node = nodes[-1] if nodes else new
            for before, after in steps:
                node = _join([before, node, after])
                nodes.append(node)
            copied.append(nodes)
        n, texts = len(new_leaves), pa.list_(pa.string())
        return pa.table(
            [
                pa.array([key[0].as_py()] * n, pa.string()),
                taken.column("doc_id"),
                pa.array(block.levels[0], pa.string()),
                pa.array(new_leaves, pa.string()),
                pa.array(siblings, texts),
                pa.array(copied, texts),
                pa.array([upper.column("subroot")[0].as_py()] * n, pa.string()),
                pa.array([upper.column("root")[0].as_py()] * n, pa.string()),
            ],
            names=["grp", "doc_id", "leaf", "new_leaf", "siblings", "copied", "subroot", "root"],
        )

    pairs = leaf_rows.groupBy("grp", "block").cogroup(above.groupBy("grp", "block"))
    found = pairs.applyInArrow(follow, f"grp string, {_VERSION}, subroot string, root string")
    source = F.when(F.col("grp") != "", F.expr("substr(grp, 2)"))
    return found.withColumn("source", source).drop("grp")


def without_line_ends(text: Column, doc_id: Column) -> Column:
    """The text as tampered with: without its line ends where 2 divides the CRC-32 of the decimal doc_id."""
    chosen = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 2 == 0
    return F.when(chosen, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def manifest(documents: DataFrame) -> DataFrame:
    """The manifest of the documents, checked against their texts as tampered with by `without_line_ends`.

    Per row doc_id, leaf, subroot, root, proof_sha256 (of all siblings from the
    leaf to the root), folded_root (of the version that the text found makes)
    and verified (it is the manifest's root). A doc_id of null counts as an
    empty text for its CRC. Other odd rows are as in `versions`.
    """
    found = versions(documents, lambda text: without_line_ends(text, F.col("doc_id")))
    folded = F.coalesce(F.try_element_at("copied", F.lit(-1)), F.col("new_leaf"))
    proof = F.sha2(F.array_join("siblings", "").cast("binary"), 256)
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof.alias("proof_sha256"),
        folded.alias("folded_root"),
        (folded == F.col("root")).alias("verified"),
    )
