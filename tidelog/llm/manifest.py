"""Merkle manifests of datasets with a witness for every row, grown by appends.

Leaves of a group stand in order; every FANOUT neighbours make a node of the next level, until one node, the group's
subroot, remains. A witness of a leaf is, level by level, its place in its run and the digests of the run's others.

A block of BLOCK leaves is aligned with the tree, so one task makes it alone: leaves are appended one by one to the open
run of the lowest level; a run that is full closes, which extends the partial witnesses of all leaves below it and appends
its digest to the run above. The roots of blocks are then appended in the same way, as leaves of a tree of their own, and
so on up; the witness of a block's root extends those of the block's leaves. No task holds more than a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.text import ascii_lower
from tidelog.operators.ordered import ordered_scan
from tidelog.session import store

FANOUT = 8
LEVELS = 3  # of a block
BLOCK = FANOUT**LEVELS
STEPS = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.string()))]))
PATH = "array<struct<place: int, siblings: array<string>>>"

Step = tuple[int, list[str]]


def sealed(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


class OpenTree:
    """A hash tree under append. What is open: one run of fewer than FANOUT nodes on each level, with the leaves below each
    node, whose witnesses go as far as their subtree is closed."""

    def __init__(self) -> None:
        self.runs: list[list[tuple[str, list[list[Step]]]]] = []

    def append(self, digest: str) -> list[Step]:
        """Add a leaf; its witness is the list returned, which grows as runs above it close."""
        witness: list[Step] = []
        self._add(0, digest, [witness])
        return witness

    def _add(self, level: int, digest: str, below: list[list[Step]]) -> None:
        if level == len(self.runs):
            self.runs.append([])
        self.runs[level].append((digest, below))
        if len(self.runs[level]) == FANOUT:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        digests = [digest for digest, _ in run]
        for place, (_, below) in enumerate(run):
            step = (place, digests[:place] + digests[place + 1:])  # one for all leaves below
            for witness in below:
                witness.append(step)
        self._add(level + 1, sealed(digests), [witness for _, below in run for witness in below])

    def finish(self, levels: int) -> str:
        """Close what is open, up to `levels` levels, or until one node remains if levels is 0; the root."""
        level = 0
        while level < levels or any(self.runs[level + 1:]) or len(self.runs[level]) > 1:
            if self.runs[level]:
                self._close(level)
            level += 1
        return self.runs[level][0][0]


def block_tree(block: int, digests: list[str]) -> tuple[str, list[list[Step]]]:
    """Root and witnesses of a block. The first block may be a group's only one, so it ends at its first single node (if it
    is full, that is the block's height); later ones have the height of a full block."""
    tree = OpenTree()
    witnesses = [tree.append(digest) for digest in digests]
    return tree.finish(LEVELS if block else 0), witnesses


def _block(nodes: DataFrame) -> Column:
    return F.floor(nodes["pos"] / BLOCK).cast("long")


def block_roots(nodes: DataFrame) -> DataFrame:
    """(grp, pos, digest) of the blocks of nodes (grp, pos, digest), pos being the block's number."""
    kind = nodes.schema["grp"].dataType.simpleString()

    def task(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("pos")
        root, _ = block_tree(key[1].as_py(), table["digest"].to_pylist())
        return pa.table({"grp": table["grp"].slice(0, 1), "pos": pa.array([key[1].as_py()], pa.int64()), "digest": pa.array([root])})

    return nodes.select("grp", "pos", "digest", _block(nodes).alias("block")).groupBy("grp", "block").applyInArrow(task, f"grp {kind}, pos long, digest string")


def grow(levels: list[DataFrame], fresh: DataFrame) -> list[DataFrame]:
    """The stored levels (grp, pos, digest) of a forest after an append of leaves (grp, pos, digest); [] is the empty forest.

    pos goes on from what the group has. Only blocks that the append reaches are made again on each level: all but a group's
    last block are closed for good, and their roots are read, not computed. Levels end where every group has one node.
    """
    out: list[DataFrame] = []
    while True:
        if len(out) < len(levels):
            replaced = fresh.select(F.col("grp").alias("_grp"), F.col("pos").alias("_pos"))
            old = levels[len(out)]
            old = old.join(replaced, old["grp"].eqNullSafe(F.col("_grp")) & (old["pos"] == F.col("_pos")), "left_anti")
            nodes = store(old.unionByName(fresh.select("grp", "pos", "digest")), "nodes")
        else:
            nodes = store(fresh.select("grp", "pos", "digest"), "nodes")
        out.append(nodes)
        if not (nodes.agg(F.max("pos")).first()[0] or 0):
            return out
        if len(out) - 1 < len(levels):
            reached = fresh.select(F.col("grp").alias("_grp"), _block(fresh).alias("_block")).distinct()
            nodes = nodes.join(reached, nodes["grp"].eqNullSafe(F.col("_grp")) & (_block(nodes) == F.col("_block")), "left_semi")
        fresh = store(block_roots(nodes), "roots")


def _extended(rows: DataFrame, above: DataFrame, extra: list[str]) -> DataFrame:
    """rows (grp, pos, digest, *extra) with `path`: each row's witness in its block, then the path that above (grp, pos,
    path, subroot, root) has for the block's root; subroot and root with it."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    named = ["grp", "pos", "digest", *extra]
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in named) + f", path {PATH}, subroot string, root string"

    def task(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.sort_by("pos")
        upper = right.to_pylist()[0] if right.num_rows else None
        paths = []
        if left.num_rows:
            higher = [(s["place"], s["siblings"]) for s in upper["path"]]
            _, witnesses = block_tree(key[1].as_py(), left["digest"].to_pylist())
            paths = [[{"place": p, "siblings": s} for p, s in (*w, *higher)] for w in witnesses]
        told = [pa.array([upper[c] if upper else None] * len(paths), pa.string()) for c in ("subroot", "root")]
        return pa.Table.from_arrays([*[left[c] for c in named], pa.array(paths, STEPS), *told], [*named, "path", "subroot", "root"])

    blocks = rows.select(*named, _block(rows).alias("block")).groupBy("grp", "block")
    return blocks.cogroup(above.select("grp", F.col("pos").alias("block"), "path", "subroot", "root").groupBy("grp", "block")).applyInArrow(task, schema)


def witnessed(levels: list[DataFrame], leaves: DataFrame, top: DataFrame) -> DataFrame:
    """leaves (grp, pos, digest and more) with path, subroot and root, by the levels of their forest and what top (grp, path,
    root) says of each group's subroot. Each level's nodes meet the witness of their block's root, from the top down."""
    head = levels[-1].withColumnRenamed("digest", "subroot")
    groups = top.select(F.col("grp").alias("_grp"), "path", "root")
    above = store(head.join(groups, head["grp"].eqNullSafe(F.col("_grp"))).select("grp", F.lit(0).cast("long").alias("pos"), "path", "subroot", "root"), "witnesses")
    for nodes in levels[-2:0:-1]:
        above = store(_extended(nodes, above, []), "witnesses")
    extra = [c for c in leaves.columns if c not in ("grp", "pos", "digest")]
    if len(levels) > 1:
        return _extended(leaves, above, extra)
    tips = above.select(F.col("grp").alias("_grp"), "path", "subroot", "root")  # groups of one leaf each
    return leaves.join(tips, leaves["grp"].eqNullSafe(F.col("_grp"))).drop("_grp")


def joined_roots(levels: list[DataFrame]) -> DataFrame:
    """(grp, path, root) of each group: the tree over the groups' subroots, in the order of the groups, null first."""
    subroots = levels[-1].select(F.lit(0).alias("grp"), F.col("grp").alias("group"), "digest")
    numbered = store(ordered_scan(subroots, [], ["group"], number="pos"), "subroots")
    forest = grow([], numbered.select("grp", "pos", "digest"))
    one = forest[-1].select("grp", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    return store(witnessed(forest, numbered, one).select(F.col("group").alias("grp"), "path", "root"), "groups")


def folded(digest: Column, path: Column) -> Column:
    """The root that a leaf's digest and its witness lead to."""
    def step(below: Column, s: Column) -> Column:
        run = F.concat(F.slice(s["siblings"], F.lit(1), s["place"]), F.array(below), F.slice(s["siblings"], s["place"] + 1, F.lit(FANOUT)))
        return F.sha2(F.array_join(run, ""), 256)

    return F.aggregate(path, digest, step)


def siblings(path: Column) -> Column:
    """The digests of a witness in one text, from the leaf's run up, left to right."""
    return F.array_join(F.flatten(F.transform(path, lambda s: s["siblings"])), "")


def row_digest(columns: list[Column]) -> Column:
    """A row's digest: of each value its length in bytes, a colon and the value, or a hyphen for null."""
    def field(c: Column) -> Column:
        c = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-"))

    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


class Manifest:
    """Leaves of documents in groups by lang, in the order of doc_id, and the levels of their forest; all stored tables.

    append() takes further documents, which must come after those there are in the order of their group.
    """

    def __init__(self) -> None:
        self.leaves: DataFrame | None = None
        self.levels: list[DataFrame] = []

    def append(self, docs: DataFrame, altered: Callable[[Column, Column], Column] | None = None) -> "Manifest":
        """Hash each row once, number the leaves by a scan that brings no group to one task, and grow the forest. altered:
        a text from (doc_id, text) whose digest is kept beside the leaf's, to be tried against the witnesses later."""
        digest = row_digest([F.col(c) for c in FIELDS])
        other = digest
        if altered is not None:
            text = altered(F.col("doc_id"), F.col("text"))
            other = F.when(text.eqNullSafe(F.col("text")), digest).otherwise(row_digest([*[F.col(c) for c in FIELDS[:-1]], text]))
        rows = store(docs.select(F.col("lang").alias("grp"), "doc_id", digest.alias("digest"), other.alias("tried")), "leaves")
        starts = None
        if self.leaves is not None:
            starts = self.leaves.groupBy("grp").agg(F.count("*").alias("start"))
        fresh = store(ordered_scan(rows, ["grp"], ["doc_id", "digest"], number="pos", starts=starts), "leaves")
        self.leaves = fresh if self.leaves is None else store(self.leaves.unionByName(fresh), "leaves")
        self.levels = grow(self.levels, fresh)
        return self

    def witnesses(self) -> DataFrame:
        """(grp, pos, digest, doc_id, tried, path, subroot, root) of every leaf: path leads over the subroot to the root."""
        return witnessed(self.levels, self.leaves, joined_roots(self.levels))


def tampered(doc_id: Column, text: Column) -> Column:
    """A text as a tamperer leaves it: A-Z lower-cased where 3 divides the CRC-32 of the decimal doc_id; null stays null."""
    hit = F.crc32(doc_id.cast("string")) % 3 == 0
    return F.when(hit & text.isNotNull(), ascii_lower(text)).otherwise(text)


def proofs(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, tried, path) of every document, tried being the digest of the tampered row.

    Nulls hash as hyphens; documents without lang are a group, the first one; those without doc_id stand first in their group
    and are not tampered with. Rows of one id stand in the order of their digests; equal rows are leaves like others. A lone
    leaf is its group's subroot, a lone subroot the root. No documents give no rows. Other columns are not read.
    """
    found = Manifest().append(docs, tampered).witnesses()
    return found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", siblings(F.col("path")).alias("proof"), "tried", "path")
