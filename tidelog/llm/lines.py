"""Lines that many documents share, found by probing perfect-hash arrays instead of joining lines."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.perfect_hash import PerfectHash, halves
from tidelog.llm.text import type_of
from tidelog.session import store

WHITE = b" \t\n\x0b\x0c\r"
MIN_CHARS, MIN_DOCS = 40, 5
HEAVY = 10_000  # a line in more than 1 / HEAVY of all (document, line) rows goes to the shard that every task holds
SHARD_ROWS = 200_000  # (document, line) rows to a shard
LEAST_SHARDS = 48


def key_of(line: bytes, min_chars: int) -> bytes | None:
    """The line without outer white space, A-Z lower-cased; None where it is shorter than min_chars code points."""
    key = line.strip(WHITE).lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


def document_lines(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, line): the distinct hashes of a document's long lines."""
    for batch in batches:
        rows, out = [], []
        for i, text in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
            found = {key_of(line, min_chars) for line in (text or b"").split(b"\n")} - {None}
            rows += [i] * len(found)
            out += found
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(out, pa.binary())], ["id", "line"])


class Shard:
    """Arrays indexed by the perfect hash of a line: its fingerprint, its count of documents and the document that keeps it."""

    def __init__(self, index: PerfectHash, prints: np.ndarray, counts: np.ndarray, winners: np.ndarray, known: np.ndarray):
        self.index, self.prints, self.counts, self.winners, self.known = index, prints, counts, winners, known

    @classmethod
    def of(cls, table: pa.Table) -> "Shard":
        """From rows (line, n, winner), each line once."""
        if not table.num_rows:
            return cls(PerfectHash([]), *(np.zeros(0, t) for t in ("<u8", "<i8", "<i8", bool)))
        a, b = halves(table.column("line").to_pylist())
        index = PerfectHash.build(a, b)
        at = np.argsort(index.index(a, b))
        winners = table.column("winner").cast(pa.int64())
        return cls(
            index, (a ^ (b << np.uint64(1)))[at], table.column("n").to_numpy()[at],
            winners.fill_null(0).to_numpy()[at], winners.is_valid().to_numpy()[at],
        )

    def row(self) -> dict[str, bytes]:
        return {
            "hash": self.index.dump(), "prints": self.prints.tobytes(), "counts": self.counts.tobytes(),
            "winners": self.winners.tobytes(), "known": self.known.tobytes(),
        }

    @classmethod
    def load(cls, row: dict[str, bytes]) -> "Shard":
        arrays = (np.frombuffer(row[c], t) for c, t in (("prints", "<u8"), ("counts", "<i8"), ("winners", "<i8"), ("known", bool)))
        return cls(PerfectHash.load(row["hash"]), *arrays)

    def probe(self, lines: list[bytes], ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Which lines are in the shard, and which of these the document loses."""
        if not lines or not len(self.prints):
            return np.zeros(len(lines), bool), np.zeros(len(lines), bool)
        a, b = halves(lines)
        at = self.index.index(a, b)
        held = (at >= 0) & (self.prints[at] == a ^ (b << np.uint64(1)))
        own, there = ids.cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False), ids.is_valid().to_numpy(zero_copy_only=False)
        wins = np.where(self.known[at], there & (own == self.winners[at]), ~there)
        return held, held & ~wins


def _flat(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, line): for each document the hashes of the lines it loses.

    A line is repeated if at least min_docs documents hold it; it stays in the one with the largest id.
    Hashes have 128 bits: the perfect hash is drawn from all of them, the fingerprint is a further 64-bit word of them.

    Lines in more than 1 / HEAVY of the rows are at most HEAVY in number, whatever the corpus; their shard goes to every
    task. All other lines are split by hash; a shard's arrays meet the probes of the documents in one task, which none
    of these lines can fill.
    """
    id_type = type_of(docs, id_col)
    schema = f"id {id_type}, line binary"
    lines = store(
        docs.select(F.col(id_col), F.col(text_col)).mapInArrow(lambda batches: document_lines(batches, min_chars), schema), "lines"
    )
    frequent = store(lines.groupBy("line").agg(F.count("*").alias("n"), F.max("id").alias("winner")).where(F.col("n") >= min_docs), "frequent")
    total = lines.count()
    heavy = Shard.of(frequent.where(F.col("n") * HEAVY > total).toArrow())
    shards = max(LEAST_SHARDS, math.ceil(total / SHARD_ROWS))
    shard_of = F.pmod(F.xxhash64("line"), F.lit(shards)).cast("int").alias("shard")

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Lines of the heavy shard are decided here: lost ones pass with lost = true, the others end here."""
        for batch in batches:
            held, lost = heavy.probe(batch.column(1).to_pylist(), batch.column(0))
            go = pa.array(~held | lost)
            yield pa.RecordBatch.from_arrays([*(c.filter(go) for c in batch.columns), pa.array(lost).filter(go)], ["id", "line", "lost"])

    def build(table: pa.Table) -> pa.Table:
        shard = table.column("shard").slice(0, 1)
        return pa.table({"shard": shard, **{k: pa.array([v], pa.binary()) for k, v in Shard.of(table).row().items()}})

    def probe(left: pa.Table, right: pa.Table) -> pa.Table:
        lost = np.zeros(left.num_rows, bool)
        for row in right.to_pylist():
            lost = Shard.load(row).probe(left.column("line").to_pylist(), _flat(left.column("id")))[1]
        return left.select(["id", "line"]).filter(pa.array(lost))

    routed = lines.mapInArrow(decide, f"{schema}, lost boolean")
    arrays = frequent.where(F.col("n") * HEAVY <= total).select(shard_of, "line", "n", "winner").groupBy("shard").applyInArrow(
        build, "shard int, hash binary, prints binary, counts binary, winners binary, known binary"
    )
    probes = routed.where(~F.col("lost")).select(shard_of, "id", "line")
    lost = probes.groupBy("shard").cogroup(store(arrays, "shards").groupBy("shard")).applyInArrow(probe, schema)
    return routed.where("lost").select("id", "line").unionByName(lost)


def cut(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """(..., text, lost lines) to (..., kept text, n_lines, n_dropped)."""
    for batch in batches:
        kept, n_lines, n_dropped = [], [], []
        for text, lost in zip(batch.column(batch.num_columns - 2).cast(pa.binary()).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
            lines = (text or b"").split(b"\n")
            gone = set(lost or ())
            stay = [line for line in lines if key_of(line, min_chars) not in gone] if gone else lines
            kept.append(b"\n".join(stay))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
            [*batch.schema.names[:-2], "kept_text", "n_lines", "n_dropped"],
        )


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, carry: list[str] | None = None,
) -> DataFrame:
    """The documents without the lines that others repeat: id, `carry`, kept_text, n_lines (before), n_dropped.

    Lines end at \\n; a line's key has outer white space stripped and A-Z lower-cased. Keys of at least min_chars code
    points in at least min_docs documents (rows) lose all their lines but in the largest id that holds them. Null or
    empty text is one empty line; a text all of whose lines go becomes empty. Ids are integers; a null id is below all
    others, and rows with equal ids fare alike. No rows give no rows. Columns not named are not read.
    """
    carry = carry or []
    lost = repeated_lines(docs, id_col, text_col, min_chars, min_docs)
    lost = lost.groupBy("id").agg(F.collect_set("line").alias("_lost")).withColumnRenamed("id", "_id")
    names = [id_col, *carry]
    read = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(names)], F.col(text_col).alias("_text"))
    joined = read.join(lost, F.col("_c0").eqNullSafe(F.col("_id")), "left").drop("_id")
    schema = ", ".join([f"`{c}` {type_of(docs, c)}" for c in names] + ["kept_text string, n_lines long, n_dropped long"])

    return joined.mapInArrow(lambda batches: cut(batches, min_chars), schema)
