"""Sequences of neighbouring documents: ordered along a Hilbert curve, then cut every `length` tokens."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.encode import encoder, tokenizer_path
from tidelog.llm.text import type_of
from tidelog.session import new_path

LENGTH = 1024
END = 0  # the id that closes a document
HASHED = 1024  # entries of a document's hashed vector
DIMS, BITS = 4, 15  # of the curve: DIMS * BITS bits of a key
SEED = 11
REMEMBERED, KEPT = 1_200_000, 600_000  # pieces a process remembers from one task to the next, and when there are more
SEQUENCES = 40  # bits of a sequence's number inside its task


def vectors(documents: list[np.ndarray]) -> np.ndarray:
    """Counts of token ids, hashed with signs into HASHED entries and of length one; empty documents are zero."""
    n = len(documents)
    mixed = np.concatenate(documents).astype(np.uint32) * np.uint32(0x9E3779B1)
    rows = np.repeat(np.arange(n) * HASHED, [len(ids) for ids in documents])
    signs = 1.0 - 2.0 * (mixed >> np.uint32(21) & np.uint32(1))
    out = np.bincount(rows + (mixed >> np.uint32(22)), weights=signs, minlength=n * HASHED).reshape(n, HASHED).astype(np.float32)
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(size > 0, size, 1)


def cells(hashed: np.ndarray) -> np.ndarray:
    """A random projection to DIMS dimensions, squeezed to BITS bits each. It depends on no other document."""
    plane = np.random.default_rng(SEED).normal(size=(HASHED, DIMS))
    return ((1 + np.tanh(hashed @ plane)) / 2 * ((1 << BITS) - 1)).astype(np.int64)


def hilbert_keys(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each point (one column per dimension, `bits` bits each) on the Hilbert curve.

    From the highest bit down, the cube that holds the point is turned so that the curve enters it in the same corner;
    the bits of the turned coordinates, Gray-decoded, are the digits of the key.
    """
    x = points.T.copy()
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for d in range(dims):
            upper = (x[d] >> bit & 1).astype(bool)
            swap = np.where(upper, 0, (x[0] ^ x[d]) & low)
            x[0] ^= np.where(upper, low, swap)
            x[d] ^= swap
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for d in range(dims):
            key = key << 1 | (x[d] >> bit & 1)
    return key


def encode(batches: Iterator[pa.RecordBatch], path: str, end: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) to (doc_id, place, tie, ids): ids with the closing one, their place on the curve and checksum."""
    tokens = encoder(path, REMEMBERED, KEPT)
    for batch in batches:
        if not batch.num_rows:
            continue
        found = tokens.ids(["" if t is None else t for t in batch.column(1).to_pylist()])
        places = np.concatenate([hilbert_keys(cells(vectors(found[at:at + 256]))) for at in range(0, len(found), 256)])
        ids = [ids.tobytes() + np.array([end], ids.dtype).tobytes() for ids in found]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(places), pa.array([zlib.crc32(b) for b in ids], pa.int64()), pa.array(ids, pa.binary())],
            ["doc_id", "place", "tie", "ids"],
        )


def cut(batches: Iterator[pa.RecordBatch], length: int, dtype: str) -> Iterator[pa.RecordBatch]:
    """Documents in order to pieces: a task's sequences follow one another and are full, all but its last."""
    sequence, filled = TaskContext.get().partitionId() << SEQUENCES, 0
    for batch in batches:
        rows, starts, lengths, ids, totals, sequences, offsets = [], [], [], [], [], [], []
        for row, data in enumerate(batch.column(1).to_pylist()):
            own, at = np.frombuffer(data, dtype).astype("<u4"), 0
            while at < len(own):
                if filled == length:
                    sequence, filled = sequence + 1, 0
                take = min(length - filled, len(own) - at)
                rows.append(row)
                starts.append(at)
                lengths.append(take)
                ids.append(own[at:at + take].tobytes())
                totals.append(len(own))
                sequences.append(sequence)
                offsets.append(filled)
                at, filled = at + take, filled + take
        longs = [pa.array(c, pa.int64()) for c in (starts, lengths, totals, sequences, offsets)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(rows, pa.int64())), *longs[:2], pa.array(ids, pa.binary()), *longs[2:]],
            ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )


def pack(
    docs: DataFrame, length: int = LENGTH, tokenizer: str | None = None, end: int = END, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of at most `length` tokens: doc_id, start, length, ids (unsigned 32-bit,
    little-endian), doc_tokens, sequence_id, offset.

    A document is its token ids and the closing id `end`; null text counts as empty, so it is that one id. Documents are
    laid out along the curve and cut where a sequence is full, so every id lies in one piece and only the last sequence
    of each task is short. Documents of equal place follow by id and content: copies, and any number of rows at one
    place, are spread over tasks. Null ids are documents like others and come first. No rows give no pieces.

    The encoded documents are stored before they are ordered, as the bounds of the tasks are drawn from a sample, which
    would otherwise encode all texts twice.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    spark, dtype = docs.sparkSession, encoder(path).dtype.str
    schema = f"doc_id {type_of(docs, id_col)}, place long, tie long, ids binary"
    stored = new_path(spark, "encoded")
    docs.select(F.col(id_col), F.col(text_col)).mapInArrow(lambda b: encode(b, path, end), schema).write.option("compression", "zstd").parquet(stored)
    order = ["place", "doc_id", "tie"]
    encoded = spark.read.schema(schema).parquet(stored).repartitionByRange(*order).sortWithinPartitions(*order)
    return encoded.select("doc_id", "ids").mapInArrow(
        lambda b: cut(b, length, dtype),
        f"doc_id {type_of(docs, id_col)}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long",
    )
