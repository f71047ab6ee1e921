"""Token counts by field and section: a document is encoded once, its tokens are joined to sections by their offsets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.encode import encoder, tokenizer_path
from tidelog.llm.text import type_of

SEPARATOR = "\n"  # between fields; it belongs to the field before it


def char_spans(lengths: np.ndarray, text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end in code points of tokens that cover `lengths` bytes of a text each; a token that holds a part of a
    code point covers it."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    if len(text) and not text.isascii():
        place = np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80) - 1
        return place[starts], place[ends - 1] + 1
    return starts, ends


def join_spans(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The section of each token, and whether the token crosses a boundary.

    bounds: where sections begin and where the last one ends, in order. A token goes to the section that holds the most
    of its characters, of several to the first. A token that covers part of a code point counts it wholly.
    """
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends - 1, side="right") - 1
    owner = first.copy()
    for t in np.flatnonzero(first != last):
        inner = np.arange(first[t], last[t] + 1)
        shares = np.minimum(bounds[inner + 1], ends[t]) - np.maximum(bounds[inner], starts[t])
        owner[t] = inner[np.argmax(shares)]
    return owner, first != last


def attribute(batches: Iterator[pa.RecordBatch], path: str, fields: list[str]) -> Iterator[pa.RecordBatch]:
    """(id, fields...) to one row per section."""
    tokens = encoder(path)
    widths = tokens.widths
    for batch in batches:
        values = [["" if v is None else v for v in column.to_pylist()] for column in batch.columns[1:]]
        texts = [SEPARATOR.join(parts) for parts in zip(*values)]
        rows, names, numbers, starts, ends, counts, crossing = [], [], [], [], [], [], []
        for row, (text, ids) in enumerate(zip(texts, tokens.ids(texts))):
            bounds, at = [0], 0
            for field, parts in zip(fields, values):
                lines = parts[row].split("\n")
                for number, line in enumerate(lines):
                    at += len(line) + 1
                    bounds.append(at)
                    names.append(field)
                    numbers.append(number)
            bounds[-1] -= 1  # nothing follows the last field
            owner, crosses = join_spans(*char_spans(widths[ids], text.encode()), np.array(bounds))
            sections = len(bounds) - 1
            rows += [row] * sections
            starts += bounds[:-1]
            ends += bounds[1:]
            counts.append(np.bincount(owner, minlength=sections))
            crossing.append(np.bincount(owner[crosses], minlength=sections))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(rows, pa.int64())), pa.array(names, pa.string()), *(pa.array(c, pa.int64()) for c in (numbers, starts, ends)),
                pa.array(np.concatenate(counts) if counts else [], pa.int64()), pa.array(np.concatenate(crossing) if crossing else [], pa.int64()),
            ],
            ["doc_id", "field", "section", "start", "end", "n_tokens", "n_crossing"],
        )
    tokens.trim()


def section_tokens(docs: DataFrame, fields: list[str], tokenizer: str | None = None, id_col: str = "doc_id") -> DataFrame:
    """Tokens of every section of every document: doc_id, field, section, start, end, n_tokens, n_crossing.

    A document is its fields joined by a line feed; a section is a line of a field, with the line feed after it, and
    start and end are its code points in the whole. The whole is encoded once, so counts sum up to the length the
    document has for a model. A token that crosses a boundary goes to the section that holds most of its characters,
    of equals to the first; n_crossing counts those among n_tokens. Null fields are empty, an empty field is one empty section; a field may
    hold any text. Rows of one id, or without, are counted each by itself. No rows give no rows.
    """
    path = tokenizer or tokenizer_path("byte_bpe_50k.json")
    read = docs.select(F.col(id_col).alias("_id"), *[F.col(f).cast("string").alias(f"_f{i}") for i, f in enumerate(fields)])
    return read.mapInArrow(
        lambda b: attribute(b, path, fields),
        f"doc_id {type_of(docs, id_col)}, field string, section long, start long, end long, n_tokens long, n_crossing long",
    )
