"""Language by rank order: a text's most frequent letter n-grams against those of each language."""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.text import type_of

GRAMS = 3  # longest n-gram
RANKS = 300  # n-grams of a profile
LANGUAGES = 1000  # most languages that can be learned; more are an error
UNKNOWN = "und"
GATHERED = 1 << 18  # different n-grams a task holds before it passes their counts on
FAR = 5  # standard deviations below the mean at which a score is no longer one of the learned languages
CODE, TOP = 20, (1 << 20) - 1  # bits of a letter in an n-gram's number

_letters = np.zeros(0, bool)


def letters() -> np.ndarray:
    """For every code point whether it is a letter."""
    global _letters
    if not len(_letters):
        _letters = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _letters


def grams(text: str | None, longest: int = GRAMS) -> np.ndarray:
    """Numbers of all n-grams of a text's words, in lower case, with a blank on either side of a word."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    codes = np.where(letters()[codes], np.minimum(codes, TOP), 0)
    codes = np.concatenate(([0], codes, [0]))
    codes = codes[(codes != 0) | (np.concatenate(([1], codes[:-1])) != 0)]
    out = [codes[codes != 0]]
    for n in range(2, longest + 1):
        inner = np.ones(max(0, len(codes) - n + 1), bool)
        number = np.zeros(len(inner), np.int64)
        for i in range(n):
            part = codes[i:i + len(inner)]
            number = number << CODE | part
            if 0 < i < n - 1:
                inner &= part != 0
        out.append(number[inner] | (n - 1) << 3 * CODE)
    return np.concatenate(out)


def ranked(numbers: np.ndarray, counts: np.ndarray, ranks: int) -> np.ndarray:
    """The most frequent n-grams, ties by number."""
    return numbers[np.lexsort((numbers, -counts))[:ranks]]


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    numbers, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return numbers, np.bincount(at, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)


def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) to (lang, gram, n), summed within a task as far as memory is bounded."""
    held: dict[str, list] = defaultdict(list)

    def release() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            numbers, counts = _merge(parts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(numbers), pa.string()), pa.array(numbers), pa.array(counts)], ["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            held[lang].append(np.unique(grams(text), return_counts=True))
            if len(held[lang]) > 256:
                held[lang] = [_merge(held[lang])]
        if sum(len(numbers) for parts in held.values() for numbers, _ in parts) > GATHERED:
            for lang in held:
                held[lang] = [_merge(held[lang])]
            if sum(len(parts[0][0]) for parts in held.values()) > GATHERED:
                yield from release()
    yield from release()


class Profiles:
    """Rank of each n-gram in each language; one that a language lacks is out of place by the whole length."""

    def __init__(self, rows: list[tuple[str, int, int]], ranks: int):
        self.ranks = ranks
        self.names = sorted({lang for lang, _, _ in rows})
        self.numbers = np.unique(np.array([gram for _, gram, _ in rows], np.int64))
        self.places = np.full((len(self.numbers) + 1, len(self.names)), -1, np.int64)
        column = {name: i for i, name in enumerate(self.names)}
        for lang, gram, rank in rows:
            self.places[np.searchsorted(self.numbers, gram), column[lang]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        numbers, counts = np.unique(grams(text), return_counts=True)
        if not len(numbers) or not self.names:
            return UNKNOWN, 0.0
        own = ranked(numbers, counts, self.ranks)
        at = np.searchsorted(self.numbers, own)
        at[(at == len(self.numbers)) | (self.numbers[np.minimum(at, len(self.numbers) - 1)] != own)] = len(self.numbers)
        places = self.places[at]
        apart = np.where(places < 0, self.ranks, np.abs(places - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(apart))
        return self.names[best], 1 - float(apart[best]) / (self.ranks * len(own))


def learn_profiles(texts: DataFrame, ranks: int = RANKS) -> Profiles:
    """Profiles from all rows of (lang, text); at most LANGUAGES * ranks rows come to the driver."""
    counted = texts.where(F.col("lang").isNotNull()).mapInArrow(count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    rows = top.select("lang", "gram", F.col("rank") - 1).limit(LANGUAGES * ranks + 1).collect()
    if len(rows) > LANGUAGES * ranks:
        raise ValueError(f"more than {LANGUAGES} languages to learn")
    return Profiles([tuple(r) for r in rows], ranks)


def identify(docs: DataFrame, profiles: Profiles, carry: list[str], text_col: str = "text") -> DataFrame:
    """`carry`, lang_pred, score for every row of docs: the language at the least out-of-place distance.

    score is 1 for a text whose n-grams stand in the same order as the language's, 0 for one that shares none. Ties go to
    the language first by name. Null text and text without letters are `und` with score 0, as is all text if nothing
    was learned. The whole text is read, however long.
    """

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(text) for text in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [*batch.schema.names[:-1], "lang_pred", "score"],
            )

    read = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)], F.col(text_col).alias("_text"))
    return read.mapInArrow(predict, ", ".join([f"`{c}` {type_of(docs, c)}" for c in carry] + ["lang_pred string", "score double"]))


def least_score(texts: DataFrame, profiles: Profiles) -> float:
    """The score below which a text is in none of the learned languages: FAR standard deviations under the mean score of
    all rows of (lang, text) that are found to be in their own language, at most half of that mean, never below 0."""
    own = identify(texts, profiles, ["lang"]).where(F.col("lang") == F.col("lang_pred"))
    mean, spread = own.agg(F.avg("score"), F.stddev_pop("score")).first()
    return 0.0 if mean is None else max(0.0, min(mean - FAR * spread, mean / 2))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2. A null id is the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2
