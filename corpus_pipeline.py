"""A corpus pipeline of llm operators: language ID, line dedup, near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before has kept; all but the last return
the columns of `documents`. Near-dedup and decontamination judge each row by itself, whatever its id, and tell rows apart by
a stored number.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidelog.llm.decontaminate import contamination  # noqa: E402
from tidelog.llm.langid import UNKNOWN, held_out, identify, learn_profiles, least_score  # noqa: E402
from tidelog.llm.lines import drop_repeated_lines  # noqa: E402
from tidelog.llm.neardup import near_duplicates  # noqa: E402
from tidelog.llm.packing import pack  # noqa: E402
from tidelog.llm.text import documents, prepared  # noqa: E402
from tidelog.session import drop, new_path, staging, store  # noqa: E402

ROW = "_row"


_rows: list[str] = []  # what stages have stored to number their rows


def tidy(docs: DataFrame) -> None:
    """Drop the numbered rows of earlier stages: their results are stored when a later stage begins. Those that docs is
    still read from stay."""
    if _rows:
        read = docs.inputFiles()
        for path in [p for p in _rows if not any(p.rsplit("/", 1)[1] in file for file in read)]:
            drop(docs.sparkSession, path)
            _rows.remove(path)


def numbered(docs: DataFrame) -> DataFrame:
    """docs, stored with a number of each row, which names the row whatever its id."""
    marked = docs.withColumn(ROW, F.monotonically_increasing_id())
    _rows.append(new_path(docs.sparkSession, "rows"))
    marked.write.parquet(_rows[-1])
    return docs.sparkSession.read.schema(marked.schema).parquet(_rows[-1])


def without(docs: DataFrame, judge: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Numbered docs without the rows of which judge(docs) has the number; what judging has stored is dropped."""
    path = new_path(docs.sparkSession, "gone")
    with staging(docs.sparkSession):
        judge(docs).select(ROW).write.parquet(path)
    return docs.join(docs.sparkSession.read.schema(f"{ROW} long").parquet(path), ROW, "left_anti").drop(ROW)


def later(places: DataFrame, group: list[str]) -> DataFrame:
    """Of (_row, *group, place), the rows that are not first of their group by place."""
    first = places.groupBy(*group).agg(F.min("place").getField(ROW).alias(ROW))
    return places.select(ROW).join(first.select(ROW), ROW, "left_anti")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in none of the learned languages go: those without text or letters, and those whose n-grams stand further
    from every profile than least_score allows."""
    prepared(spark)
    learned = docs.where(~held_out()).select("lang", "text")
    profiles = learn_profiles(learned)
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") > 0) & (F.col("score") >= least_score(learned, profiles))
    return identify(docs, profiles, docs.columns).where(known).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more that five documents share stay in one of them; n_chars follows."""
    prepared(spark)
    carry = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    kept = drop_repeated_lines(docs, carry=carry).withColumnRenamed("kept_text", "text").withColumn("n_chars", F.length("text").cast("long"))
    return kept.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingles of five words, similarity 0.8 or more, one row of the least id stays; of blank rows,
    which are linked with nothing, one of each id and text."""
    prepared(spark)
    tidy(docs)
    return without(numbered(docs), copies)


def copies(rows: DataFrame) -> DataFrame:
    """The rows that near_dedup drops."""
    judged = near_duplicates(rows, ROW).select(F.col("doc_id").alias(ROW), "component_id")
    places = store(judged.join(rows.select(ROW, "doc_id"), ROW).withColumn("place", F.struct(F.col("doc_id").isNull(), "doc_id", ROW)), "places")
    blank = rows.where(F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(ROW, "doc_id", "text", F.struct(ROW).alias("place"))
    return later(places, ["component_id"]).unionByName(later(blank, ["doc_id", "text"]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item, or the whole of a shorter one, go."""
    prepared(spark)
    tidy(docs)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return without(numbered(docs), lambda rows: contamination(rows, benchmark, id_col=ROW).where("contaminated").select(F.col("doc_id").alias(ROW)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents left, in sequences of at most 1024 tokens."""
    prepared(spark)
    tidy(docs)
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

ORACLE_SQL = None  # SQL has neither rank-order profiles nor a tokenizer; tests/llm compares the stages with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage keeps is written once, as the next one reads it several times, and dropped
    when the next one's result is written."""
    prepared(spark)
    sf_dir = sf_dir.rstrip("/")
    docs, before = documents(spark, sf_dir), None
    for name, stage in STAGES[:-1]:
        kept, path = stage(spark, docs, sf_dir), new_path(spark, name)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before:
            drop(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
