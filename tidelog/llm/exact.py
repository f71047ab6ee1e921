"""Exact duplicates: heavy hitters by Misra-Gries, all other digests by a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.text import ascii_lower
from tidelog.session import store

TRACKED = 8192  # counters of the sketch: a digest of more than 7 / 8192 of all rows is surely found
HEAVY = 1024  # most digests that are broadcast
GROUPS = 256  # sketches that are merged before the last one


def frequent_digests(digests: DataFrame, tracked: int = TRACKED, heavy: int = HEAVY) -> DataFrame:
    """At most `heavy` candidates, one row each: a Misra-Gries sketch (the built-in frequent-items aggregate)
    per partition, merged in two steps so that no task receives the sketches of all partitions."""
    part = digests.groupBy((F.spark_partition_id() % GROUPS).alias("_part"))
    sketch = part.agg(F.expr(f"approx_top_k_accumulate(digest, {tracked})").alias("s"))
    sketch = sketch.groupBy(F.lit(0).alias("_all")).agg(F.expr(f"approx_top_k_combine(s, {tracked})").alias("s"))  # grouped: a task without rows makes no state
    items = sketch.select(F.explode(F.expr(f"approx_top_k_estimate(s, {heavy})")).alias("i"))
    return items.select(F.col("i.item").alias("digest"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tracked: int = TRACKED, heavy: int = HEAVY) -> DataFrame:
    """Groups of documents whose texts are equal after lower-casing A-Z.

    Returns one row per document: doc_id, keep_id (the group's largest id), group_size, kept, text_sha256.
    Null text counts as empty. A null id is below all others and is kept only if its group has no other;
    rows that repeat both the id and the text of the one that stays are all kept. No rows give no rows.
    Other columns are not read, whatever their names.

    The sketch only proposes: candidates are counted exactly, and those verified rows, at most `heavy`, are
    broadcast to take their groups out before the shuffle. What is left has no group of more than about
    7 / tracked of all rows, so no task of the window gets a large part of them.
    """
    digest = F.sha2(ascii_lower(F.col(text_col)), 256)
    digests = store(docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest")), "digests")
    candidates = F.broadcast(frequent_digests(digests, tracked, heavy))
    totals = [F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")]
    winners = F.broadcast(store(digests.join(candidates, "digest", "left_semi").groupBy("digest").agg(*totals), "winners"))

    common = digests.join(winners, "digest")
    group = Window.partitionBy("digest")
    rare = digests.join(winners, "digest", "left_anti").select(
        "digest", "doc_id", F.max("doc_id").over(group).alias("keep_id"), F.count("*").over(group).alias("group_size")
    )
    return common.select(rare.columns).unionByName(rare).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("digest").alias("text_sha256")
    )
