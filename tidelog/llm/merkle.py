"""Fixity of archive replicas: trees of hashes over records and offset ranges, searched only where they differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.operators.ordered import ordered_scan
from tidelog.session import store

RANGE = 1 << 18  # bytes of the offset range of a lowest node
FANOUT = 32  # nodes under a higher one


def warc_record(url: Column, body: Column) -> Column:
    """A response record as it stands in the archive; null counts as empty."""
    body = F.coalesce(body, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "))
    return F.concat(head, F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def lay_out(records: DataFrame, file_col: str, order: list[str], length_col: str) -> DataFrame:
    """Add `offset`: the bytes before a record in its file, by a scan that no file, however large, brings to one task."""
    placed = ordered_scan(records, [file_col], order, sums={"_end": F.col(length_col)})
    return placed.withColumn("offset", F.col("_end") - F.col(length_col)).drop("_end")


def _parent(children: DataFrame, level: int) -> DataFrame:
    """Nodes of a level from those below: the hash of the hashes of up to FANOUT children in the order of their offsets."""
    ordered = F.sort_array(F.collect_list(F.struct("node", "digest")))
    return children.groupBy("replica", "file", F.floor(F.col("node") / FANOUT).cast("long").alias("above")).agg(
        F.sha2(F.array_join(F.transform(ordered, lambda c: F.concat_ws(":", c["node"], c["digest"])), ","), 256).alias("digest")
    ).select("replica", "file", F.lit(level).alias("level"), F.col("above").alias("node"), "digest")


def hash_tree(records: DataFrame, range_bytes: int = RANGE) -> DataFrame:
    """Stored nodes (replica, file, level, node, digest) over records (replica, file, offset, length, digest).

    A node of level 0 covers the records that begin in one offset range of a file, one of level n FANOUT nodes of the
    level below; the top level has one node per file. A hash is over its parts in order, with their places. Records of
    equal offset are ordered by their content. A group holds one range or FANOUT nodes, never a file.
    """
    ordered = F.sort_array(F.collect_list(F.struct("offset", "length", "digest")))
    lowest = records.groupBy("replica", "file", F.floor(F.col("offset") / range_bytes).cast("long").alias("node")).agg(
        F.sha2(F.array_join(F.transform(ordered, lambda r: F.concat_ws(":", r["offset"], r["length"], r["digest"])), ","), 256).alias("digest")
    ).select("replica", "file", F.lit(0).alias("level"), "node", "digest")
    level = store(lowest, "tree")
    levels, number = [level], 0
    last = level.agg(F.max("node")).first()[0] or 0
    while last:
        number, last = number + 1, last // FANOUT
        level = store(_parent(level, number), "tree")
        levels.append(level)
    tree = levels[0]
    for level in levels[1:]:
        tree = tree.unionByName(level)
    return tree


def audit(records: DataFrame, left: str, right: str, range_bytes: int = RANGE) -> DataFrame:
    """(file, offset, left_digest, right_digest, fault) of the records in which two replicas of the archive differ.

    records: (replica, file, offset, length, digest), the offsets as each replica has them. The roots of both are
    compared, then only the children of nodes that differ, down to offset ranges; only records in differing ranges are
    compared one by one. fault is `altered`, `missing` (only in left) or `extra` (only in right). A null file is a file
    like others, a null digest is a value like others; a row without an offset belongs to no range and is left out.
    Records of one offset and content are told apart by number: `missing` if right has fewer. No rows give no rows.
    """
    records = records.where(F.col("offset").isNotNull()).withColumn("digest", F.coalesce("digest", F.lit("")))
    both = records.where(F.col("replica").isin(left, right))
    tree = hash_tree(both, range_bytes)
    height = tree.agg(F.max("level")).first()[0]
    if height is None:
        height = 0
    suspects = None
    for level in range(height, -1, -1):
        nodes = tree.where(F.col("level") == level)
        if suspects is not None:
            above = F.floor(F.col("node") / FANOUT).cast("long")
            nodes = nodes.join(suspects.withColumnsRenamed({"file": "_file", "node": "_node"}), F.col("file").eqNullSafe(F.col("_file")) & (above == F.col("_node")), "left_semi")
        digest = {side: F.max(F.when(F.col("replica") == side, F.col("digest"))) for side in (left, right)}
        differ = nodes.groupBy("file", "node").agg(digest[left].alias("l"), digest[right].alias("r")).where(~F.col("l").eqNullSafe(F.col("r")))
        suspects = store(differ.select("file", "node"), "suspects")
    ranges = suspects.withColumnsRenamed({"file": "_file", "node": "_node"})
    within = F.col("file").eqNullSafe(F.col("_file")) & (F.floor(F.col("offset") / range_bytes).cast("long") == F.col("_node"))
    near = both.join(ranges, within, "left_semi")
    count = {side: F.sum(F.when(F.col("replica") == side, 1).otherwise(0)) for side in (left, right)}
    odd = near.groupBy("file", "offset", "length", "digest").agg(count[left].alias("l"), count[right].alias("r")).where("l <> r")
    faults = odd.groupBy("file", "offset").agg(
        F.max(F.when(F.col("l") > F.col("r"), F.col("digest"))).alias("left_digest"), F.max(F.when(F.col("r") > F.col("l"), F.col("digest"))).alias("right_digest")
    )
    fault = F.when(F.col("right_digest").isNull(), "missing").when(F.col("left_digest").isNull(), "extra").otherwise("altered")
    return faults.withColumn("fault", fault)
