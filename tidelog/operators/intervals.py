"""Joins on ranges without an equal key, with work in proportion to the pairs that match.

Points are laid on one line and numbered along it. The line is cut into cells of neighbours, and the first point of each run
of CELL is a mark; between the marks an interval's ends tell by binary search which cells it reaches. It goes to these and meets
their points by the cell's number. Only the first and the last of its cells can hold points that are not its own. Equal points
have numbers of their own, so a value that most rows hold fills many cells, and no task. Cells are at least as long as
intervals are on average: intervals that grow longer with the data are not copied to more cells. Intervals are stored once and
shuffled once, as these copies.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.ordered import ordered_scan
from tidelog.session import store

CELL = 1_000  # points of a cell, or as many as the intervals hold on average if that is more
FULL = 20_000  # intervals of a cell that one task joins; more are dealt to several, each with a copy of the cell


# Types that NumPy has in the order that Spark has them in. For others, such as structs and strings with a collation, Spark counts.
ALIKE = {"tinyint", "smallint", "int", "bigint", "float", "double", "decimal", "date", "timestamp", "timestamp_ntz", "string", "binary", "boolean"}


def marks_before(marks: np.ndarray, side: str):
    """A column function: how many marks are below a value (left), or up to it (right)."""

    def count(values: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(marks, values.to_numpy(zero_copy_only=False), side), pa.int64())

    return F.arrow_udf(count, "long")


def counted(marks: DataFrame, ends: DataFrame) -> DataFrame:
    """Rows of ends (_start, _end, _interval) with the marks (_at) below _start and up to _end, by one line of all of these."""
    ends = store(ends.withColumn("_id", F.monotonically_increasing_id()), "intervals", compression="zstd")
    line = marks.select("_at", F.lit(1).alias("_kind"), F.lit(1).alias("_add"), F.lit(None).cast("long").alias("_id"))
    for end, side in (("_start", 0), ("_end", 2)):
        line = line.union(ends.select(end, F.lit(side), F.lit(0), "_id"))
    scanned = ordered_scan(line, [], ["_at", "_kind"], sums={"_sum": F.col("_add")})
    begun = scanned.where("_kind = 0").select("_id", F.col("_sum").alias("_begun"))
    return ends.join(begun, "_id").join(scanned.where("_kind = 2").select("_id", F.col("_sum").alias("_upto")), "_id")


def common(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str) -> T.DataType:
    """The type that the values of both sides are compared in."""
    return points.select(at).union(intervals.select(start)).union(intervals.select(end)).schema[0].dataType


def reach(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """Points as (_n, _point), numbered along the line, and intervals as (_first, _last, _interval): what an interval holds is
    among the runs of CELL points from _first to _last, both included. Rows without all of these hold nothing."""
    kind = common(points, intervals, at, start, end)
    point = F.struct(*[F.col(c) for c in points.columns]).alias("_point")
    interval = F.struct(*[F.col(c) for c in intervals.columns]).alias("_interval")
    line = points.where(F.col(at).isNotNull()).select(F.col(at).cast(kind).alias("_at"), point)
    placed = ordered_scan(line, [], ["_at"], number="_n")
    marks = placed.where(F.col("_n") % CELL == 0).select("_n", "_at")
    ends = intervals.where(F.col(start) <= F.col(end)).select(F.col(start).cast(kind).alias("_start"), F.col(end).cast(kind).alias("_end"), interval)
    if kind.simpleString().split("(")[0] in ALIKE:
        known = marks.toArrow().sort_by("_n")["_at"].to_numpy()
        found = ends.select(marks_before(known, "left")("_start").alias("_begun"), marks_before(known, "right")("_end").alias("_upto"), "_interval")
    else:
        found = counted(marks, ends)
    # Points equal to a mark may stand before it. In the order of their cells intervals take less room, stored and shuffled.
    found = found.select(F.greatest(F.col("_begun") - 1, F.lit(0)).alias("_first"), (F.col("_upto") - 1).alias("_last"), "_interval")
    held = store(found.sortWithinPartitions("_first", "_last"), "held", compression="zstd")
    return placed.select("_n", "_point"), held.where("_first <= _last")


def range_join(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str) -> DataFrame:
    """All columns of both sides (names must differ) for each point with start <= at <= end.

    Nulls match nothing, as in SQL; repeated rows on either side give repeated pairs. Intervals are copied once per cell
    that they reach, two or three on average; points once per FULL intervals that their cell meets. The marks, one value in
    CELL points, are held by the driver and the Python workers.
    """
    clash = set(points.columns) & set(intervals.columns)
    if clash:
        raise ValueError(f"both sides have the columns {sorted(clash)}")
    numbered, held = reach(points, intervals, at, start, end)
    runs = max(1, round(held.agg(F.avg(F.col("_last") - F.col("_first"))).first()[0] or 0))  # of CELL points, in a cell
    cells = F.explode(F.sequence(F.floor(F.col("_first") / runs), F.floor(F.col("_last") / runs)))
    dealt = held.withColumn("_id", F.monotonically_increasing_id()).withColumn("_cell", cells)
    copies = dealt.groupBy("_cell").agg(F.ceil(F.count("*") / FULL).cast("int").alias("_copies"))
    wide = store(copies.where("_copies > 1"), "wide").withColumnRenamed("_cell", "_full")  # few cells, if any
    salted = dealt.join(wide, dealt["_cell"] == wide["_full"], "left").withColumn("_copy", F.pmod(F.xxhash64("_id"), F.coalesce("_copies", F.lit(1))).cast("int"))
    placed = numbered.withColumn("_cell", F.floor(F.col("_n") / (runs * CELL)))
    placed = placed.join(wide, placed["_cell"] == wide["_full"], "left")
    placed = placed.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.coalesce("_copies", F.lit(1)) - 1)))
    left, right = placed.select("_cell", "_copy", "_point"), salted.select("_cell", "_copy", "_interval")
    kind = common(points, intervals, at, start, end)
    moment, begin, stop = (F.col(side).getField(c).cast(kind) for side, c in (("_point", at), ("_interval", start), ("_interval", end)))
    met = left.join(right, ["_cell", "_copy"]).where((moment >= begin) & (moment <= stop))
    return met.select("_point.*", "_interval.*")


def overlap_join(left: DataFrame, right: DataFrame, left_range: tuple[str, str], right_range: tuple[str, str]) -> DataFrame:
    """All columns of both sides for each two intervals that share a value. Of two such either the right one begins within
    the left one, or the left one begins within the right one, after it."""
    left = left.where(F.col(left_range[0]) <= F.col(left_range[1]))
    right = right.where(F.col(right_range[0]) <= F.col(right_range[1]))
    inside = range_join(right, left, right_range[0], *left_range)
    after = range_join(left, right, left_range[0], *right_range).where(F.col(left_range[0]) > F.col(right_range[0]))
    columns = [*left.columns, *right.columns]
    return inside.select(*columns).unionByName(after.select(*columns))
