"""Window functions over groups of any size: bounded frames, ranks, neighbours.

Rows are numbered within their group by a scan of slices, and a group is cut into blocks of BLOCK numbers. A block gets, as
a halo, the rows before and after it that its frames look at, so a window function over (group, block) sees all it needs;
halo rows then go. Frames over a range of values are differences of two running sums. No exchange is by the group alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.operators.ordered import ordered_scan
from tidelog.session import store

BLOCK = 50_000  # rows of a group that one task takes at once
NUMBER = "_number"

Frame = tuple[Column, int, int]


def lag(value: Column, by: int = 1) -> Frame:
    return F.max(value), -by, -by


def lead(value: Column, by: int = 1) -> Frame:
    return F.max(value), by, by


def numbered(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """df stored, with the number of each row in its group, from 0. Rows of one place in the order stand by their hash."""
    return store(ordered_scan(df, keys, order, number=NUMBER), "numbered")


def over_rows(rows: DataFrame, keys: list[str], frames: dict[str, Frame]) -> DataFrame:
    """Numbered rows with an aggregate over each frame: (aggregate, first row, last row), counted from the current one."""
    before = max([0, *[-low for _, low, _ in frames.values()]])
    after = max([0, *[high for _, _, high in frames.values()]])
    block = max(BLOCK, before, after)
    at, own = F.pmod(F.col(NUMBER), F.lit(block)), F.floor(F.col(NUMBER) / block)
    # Its own block, the next one if that looks back to it, the one before if that looks ahead to it.
    homes = [own, F.when(at >= block - before, own + 1), F.when((at < after) & (own > 0), own - 1)]
    spread = rows.withColumn("_block", F.explode(F.array_compact(F.array(*homes))))
    window = Window.partitionBy(*keys, "_block").orderBy(NUMBER)
    told = spread.withColumns({name: aggregate.over(window.rowsBetween(low, high)) for name, (aggregate, low, high) in frames.items()})
    return told.where(F.col("_block") == own).drop("_block")


def over_range(rows: DataFrame, keys: list[str], by: str, sums: dict[str, Frame]) -> DataFrame:
    """Numbered rows with a sum over each range: (summand, low, high), of the rows of the group whose `by` is from low below to
    high above the current row's. Where `by` is null the range is the rows of null."""
    place = [*keys, NUMBER]
    out = rows
    for name, (summand, low, high) in sums.items():
        known = F.col(by).isNotNull()
        line = rows.select(*place, F.col(by).alias("_at"), F.lit(1).alias("_kind"), F.coalesce(summand, F.lit(0)).alias("_add"))
        begins = rows.where(known).select(*place, (F.col(by) + low).alias("_at"), F.lit(0).alias("_kind"), F.lit(0).alias("_add"))
        stops = rows.select(*place, (F.col(by) + high).alias("_at"), F.lit(2).alias("_kind"), F.lit(0).alias("_add"))
        scanned = ordered_scan(line.unionByName(begins).unionByName(stops), keys, ["_at", "_kind"], sums={"_sum": F.col("_add")})
        upto = F.when(F.col("_kind") == 2, F.col("_sum")).when(F.col("_kind") == 0, -F.col("_sum"))
        found = store(scanned.where("_kind <> 1").groupBy(*place).agg(F.sum(upto).alias(name)), "ranges")
        out = _with(out, found, place, name)
    return out


def with_rank(rows: DataFrame, keys: list[str], by: str, name: str) -> DataFrame:
    """Rows with their rank by a column, null first: one more than the rows of the group that stand before it. Equal values
    are counted together before they are scanned."""
    counts = rows.groupBy(*keys, by).agg(F.count("*").alias("_n"))
    scanned = ordered_scan(counts, keys, [by], sums={"_upto": F.col("_n")})
    return _with(rows, store(scanned.select(*keys, by, (F.col("_upto") - F.col("_n") + 1).alias(name)), "ranks"), [*keys, by], name)


def _with(rows: DataFrame, found: DataFrame, on: list[str], name: str) -> DataFrame:
    renamed = found.select(*[F.col(c).alias(f"_of_{i}") for i, c in enumerate(on)], name)
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_of_{i}")) for i, c in enumerate(on)])
    return rows.join(renamed, match).drop(*[f"_of_{i}" for i in range(len(on))])
