"""Row numbers, running sums and last-known values over groups of any size.

A plain window function takes a whole group into one task. Here the rows are range-partitioned by
(group, order), so that one hot group is spread over many slices; each slice is summarised, the
summaries (one row per slice and group) are scanned, and their result is joined back. The slices are
stored first: their bounds come from sampling, so they must not be drawn twice.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.session import store

SLICE = "_slice"
POS = "_pos"
SPREAD = "_spread"


SLICE_BYTES = 1 << 30
UNKNOWN = 1 << 60  # what the planner says of inputs that are not stored is beyond any size


def slices_for(df: DataFrame) -> int | None:
    """How many slices keep each near SLICE_BYTES, by the stored size of what df reads; None if the session's
    own number of shuffle partitions will do (which adaptive execution may then lower).

    The sizes of the inputs are summed: the planner's estimate of a join would be their product.
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    size = sum(n for n in sizes if n < UNKNOWN)
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = size // SLICE_BYTES
    return wanted if wanted > usual else None


def row_hash(df: DataFrame) -> Column:
    """A hash of a row's content; maps and variants cannot be hashed and are left out."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return F.xxhash64(*[c for c, kind in kinds.items() if "map<" not in kind and "variant" not in kind])


def sliced(df: DataFrame, keys: list[str], order: list[str], slices: int | None = None) -> DataFrame:
    """df stored in (keys, order) order, with its slice number and its place in the slice.

    Rows of one key and one place in the order may be any number; their hash tells them apart, so that
    they too can be cut. It comes from the row alone: a task that is run again sends it the same way.
    """
    by = [*keys, *order, SPREAD]
    slices = slices or slices_for(df)
    spread = df.withColumn(SPREAD, row_hash(df))
    ranged = spread.repartitionByRange(slices, *by) if slices else spread.repartitionByRange(*by)
    return store(
        ranged.sortWithinPartitions(*by)
        .drop(SPREAD)
        .withColumn(SLICE, F.spark_partition_id())
        .withColumn(POS, F.monotonically_increasing_id()),
        "sliced", compression="zstd",
    )


def same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Null-safe equality on columns, as a join condition."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def ordered_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    number: str | None = None,
    sums: dict[str, Column] | None = None,
    last: dict[str, Column] | None = None,
    slices: int | None = None,
    starts: DataFrame | None = None,
) -> DataFrame:
    """Add, per group `keys` in the order `order`:

    number: 0, 1, 2, ... ; sums: running totals, this row included; last: the latest non-null
    value, this row included. `order` should be unique within a group. starts: (*keys, start), the number
    a group begins with; it meets the summaries, not the rows.
    """
    sums, last = sums or {}, last or {}
    inputs = {f"_in_{name}": col for name, col in {**sums, **last}.items()}
    staged = sliced(df.withColumns(inputs) if inputs else df, keys, order, slices)

    totals = [F.min(POS).alias("_first"), F.count("*").alias("_n")]
    totals += [F.sum(f"_in_{c}").alias(f"_all_{c}") for c in sums]
    totals += [
        F.max_by(f"_in_{c}", F.when(F.col(f"_in_{c}").isNotNull(), F.col(POS))).alias(f"_all_{c}")
        for c in last
    ]
    summary = store(staged.groupBy(SLICE, *keys).agg(*totals), "slices")

    earlier = (
        Window.partitionBy(*(keys or [F.lit(0)])).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = [F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")]
    carried += [F.coalesce(F.sum(f"_all_{c}").over(earlier), F.lit(0)).alias(f"_carry_{c}") for c in sums]
    carried += [F.last(f"_all_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in last]
    summary = summary.select(
        F.col(SLICE), *keys, F.col("_first"), *carried
    )
    if starts is not None:
        begin = starts.select(*[F.col(k).alias(f"_of_{k}") for k in keys], F.col("start").alias("_start"))
        match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
        summary = summary.join(begin, match, "left").withColumn("_before", F.col("_before") + F.coalesce("_start", F.lit(0)))
        summary = store(summary.drop(*[f"_of_{k}" for k in keys], "_start"), "slices")

    local = staged
    if inputs:
        within = (
            Window.partitionBy(SLICE, *keys).orderBy(POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        local = local.withColumns(
            {f"_own_{c}": F.sum(f"_in_{c}").over(within) for c in sums}
            | {f"_own_{c}": F.last(f"_in_{c}", ignorenulls=True).over(within) for c in last}
        )

    joined = local.join(summary, same(local, summary, [SLICE, *keys]), "inner")
    out = [local[c] for c in df.columns]
    if number:
        out.append((summary["_before"] + local[POS] - summary["_first"]).alias(number))
    out += [(F.col(f"_carry_{c}") + F.coalesce(F.col(f"_own_{c}"), F.lit(0))).alias(c) for c in sums]
    out += [F.coalesce(F.col(f"_own_{c}"), F.col(f"_carry_{c}")).alias(c) for c in last]
    return joined.select(*out)


def asof_join(
    left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str, take: list[str],
    tie: list[str] | None = None,
) -> DataFrame:
    """For each left row, the columns `take` of the latest right row with right_time <= left_time.

    Both sides are laid on one time line and the last right row is carried forward, so no pair of
    rows is ever formed. `tie` orders left rows of equal time; right rows of one time must differ.
    """
    tie = tie or []
    value = F.struct(*[F.col(c).alias(c) for c in take])
    events = left.select(
        *by, F.col(left_time).alias("_t"), F.lit(1).alias("_side"), *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)],
        F.struct(*left.columns).alias("_left"),
    )
    marks = right.select(*by, F.col(right_time).alias("_t"), F.lit(0).alias("_side"), value.alias("_right"))
    line = events.unionByName(marks, allowMissingColumns=True)
    order = ["_t", "_side", *[f"_tie{i}" for i in range(len(tie))]]
    scanned = ordered_scan(line, by, order, last={"_known": F.col("_right")})
    return scanned.where("_side = 1").select("_left.*", *[F.col(f"_known.{c}").alias(c) for c in take])
