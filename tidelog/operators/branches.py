"""Topic branches: forks of a topic (or of another branch) that share the records before the fork.

No record is copied. A branch is one row per partition, (branch_id, topic, name, parent_id, partition,
fork_offset, created_at_ms, state, metadata); its own records sit in a log under the branch's id and
begin at the fork offset. Reading a branch joins the base records to the forks on (source, partition).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions.text import not_blank
from tidelog.operators.ordered import same
from tidelog.session import store
from tidelog.sources.topic_log import TopicLog

ACTIVE, DISCARDED, MERGED = "active", "discarded", "merged"


def branch_check(requests: DataFrame, ends: DataFrame, branches: DataFrame | None = None) -> DataFrame:
    """Add branch_id, source and reason, why a request is rejected: blank, unknown source, exists or asked twice; else null.

    requests: topic, name and, if wished, parent_id, fork_offset (for every partition), base_offsets
    (map partition -> offset) and metadata. ends: see branch_create.
    """
    optional = {
        "parent_id": "string", "fork_offset": "bigint",
        "base_offsets": "map<int,bigint>", "metadata": "map<string,string>",
    }
    for column, kind in optional.items():
        if column not in requests.columns:
            requests = requests.withColumn(column, F.lit(None).cast(kind))
    named = requests.withColumns({"branch_id": F.concat_ws("/", "topic", "name"), "source": F.coalesce("parent_id", "topic")})
    known = ends.select(F.col("topic").alias("source"))
    if branches is not None:
        known = known.unionByName(branches.select(F.col("branch_id").alias("source")))
        taken = branches.select("branch_id").distinct().withColumn("_taken", F.lit(True))
    asked = named.groupBy("branch_id").agg(F.count("*").alias("_asked"))
    found = named.join(asked, "branch_id").join(known.distinct().withColumn("_known", F.lit(True)), "source", "left")
    found = found.join(taken, "branch_id", "left") if branches is not None else found.withColumn("_taken", F.lit(None).cast("boolean"))
    reason = (
        F.when(~(not_blank(F.col("topic")) & not_blank(F.col("name"))), "blank")
        .when(F.col("_known").isNull(), "unknown source")
        .when(F.col("_taken").isNotNull(), "exists")
        .when(F.col("_asked") > 1, "asked twice")
    )
    return found.withColumn("reason", reason).drop("_asked", "_known", "_taken")


def branch_create(requests: DataFrame, ends: DataFrame, created_at_ms: int, branches: DataFrame | None = None) -> DataFrame:
    """Rows of the branches table for the new branches that branch_check has nothing against.

    Without an offset the fork is where the topic, or the parent, ends now; a fork never lies beyond that end.
    ends: (topic, partition, end_offset) of the base topics and, under their ids, of branches that have records of their own.
    """
    own_ends = ends.select(F.col("topic").alias("source"), "partition", "end_offset")
    if branches is not None:
        forks = branches.select(F.col("branch_id").alias("source"), "partition", F.col("fork_offset").alias("end_offset"))
        own_ends = own_ends.unionByName(forks).groupBy("source", "partition").agg(F.max("end_offset").alias("end_offset"))
    asked = F.coalesce(F.try_element_at("base_offsets", "partition"), F.col("fork_offset"))
    return store(
        branch_check(requests, ends, branches).where("reason IS NULL")
        .join(own_ends, "source")
        .select(
            "branch_id", "topic", "name", "parent_id", "partition",
            F.least(F.coalesce(asked, F.col("end_offset")), F.col("end_offset")).alias("fork_offset"),
            F.lit(created_at_ms).cast("bigint").alias("created_at_ms"),
            F.lit(ACTIVE).alias("state"), "metadata",
        ),
        "branches",
    )


def branch_append(log: TopicLog, branches: DataFrame, branch_id: str, records: DataFrame, **options) -> DataFrame:
    """Append records (key, value, ...) to a branch only; its offsets go on from the fork."""
    forks = branches.where(F.col("branch_id") == branch_id).select(
        F.lit(branch_id).alias("topic"), "partition", F.col("fork_offset").alias("first_offset")
    )
    return log.append(records.withColumn("topic", F.lit(branch_id)), first_offsets=forks, check_names=False, **options)


def branch_lineage(branches: DataFrame) -> DataFrame:
    """(branch_id, source, depth, partition, upto): whose records each branch sees, below which offset.

    depth 0 is the branch itself, without a bound; then its parents and at last the topic, bounded by
    the lowest fork on the way. Every round doubles the length of the ways up that are known, so there are as many
    rounds as the longest way has binary digits; a branch that is its own ancestor is an error.
    """
    key = ["branch_id", "partition"]
    up = branches.select(*key, F.coalesce("parent_id", "topic").alias("source"), F.col("fork_offset").alias("upto"), F.lit(1).alias("depth"))
    rounds = 0
    jumps = store(up, "jumps")  # from each branch to what lies 2 ** rounds steps up, and the lowest fork on that way
    seen = store(
        branches.select(*key, F.col("branch_id").alias("source"), F.lit(0).alias("depth"), F.lit(None).cast("bigint").alias("upto")), "lineage"
    )
    roots = store(up.select(F.col("source").alias("branch_id"), "partition").join(branches.select(*key), key, "left_anti").distinct(), "roots")
    tops = roots.select(*key, F.col("branch_id").alias("source"), F.lit(0).alias("depth"), F.lit(None).cast("bigint").alias("upto"))
    names = branches.select("branch_id").distinct().count()
    while not jumps.isEmpty():
        if 1 << rounds > 2 * names:
            raise ValueError("a branch is its own ancestor")
        via = jumps.select("branch_id", "partition", F.col("source").alias("_via"), F.col("upto").alias("_upto"), F.col("depth").alias("_depth"))
        above = seen.unionByName(tops).select(F.col("branch_id").alias("_via"), "partition", "source", "depth", "upto")
        further = via.join(above, ["_via", "partition"]).select(
            *key, "source", (F.col("depth") + F.col("_depth")).alias("depth"), F.least("upto", "_upto").alias("upto")
        )
        onward = jumps.select(F.col("branch_id").alias("_via"), "partition", "source", "upto", "depth")
        longer = via.join(onward, ["_via", "partition"]).select(
            *key, "source", F.least("upto", "_upto").alias("upto"), (F.col("depth") + F.col("_depth")).alias("depth")
        )
        seen, jumps, rounds = store(seen.unionByName(further), "lineage"), store(longer, "jumps"), rounds + 1
    return seen.select("branch_id", "source", "depth", "partition", "upto")


def branch_discard(branches: DataFrame, changes: DataFrame) -> DataFrame:
    """Branches with their latest state; changes: (branch_id, state, changed_at)."""
    latest = changes.groupBy("branch_id").agg(F.max_by("state", "changed_at").alias("_state"))
    return (
        branches.join(latest, "branch_id", "left")
        .withColumn("state", F.coalesce("_state", "state"))
        .drop("_state")
    )


def branch_list(branches: DataFrame, own_records: DataFrame, topic: str | None = None) -> DataFrame:
    """One row per branch, with the number of its own messages."""
    if topic is not None:
        branches = branches.where(F.col("topic") == topic)
    counts = own_records.groupBy(F.col("topic").alias("branch_id")).agg(F.count("*").alias("n"))
    heads = branches.groupBy("branch_id", "topic", "name", "parent_id", "state", "created_at_ms").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("partition", "fork_offset")))).alias("base_offsets")
    )
    return heads.join(counts, "branch_id", "left").withColumn("message_count", F.coalesce("n", F.lit(0))).drop("n")


def branch_get(branches: DataFrame, own_records: DataFrame, branch_id: str) -> DataFrame:
    return branch_list(branches.where(F.col("branch_id") == branch_id), own_records.where(F.col("topic") == branch_id))


def branch_read(branches: DataFrame, base: DataFrame, own_records: DataFrame) -> DataFrame:
    """All records visible in each branch that is not discarded, with branch_id first.

    The records are scanned once and matched on (source, partition). The lineage has one row per
    branch, ancestor and partition; stored, it has a size by which the planner can broadcast it, which it
    could not guess for a recursion.
    """
    live = branches.where(F.col("state") != DISCARDED).select("branch_id").distinct()
    lineage = branch_lineage(branches).join(live, "branch_id", "left_semi")
    records = base.unionByName(own_records)
    seen = store(lineage.select("branch_id", F.col("source").alias("topic"), "partition", "upto"), "lineage")
    visible = seen["upto"].isNull() | (records["offset"] < seen["upto"])
    return records.join(seen, same(records, seen, ["topic", "partition"]) & visible).select(
        "branch_id", *[records[c] for c in records.columns if c != "topic"]
    )


def branch_messages(view: DataFrame, branch_id: str, limit: int | None = None) -> DataFrame:
    """Messages of one branch by partition and offset, as many as asked for."""
    rows = view.where(F.col("branch_id") == branch_id).orderBy("partition", "offset")
    return rows if limit is None else rows.limit(limit)


def branch_scan(base: TopicLog, own: TopicLog, branches: DataFrame, branch_id: str) -> DataFrame:
    """All records of one branch, with branch_id first: its lineage becomes bounds that reach the scans.

    The lineage of one branch has a row per ancestor and partition; these come to the driver.
    """
    here = F.col("branch_id") == branch_id
    gone = branches.where(here & (F.col("state") == DISCARDED)).take(1)
    lines = [] if gone else branch_lineage(branches).where(here).collect()
    ids = {r.branch_id for r in branches.select("branch_id").distinct().collect()} if lines else set()
    parts = None
    for source in sorted({r.source for r in lines}):
        bounds = [
            (F.col("partition") == r.partition) & (F.lit(True) if r.upto is None else F.col("offset") < r.upto) for r in lines if r.source == source
        ]
        records = (own if source in ids else base).scan(source).where(reduce(lambda a, b: a | b, bounds))
        parts = records if parts is None else parts.unionByName(records)
    if parts is None:
        parts = base.scan().limit(0)
    return parts.select(F.lit(branch_id).alias("branch_id"), *[c for c in parts.columns if c != "topic"])
