"""Agent memories: checking, filing into tiers, and recalling the best of each tier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.functions.text import not_blank, word_cosine, words
from tidelog.operators.ordered import ordered_scan
from tidelog.session import store

EPISODIC, SEMANTIC, PROCEDURAL = "episodic", "semantic", "procedural"

# Tiers a kind of memory is written to, and the ending of each tier's topic name (fixed values).
TIERS = {"observation": [EPISODIC], "fact": [EPISODIC, SEMANTIC], "procedure": [PROCEDURAL]}
ENDINGS = {EPISODIC: "-ep", SEMANTIC: "-sem", PROCEDURAL: "-proc"}
DEFAULT_K = 5


def memory_errors() -> Column:
    """What is wrong with a memory (agent_id, kind, content, salience, skill), as an array of texts."""
    kind, salience = F.col("kind"), F.col("salience")
    procedure = F.coalesce(kind == "procedure", F.lit(False))
    return F.array_compact(F.array(
        F.when(~not_blank(F.col("agent_id")), "agent_id is blank"),
        F.when(~not_blank(F.col("content")), "content is blank"),
        F.when(~F.coalesce(kind.isin(*TIERS), F.lit(False)), "unknown kind"),
        F.when(procedure & ~not_blank(F.col("skill")), "a procedure needs a skill"),
        F.when(salience.isNotNull() & (F.isnan("salience") | ~salience.between(0.0, 1.0)), "salience is not from 0 to 1"),
    ))


def validate_memories(entries: DataFrame) -> DataFrame:
    """Add valid and errors to each entry."""
    return entries.withColumn("errors", memory_errors()).withColumn("valid", F.size("errors") == 0)


def memory_remember(entries: DataFrame, arrival: list[str], stored: DataFrame | None = None) -> DataFrame:
    """File valid entries under their tiers' topics, with dense offsets per topic that go on from those in `stored`,
    what earlier calls have returned.

    Returns the new rows, which are the receipts, kept by tier and in topic order, so that a recall for one agent reads
    one folder per tier and few row groups of it.
    """
    valid = validate_memories(entries).where("valid").drop("valid", "errors")
    by_kind = F.create_map(*[x for kind, tiers in TIERS.items() for x in (F.lit(kind), F.array(*map(F.lit, tiers)))])
    ending = F.create_map(*[F.lit(x) for pair in ENDINGS.items() for x in pair])
    filed = (
        valid.withColumn("tier", F.explode(by_kind[F.col("kind")]))
        .withColumn("topic", F.concat("agent_id", ending[F.col("tier")]))
    )
    starts = None if stored is None else store(stored.groupBy("tier", "topic").agg((F.max("offset") + 1).alias("start")), "starts")
    numbered = ordered_scan(filed, ["tier", "topic"], arrival, number="offset", starts=starts)
    return store(numbered.sortWithinPartitions("tier", "topic", "offset"), "memories", ["tier"])


def memory_recall(
    memories: DataFrame,
    requests: DataFrame,
    k_episodic: int = 0,
    k_semantic: int = 0,
    scope: str = "agent_id",
    score: Column | None = None,
) -> DataFrame:
    """The best memories of the episodic and the semantic tier for each request; k of 0 is the default.

    requests: one row per `scope` value, with its query. scope is "agent_id", or "namespace" for
    memories shared by all agents of a namespace. score compares `content` with `query`; by default it
    is the cosine of their words, a query being split once and a memory's content once per request. The requests are
    stored, so the planner knows their size: it broadcasts them or, if they are many, sorts both sides and splits the
    memories of a busy agent.
    """
    asked = [scope, "query", words(F.col("query")).alias("_asked")] if score is None else [scope, "query"]
    requests = store(requests.where(not_blank(F.col(scope)) & not_blank(F.col("query"))).select(*asked), "requests")
    hits = memories.join(requests, scope)
    if score is None:
        hits = hits.withColumn("_told", words(F.col("content")))
        score = word_cosine(F.col("_told"), F.col("_asked"))
    hits = hits.withColumn("score", score).drop("query", "_asked", "_told")
    return best_of(hits, EPISODIC, scope, k_episodic or DEFAULT_K).unionByName(
        best_of(hits, SEMANTIC, scope, k_semantic or DEFAULT_K)
    )


def best_of(hits: DataFrame, tier: str, scope: str, k: int) -> DataFrame:
    """The k best hits of a tier per scope value; as k is a constant, each task first keeps its own k."""
    ranking = Window.partitionBy(scope).orderBy(F.desc("score"), "offset", "topic")
    tiered = hits.where(F.col("tier") == tier)
    return tiered.withColumn("place", F.row_number().over(ranking)).where(F.col("place") <= k)
