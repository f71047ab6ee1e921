"""Search and agent memory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.routing import hash_partition
from tidelog.operators import memory
from tidelog.operators import search as s
from tidelog.operators.ann import CodeIndex, few_read
from tidelog.operators.ordered import ordered_scan
from tidelog.plans.inputs import PARTITIONS, once, table
from tidelog.plans.metrics import ENTRIES, memory_entries
from tidelog.plans.registry import hashed, query
from tidelog.session import store

DIMS = 64


@once
def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic `vectors`: one record per embedding, keyed by its id."""
    key = F.col("vec_id").cast("string")
    rows = table(spark, sf_dir, "embeddings").select(
        F.lit("vectors").alias("topic"), hash_partition(key, PARTITIONS).alias("partition"), key.alias("key"),
        "vec_id", "label", "embedding",
    )
    return store(ordered_scan(rows, ["partition"], ["vec_id"], number="offset").drop("vec_id"), "vectors", ["partition"])


def query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """The embedding that is looked for: that of id 0."""
    return [float(x) for x in table(spark, sf_dir, "embeddings").where("vec_id = 0").first().embedding]


VECTORS = f"""
vectors AS (
  SELECT *, row_number() OVER (PARTITION BY "partition" ORDER BY vec_id) - 1 AS "offset"
  FROM (SELECT {hashed('CAST(vec_id AS VARCHAR)')} AS "partition", CAST(vec_id AS VARCHAR) AS "key", vec_id, label,
               CAST(embedding AS DOUBLE[]) AS embedding FROM embeddings)),
wanted AS (SELECT CAST(embedding AS DOUBLE[]) AS q FROM embeddings WHERE vec_id = 0),
scored AS (SELECT v.*, list_cosine_similarity(embedding, q) AS score FROM vectors v, wanted)"""
BEST = 'SELECT "partition", "offset", "key", label, round(score, 6) AS score FROM'
ORDER = 'ORDER BY score DESC, "partition", "offset" LIMIT 10'


def hits(found: DataFrame) -> DataFrame:
    return found.select("partition", "offset", "key", "label", F.round("score", 6).alias("score"))


@query("semantic_search", f"WITH {VECTORS} {BEST} (SELECT * FROM scored {ORDER})")
def semantic_search(spark, sf_dir):
    return hits(s.semantic_search(vectors(spark, sf_dir), "vectors", query_vector(spark, sf_dir)))


@query("search_filtered", f"WITH {VECTORS} {BEST} (SELECT * FROM scored WHERE label = 3 {ORDER})")
def search_filtered(spark, sf_dir):
    return hits(s.semantic_search(vectors(spark, sf_dir), "vectors", query_vector(spark, sf_dir), filters={"label": 3}))


@once
def code_index(spark: SparkSession, sf_dir: str) -> CodeIndex:
    return CodeIndex(spark, vectors(spark, sf_dir), DIMS)


ASKED = 100  # every row whose id this divides is a query


@query("semantic_search_ann", f"""
WITH {VECTORS.replace("wanted AS (SELECT", "wanted AS (SELECT vec_id AS query_id,").replace("vec_id = 0", f"vec_id % {ASKED} = 0").replace("v.*,", "v.*, query_id,")},
placed AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, "partition", "offset") AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS place, "partition", "offset", round(score, 6) AS score, true AS recall_is_enough, true AS few_are_read
FROM placed WHERE place <= 10
""")
def semantic_search_ann(spark, sf_dir):
    """Every embedding whose id is divisible by 100, looked up among all; the SQL scores all pairs. Recall@10 against brute
    force must be 0.9 at least, and less than a third of the records be scored exactly."""
    index = code_index(spark, sf_dir)
    asked = store(table(spark, sf_dir, "embeddings").where(F.col("vec_id") % ASKED == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("q")), "queries")
    hits = store(index.search(asked, vector_col="q"), "hits")
    enough = index.recall(hits, asked) >= 0.9
    return hits.select(
        "query_id", "place", "partition", "offset", F.round("score", 6).alias("score"),
        F.lit(enough).alias("recall_is_enough"), few_read(index.scored, asked.count(), index.rows).alias("few_are_read"),
    )


# -- memory -----------------------------------------------------------------------------------------


@once
def memories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filed in two calls: the first turns, then all others."""
    entries = memory_entries(spark, sf_dir)
    first = memory.memory_remember(entries.where("turn < 2"), ["turn"])
    return first.unionByName(memory.memory_remember(entries.where("turn >= 2"), ["turn"], first))


FILED = f"""
{ENTRIES},
filed AS (
  SELECT agent_id, namespace, kind, turn, content, tier, agent_id || ending AS topic,
         row_number() OVER (PARTITION BY agent_id, tier ORDER BY turn) - 1 AS "offset"
  FROM checked JOIN (VALUES ('observation', 'episodic', '-ep'), ('fact', 'episodic', '-ep'), ('fact', 'semantic', '-sem'),
                            ('procedure', 'procedural', '-proc')) tiers(kind, tier, ending) USING (kind)
  WHERE problems = ''),
told AS (SELECT *, list_filter(list_distinct(string_split(regexp_replace(lower(content), '[\\s[:punct:]]+', ' ', 'g'), ' ')),
                               lambda w: w <> '') AS words FROM filed)"""


@query("memory_remember", f'WITH {FILED} SELECT agent_id, kind, turn, tier, topic, "offset" FROM filed')
def memory_remember(spark, sf_dir):
    return memories(spark, sf_dir).select("agent_id", "kind", "turn", "tier", "topic", "offset")


def recall_sql(scope: str, asked: str) -> str:
    return f"""
WITH {FILED},
asked AS ({asked}),
ranked AS (
  SELECT t.*, qwords, len(list_intersect(words, qwords)) AS shared,
         CASE WHEN len(words) * len(qwords) > 0
              THEN CAST(len(list_intersect(words, qwords)) AS DOUBLE) / sqrt(CAST(len(words) * len(qwords) AS DOUBLE)) ELSE 0 END AS score
  FROM told t JOIN (SELECT {scope}, list_filter(list_distinct(string_split(regexp_replace(lower(query), '[\\s[:punct:]]+', ' ', 'g'), ' ')),
                               lambda w: w <> '') AS qwords FROM asked WHERE regexp_matches(query, '\\S')) q USING ({scope})
  WHERE tier IN ('episodic', 'semantic')),
placed AS (SELECT *, row_number() OVER (PARTITION BY {scope}, tier ORDER BY score DESC, "offset", topic) AS place FROM ranked)
SELECT {scope}, tier, topic, "offset", CAST(place AS INTEGER) AS place, round(score, 6) AS score FROM placed WHERE place <= 5
"""


def recalled(found: DataFrame, scope: str) -> DataFrame:
    return found.select(scope, "tier", "topic", "offset", "place", F.round("score", 6).alias("score"))


@query("memory_recall", recall_sql("agent_id", "SELECT 'agent-' || conv_id AS agent_id, text AS query FROM conversations WHERE turn = 0"))
def memory_recall(spark, sf_dir):
    """Every agent asks with the text of its first turn."""
    asked = table(spark, sf_dir, "conversations").where("turn = 0").select(
        F.concat(F.lit("agent-"), F.col("conv_id")).alias("agent_id"), F.col("text").alias("query")
    )
    return recalled(memory.memory_recall(memories(spark, sf_dir), asked), "agent_id")


@query("memory_recall_shared", recall_sql("namespace", """
SELECT 'team-' || (conv_id % 7) AS namespace, min_by(text, conv_id) AS query FROM conversations WHERE turn = 0 GROUP BY conv_id % 7"""))
def memory_recall_shared(spark, sf_dir):
    """Every team asks with the first turn of its first conversation, over the memories of all its agents."""
    first = table(spark, sf_dir, "conversations").where("turn = 0")
    asked = first.groupBy(F.concat(F.lit("team-"), F.col("conv_id") % 7).alias("namespace")).agg(
        F.min_by("text", "conv_id").alias("query")
    )
    return recalled(memory.memory_recall(memories(spark, sf_dir), asked, scope="namespace"), "namespace")
