"""Search by embedding: exact, filtered, and approximate over an index of buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.vectors import buckets_of, cosine, sign_buckets, sign_planes

DEFAULT_K, MAX_K = 10, 1000


def check_search(topic: str, query, k: int) -> None:
    if not topic or not topic.strip():
        raise ValueError("the topic is blank")
    if query is None or len(query) == 0 or (isinstance(query, str) and not query.strip()):
        raise ValueError("the query is blank")
    if not 1 <= k <= MAX_K:
        raise ValueError("k is not from 1 to 1000")


def scored(records: DataFrame, query: list[float], embedding: str = "embedding") -> DataFrame:
    """Records with a score in place of the embedding; null where that is not usable."""
    return records.withColumn("score", cosine(F.col(embedding), query)).drop(embedding)


def top(records: DataFrame, k: int) -> DataFrame:
    """The k best by score. Each task keeps k rows, so only k per task are moved.

    Records without a score come last and go afterwards: a filter before would score everything twice.
    """
    return records.orderBy(F.desc_nulls_last("score"), "partition", "offset").limit(k).where("score IS NOT NULL")


def matching(records: DataFrame, filters: dict | None) -> DataFrame:
    """Records whose columns equal the given values; applied before ranking."""
    for column, wanted in (filters or {}).items():
        records = records.where(F.col(column).isNull() if wanted is None else F.col(column) == F.lit(wanted))
    return records


def semantic_search(
    records: DataFrame, topic: str, query: list[float], k: int = DEFAULT_K, filters: dict | None = None,
    embedding: str = "embedding",
) -> DataFrame:
    """The k records of a topic most like the query vector, best first."""
    check_search(topic, query, k)
    candidates = matching(records.where(F.col("topic") == topic), filters)
    return top(scored(candidates, query, embedding), k)


def search_total(records: DataFrame, topic: str, filters: dict | None = None) -> int:
    """How many records the search ranks among."""
    return matching(records.where(F.col("topic") == topic), filters).count()


class BucketIndex:
    """Records filed under the buckets their embedding falls into, one per table of sign hyperplanes.

    Stored by table and in bucket order: a search reads, per table, the row groups of the bucket its query
    falls into and scores only those records. More tables find more of the true neighbours; more bits read less.
    """

    def __init__(self, spark: SparkSession, path: str, dims: int, tables: int = 8, bits: int = 6):
        self.spark, self.path = spark, path
        self.dims, self.tables, self.bits = dims, tables, bits
        self.planes = sign_planes(dims, tables, bits)

    def filed(self, records: DataFrame, embedding: str = "embedding") -> DataFrame:
        buckets = sign_buckets(F.col(embedding), self.planes)
        return (
            records.withColumn("_buckets", buckets)
            .select("*", F.posexplode("_buckets").alias("tbl", "bucket"))
            .drop("_buckets")
        )

    def build(self, records: DataFrame, embedding: str = "embedding") -> "BucketIndex":
        # Range partitioning splits a bucket by hash wherever it is too full for one task; sorted files
        # let a search skip the row groups of other buckets.
        spread = F.xxhash64("partition", "offset")
        (
            self.filed(records, embedding)
            .withColumn("_spread", spread)
            .repartitionByRange("tbl", "bucket", "_spread")
            .sortWithinPartitions("tbl", "bucket")
            .drop("_spread")
            .write.mode("append").partitionBy("tbl").parquet(self.path)
        )
        self.schema = self.filed(records, embedding).schema
        return self

    def candidates(self, query: list[float], flips: int = 0) -> DataFrame:
        """Records in the query's bucket of some table, or in one that differs from it in at most `flips` bits."""
        import numpy as np

        found = buckets_of(np.asarray([query], dtype=float), self.planes)[0]
        masks = [m for m in range(1 << self.bits) if m.bit_count() <= flips]
        wanted = " OR ".join(f"(tbl = {t} AND bucket IN ({', '.join(str(int(b) ^ m) for m in masks)}))" for t, b in enumerate(found))
        return self.spark.read.schema(self.schema).parquet(self.path).where(wanted)

    def search(self, query: list[float], k: int = DEFAULT_K, filters: dict | None = None, embedding: str = "embedding", flips: int = 0) -> DataFrame:
        """The k best among all records that in some table share a bucket with the query, or are at most `flips` bits away."""
        check_search("index", query, k)
        close = matching(self.candidates(query, flips), filters)
        hits = scored(close.drop("tbl", "bucket"), query, embedding)
        # A record found in several tables has one score; copies are dropped among the best only:
        # the best k records fill at most k * tables rows.
        best = top(hits, k * self.tables)
        return top(best.dropDuplicates(["topic", "partition", "offset"]), k)
