"""Search of many vectors at once in an inverted file with product-quantized residuals.

Every record is filed under its nearest coarse centroid and kept there as one byte per group of dimensions: the nearest
of up to 256 residuals of that group. A search reads codes of the lists that may hold hits, scores them through what the
codes stand for, and scores the best of each query exactly, on the vectors themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.functions.vectors import cosine_pair, matrix
from tidelog.operators.search import DEFAULT_K, check_search
from tidelog.session import store

SAMPLE = 16_384  # records that centroids and codes are fitted on at most, those of the least hashes
GROUP = 4  # dimensions to a byte
ROUNDS = 10  # of k-means
DEPTH = 12  # records scored exactly, per wanted hit
ROWS, QUERIES = 16_384, 1_024  # of a block that one call scores


def unit(x: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(size > 0, size, 1)


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (np.einsum("ij,ij->i", centres, centres) - 2 * x @ centres.T).argmin(axis=1)


def k_means(x: np.ndarray, k: int) -> np.ndarray:
    """At most k centres of x, from rows spread evenly over it; ties go to the first centre, so the same x gives the same."""
    centres = np.unique(x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)], axis=0)
    for _ in range(ROUNDS):
        near = nearest(x, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


class Codec:
    """Centroids and code books fitted on a sample of unit vectors, and how far both are from what they stand for."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.sample, self.dims = sample, sample.shape[1]
        self.centres = k_means(sample, lists)
        near = nearest(sample, self.centres)
        residuals = sample - self.centres[near]
        self.cuts = list(range(0, self.dims, GROUP))
        self.books = [k_means(residuals[:, at:at + GROUP], 256) for at in self.cuts]
        missed = sample - self.decode(near, self.encode(sample, near))
        self.spread = self._typical(residuals, near)
        self.error = self._typical(missed, near)

    def _typical(self, off: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Per list, the root mean square of what a residual adds in one direction; of all lists where the sample has no row."""
        squares = np.einsum("ij,ij->i", off, off)
        count = np.bincount(near, minlength=len(self.centres))
        sums = np.bincount(near, weights=squares, minlength=len(self.centres))
        return np.sqrt(np.where(count > 0, sums / np.maximum(count, 1), squares.mean()) / self.dims)

    def encode(self, x: np.ndarray, near: np.ndarray) -> np.ndarray:
        residuals = x - self.centres[near]
        return np.stack([nearest(residuals[:, at:at + GROUP], book) for at, book in zip(self.cuts, self.books)], axis=1).astype(np.uint8)

    def decode(self, near: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return self.centres[near] + np.hstack([book[codes[:, i]] for i, book in enumerate(self.books)])

    def lists_for(self, queries: np.ndarray, k: int, rows: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per query the lists to look into, and the least coded score worth a look there.

        The sample tells which score the k-th best of all rows will about have. A list is left out if its centroid's score
        lies below that by more than what the largest of `rows` normal deviates would add to it.
        """
        far = sqrt(2 * log(max(rows, 2))) + 1
        rank = min(ceil(k * len(self.sample) / max(rows, 1)), len(self.sample))
        for q in queries:
            bar = np.partition(self.sample @ q, -rank)[-rank]
            centre = self.centres @ q
            wanted = np.flatnonzero((centre + far * self.spread >= bar) | (centre == centre.max()))
            yield wanted, bar - far * self.error[wanted]


class CodeIndex:
    """Codes of all records (partition, offset, embedding), in the order of their lists, beside the records themselves."""

    def __init__(self, spark: SparkSession, records: DataFrame, dims: int, lists: int | None = None, embedding: str = "embedding"):
        self.spark, self.dims, self.embedding = spark, dims, embedding
        self.records = records.select("partition", "offset", F.col(embedding).alias("embedding")).where(F.size("embedding") == dims)
        order = F.xxhash64("partition", "offset")
        drawn = self.records.select("embedding", order.alias("h"), "partition", "offset").orderBy("h", "partition", "offset").limit(SAMPLE)
        _, sample = matrix(drawn.select("embedding").toArrow()["embedding"].combine_chunks(), dims) if dims else (None, np.zeros((0, 0)))
        self.codec = Codec(unit(sample), lists or max(1, round(sqrt(len(sample)) / 2))) if len(sample) else None
        self.codes = store(self._filed(), "codes") if self.codec else None
        self.sizes = {r["list"]: r["count"] for r in self.codes.groupBy("list").count().collect()} if self.codec else {}
        self.rows = sum(self.sizes.values())

    def _filed(self) -> DataFrame:
        codec = self.spark.sparkContext.broadcast(self.codec)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                usable, x = matrix(batch.column(2), codec.value.dims)
                size = np.linalg.norm(x, axis=1)
                good = np.isfinite(size) & (size > 0)
                keep = pa.array(np.flatnonzero(usable)[good])
                near = nearest(unit(x[good]), codec.value.centres)
                codes = codec.value.encode(unit(x[good]), near)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near, pa.int32()), batch.column(0).take(keep), batch.column(1).take(keep), pa.array([c.tobytes() for c in codes], pa.binary())],
                    ["list", "partition", "offset", "code"],
                )

        filed = self.records.select(F.col("partition").cast("int"), "offset", "embedding").mapInArrow(task, "list int, partition int, offset long, code binary")
        spread = F.xxhash64("partition", "offset")
        return filed.withColumn("spread", spread).repartitionByRange("list", "spread").sortWithinPartitions("list", "spread").drop("spread")

    def _blocks(self, counts: dict[int, int], size: int, name: str) -> DataFrame:
        rows = [(at, ceil(count / size)) for at, count in sorted(counts.items())]
        return self.spark.createDataFrame(rows, f"list int, {name} int")

    def _routed(self, queries: DataFrame, k: int) -> DataFrame:
        """queries (query_id, q) once per list that they look into, with the least score worth a look."""
        codec, rows = self.spark.sparkContext.broadcast(self.codec), self.rows
        kind = queries.schema["query_id"].dataType.simpleString()

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                usable, x = matrix(batch.column(1), codec.value.dims)
                found = list(codec.value.lists_for(unit(x), k, rows))
                places = np.repeat(np.flatnonzero(usable), [len(w) for w, _ in found])
                if len(places):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.concatenate([w for w, _ in found]), pa.int32()), batch.column(0).take(pa.array(places)),
                        batch.column(1).take(pa.array(places)), pa.array(np.concatenate([b for _, b in found]), pa.float64()),
                    ], ["list", "query_id", "q", "bar"])

        return queries.mapInArrow(task, f"list int, query_id {kind}, q array<double>, bar double")

    def candidates(self, queries: DataFrame, k: int) -> DataFrame:
        """(query_id, partition, offset, coded): of each query (query_id, q) the DEPTH * k records of the best coded scores.

        Lists meet the queries that look into them in blocks of ROWS by QUERIES, so neither a full list nor one that all
        queries look into fills a task; a block gives at most DEPTH * k records to a query.
        """
        codec, keep = self.spark.sparkContext.broadcast(self.codec), DEPTH * k
        routed = store(self._routed(queries, k), "routed")
        asked = {r["list"]: r["count"] for r in routed.groupBy("list").count().collect()}
        chunks, groups = self._blocks(self.sizes, ROWS, "chunks"), self._blocks(asked, QUERIES, "groups")
        rows = self.codes.join(chunks, "list").join(groups, "list").withColumn("chunk", F.pmod(F.xxhash64("partition", "offset"), "chunks").cast("int"))
        rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).select("list", "chunk", "part", "partition", "offset", "code")
        wanted = routed.join(chunks, "list").join(groups, "list").withColumn("part", F.pmod(F.xxhash64("query_id"), "groups").cast("int"))
        wanted = wanted.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("list", "chunk", "part", "query_id", "q", "bar")
        kind = queries.schema["query_id"].dataType.simpleString()

        def task(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            model, ids, places, scores = codec.value, [], [], []
            if left.num_rows and right.num_rows:
                codes = np.frombuffer(b"".join(left["code"].to_pylist()), np.uint8).reshape(left.num_rows, -1)
                x = model.decode(np.full(left.num_rows, key[0].as_py()), codes)
                _, q = matrix(right["q"].combine_chunks(), model.dims)
                bars = right["bar"].to_numpy()
                told = unit(q) @ x.T
                for i, row in enumerate(told):
                    found = np.flatnonzero(row >= bars[i])
                    if len(found) > keep:
                        found = found[np.argpartition(-row[found], keep - 1)[:keep]]
                    ids.append(np.full(len(found), i))
                    places.append(found)
                    scores.append(row[found])
            flat = pa.array(np.concatenate(places) if places else np.zeros(0, np.int64))
            of = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int64))
            return pa.Table.from_arrays([
                right["query_id"].take(of), left["partition"].take(flat), left["offset"].take(flat), pa.array(np.concatenate(scores) if scores else np.zeros(0)),
            ], ["query_id", "partition", "offset", "coded"])

        keys = ["list", "chunk", "part"]
        found = rows.groupBy(*keys).cogroup(wanted.groupBy(*keys)).applyInArrow(task, f"query_id {kind}, partition int, offset long, coded double")
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("coded"), "partition", "offset"))
        return found.withColumn("place", place).where(F.col("place") <= keep).drop("place")

    def search(self, queries: DataFrame, k: int = DEFAULT_K, id_col: str = "query_id", vector_col: str = "embedding") -> DataFrame:
        """(id_col, place, partition, offset, score): the k best records of every query, scored exactly, best first.

        A query whose vector is null, zero or of another length finds nothing; so does any query of an empty index.
        """
        check_search("index", [0.0], k)
        kind = queries.schema[id_col].dataType.simpleString()
        if self.codec is None:
            return self.spark.createDataFrame([], f"`{id_col}` {kind}, place int, partition int, offset long, score double")
        asked = queries.select(F.col(id_col).alias("query_id"), F.col(vector_col).cast("array<double>").alias("q"))
        asked = store(asked.where((F.size("q") == self.dims) & F.exists("q", lambda c: c != 0)), "asked")
        self.scored = store(self.candidates(asked, k), "candidates")
        pairs = self.scored.join(self.records, ["partition", "offset"]).join(asked, "query_id")
        return ranked(pairs.withColumn("score", cosine_pair(F.col("embedding"), F.col("q"))), k).withColumnRenamed("query_id", id_col)

    def brute(self, queries: DataFrame, k: int = DEFAULT_K) -> DataFrame:
        """The same by scoring every record for every query (query_id, q); for so many queries as one matrix may hold."""
        rows = queries.toArrow()
        _, q = matrix(rows["q"].combine_chunks(), self.dims)
        shared = self.spark.sparkContext.broadcast((rows["query_id"], unit(q)))
        kind = queries.schema["query_id"].dataType.simpleString()

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, q = shared.value
            for batch in batches:
                usable, x = matrix(batch.column(2), q.shape[1])
                told = unit(x) @ q.T
                best = np.argsort(-told, axis=0, kind="stable")[:k].T
                places = pa.array(np.flatnonzero(usable)[best.ravel()])
                of = pa.array(np.repeat(np.arange(len(q)), best.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [ids.take(of).combine_chunks(), batch.column(0).take(places), batch.column(1).take(places), pa.array(np.take_along_axis(told.T, best, 1).ravel())],
                    ["query_id", "partition", "offset", "score"],
                )

        found = self.records.select(F.col("partition").cast("int"), "offset", "embedding").mapInArrow(task, f"query_id {kind}, partition int, offset long, score double")
        return ranked(found, k)

    def recall(self, hits: DataFrame, queries: DataFrame, k: int = DEFAULT_K, most: int = 256) -> float:
        """The share of true hits that hits has, over at most `most` queries (query_id, q), those of the least hashes."""
        some = store(queries.orderBy(F.xxhash64("query_id"), "query_id").limit(most), "some")
        truth = self.brute(some, k).select("query_id", "partition", "offset")
        found = truth.join(hits.select("query_id", "partition", "offset", F.lit(1).alias("hit")), ["query_id", "partition", "offset"], "left")
        return found.agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0] or 0.0


def ranked(scored: DataFrame, k: int) -> DataFrame:
    """(query_id, place, partition, offset, score) of the k best of each query."""
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "partition", "offset"))
    best = scored.where(F.col("score").isNotNull()).withColumn("place", place).where(F.col("place") <= k)
    return best.select("query_id", "place", F.col("partition").cast("int").alias("partition"), "offset", "score")


def few_read(scored: DataFrame, queries: int, rows: int) -> Column:
    """Whether less than a third of the records were scored exactly, on average over the queries."""
    return F.lit(3 * scored.count() < queries * rows)
