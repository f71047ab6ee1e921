"""The topic log: an append-only Parquet table with dense offsets per topic and partition.

    <root>/pending/txn=<id>/...                                 the records of an append that is being written
    <root>/entries/txn=<id>/*.parquet                           per topic and partition: the append's offsets
    <root>/commits/<version>.json                               which append the version consists of
    <root>/data/txn=<id>/topic=<name>/partition=<n>/*.parquet   the records of a committed append
    <root>/compact/txn=<id>/...                                 the same records in fewer files, for batch reads

An append is committed by creating the file of the next version, which must not be there yet; of two writers that began
at one version the second fails, whenever it comes. Only then its folder is moved to `data`, in one step; should the
writer die in between, whoever opens the log next moves it. So `data` holds committed records only, for streams as well.
The file system must create files exclusively and rename folders at once, as HDFS does.
"""

from __future__ import annotations

import json
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.names import topic_name_reason
from tidelog.functions.routing import hash_partition, route
from tidelog.operators.ordered import ordered_scan
from tidelog.session import hadoop_path, releasing, staging, store

HEADERS = T.MapType(T.StringType(), T.BinaryType())

MANIFEST = T.StructType([
    T.StructField("txn", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("first_offset", T.LongType()),
    T.StructField("end_offset", T.LongType()),
    T.StructField("records", T.LongType()),
    T.StructField("first_timestamp", T.LongType()),
    T.StructField("last_timestamp", T.LongType()),
    T.StructField("partitions", T.IntegerType()),  # of the topic: fixed by its first append
    T.StructField("routed", T.BooleanType()),  # by key alone, none by an explicit partition
])

COMMIT = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("txn", T.StringType()),
    T.StructField("folder", T.StringType()),
    T.StructField("replaces", T.ArrayType(T.StringType())),
])

# Parquet codec for each codec name a producer may set.
CODECS = {"none": "none", "gzip": "gzip", "snappy": "snappy", "lz4": "lz4", "zstd": "zstd"}

# Files a stream takes at once, if it does not say otherwise.
FILES_PER_TRIGGER = 1000


def record_schema(value_type: T.DataType | None = None) -> T.StructType:
    return T.StructType([
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", value_type or T.StringType()),
        T.StructField("headers", HEADERS),
        T.StructField("txn", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
    ])


class ConcurrentAppend(RuntimeError):
    """Another writer has published offsets since this append took its own."""


class TopicLog:
    COLUMNS = ["topic", "partition", "offset", "timestamp", "key", "value", "headers"]

    def __init__(self, spark: SparkSession, root: str, value_type: T.DataType | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = record_schema(value_type)

    # -- reading -------------------------------------------------------------------------------

    def _commits(self) -> DataFrame | None:
        """(version, txn, folder, replaces) of the commits in force, or None if there are none."""
        self._finish_moves()
        fs, path = hadoop_path(self.spark, f"{self.root}/commits")
        if not fs.exists(path):
            return None
        return self.spark.read.schema(COMMIT).json(f"{self.root}/commits/*.json")

    def _finish_moves(self) -> None:
        """Move committed appends out of `pending`, where a writer died before it did so."""
        fs, pending = hadoop_path(self.spark, f"{self.root}/pending")
        if not fs.exists(pending):
            return
        waiting = {f.getPath().getName().removeprefix("txn=") for f in fs.listStatus(pending)}
        if waiting:
            commits = self.spark.read.schema(COMMIT).json(f"{self.root}/commits/*.json") if fs.exists(hadoop_path(self.spark, f"{self.root}/commits")[1]) else None
            for row in commits.where(F.col("txn").isin(*waiting)).collect() if commits is not None else []:
                self._move(row.txn, row.folder)

    def _move(self, txn: str, folder: str) -> None:
        fs, source = hadoop_path(self.spark, f"{self.root}/pending/txn={txn}")
        fs.mkdirs(hadoop_path(self.spark, f"{self.root}/{folder}")[1])
        target = hadoop_path(self.spark, f"{self.root}/{folder}/txn={txn}")[1]
        if not fs.rename(source, target) and not fs.exists(target):  # another reader may have moved it
            raise RuntimeError(f"{source} could not be moved to {target}")

    def version(self) -> int:
        """The number of the last commit; 0 if there is none."""
        fs, path = hadoop_path(self.spark, f"{self.root}/commits")
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json")), default=0)

    def manifest(self) -> DataFrame:
        """One row per append, topic and partition; `folder` says where its records are."""
        commits = self._commits()
        if commits is None:
            return self.spark.createDataFrame([], T.StructType([*MANIFEST, T.StructField("folder", T.StringType())]))
        replaced = commits.select(F.explode("replaces").alias("txn"))
        current = commits.join(replaced, "txn", "left_anti").select("txn", "folder")
        return self.entries().join(current, "txn").select(*[f.name for f in MANIFEST], "folder")

    def entries(self) -> DataFrame:
        """The entries of all appends, committed or not."""
        return self.spark.read.schema(MANIFEST).parquet(f"{self.root}/entries")

    def topics(self) -> DataFrame:
        """(topic, partitions): the partition count that each topic's first append has fixed."""
        return self.manifest().groupBy("topic").agg(F.max("partitions").alias("partitions"))

    def scan(self, *topics: str, since: int | None = None) -> DataFrame:
        """Committed records of the topics (of all topics if none is named), pruned by folder; with `since`, those of that
        time or later, from the appends whose last record is.

        The folders are named to the reader, one per append and topic, just as Spark's own list of files would hold
        them; compact() keeps them few.
        """
        published = self.manifest()
        if topics:
            published = published.where(F.col("topic").isin(*topics))
        if since is not None:
            published = published.where(F.col("last_timestamp") >= since)
        folders = published.select("folder", "txn", "topic").distinct().collect()
        parts = None
        for folder in ("data", "compact"):
            paths = sorted(f"{self.root}/{folder}/txn={f.txn}/topic={escape(f.topic)}" for f in folders if f.folder == folder)
            if paths:
                reader = self.spark.read.schema(self.schema).option("basePath", f"{self.root}/{folder}")
                read = reader.parquet(*paths).select(*self.COLUMNS)
                if since is not None:
                    read = read.where(F.col("timestamp") >= since)
                parts = read if parts is None else parts.unionByName(read)
        return self.spark.createDataFrame([], self.schema).select(*self.COLUMNS) if parts is None else parts

    def appends(self) -> DataFrame:
        """(version, txn) of all committed appends, compacted since or not."""
        commits = self._commits()
        if commits is None:
            return self.spark.createDataFrame([], "version long, txn string")
        return commits.where(F.col("folder") == "data").select("version", "txn")

    def read_appends(self, txns: list[str], topic: str | None = None) -> DataFrame:
        """Records of single appends, with `txn`; of one topic, or of all."""
        inner = "" if topic is None else f"/topic={escape(topic)}"
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.root}/data")
        return reader.parquet(*[f"{self.root}/data/txn={txn}{inner}" for txn in txns]).select(*self.COLUMNS, "txn")

    def key_scan(self, topic: str, key: str) -> DataFrame:
        """A topic's records with the key. If all were routed by key, only the partition that it belongs to is read."""
        known = self.manifest().where(F.col("topic") == topic).agg(F.min("routed").alias("routed"), F.max("partitions").alias("n")).first()
        records = self.scan(topic).where(F.col("key") == key)
        if known.routed:
            records = records.where(F.col("partition") == hash_partition(F.lit(key), known.n))
        return records

    def end_offsets(self) -> DataFrame:
        """Next offset to be written, per topic and partition, from the manifest alone."""
        return self.manifest().groupBy("topic", "partition").agg(F.max("end_offset").alias("end_offset"))

    def describe(self) -> DataFrame:
        """What describe_topic finds out about each topic, from the manifest alone."""
        return self.manifest().groupBy("topic", "partition").agg(
            F.min("first_offset").alias("begin_offset"),
            F.max("end_offset").alias("end_offset"),
            F.sum("records").alias("records"),
            F.min("first_timestamp").alias("first_timestamp"),
            F.max("last_timestamp").alias("last_timestamp"),
        )

    def stream(self, topic: str, **options: str) -> DataFrame:
        """Committed records of a topic as a stream, a bounded number of files at a time."""
        self._finish_moves()
        reader = self.spark.readStream.schema(self.schema).option("basePath", f"{self.root}/data")
        for key, value in {"maxFilesPerTrigger": str(FILES_PER_TRIGGER), **options}.items():
            reader = reader.option(key, value)
        return reader.parquet(f"{self.root}/data/txn=*/topic={escape(topic)}").select(*self.COLUMNS)

    # -- writing -------------------------------------------------------------------------------

    def append(
        self,
        records: DataFrame,
        partitions: int | None = None,
        arrival: list[str] | None = None,
        first_offsets: DataFrame | None = None,
        compression: str = "snappy",
        check_names: bool = True,
        at_version: int | None = None,
    ) -> DataFrame:
        """Append records and return their receipts (topic, partition, offset, timestamp).

        records: topic, key, value and, if wished, headers, timestamp (epoch ms) and partition.
        partitions: how many a new topic has (1 if not said); for a known topic it must be what it has.
        arrival: columns that give the order of arrival; without them, the order of the input.
        first_offsets: (topic, partition, first_offset) for logs that do not begin at 0.
        check_names: refuse topic names that break the rules; branches have names of their own kind.
        at_version: the version that the records were chosen for; if the log has gone on since, the append fails.
        """
        txn, version = uuid.uuid4().hex, self.version() if at_version is None else at_version
        with staging(self.spark):
            counts = store(self.topics().withColumnRenamed("partitions", "_known"), "topics")
            ready = self._complete(records, counts, partitions, check_names)
            if not arrival:
                # Written down, as the order of the input need not be the same when it is computed again.
                arrival = ["_arrived"]
                ready = store(ready.withColumn("_arrived", F.monotonically_increasing_id()), "arrived")
            ends = self.end_offsets().select("topic", "partition", F.col("end_offset").alias("start"))
            if first_offsets is not None:
                given = first_offsets.select("topic", "partition", F.col("first_offset").alias("_given"))
                ends = given.join(ends, ["topic", "partition"], "full").select("topic", "partition", F.coalesce("start", "_given").alias("start"))
            placed = ordered_scan(ready, ["topic", "partition"], arrival, number="offset", starts=store(ends, "ends"))
            routed = "partition" not in records.columns
            entries = self._write(txn, placed, compression, counts, partitions, routed)
            if entries.isEmpty():
                return self.spark.createDataFrame([], self.schema).select("topic", "partition", "offset", "timestamp")
            self._publish(version + 1, txn)
        return self._folder("data", txn).select("topic", "partition", "offset", "timestamp")

    def _folder(self, folder: str, txn: str) -> DataFrame:
        body = T.StructType([f for f in self.schema if f.name != "txn"])
        return self.spark.read.schema(body).parquet(f"{self.root}/{folder}/txn={txn}")

    def _write(self, txn: str, placed: DataFrame, compression: str, counts: DataFrame, partitions: int | None, routed: bool) -> DataFrame:
        """Write the records of an append, pending, and its entries, which are returned."""
        ordered = placed.select("offset", "timestamp", "key", "value", "headers", "topic", "partition").sortWithinPartitions("topic", "partition", "offset")
        with releasing(placed.sparkSession):
            (
                ordered.write.partitionBy("topic", "partition")
                .option("compression", CODECS[compression])
                # Row groups hold many keys each, so their ranges say little about a key; bloom filters do.
                .option("parquet.bloom.filter.enabled#key", "true")
                .parquet(f"{self.root}/pending/txn={txn}")
            )
        totals = self._folder("pending", txn).groupBy("topic", "partition").agg(
            F.min("offset").alias("first_offset"),
            (F.max("offset") + 1).alias("end_offset"),
            F.count("*").alias("records"),
            F.min("timestamp").alias("first_timestamp"),
            F.max("timestamp").alias("last_timestamp"),
        )
        path = f"{self.root}/entries/txn={txn}"
        totals.join(counts, "topic", "left").withColumns({
            "partitions": F.coalesce("_known", F.lit(partitions or 1)), "routed": F.lit(routed),
        }).drop("_known").write.parquet(path)
        return self.spark.read.schema(T.StructType([f for f in MANIFEST if f.name != "txn"])).parquet(path)

    def _complete(self, records: DataFrame, counts: DataFrame, partitions: int | None, check_names: bool) -> DataFrame:
        has = set(records.columns)
        spread = F.to_json(F.struct(*[c for c in ("timestamp", "value", "headers") if c in has]))
        topic, known = F.col("topic"), F.col("_known")
        if check_names:
            reason = topic_name_reason(topic)
            topic = F.when(reason.isNull(), topic).otherwise(F.raise_error(F.concat(F.lit("topic name is "), reason)))
        if partitions is not None:
            text = F.concat(F.lit("the topic has another number of partitions: "), known.cast("string"))
            known = F.when(known.isNull() | (known == partitions), known).otherwise(F.raise_error(text))
        count = F.coalesce(known, F.lit(partitions or 1))
        added = {"partition": route(F.col("key"), count, F.col("partition") if "partition" in has else None, spread), "topic": topic}
        if "headers" not in has:
            added["headers"] = F.create_map().cast(HEADERS)
        if "timestamp" not in has:
            added["timestamp"] = F.unix_millis(F.current_timestamp())
        return records.join(counts, "topic", "left").withColumns(added).drop("_known")

    def _publish(self, version: int, txn: str, folder: str = "data", replaces: list[str] | None = None) -> None:
        """Commit an append as this version, or fail if the version is there; then let its records be seen."""
        fs, path = hadoop_path(self.spark, f"{self.root}/commits/{version:020d}.json")
        body = json.dumps({"version": version, "txn": txn, "folder": folder, "replaces": replaces or []}) + "\n"
        try:
            out = fs.create(path, False)
        except Py4JJavaError as error:
            if not fs.exists(path):
                raise
            for own in (f"pending/txn={txn}", f"entries/txn={txn}"):
                fs.delete(hadoop_path(self.spark, f"{self.root}/{own}")[1], True)
            raise ConcurrentAppend(f"another writer has committed version {version} of {self.root}") from error
        out.write(bytearray(body.encode()))
        out.close()
        self._move(txn, folder)

    def compact(self) -> None:
        """Write the records of all appends once more, in one folder, for batch reads. Streams go on with the appends."""
        txn, version = uuid.uuid4().hex, self.version()
        manifest = self.manifest()
        appends = [r.txn for r in manifest.select("txn").distinct().collect()]
        if len(appends) > 1:
            with staging(self.spark):
                kept = manifest.groupBy("topic").agg(F.max("partitions").alias("_known"), F.min("routed").alias("_routed"))
                counts = store(kept.select("topic", "_known"), "topics")
                routed = not kept.where(~F.col("_routed")).take(1)
                self._write(txn, self.scan().repartitionByRange("topic", "partition", "offset"), "snappy", counts, None, routed)
                self._publish(version + 1, txn, "compact", appends)

    def transaction(self, **options) -> "Transaction":
        return Transaction(self, options)


class Transaction:
    """Records for any number of topics that are appended together or not at all."""

    def __init__(self, log: TopicLog, options: dict):
        self.log = log
        self.options = options
        self.buffer: list[DataFrame] = []
        self.open = True

    def send(self, records: DataFrame) -> "Transaction":
        if not self.open:
            raise RuntimeError("the transaction has ended")
        self.buffer.append(records)
        return self

    def commit(self) -> DataFrame | None:
        """Publish all that was sent; an empty transaction publishes nothing and is fine."""
        if not self.open:
            raise RuntimeError("the transaction has ended")
        if not self.buffer:
            self.open = False
            return None
        records = self.buffer[0]
        for more in self.buffer[1:]:
            records = records.unionByName(more, allowMissingColumns=True)
        receipts = self.log.append(records, **self.options)
        self.open = False
        self.buffer = []
        return receipts

    flush = commit

    def abort(self) -> None:
        self.open = False
        self.buffer = []


def escape(topic: str) -> str:
    """A topic's folder name, as the Parquet writer spells it."""
    from urllib.parse import quote

    # The characters Spark escapes in partition folder names, beside control characters.
    special = "\"#%'*/:=?\\{[]^"
    return "".join(quote(c, safe="") if c in special or ord(c) < 32 or ord(c) == 127 else c for c in topic)
