"""Checks made on records before they are appended."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.session import hadoop_path
from tidelog.sources.topic_log import TopicLog

DEFAULT_MAX_REQUEST_BYTES = 1024 * 1024


def record_size(key: str = "key", value: str = "value"):
    return F.coalesce(F.octet_length(key), F.lit(0)) + F.coalesce(F.octet_length(value), F.lit(0))


def reject_oversize(records: DataFrame, max_bytes: int = DEFAULT_MAX_REQUEST_BYTES) -> DataFrame:
    """Add size (bytes of key and value) and accepted; write the rows that are not to a dead-letter table."""
    return records.withColumn("size", record_size()).withColumn("accepted", F.col("size") <= max_bytes)


def first_sent(batch: DataFrame, ids: list[str], arrival: list[str]) -> DataFrame:
    """One row per id, the one that arrived first. Copies are folded before the shuffle."""
    row = F.struct(*batch.columns)
    return (
        batch.groupBy(*[F.col(c).alias(f"_id_{c}") for c in ids])
        .agg(F.min_by(row, F.struct(*arrival)).alias("_row"))
        .select("_row.*")
    )


def dedup_append(
    log: TopicLog, batch: DataFrame, ids: list[str], stored_ids: DataFrame, arrival: list[str], **options
) -> DataFrame:
    """Append what was not stored before: a record sent again, in this batch or earlier, is kept once.

    stored_ids: the ids of records the log already holds.
    """
    fresh = first_sent(batch, ids, arrival).join(stored_ids, ids, "left_anti")
    return log.append(fresh, arrival=arrival, **options)


class IdIndex:
    """The ids of all records of a log, in a table bucketed by them, so that a batch is checked without a shuffle of what is
    stored and without a scan of the log.

    ids: the names of the id's columns; of(records) gives them, beside `txn`, for records that the log holds.
    The table is made of committed appends only: whichever it does not have yet is read and added before a batch is checked, so
    a writer that dies after its append, or another one that does not know of the table, leaves nothing out. Ids that
    are added twice do no harm. All writers must use one number of buckets.
    Of ids with a null, equal ones in a batch are folded, but none is ever found in the table.
    """

    def __init__(self, log: TopicLog, ids: list[str], of: Callable[[DataFrame], DataFrame], buckets: int):
        self.log, self.ids, self.of, self.buckets = log, ids, of, buckets
        self.path = f"{log.root}/ids"
        self.name = "tidelog_ids_" + hashlib.md5(self.path.encode()).hexdigest()

    def table(self) -> DataFrame | None:
        """(txn, *ids) as a bucketed table, or None if nothing has been added."""
        spark = self.log.spark
        fs, path = hadoop_path(spark, self.path)
        if not fs.exists(path):
            return None
        if not spark.catalog.tableExists(self.name):  # the files are there, but this session's catalog does not know them
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(self.path).schema)
            spark.sql(f"CREATE TABLE {self.name} ({columns}) USING parquet CLUSTERED BY ({', '.join(self.ids)}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        spark.catalog.refreshTable(self.name)
        return spark.table(self.name)

    def catch_up(self) -> int:
        """Add the ids of the appends that have been committed since; return the log's version they go up to."""
        spark, version, known = self.log.spark, self.log.version(), self.table()
        new = self.log.appends().where(F.col("version") <= version)
        if known is not None:
            new = new.join(self._added(), "txn", "left_anti")
        txns = sorted(r.txn for r in new.select("txn").collect())  # appends since the last time
        if txns:
            rows = self.of(self.log.read_appends(txns)).select("txn", *self.ids).repartition(self.buckets, *self.ids)
            rows.write.mode("append").format("parquet").bucketBy(self.buckets, *self.ids).option("path", self.path).saveAsTable(self.name)
            spark.createDataFrame([(t,) for t in txns], "txn string").coalesce(1).write.mode("append").parquet(f"{self.path}-added")
        return version

    def _added(self) -> DataFrame:
        """The appends whose ids the table has: told after they were written, so an append may be added twice, but not left out."""
        path = f"{self.path}-added"
        fs, found = hadoop_path(self.log.spark, path)
        return self.log.spark.read.schema("txn string").parquet(path) if fs.exists(found) else self.log.spark.createDataFrame([], "txn string")

    def fresh(self, batch: DataFrame, arrival: list[str]) -> DataFrame:
        """The first of each id in the batch, if the table does not have it."""
        once, known = first_sent(batch, self.ids, arrival), self.table()
        return once if known is None else once.join(known, self.ids, "left_anti")

    def append(self, batch: DataFrame, arrival: list[str], **options) -> DataFrame:
        """Append what was not stored before, as dedup_append does. Should another writer commit meanwhile, it fails with
        ConcurrentAppend and can be tried again."""
        version = self.catch_up()
        return self.log.append(self.fresh(batch, arrival), arrival=arrival, at_version=version, **options)
