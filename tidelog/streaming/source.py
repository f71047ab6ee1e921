"""A topic as a stream with an offset per partition: where to start, how much to take at once, where to go on.

    spark.readStream.format("tidelog").option("root", log.root).option("topic", "events")
        .option("startingOffsets", '{"0": 100, "3": -1}')      # or earliest, latest; partitions not named: earliest
        .option("startingTimestamp", "1705276800000")          # instead: from the first record of that time or later
        .option("maxRecordsPerBatch", "100000")

A batch is one gapless range of offsets per partition, so a position is always the end of what has been read. The driver
reads the commits and entries it has not seen yet, never records (but for a starting timestamp, one column of one append
per partition); tasks take ranges of at most RECORDS offsets and hand on Arrow batches of at most BATCH records, reading
BUFFER bytes of a column at a time and only the columns of the schema that is asked for. Paths are those that PyArrow's
file systems open.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidelog.sources.topic_log import TopicLog, escape

BEGINNING, END = 0, -1
RECORDS = 500_000  # offsets that a task reads at most
BATCH = 8_192  # records that a task holds at once
BUFFER = 1 << 20  # bytes of a column chunk that a task holds at once; without it, whole chunks
SCHEMA = "topic string, partition int, offset long, timestamp long, key string, value string, headers map<string, binary>"


@dataclass
class Range(InputPartition):
    """Offsets from first to before end of one partition, all of one append."""

    txn: str
    partition: int
    first: int
    end: int


class Folder:
    """The files of a log as PyArrow opens them."""

    def __init__(self, root: str):
        self.fs, path = arrow_fs.FileSystem.from_uri(root)
        self.path = path.rstrip("/")

    def names(self, at: str) -> list[str]:
        found = self.fs.get_file_info(arrow_fs.FileSelector(f"{self.path}/{at}", allow_not_found=True))
        return sorted(f.base_name for f in found)

    def files(self, at: str) -> list[str]:
        return [f"{self.path}/{at}/{name}" for name in self.names(at) if name.endswith(".parquet")]

    def text(self, at: str) -> str:
        with self.fs.open_input_stream(f"{self.path}/{at}") as stream:
            return stream.read().decode()

    def groups(self, file: str, column: str, low: int, high: int) -> tuple[pq.ParquetFile, list[int]]:
        """A file and those of its row groups that may hold a value of column from low to high."""
        opened = pq.ParquetFile(file, filesystem=self.fs, buffer_size=BUFFER)
        index = opened.schema_arrow.get_field_index(column)
        hit = []
        for group in range(opened.metadata.num_row_groups):
            known = opened.metadata.row_group(group).column(index).statistics
            if known is None or not known.has_min_max or (known.max >= low and known.min <= high):
                hit.append(group)
        return opened, hit

    def partition(self, txn: str, topic: str, partition: int) -> list[str]:
        """An append's files of a partition; its folder may not have been moved yet by the writer that has committed it."""
        inner = f"txn={txn}/topic={escape(topic)}/partition={partition}"
        return self.files(f"data/{inner}") or self.files(f"pending/{inner}")


class Entries:
    """What each append has added to the partitions of a topic, in order; read once per commit."""

    def __init__(self, folder: Folder, topic: str):
        self.folder, self.topic = folder, topic
        self.seen = ""
        self.by_partition: dict[int, list[tuple[int, int, int, str]]] = {}  # (first, end, last timestamp, txn)

    def refresh(self) -> "Entries":
        for name in self.folder.names("commits"):
            if name.endswith(".json") and name > self.seen:
                commit = json.loads(self.folder.text(f"commits/{name}"))
                if commit["folder"] == "data":  # a compaction adds no records
                    self._add(commit["txn"])
                self.seen = name
        return self

    def _add(self, txn: str) -> None:
        wanted = ["topic", "partition", "first_offset", "end_offset", "last_timestamp"]
        for file in self.folder.files(f"entries/txn={txn}"):
            for row in pq.read_table(file, columns=wanted, filesystem=self.folder.fs, filters=[("topic", "=", self.topic)], partitioning=None).to_pylist():
                entry = (row["first_offset"], row["end_offset"], row["last_timestamp"], txn)
                self.by_partition.setdefault(row["partition"], []).append(entry)
                self.by_partition[row["partition"]].sort()

    def ends(self) -> dict[int, int]:
        return {p: entries[-1][1] for p, entries in sorted(self.by_partition.items())}

    def begins(self) -> dict[int, int]:
        return {p: entries[0][0] for p, entries in sorted(self.by_partition.items())}

    def first_since(self, partition: int, timestamp: int) -> int:
        """The first offset of a partition whose record is of that time or later; the end if there is none."""
        for first, end, last, txn in self.by_partition[partition]:
            if last >= timestamp:
                found = []
                for file in self.folder.partition(txn, self.topic, partition):
                    opened, groups = self.folder.groups(file, "timestamp", timestamp, (1 << 63) - 1)
                    for batch in opened.iter_batches(BATCH, columns=["offset", "timestamp"], row_groups=groups, use_threads=False):
                        found += [o for o, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if t >= timestamp][:1]
                return min(found, default=end)
        return self.ends()[partition]


class TopicReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str], names: list[str] = TopicLog.COLUMNS):
        self.topic, self.root, self.names = options["topic"], options["root"], list(names)
        self.most = int(options["maxrecordsperbatch"]) if options.get("maxrecordsperbatch") else None
        self.starting = options.get("startingoffsets", "earliest")
        self.since = int(options["startingtimestamp"]) if options.get("startingtimestamp") else None
        if self.most is not None and self.most < 1:
            raise ValueError("maxRecordsPerBatch must be 1 or more")
        if self.since is not None and "startingoffsets" in options:
            raise ValueError("give startingOffsets or startingTimestamp, not both")
        self.asked = {} if self.starting in ("earliest", "latest") else {int(p): int(o) for p, o in json.loads(self.starting).items()}
        self.entries: Entries | None = None
        self.position: dict[str, int] | None = None

    def _known(self) -> Entries:
        self.entries = self.entries or Entries(Folder(self.root), self.topic)
        return self.entries.refresh()

    def _start(self, entries: Entries, partition: int) -> int:
        """Where a partition is begun that the stream has no position in."""
        if self.since is not None:
            return entries.first_since(partition, self.since)
        start = self.asked.get(partition, END if self.starting == "latest" else BEGINNING)
        return entries.ends()[partition] if start == END else max(start, entries.begins()[partition])

    def initialOffset(self) -> dict:
        entries = self._known()
        return {str(p): self._start(entries, p) for p in entries.ends()}

    def latestOffset(self) -> dict:
        """The position after the next batch: each partition goes on by its share of the bound, or to its end. A bound below
        the number of partitions is spent on those with most left."""
        entries = self._known()
        if self.position is None:
            self.position = self.initialOffset()
        ends = entries.ends()
        # Partitions that came after the start are read from their beginning, or from the asked time on.
        new = {str(p): entries.begins()[p] if self.since is None else self._start(entries, p) for p in ends if str(p) not in self.position}
        at = {**self.position, **new}
        left = {p: max(0, ends[p] - at[str(p)]) for p in ends}
        if self.most is None:
            take = left
        else:
            share = self.most // max(len(ends), 1)
            lucky = sorted(ends, key=lambda p: (-left[p], p))[:self.most]
            take = {p: min(left[p], share) if share else int(p in lucky and left[p] > 0) for p in ends}
        return {**at, **{str(p): at[str(p)] + take[p] for p in ends}}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        """Ranges of one append each. What is planned last is where the stream stands; after a restart the engine plans the last batch again before it asks for more."""
        entries = self._known()
        self.position = {**start, **end}
        out: list[InputPartition] = []
        for name, stop in end.items():
            held = entries.by_partition[int(name)]
            at = start.get(name, entries.begins()[int(name)] if self.since is None else self._start(entries, int(name)))
            place = max(bisect_right([e[0] for e in held], at) - 1, 0)
            for first, last, _, txn in held[place:]:
                low, high = max(at, first), min(stop, last)
                out += [Range(txn, int(name), cut, min(cut + RECORDS, high)) for cut in range(low, high, RECORDS)]
                if last >= stop:
                    break
        return out

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        folder = Folder(self.root)
        stored = ["offset", *[name for name in self.names if name not in ("topic", "partition", "offset")]]
        for file in folder.partition(partition.txn, self.topic, partition.partition):
            opened, groups = folder.groups(file, "offset", partition.first, partition.end - 1)
            for batch in opened.iter_batches(BATCH, columns=stored, row_groups=groups, use_threads=False) if groups else ():
                offsets = batch.column("offset").to_numpy()
                kept = batch.filter(pa.array((offsets >= partition.first) & (offsets < partition.end)))
                if kept.num_rows:
                    told = {name: kept.column(name) for name in stored}
                    told["topic"] = pa.array([self.topic] * kept.num_rows)
                    told["partition"] = pa.array([partition.partition] * kept.num_rows, pa.int32())
                    if "headers" in told:
                        told["headers"] = told["headers"].cast(pa.map_(pa.string(), pa.binary()))
                    yield pa.RecordBatch.from_arrays([told[name] for name in self.names], self.names)


class TopicSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidelog"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TopicReader:
        return TopicReader({k.lower(): v for k, v in self.options.items()}, schema.names)


def open_stream(
    spark: SparkSession, log: TopicLog, topic: str, starts: str | dict[int, int] = "earliest", since: int | None = None, most: int | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """A topic's committed records from a position on: `earliest`, `latest`, offsets by partition (-1: the end; partitions
    not named: the beginning), or those since a time; at most `most` of them in a batch. Spark does not tell a Python source
    which columns are used: what `columns` leaves out is not read."""
    spark.dataSource.register(TopicSource)
    reader = spark.readStream.format("tidelog").option("root", log.root).option("topic", topic)
    if columns is not None:
        fields = T.StructType.fromDDL(SCHEMA)
        reader = reader.schema(T.StructType([fields[name] for name in columns]))
    if since is not None:
        reader = reader.option("startingTimestamp", str(since))
    else:
        reader = reader.option("startingOffsets", starts if isinstance(starts, str) else json.dumps({str(p): o for p, o in starts.items()}))
    if most is not None:
        reader = reader.option("maxRecordsPerBatch", str(most))
    return reader.load()


def drain(stream: DataFrame, path: str, checkpoint: str, batches: int | None = None, mode: str = "append") -> None:
    """Write a stream's batches to `path`, each under its number, so that one that is run again replaces itself; until all
    that is there has been read, or for so many runs of one batch."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    if batches is not None:
        for _ in range(batches):
            writer.trigger(availableNow=True).start().awaitTermination()  # takes the batch that it finds at its start
        return
    query = writer.start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
