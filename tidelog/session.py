"""Session settings and the shared folder that staged tables are written to."""

from __future__ import annotations

import contextvars
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that results depend on; they can be changed while a session runs.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# By this setting Spark drops what a query has shuffled when the query ends.
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_dirs: dict[str, str] = {}
_staged: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("staged", default=None)
_shipped: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Set what results depend on; leave sizing and everything else to the cluster."""
    for key, value in RESULT_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Executors get it as a file of the application. Workers that Spark starts beside the driver, as for
    stateful streams, find it by their path.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="run-"), "tidelog")
    sc.addPyFile(shutil.make_archive(archive, "zip", root_dir=home, base_dir="tidelog"))
    known = sc.environment.get("PYTHONPATH", "")
    sc.environment["PYTHONPATH"] = os.pathsep.join(p for p in (home, known) if p)
    _shipped.add(sc.applicationId)


def build_session(app: str = "tidelog", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **RESULT_SETTINGS,
        **{key.replace("__", "."): value for key, value in settings.items()},
    }
    for key, value in defaults.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in spark.checkpoint.dir.

    Only a local session may go without that setting: it gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        sc.setCheckpointDir(_local_dirs[sc.applicationId])
    return _local_dirs[sc.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/tidelog/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path whose table is dropped with those that store() has written, if this is within staging()."""
    path = new_path(spark, name)
    if _staged.get() is not None:
        _staged.get().append(path)
    return path


def drop(spark: SparkSession, path: str) -> None:
    fs, found = hadoop_path(spark, path)
    fs.delete(found, True)


@contextmanager
def releasing(spark: SparkSession) -> Iterator[None]:
    """Have writes inside drop what they have shuffled when they are done. What they wrote is read from its files, and
    shuffles else lie on disk until the driver happens to collect its garbage. A setting of the session's own stands."""
    own = spark.conf.get(RELEASE, None) is None
    if own:
        spark.conf.set(RELEASE, "true")
    try:
        yield
    finally:
        if own:
            spark.conf.unset(RELEASE)


def store(df: DataFrame, name: str, partition_by: list[str] | None = None, compression: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back.

    Cuts the lineage at data that outlives any executor, fixes values that are not reproducible
    (partition ids, sampled range bounds), and gives the planner a real size, so it broadcasts the
    table in later joins only while it is under spark.sql.autoBroadcastJoinThreshold.
    """
    path = staged_path(df.sparkSession, name)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if compression:
        writer = writer.option("compression", compression)
    with releasing(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, as the JVM has them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables that are stored inside belong to the work done there and are dropped when it ends."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(token)
        for path in paths:
            drop(spark, path)
