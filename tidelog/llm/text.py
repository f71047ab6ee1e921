"""Small helpers that several text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.session import configure

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Bytes to bytes, A-Z lower-cased and [\x20\x09-\x0D] made spaces; other bytes, UTF-8's among them, stay.
PLAIN = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))


# Rows that a Python worker is given at once: whole texts are long, and idle workers keep what they once needed.
BATCH_ROWS = "1000"


def prepared(spark: SparkSession) -> SparkSession:
    """The session with this package's settings, and with batches of texts that leave executors their memory."""
    configure(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other letters left alone; null is empty.

    lower() is the quick way but also changes letters beyond ASCII, so it serves texts without such.
    """
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()
