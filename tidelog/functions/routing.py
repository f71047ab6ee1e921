"""Choosing a record's partition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_partition(text: Column, partitions: int | Column) -> Column:
    """Partition from the first 32 bits of the MD5 of text; equal text, equal partition."""
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % partitions).cast("int")


def route(key: Column, partitions: int | Column, explicit: Column | None = None, spread: Column | None = None) -> Column:
    """An explicit partition wins, then the key's hash; keyless records go by the hash of `spread`."""
    choices = [] if explicit is None else [explicit.cast("int")]
    choices.append(hash_partition(key, partitions))
    if spread is not None:
        choices.append(hash_partition(spread, partitions))
    return F.coalesce(*choices, F.lit(0))
