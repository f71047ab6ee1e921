"""Record headers: a map from name to bytes, the last write of a name wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMPTY = "map<string,binary>"


def header_get(headers: Column, name: str) -> Column:
    """The header's bytes, or null."""
    return F.try_element_at(headers, F.lit(name))


def header_get_str(headers: Column, name: str) -> Column:
    """The header as text, or null if it is missing or not UTF-8."""
    return F.try_validate_utf8(header_get(headers, name).cast("string"))


def header_add(headers: Column, name: str, value: Column) -> Column:
    """The headers with name set to value, in place of any earlier value."""
    base = F.coalesce(headers, F.create_map().cast(EMPTY))
    others = F.map_filter(base, lambda k, _: k != F.lit(name))
    return F.map_concat(others, F.create_map(F.lit(name), value.cast("binary")))


def header_count(headers: Column) -> Column:
    return F.coalesce(F.size(headers), F.lit(0))


def headers_empty(headers: Column) -> Column:
    return header_count(headers) == 0


def header_explode(records: DataFrame, headers: str = "headers") -> DataFrame:
    """One row per record and header: its columns, then header_name and header_value."""
    kept = [c for c in records.columns if c != headers]
    return records.select(*kept, F.explode(headers).alias("header_name", "header_value"))
