"""W3C trace context in record headers: traceparent is version-traceid-spanid-flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.functions.headers import header_add, header_get_str

PARENT = "traceparent"
STATE = "tracestate"
# The published layout of a traceparent of version 00; ids of zeros only are not valid.
LAYOUT = "^00-([0-9a-f]{32})-([0-9a-f]{16})-([0-9a-f]{2})$"


def trace_extract(headers: Column) -> dict[str, Column]:
    """trace_id, span_id, trace_flags and trace_state; null where there is no valid context."""
    parent = header_get_str(headers, PARENT)
    trace, span = F.regexp_extract(parent, LAYOUT, 1), F.regexp_extract(parent, LAYOUT, 2)
    good = parent.rlike(LAYOUT) & (trace != "0" * 32) & (span != "0" * 16)
    return {
        "trace_id": F.when(good, trace),
        "span_id": F.when(good, span),
        "trace_flags": F.when(good, F.regexp_extract(parent, LAYOUT, 3)),
        "trace_state": F.when(good, header_get_str(headers, STATE)),
    }


def trace_inject(headers: Column, trace_id: Column, span_id: Column, sampled: Column | None = None) -> Column:
    """The headers with a traceparent for the given span."""
    flags = F.lit("01") if sampled is None else F.when(sampled, "01").otherwise("00")
    return header_add(headers, PARENT, F.concat_ws("-", F.lit("00"), trace_id, span_id, flags))
