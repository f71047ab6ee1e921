"""Topic name rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The longest name in bytes, the reserved names, and what a name may not contain.
MAX_NAME_BYTES = 249
RESERVED = [".", ".."]
OUTSIDE = "[^A-Za-z0-9._-]"


def topic_name_reason(name: Column) -> Column:
    """Why the name is not allowed, or null. Only the first rule broken is told."""
    return (
        F.when(name.isNull() | (F.octet_length(name) == 0), "empty")
        .when(F.octet_length(name) > MAX_NAME_BYTES, "too long")
        .when(name.isin(*RESERVED), "reserved")
        .when(name.rlike(OUTSIDE), "invalid character")
    )


def topic_name_check(name: Column) -> dict[str, Column]:
    """Columns valid, reason and bad_char (the first character that is not allowed)."""
    reason = topic_name_reason(name)
    return {
        "valid": reason.isNull(),
        "reason": reason,
        "bad_char": F.when(reason == "invalid character", F.regexp_extract(name, OUTSIDE, 0)),
    }
