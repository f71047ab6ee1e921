"""Message authentication codes as column expressions."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import Column
from pyspark.sql import functions as F

BLOCK = 64  # bytes of a SHA-256 block


def hmac_sha256(message: Column, secret: bytes) -> Column:
    """HMAC with SHA-256 (RFC 2104) of a text or binary column, as 32 bytes; null for null."""
    key = (sha256(secret).digest() if len(secret) > BLOCK else secret).ljust(BLOCK, b"\0")
    inner = F.sha2(F.concat(F.lit(bytes(b ^ 0x36 for b in key)), message.cast("binary")), 256)
    return F.unhex(F.sha2(F.concat(F.lit(bytes(b ^ 0x5C for b in key)), F.unhex(inner)), 256))
