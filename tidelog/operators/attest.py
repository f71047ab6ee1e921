"""Attestations: signed envelopes in a record header that state what was written where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.headers import header_add, header_get
from tidelog.functions.mac import hmac_sha256

# The header's name is the writer's choice; give `header` where a log uses another.
HEADER = "attestation"
DEFAULT_KEY_ID = "broker-0"
MAC_BYTES = 32

ENVELOPE = (
    "payload_sha256 string, topic string, partition int, offset bigint, schema_id int, "
    "timestamp_ms bigint, key_id string, signature string, contract_id string"
)
NEEDED = ["payload_sha256", "topic", "partition", "offset", "schema_id", "timestamp_ms", "key_id", "signature"]


def canonical(env: dict[str, Column]) -> Column:
    """The text that is signed (fixed format)."""
    return F.concat_ws("|", *[
        env[c].cast("string")
        for c in ("topic", "partition", "offset", "payload_sha256", "schema_id", "timestamp_ms", "key_id")
    ])


def base64_text(data: Column) -> Column:
    """Base64 in one line, whatever line length the session's setting asks for."""
    return F.regexp_replace(F.base64(data), r"\s", "")


def attest_sign(
    records: DataFrame,
    secret: bytes,
    key_id: str = DEFAULT_KEY_ID,
    schema_id: Column | None = None,
    contract_id: Column | None = None,
    value: str = "value",
    value_string: str | None = None,
    header: str = HEADER,
) -> DataFrame:
    """Records with an attestation header over their value and coordinates.

    The signature is an HMAC-SHA256 by a secret that signer and verifier share: it needs no code but Spark's own.
    The payload is `value`, unless value_string names a text column and value is None; both is an error.
    """
    if value and value_string:
        raise ValueError("a payload is either `value` or `value_string`")
    payload = F.coalesce(F.col(value or value_string).cast("binary"), F.lit(b""))
    env = {
        "payload_sha256": F.sha2(payload, 256),
        "topic": F.col("topic"),
        "partition": F.col("partition"),
        "offset": F.col("offset"),
        "schema_id": (F.lit(0) if schema_id is None else schema_id).cast("int"),
        "timestamp_ms": F.col("timestamp"),
        "key_id": F.lit(key_id),
    }
    contract = (F.lit(None) if contract_id is None else contract_id).cast("string")
    signed = records.withColumn("_signature", base64_text(hmac_sha256(canonical(env), secret)))
    envelope = F.to_json(F.struct(
        *[c.alias(n) for n, c in env.items()], F.col("_signature").alias("signature"), contract.alias("contract_id")
    ))
    sealed = base64_text(envelope.cast("binary"))
    return signed.withColumn("headers", header_add(F.col("headers"), header, sealed)).drop("_signature")


def attest_open(records: DataFrame, header: str = HEADER) -> DataFrame:
    """Add env, the envelope, and status: absent, bad base64, bad envelope or present."""
    raw = header_get(F.col("headers"), header).cast("string")
    # Strict base64: the standard alphabet and padding only, no line breaks.
    strict = raw.rlike(r"\A(?:[A-Za-z0-9+/]{4})*(?:[A-Za-z0-9+/]{2}==|[A-Za-z0-9+/]{3}=)?\z")
    decoded = F.when(strict, F.try_to_binary(raw, F.lit("base64")))
    parsed = F.from_json(F.try_validate_utf8(decoded.cast("string")), ENVELOPE)
    opened = records.withColumns({"_raw": raw, "_bytes": decoded, "env": parsed})
    complete = F.lit(True)
    for field in NEEDED:
        complete = complete & F.col("env").getField(field).isNotNull()
    status = (
        F.when(F.col("_raw").isNull(), "absent")
        .when(F.col("_bytes").isNull(), "bad base64")
        .when(~F.coalesce(complete, F.lit(False)), "bad envelope")
        .otherwise("present")
    )
    return opened.withColumn("status", status).drop("_raw", "_bytes")


def attest_verify(records: DataFrame, secret: bytes, header: str = HEADER) -> DataFrame:
    """Add verified, status, producer_id, schema_id (null for 0), contract_id and timestamp_ms.

    The signature is checked over the envelope's fields. A broken header is a status, not a failed job:
    absent, bad base64, bad envelope, bad signature or verified.
    """
    opened = attest_open(records, header)
    env = F.col("env")
    text = canonical({n: env.getField(n) for n in NEEDED})
    signature = F.try_to_binary(env.getField("signature"), F.lit("base64"))
    here = F.col("status") == "present"
    checked = opened.withColumn("_holds", F.coalesce(hmac_sha256(text, secret) == signature, F.lit(False)))
    # As in the reader's contract: fields are told once the signature could be checked at all.
    told = here & (F.octet_length(signature) == MAC_BYTES)
    return checked.select(
        *records.columns,
        (here & F.col("_holds")).alias("verified"),
        F.when(here & F.col("_holds"), "verified").when(here, "bad signature").otherwise(F.col("status")).alias("status"),
        F.when(told, env.getField("key_id")).otherwise("").alias("producer_id"),
        F.when(told & (env.getField("schema_id") != 0), env.getField("schema_id")).alias("schema_id"),
        F.when(told, env.getField("contract_id")).alias("contract_id"),
        F.when(told, env.getField("timestamp_ms")).otherwise(F.lit(0)).alias("timestamp_ms"),
    )


def attest_audit(records: DataFrame, header: str = HEADER, value: str = "value") -> DataFrame:
    """Add key_id and finding: does the envelope speak of this very record? Needs no key and no Python."""
    opened = attest_open(records, header)
    env = F.col("env")
    moved = (
        (env.getField("topic") != F.col("topic")) | (env.getField("partition") != F.col("partition"))
        | (env.getField("offset") != F.col("offset"))
    )
    altered = env.getField("payload_sha256") != F.sha2(F.coalesce(F.col(value).cast("binary"), F.lit(b"")), 256)
    finding = (
        F.when(F.col("status") != "present", F.col("status"))
        .when(altered, "altered value").when(moved, "moved").otherwise("matches")
    )
    return opened.select(*records.columns, env.getField("key_id").alias("key_id"), finding.alias("finding"))
