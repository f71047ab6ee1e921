"""Attestations over the events topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.headers import header_add, header_get
from tidelog.functions.mac import hmac_sha256
from tidelog.operators import attest
from tidelog.plans.inputs import once
from tidelog.plans.reads import events
from tidelog.plans.registry import ELOG, query
from tidelog.session import store

SECRET = b"a secret for these tables"


@once
def signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, signed: schema 7, but none for views; purchases name a contract."""
    records = events(spark, sf_dir).withColumn("kind", F.col("headers")["event_type"].cast("string"))
    out = attest.attest_sign(
        records, SECRET, schema_id=F.when(F.col("kind") == "view", 0).otherwise(7), contract_id=F.when(F.col("kind") == "purchase", "paid")
    )
    return store(out, "signed")


@once
def tampered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed events after mishaps: purchases were altered, signups moved by one offset, errors carry a
    broken header (base64 by even ids only), every other click a signature of zeros, views none at all."""
    rows = signed(spark, sf_dir)
    odd = F.get_json_object("value", "$.event_id").cast("bigint") % 2 == 1
    rows = attest.attest_open(rows).drop("status")
    forged = attest.base64_text(F.to_json(F.col("env").withField("signature", F.lit("A" * 43 + "="))).cast("binary"))
    # {"topic":1}
    bare = F.lit("eyJ0b3BpYyI6MX0=")
    header = (
        F.when(F.col("kind") == "error", F.when(odd, F.lit("%%%")).otherwise(bare))
        .when((F.col("kind") == "click") & odd, forged)
        .otherwise(header_get(F.col("headers"), attest.HEADER).cast("string"))
    )
    without = F.map_filter("headers", lambda k, _: k != attest.HEADER)
    return store(
        rows.withColumns({
            "headers": F.when(F.col("kind") == "view", without).otherwise(header_add(F.col("headers"), attest.HEADER, header)),
            "value": F.when(F.col("kind") == "purchase", F.concat("value", F.lit(" "))).otherwise(F.col("value")),
            "offset": F.when(F.col("kind") == "signup", F.col("offset") + 1).otherwise(F.col("offset")),
        }).drop("env"),
        "tampered",
    )


@query("attest_sign", f"""
WITH {ELOG}
SELECT "partition", "offset", sha256(payload) AS payload_sha256,
       topic || '|' || "partition" || '|' || "offset" || '|' || sha256(payload) || '|' ||
       CASE WHEN event_type = 'view' THEN 0 ELSE 7 END || '|' || "timestamp" || '|broker-0' AS signed_text,
       CASE WHEN event_type = 'purchase' THEN 'paid' END AS contract_id, CAST(32 AS INTEGER) AS signature_bytes, TRUE AS holds
FROM elog
""")
def attest_sign(spark, sf_dir):
    """What was signed for every event, and that the signature holds."""
    opened = attest.attest_open(signed(spark, sf_dir))
    env = F.col("env")
    text = attest.canonical({n: env.getField(n) for n in attest.NEEDED})
    signature = F.unbase64(env.getField("signature"))
    return opened.select(
        "partition", "offset", env.getField("payload_sha256").alias("payload_sha256"), text.alias("signed_text"),
        env.getField("contract_id").alias("contract_id"), F.octet_length(signature).alias("signature_bytes"),
        (hmac_sha256(text, SECRET) == signature).alias("holds"),
    )


PLACE = """"partition", "offset" + CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS "offset", event_type AS kind"""


@query("attest_verify", f"""
WITH {ELOG}, found AS (
  SELECT *, CASE WHEN event_type = 'view' THEN 'absent'
                 WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 1 THEN 'bad base64' ELSE 'bad envelope' END
                 WHEN event_type = 'click' AND event_id % 2 = 1 THEN 'bad signature' ELSE 'verified' END AS status FROM elog)
SELECT {PLACE}, status, status = 'verified' AS verified,
       CASE WHEN event_type IN ('view', 'error') THEN '' ELSE 'broker-0' END AS producer_id,
       CAST(CASE WHEN event_type NOT IN ('view', 'error') THEN 7 END AS INTEGER) AS schema_id,
       CASE WHEN event_type = 'purchase' THEN 'paid' END AS contract_id,
       CASE WHEN event_type IN ('view', 'error') THEN 0 ELSE "timestamp" END AS timestamp_ms
FROM found
""")
def attest_verify(spark, sf_dir):
    checked = attest.attest_verify(tampered(spark, sf_dir), SECRET)
    return checked.select("partition", "offset", "kind", "status", "verified", "producer_id", "schema_id", "contract_id", "timestamp_ms")


@query("attest_audit", f"""
WITH {ELOG}
SELECT {PLACE}, CASE WHEN event_type IN ('view') OR (event_type = 'error' AND event_id % 2 = 1) THEN NULL
                     WHEN event_type = 'error' THEN NULL ELSE 'broker-0' END AS key_id,
       CASE WHEN event_type = 'view' THEN 'absent'
            WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 1 THEN 'bad base64' ELSE 'bad envelope' END
            WHEN event_type = 'purchase' THEN 'altered value' WHEN event_type = 'signup' THEN 'moved' ELSE 'matches' END AS finding
FROM elog
""")
def attest_audit(spark, sf_dir):
    return attest.attest_audit(tampered(spark, sf_dir)).select("partition", "offset", "kind", "key_id", "finding")
