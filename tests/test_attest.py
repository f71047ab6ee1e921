import base64
import json
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidelog.functions.mac import hmac_sha256
from tidelog.operators import attest

SECRET = b"secret"
RECORD = "topic string, partition int, offset bigint, timestamp bigint, key string, value string, headers map<string,binary>"

# Test cases 1, 2 and 6 of RFC 4231: key, data, HMAC-SHA-256.
VECTORS = [
    (b"\x0b" * 20, b"Hi There", "b0344c61d8db38535ca8afceaf0bf12b881dc200c9833da726e9376c2e32cff7"),
    (b"Jefe", b"what do ya want for nothing?", "5bdcc146bf60754e6a042426089575c75a003f089d2739839dec58b964ec3843"),
    (b"\xaa" * 131, b"Test Using Larger Than Block-Size Key - Hash Key First", "60e431591ee0b67f0d8a26aacbf5b77f8e0bc6213728c5140546040f0ee37f54"),
]


@pytest.mark.parametrize("secret,message,code", VECTORS)
def test_rfc_vectors(spark, secret, message, code):
    rows = spark.createDataFrame([(bytearray(message),), (None,)], "m binary")
    got = [r.c for r in rows.select(F.lower(F.hex(hmac_sha256(F.col("m"), secret))).alias("c")).collect()]
    assert got == [code, None]


def records(spark, headers=None):
    row = ("orders", 0, 42, 1_700_000_000_000, None, '{"amount":100}', headers or {})
    return spark.createDataFrame([row], RECORD)


def test_round_trip(spark):
    signed = attest.attest_sign(records(spark), SECRET, key_id="key-1", schema_id=F.lit(7))
    env = json.loads(base64.b64decode(bytes(signed.first().headers[attest.HEADER]), validate=True))
    assert env["payload_sha256"] == sha256(b'{"amount":100}').hexdigest() and env["offset"] == 42
    row = attest.attest_verify(signed, SECRET).first()
    assert (row.verified, row.status, row.producer_id, row.schema_id, row.timestamp_ms) == (True, "verified", "key-1", 7, 1_700_000_000_000)
    assert attest.attest_audit(signed).first().finding == "matches"
    other = attest.attest_verify(signed, b"other").first()
    assert (other.verified, other.status, other.producer_id) == (False, "bad signature", "key-1")
    altered = signed.withColumn("value", F.lit("{}"))
    assert attest.attest_verify(altered, SECRET).first().verified
    assert attest.attest_audit(altered).first().finding == "altered value"
    assert attest.attest_audit(signed.withColumn("offset", F.col("offset") + 1)).first().finding == "moved"


def test_broken_headers(spark):
    def verify(header):
        df = records(spark, {attest.HEADER: bytearray(header)})
        row = attest.attest_verify(df, SECRET).first()
        assert not row.verified
        return row.status, row.producer_id, row.schema_id

    envelope = {"payload_sha256": "x", "topic": "t", "partition": 0, "offset": 1, "schema_id": 0, "timestamp_ms": 5, "key_id": "k", "signature": "AAAA"}
    wrap = lambda e: base64.b64encode(json.dumps(e).encode())
    assert verify(b"%%%") == ("bad base64", "", None)
    assert verify(base64.b64encode(b"no json")) == ("bad envelope", "", None)
    assert verify(wrap({**envelope, "offset": None})) == ("bad envelope", "", None)
    assert verify(wrap(envelope)) == ("bad signature", "", None)
    assert verify(wrap({**envelope, "signature": "%%"})) == ("bad signature", "", None)
    assert verify(wrap({**envelope, "signature": base64.b64encode(bytes(32)).decode()})) == ("bad signature", "k", None)
    assert attest.attest_verify(records(spark), SECRET).first().status == "absent"


def test_sign_arguments(spark):
    with pytest.raises(ValueError):
        attest.attest_sign(records(spark), SECRET, value="value", value_string="key")
    signed = attest.attest_sign(records(spark), SECRET, value=None, value_string="value", header="proof")
    assert attest.attest_verify(signed, SECRET, "proof").first().verified
