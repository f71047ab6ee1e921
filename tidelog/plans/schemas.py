"""The schema catalog, typed decoding, and compatibility."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import schemas as sc
from tidelog.plans.inputs import once, table
from tidelog.plans.metrics import faulty
from tidelog.plans.reads import events
from tidelog.plans.registry import ELOG, query
from tidelog.session import store

CATALOG = "id int, subject string, version int, schema_type string, schema string"


def schema_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part registers a schema under its brand: the type names a field, the size decides on its type
    and on a further field."""
    text = F.concat(
        F.lit('{"type":"record","name":"Part","fields":[{"name":"id","type":"long"},{"name":"'), F.lower("p_type"),
        F.lit('","type":"'), F.when(F.col("p_size") % 2 == 0, "int").otherwise("long"), F.lit('"}'),
        F.when(F.col("p_size") % 3 == 0, ',{"name":"note","type":"string","default":"none"}').otherwise(""), F.lit("]}"),
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("subject"), F.lit(sc.AVRO).alias("schema_type"), text.alias("schema"), "p_partkey", "p_type", "p_size"
    )


@once
def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered in two rounds: first standard and promotional parts, then all."""
    asked = schema_requests(spark, sf_dir)
    nothing = spark.createDataFrame([], CATALOG)
    first = store(sc.schema_register(asked.where("p_type IN ('STANDARD', 'PROMO')"), nothing, ["p_partkey"]), "schemas")
    more = sc.schema_register(asked, first, ["p_partkey"])
    return store(first.unionByName(more), "schemas")


REQUESTS = """
asked AS (
  SELECT p_brand AS subject, p_partkey, p_type, p_size,
         '{"type":"record","name":"Part","fields":[{"name":"id","type":"long"},{"name":"' || lower(p_type) || '","type":"' ||
         CASE WHEN p_size % 2 = 0 THEN 'int' ELSE 'long' END || '"}' ||
         CASE WHEN p_size % 3 = 0 THEN ',{"name":"note","type":"string","default":"none"}' ELSE '' END || ']}' AS "schema"
  FROM part),
rounds AS (SELECT *, CASE WHEN p_type IN ('STANDARD', 'PROMO') THEN 1 ELSE 2 END AS round FROM asked),
ids AS (SELECT "schema", CAST(row_number() OVER (ORDER BY min(round), min(p_partkey)) AS INTEGER) AS id FROM rounds GROUP BY "schema"),
catalog AS (
  SELECT subject, "schema", id,
         CAST(row_number() OVER (PARTITION BY subject ORDER BY round, first) AS INTEGER) AS version
  FROM (SELECT subject, "schema", min(round) AS round, min(p_partkey) AS first FROM rounds GROUP BY subject, "schema") JOIN ids USING ("schema"))"""


@query("schema_register", f'WITH {REQUESTS} SELECT id, subject, version, \'AVRO\' AS schema_type, "schema" FROM catalog')
def schema_register(spark, sf_dir):
    return catalog(spark, sf_dir)


@query("schema_catalog", f"""
WITH {REQUESTS}
SELECT subject, array_to_string(list(version ORDER BY version), ',') AS versions, max(version) AS latest_version,
       max_by(id, version) AS latest_id, max_by("schema", version) AS latest_schema FROM catalog GROUP BY subject
""")
def schema_catalog(spark, sf_dir):
    known = catalog(spark, sf_dir)
    listed = sc.versions(known).withColumn("versions", F.array_join("versions", ","))
    return sc.subjects(known).join(listed, "subject").join(sc.latest(known), "subject").select(
        "subject", "versions", F.col("version").alias("latest_version"), F.col("id").alias("latest_id"), F.col("schema").alias("latest_schema")
    )


@query("schema_delete", f"""
WITH {REQUESTS}
SELECT subject, CAST(count(*) AS BIGINT) AS versions, subject IN ('Brand#1', 'Brand#2') AS deleted FROM catalog GROUP BY subject
""")
def schema_delete(spark, sf_dir):
    """Two subjects are deleted: what is left, and what was removed."""
    gone = spark.createDataFrame([("Brand#1",), ("Brand#2",)], "subject string")
    left, removed = sc.schema_delete(catalog(spark, sf_dir), gone)
    kept = sc.live(left).groupBy("subject").agg(F.count("*").alias("versions")).withColumn("deleted", F.lit(False))
    return kept.unionByName(removed.select("subject", F.size("versions").cast("bigint").alias("versions"), F.lit(True).alias("deleted")))


EVENT_SCHEMA = (
    '{"type":"record","name":"Event","fields":[{"name":"event_id","type":"long"},'
    '{"name":"event_type","type":"string"},{"name":"value","type":"double"}]}'
)


@query("decode_topic", f"""
WITH {ELOG}
SELECT "partition", "offset", CASE WHEN event_type = 'click' THEN event_id END AS event_id,
       CASE WHEN event_type = 'click' THEN event_type END AS event_type, CASE WHEN event_type = 'click' THEN amount END AS "value",
       event_type <> 'click' AS corrupt FROM elog
""")
def decode_topic(spark, sf_dir):
    """Only clicks were left as the schema wants them."""
    decoded = sc.decode_topic(faulty(spark, sf_dir), EVENT_SCHEMA)
    return decoded.select("partition", "offset", "decoded.*", F.col("corrupt").isNotNull().alias("corrupt"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each brand proposes its last part's schema with a rank added: small parts' may be null, which is its default."""
    last = schema_requests(spark, sf_dir).groupBy("subject").agg(F.max(F.struct("p_partkey", "schema", "p_size")).alias("r"))
    rank = F.when(F.col("r.p_size") > 25, ',{"name":"rank","type":"int"}]}').otherwise(',{"name":"rank","type":["null","int"],"default":null}]}')
    return last.select("subject", F.concat(F.regexp_replace("r.schema", r"\]\}$", ""), rank).alias("schema"))


CHANGES = f"""
WITH {REQUESTS},
candidates AS (
  SELECT subject, regexp_replace(max_by("schema", p_partkey), '\\]\\}}$', '') ||
         CASE WHEN max_by(p_size, p_partkey) > 25 THEN ',{{"name":"rank","type":"int"}}]}}' ELSE ',{{"name":"rank","type":["null","int"],"default":null}}]}}' END AS "schema"
  FROM asked GROUP BY subject),
old AS (SELECT subject, json_extract_string(f, '$.name') AS name, json_extract_string(f, '$.type') AS old_type
        FROM (SELECT subject, unnest(CAST(json_extract(max_by("schema", version), '$.fields') AS JSON[])) AS f FROM catalog GROUP BY subject)),
new AS (SELECT subject, json_extract_string(f, '$.name') AS name, 
               CASE WHEN json_type(f, '$.type') = 'ARRAY' THEN 'int|null' ELSE json_extract_string(f, '$.type') END AS new_type,
               CASE WHEN json_exists(f, '$.default') THEN 'yes' END AS dflt
        FROM (SELECT subject, unnest(CAST(json_extract("schema", '$.fields') AS JSON[])) AS f FROM candidates)),
changes AS (
  SELECT subject, name, old_type, new_type,
    CASE WHEN new_type IS NULL THEN 'removed' WHEN old_type IS NULL AND dflt IS NULL THEN 'added without default'
         WHEN old_type IS NULL THEN 'added' WHEN old_type = 'int' AND new_type = 'long' THEN 'widened'
         WHEN old_type <> new_type THEN 'retyped' END AS change
  FROM old FULL JOIN new USING (subject, name))"""


@query("schema_changes", f"""{CHANGES} SELECT subject, name, old_type, new_type, change,
       change IN ('added without default', 'retyped') AS breaks FROM changes WHERE change IS NOT NULL""")
def schema_changes(spark, sf_dir):
    return sc.schema_changes(candidates(spark, sf_dir), catalog(spark, sf_dir))


@query("schema_compat_report", f"""{CHANGES} SELECT subject, count(change) AS changes,
       count(*) FILTER (change IN ('added without default', 'retyped')) AS breaking,
       count(*) FILTER (change IN ('added without default', 'retyped')) = 0 AS is_compatible FROM changes GROUP BY subject""")
def schema_compat_report(spark, sf_dir):
    return sc.schema_compat_report(candidates(spark, sf_dir), catalog(spark, sf_dir))


@query("schema_decode_rate", f"""
WITH {ELOG} SELECT "partition", count(*) AS records, count(*) FILTER (event_type = 'click') AS decodable FROM elog GROUP BY "partition"
""")
def schema_decode_rate(spark, sf_dir):
    """How much of the spoiled topic the schema can decode."""
    return sc.decode_rate(faulty(spark, sf_dir), EVENT_SCHEMA, by=["partition"])
