"""Metrics, row checks, headers and traces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions import headers as h
from tidelog.functions.names import topic_name_check
from tidelog.functions.traces import trace_extract, trace_inject
from tidelog.operators import contracts, metrics, sketches, tracing
from tidelog.operators.memory import validate_memories
from tidelog.plans.inputs import event_log, millis, once, table
from tidelog.plans.reads import events
from tidelog.plans.registry import ELOG, query
from tidelog.session import new_path, store

DAY_MS = 86_400_000


def operations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An operation log: purchases and signups produce, views and clicks consume, errors fail."""
    kind = F.col("event_type")
    op = F.when(kind.isin("purchase", "signup"), "produce").when(kind.isin("view", "click"), "consume").otherwise("error")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("client"), op.alias("op"), (F.col("event_id") % 3 + 1).alias("messages"),
        F.octet_length("props").cast("bigint").alias("bytes"), F.col("value").alias("latency_ms"),
    )


OPS = """
WITH ops AS (
  SELECT user_id AS client, event_id % 3 + 1 AS messages, CAST(strlen(props) AS BIGINT) AS bytes, value AS latency_ms,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'produce'
              WHEN event_type IN ('view', 'click') THEN 'consume' ELSE 'error' END AS op
  FROM events)"""


def counters(messages: str) -> str:
    return f"""
  CAST(coalesce(sum({messages}) FILTER (op = 'produce'), 0) AS BIGINT) AS messages_produced,
  CAST(coalesce(sum({messages}) FILTER (op = 'consume'), 0) AS BIGINT) AS messages_consumed,
  CAST(coalesce(sum(bytes) FILTER (op = 'produce'), 0) AS BIGINT) AS bytes_sent,
  CAST(coalesce(sum(bytes) FILTER (op = 'consume'), 0) AS BIGINT) AS bytes_received,
  count(*) FILTER (op = 'error') AS errors_total"""


def average(op: str) -> str:
    """Average latency in whole numbers: cents summed up, the mean rounded half up to millionths."""
    n, cents = f"count(*) FILTER (op = '{op}')", f"sum(CAST(round(latency_ms * 100) AS BIGINT)) FILTER (op = '{op}')"
    return f"coalesce(((CAST({cents} AS BIGINT) * 20000 + {n}) // (2 * {n})) / 1000000.0, 0.0)"


@query("client_metrics", f"""
{OPS} SELECT client, {counters('messages')},
  {average('produce')} AS produce_latency_avg_ms, {average('consume')} AS consume_latency_avg_ms
FROM ops GROUP BY client
""")
def client_metrics(spark, sf_dir):
    """Latencies are summed as decimals, so that the averages do not hang on the order of the rows."""
    ops = operations(spark, sf_dir).withColumn("latency_ms", F.col("latency_ms").cast("decimal(18,2)"))
    out = metrics.client_metrics(ops, ["client"])
    return out.withColumns({c: F.round(c, 6) for c in ("produce_latency_avg_ms", "consume_latency_avg_ms")})


@query("op_counters", f"{OPS} SELECT client, {counters('1')} FROM ops GROUP BY client")
def op_counters(spark, sf_dir):
    return metrics.op_counters(operations(spark, sf_dir), ["client"])


@query("latency_p99", f"""
{OPS}, ranked AS (SELECT op, latency_ms, row_number() OVER (PARTITION BY op ORDER BY latency_ms) - 1 AS r,
                         count(*) OVER (PARTITION BY op) AS n FROM ops)
SELECT op, latency_ms AS latency, n FROM ranked WHERE r = least(CAST(floor(0.99 * n) AS BIGINT), n - 1)
""")
def latency_p99(spark, sf_dir):
    return metrics.latency_quantile(operations(spark, sf_dir), ["op"], "latency_ms")


@query("throughput", f"""
WITH {ELOG}
SELECT topic, "partition", count(*) AS messages, (max("timestamp") - min("timestamp")) / 1000.0 AS seconds,
       round(count(*) / nullif((max("timestamp") - min("timestamp")) / 1000.0, 0), 9) AS messages_per_second
FROM elog GROUP BY ALL
""")
def throughput(spark, sf_dir):
    out = metrics.throughput(event_log(spark, sf_dir).describe(), ["topic", "partition"])
    return out.withColumn("messages_per_second", F.round("messages_per_second", 9))


def metric_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"), "value",
        F.create_map(F.lit("user"), (F.col("user_id") % 10).cast("string")).alias("labels"),
        millis("ts").alias("timestamp"),
    )


@query("metrics_history", f"""
SELECT epoch_us(ts) // 1000 // {DAY_MS} * {DAY_MS} AS window_start, event_type AS name, CAST(user_id % 10 AS VARCHAR) AS user_label,
       count(*) AS points, round(sum(value), 4) AS total, min(value) AS low, max(value) AS high
FROM events GROUP BY ALL
""")
def metrics_history(spark, sf_dir):
    daily = metrics.metrics_history(metric_points(spark, sf_dir), DAY_MS)
    return daily.withColumn("user_label", F.col("labels")["user"]).withColumn("total", F.round("total", 4)).drop("labels")


FRACTIONS = {"p50": 0.5, "p99": 0.99}
RANK_ERROR = 0.02


@query("metrics_quantiles", f"""
SELECT 'day' AS span, epoch_us(ts) // 1000 // {DAY_MS} * {DAY_MS} AS window_start, event_type AS name, count(*) AS points,
       min(value) AS low, max(value) AS high, TRUE AS p50_holds, TRUE AS p99_holds FROM events GROUP BY ALL
UNION ALL SELECT 'all', NULL, event_type, count(*), min(value), max(value), TRUE, TRUE FROM events GROUP BY ALL
""")
def metrics_quantiles(spark, sf_dir):
    """Hour sketches, stored in two appends of the points, merged into days and into all of time; whether their quantiles
    are as exact as they should be is told by the points."""
    points, path = metric_points(spark, sf_dir), new_path(spark, "hours")
    for half in (0, 1):
        part = points.where(F.pmod(F.floor(F.col("timestamp") / 1000), F.lit(2)) == half)
        sketches.window_sketches(part, DAY_MS // 24).write.mode("append").parquet(path)
    hours, rows = spark.read.parquet(path), []
    day = points.withColumn("window_start", F.col("timestamp") - F.pmod("timestamp", F.lit(DAY_MS)))
    for span, width, read, by in (("day", DAY_MS, day, ("window_start", "name")), ("all", None, points, ("name",))):
        told = sketches.quantiles(store(sketches.coarser(hours, width), span), FRACTIONS)
        errors = sketches.rank_errors(read, told, FRACTIONS, by)
        holds = [(F.col(f"{c}_error") <= RANK_ERROR).alias(f"{c}_holds") for c in FRACTIONS]
        rows.append(told.join(errors, [*by]).select(F.lit(span).alias("span"), "window_start", "name", "points", "low", "high", *holds))
    return rows[0].unionByName(rows[1])


@query("failure_streaks", """
WITH marked AS (
  SELECT user_id, ts, event_id, event_type = 'error' AS failed,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS place,
         sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END)
           OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run
  FROM events)
SELECT user_id, count(*) AS failures, min(place) AS first_place, epoch_us(min(ts)) // 1000 AS started, epoch_us(max(ts)) // 1000 AS ended
FROM marked WHERE failed GROUP BY user_id, run HAVING count(*) >= 2
""")
def failure_streaks(spark, sf_dir):
    """Two or more errors of a user in a row."""
    outcomes = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    runs = metrics.failure_streaks(outcomes, "user_id", ["ts", "event_id"], F.col("event_type") == "error", 2)
    return runs.withColumns({"started": millis("started"), "ended": millis("ended")})


KINDS = "[" + ", ".join(f"'{k}'" for k in metrics.ERROR_KINDS) + "]"
RETRY = "(" + ", ".join(f"'{k}'" for k in metrics.RETRYABLE) + ")"


@query("classify_errors", f"""
WITH errors AS (SELECT ({KINDS})[CAST(user_id % {len(metrics.ERROR_KINDS)} AS INTEGER) + 1] AS kind FROM events WHERE event_type = 'error')
SELECT kind, kind IN {RETRY} AS retryable, count(*) AS errors FROM errors GROUP BY kind
""")
def classify_errors(spark, sf_dir):
    """Error events; the user decides on the kind."""
    kinds = F.array(*[F.lit(k) for k in metrics.ERROR_KINDS])
    errors = table(spark, sf_dir, "events").where("event_type = 'error'").select(
        F.get(kinds, (F.col("user_id") % len(metrics.ERROR_KINDS)).cast("int")).alias("kind")
    )
    return metrics.classify_errors(errors)


# -- row checks -------------------------------------------------------------------------------------


@query("validate_topic_names", r"""
WITH names AS (
  SELECT 'document' AS source, doc_id AS id, text AS name FROM documents
  UNION ALL SELECT 'page', page_id, url FROM pages
  UNION ALL SELECT 'customer', c_custkey, replace(c_name, '#', '.') FROM customer
  UNION ALL SELECT 'turn', conv_id * 1000 + turn, repeat('.', CAST(turn AS INTEGER)) FROM conversations),
checked AS (SELECT source, id, CASE
    WHEN name IS NULL OR strlen(name) = 0 THEN 'empty' WHEN strlen(name) > 249 THEN 'too long'
    WHEN name IN ('.', '..') THEN 'reserved' WHEN regexp_matches(name, '[^A-Za-z0-9._-]') THEN 'invalid character' END AS reason,
    name FROM names)
SELECT source, id, reason IS NULL AS valid, reason,
       CASE WHEN reason = 'invalid character' THEN regexp_extract(name, '[^A-Za-z0-9._-]') END AS bad_char FROM checked
""")
def validate_topic_names(spark, sf_dir):
    """Document texts, page addresses, customer names and rows of dots as topic names."""
    names = (
        table(spark, sf_dir, "documents").select(F.lit("document").alias("source"), F.col("doc_id").alias("id"), F.col("text").alias("name"))
        .unionAll(table(spark, sf_dir, "pages").select(F.lit("page"), "page_id", "url"))
        .unionAll(table(spark, sf_dir, "customer").select(F.lit("customer"), "c_custkey", F.replace("c_name", F.lit("#"), F.lit("."))))
        .unionAll(table(spark, sf_dir, "conversations").select(
            F.lit("turn"), F.col("conv_id") * 1000 + F.col("turn"), F.repeat(F.lit("."), F.col("turn").cast("int"))))
    )
    return names.withColumns(topic_name_check(F.col("name"))).drop("name")


def memory_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as memories: users observe, assistants state facts, system turns are procedures.

    Salience grows with the turn beyond its bound, and procedures of odd conversations name no skill.
    """
    kind = F.when(F.col("role") == "user", "observation").when(F.col("role") == "assistant", "fact").otherwise("procedure")
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("agent-"), F.col("conv_id")).alias("agent_id"),
        F.concat(F.lit("team-"), F.col("conv_id") % 7).alias("namespace"),
        kind.alias("kind"), F.col("text").alias("content"), (F.col("turn") / F.lit(5.0)).alias("salience"),
        F.when(F.col("conv_id") % 2 == 0, "dialogue").otherwise(" ").alias("skill"),
        F.col("turn").alias("turn"),
    )


ENTRIES = """
entries AS (
  SELECT 'agent-' || conv_id AS agent_id, 'team-' || (conv_id % 7) AS namespace, text AS content, turn / 5.0 AS salience,
         CASE role WHEN 'user' THEN 'observation' WHEN 'assistant' THEN 'fact' ELSE 'procedure' END AS kind,
         CASE WHEN conv_id % 2 = 0 THEN 'dialogue' ELSE ' ' END AS skill, turn
  FROM conversations),
checked AS (
  SELECT *, concat_ws('; ',
    CASE WHEN NOT regexp_matches(content, '\\S') THEN 'content is blank' END,
    CASE WHEN kind = 'procedure' AND NOT regexp_matches(skill, '\\S') THEN 'a procedure needs a skill' END,
    CASE WHEN salience NOT BETWEEN 0 AND 1 THEN 'salience is not from 0 to 1' END) AS problems
  FROM entries)""".replace("\\\\", "\\")


@query("validate_memories", f"WITH {ENTRIES} SELECT agent_id, turn, kind, problems = '' AS valid, problems FROM checked")
def validate_memories_query(spark, sf_dir):
    checked = validate_memories(memory_entries(spark, sf_dir))
    return checked.select("agent_id", "turn", "kind", "valid", F.concat_ws("; ", "errors").alias("problems"))


CONTRACT = {
    "type": "object",
    "properties": {"event_id": {"type": "integer"}, "event_type": {"type": "string"}, "value": {"type": "number"}},
    "required": ["event_id", "event_type", "value"],
}


def faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events topic with values spoiled by type: errors hold text for a number, views lack it, signups
    are cut short, purchases hold null; clicks are as they were."""
    kind, value = F.col("headers")["event_type"].cast("string"), F.col("value")
    spoiled = (
        F.when(kind == "error", F.regexp_replace(value, r'"value":([0-9.]+)', '"value":"$1"'))
        .when(kind == "view", F.regexp_replace(value, r',"value":[0-9.]+', ""))
        .when(kind == "signup", F.regexp_replace(value, r"\}$", ""))
        .when(kind == "purchase", F.regexp_replace(value, r'"value":[0-9.]+', '"value":null'))
        .otherwise(value)
    )
    return events(spark, sf_dir).withColumn("value", spoiled)


FAULTS = f"""
WITH {ELOG}, found AS (
  SELECT "partition", "offset", event_type, event_type = 'click' AS valid,
    CASE event_type WHEN 'signup' THEN '$' WHEN 'click' THEN NULL ELSE 'value' END AS field_path,
    CASE event_type WHEN 'signup' THEN 'object' WHEN 'click' THEN NULL ELSE 'number' END AS expected,
    CASE event_type WHEN 'error' THEN 'string' WHEN 'view' THEN 'missing' WHEN 'signup' THEN 'invalid'
                    WHEN 'purchase' THEN 'null' END AS actual,
    CASE event_type WHEN 'error' THEN 'value must be number, found string' WHEN 'view' THEN 'value is required'
                    WHEN 'signup' THEN 'value is not JSON' WHEN 'purchase' THEN 'value must be number, found null' END AS message
  FROM elog)"""


@query("contract_validate", f'{FAULTS} SELECT "partition", "offset", valid, field_path, expected, actual, message FROM found')
def contract_validate(spark, sf_dir):
    checked = contracts.contract_validate(faulty(spark, sf_dir), CONTRACT)
    return checked.select("partition", "offset", "valid", F.inline_outer("errors"))


LISTS = {
    "type": "object", "required": ["note"],
    "properties": {"note": {"type": ["string", "null"]}, "tags": {"type": "array", "items": {"type": "string", "maxLength": 7}}},
}


@query("contract_items", """
SELECT event_id, 'note' AS field_path, 'string|null' AS expected, 'integer' AS actual FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, 'tags[1]', 'string', 'integer' FROM events WHERE event_type = 'error'
UNION ALL SELECT event_id, 'tags[0]', 'maxLength 7', '8' FROM events WHERE event_type = 'purchase'
UNION ALL SELECT event_id, NULL, NULL, NULL FROM events WHERE event_type IN ('view', 'signup')
""")
def contract_items(spark, sf_dir):
    """Fields of several types and arrays: views have a null note and clicks a number, errors a number among their tags."""
    kind = F.col("event_type")
    note = F.when(kind == "view", "null").when(kind == "click", "5").otherwise('"x"')
    second = F.when(kind == "error", F.col("user_id").cast("string")).otherwise('"t"')
    value = F.concat(F.lit('{"note":'), note, F.lit(',"tags":["'), kind, F.lit('",'), second, F.lit("]}"))
    checked = contracts.contract_validate(table(spark, sf_dir, "events").select("event_id", value.alias("value")), LISTS)
    return checked.select("event_id", F.inline_outer("errors")).drop("message")


@query("contract_quarantine", f"""
{FAULTS} SELECT valid, event_type, coalesce(actual, '') AS fault, count(*) AS records FROM found GROUP BY ALL
""")
def contract_quarantine(spark, sf_dir):
    """What lies in the table of valid records and in the quarantine after the split."""
    checked = contracts.contract_validate(faulty(spark, sf_dir), CONTRACT)
    good, bad = contracts.contract_quarantine(checked, new_path(spark, "checked"))
    kind = F.col("headers")["event_type"].cast("string").alias("event_type")
    kept = good.select(F.lit(True).alias("valid"), kind, F.lit("").alias("fault"))
    held = bad.select(F.lit(False).alias("valid"), kind, F.col("errors")[0]["actual"].alias("fault"))
    return kept.unionByName(held).groupBy("valid", "event_type", "fault").agg(F.count("*").alias("records"))


# -- headers and traces -----------------------------------------------------------------------------


@query("header_get", f"""WITH {ELOG} SELECT "partition", "offset", hex(encode(event_type)) AS type_bytes, CAST(NULL AS VARCHAR) AS absent FROM elog""")
def header_get(spark, sf_dir):
    head = F.col("headers")
    return events(spark, sf_dir).select(
        "partition", "offset", F.hex(h.header_get(head, "event_type")).alias("type_bytes"),
        F.hex(h.header_get(head, "none")).alias("absent"),
    )


@query("header_get_str", f"""
WITH {ELOG} SELECT "partition", "offset", event_type, CASE WHEN event_type <> 'error' THEN props END AS props FROM elog
""")
def header_get_str(spark, sf_dir):
    """Errors get a props header that is no text."""
    head = F.col("headers")
    broken = F.when(h.header_get_str(head, "event_type") == "error", h.header_add(head, "props", F.lit(b"\x00\xff\xab\xcd"))).otherwise(head)
    return events(spark, sf_dir).select(
        "partition", "offset", h.header_get_str(head, "event_type").alias("event_type"), h.header_get_str(broken, "props").alias("props")
    )


@query("header_add", f"""
WITH {ELOG} SELECT "partition", "offset", 'v-' || event_type AS event_type, "key" AS source, CAST(4 AS INTEGER) AS headers_n FROM elog
""")
def header_add(spark, sf_dir):
    """One header overwritten, one added."""
    old = h.header_get_str(F.col("headers"), "event_type")
    added = h.header_add(h.header_add(F.col("headers"), "event_type", F.concat(F.lit("v-"), old)), "source", F.col("key"))
    return events(spark, sf_dir).withColumn("headers", added).select(
        "partition", "offset", h.header_get_str(F.col("headers"), "event_type").alias("event_type"),
        h.header_get_str(F.col("headers"), "source").alias("source"), h.header_count(F.col("headers")).alias("headers_n"),
    )


TRACE = "'00-' || md5('trace-' || event_id) || '-' || substr(md5('span-' || event_id), 1, 16) || '-01'"


@query("header_explode", f"""
WITH {ELOG}
SELECT "partition", "offset", 'event_type' AS header_name, event_type AS header_text, CAST(3 AS INTEGER) AS headers_n, FALSE AS is_empty FROM elog
UNION ALL SELECT "partition", "offset", 'props', props, 3, FALSE FROM elog
UNION ALL SELECT "partition", "offset", 'traceparent', {TRACE}, 3, FALSE FROM elog
""")
def header_explode(spark, sf_dir):
    counted = events(spark, sf_dir).withColumns(
        {"headers_n": h.header_count(F.col("headers")), "is_empty": h.headers_empty(F.col("headers"))}
    )
    return h.header_explode(counted.select("partition", "offset", "headers_n", "is_empty", "headers")).select(
        "partition", "offset", "header_name", F.col("header_value").cast("string").alias("header_text"), "headers_n", "is_empty"
    )


@query("trace_extract", f"""
WITH {ELOG}
SELECT "partition", "offset", CASE WHEN event_type <> 'error' THEN md5('trace-' || event_id) END AS trace_id,
       CASE WHEN event_type <> 'error' THEN substr(md5('span-' || event_id), 1, 16) END AS span_id,
       CASE WHEN event_type <> 'error' THEN '01' END AS trace_flags FROM elog
""")
def trace_extract_query(spark, sf_dir):
    """Errors carry a trace parent that is no text, so they have no context."""
    head = F.col("headers")
    broken = F.when(h.header_get_str(head, "event_type") == "error", h.header_add(head, "traceparent", F.lit(b"\xff\xfe"))).otherwise(head)
    found = trace_extract(broken)
    return events(spark, sf_dir).select("partition", "offset", *[found[c].alias(c) for c in ("trace_id", "span_id", "trace_flags")])


@query("trace_inject", f"""
WITH {ELOG}
SELECT "partition", "offset", '00-' || md5("key") || '-' || substr(md5('child-' || event_id), 1, 16) ||
       CASE WHEN event_type = 'error' THEN '-01' ELSE '-00' END AS traceparent FROM elog
""")
def trace_inject_query(spark, sf_dir):
    """A new context per record: the trace is the user's, errors are sampled."""
    head = F.col("headers")
    number = F.get_json_object("value", "$.event_id")
    span = F.substring(F.md5(F.concat(F.lit("child-"), number)), 1, 16)
    put = trace_inject(head, F.md5("key"), span, h.header_get_str(head, "event_type") == "error")
    return events(spark, sf_dir).select("partition", "offset", h.header_get_str(put, "traceparent").alias("traceparent"))


@query("trace_join", f"""
WITH {ELOG}
SELECT md5('trace-' || event_id) AS trace_id, topic, "partition", "offset", 'events produce' AS produce_span,
       'events process' AS process_span, "timestamp" AS produced_at, "timestamp" + CAST(floor(amount) AS BIGINT) AS processed_at,
       CAST(floor(amount) AS BIGINT) AS latency_ms
FROM elog WHERE event_type <> 'error'
""")
def trace_join(spark, sf_dir):
    """Every event is produced; all but errors are processed, after a delay its value tells."""
    records = events(spark, sf_dir)
    delay = F.floor(F.get_json_object("value", "$.value").cast("double"))
    handled = records.where(h.header_get_str(F.col("headers"), "event_type") != "error").withColumn("done", F.col("timestamp") + delay)
    return tracing.trace_join(tracing.spans(records, "produce"), tracing.spans(handled, "process", "done"))
