"""The registered queries of this subpackage, with the SQL they are checked against where there is any."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.attribution import section_tokens
from tidelog.llm.decontaminate import contamination
from tidelog.llm.exact import exact_groups
from tidelog.llm.html import extract
from tidelog.llm.langid import held_out, identify, learn_profiles
from tidelog.llm.lines import drop_repeated_lines
from tidelog.llm.manifest import folded, proofs
from tidelog.llm.merkle import audit, lay_out, warc_record
from tidelog.llm.neardup import near_duplicates
from tidelog.llm.packing import pack
from tidelog.llm.pieces import encode
from tidelog.llm.pii import KINDS, find_pii, fit_field
from tidelog.llm.text import documents, prepared
from tidelog.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepared(spark), sf_dir.rstrip("/"))

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def joined_spans(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def spans_of(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")


@query("op1_pii_spans")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents; the counts are of the patterns' matches, spans has also what the field adds."""
    docs = documents(spark, sf_dir)
    found = find_pii(docs, fit_field(docs))
    counts = [spans_of(kind).alias(f"n_{kind}") for kind in KINDS]
    added = (F.size("spans") - F.size("base")).cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(joined_spans("base"), 256).alias("base_sha256"), joined_spans("spans").alias("spans"), added)


@query("op2_token_attribution")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document's text, and of its source and language, which stand before it."""
    return section_tokens(documents(spark, sf_dir), ["source", "lang", "text"])


@query("op3_exact_dedup", f"""
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS t FROM documents)
WINDOW g AS (PARTITION BY t)
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicates of all documents."""
    return exact_groups(documents(spark, sf_dir))


LINES_SQL = f"""
lines AS (
  SELECT doc_id, lang, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents),
keyed AS (SELECT *, {LOWER.format(f"trim(line, {WHITE})")} AS key FROM lines),
shared AS (SELECT key, max(doc_id) AS winner FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT k.*, s.key IS NULL OR k.doc_id = s.winner AS stays FROM keyed k LEFT JOIN shared s ON k.key = s.key)"""


@query("op4_line_dedup", f"""
WITH {LINES_SQL}
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines shared by five documents or more, in all documents."""
    kept = drop_repeated_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op5_curve_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    pieces = pack(documents(spark, sf_dir))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those that are not held out."""
    docs = documents(spark, sf_dir)
    profiles = learn_profiles(docs.where(~held_out()).select("lang", "text"))
    found = identify(docs, profiles, ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(LOWER.format("coalesce(text, '')"))
HITS_SQL = f"""
item_words AS (SELECT item_id, {WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, w[s:s + least(10, len(w)) - 1] AS win
  FROM item_words, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS u(s) WHERE len(w) > 0),
doc_words AS (SELECT doc_id, {WORDS} AS w FROM documents),
places AS (
  SELECT d.doc_id, p.s AS s, len(i.win) AS n, i.item_id
  FROM (SELECT DISTINCT len(win) AS n FROM windows) l, doc_words d, unnest(range(1, len(d.w) - l.n + 2)) AS p(s), windows i
  WHERE len(i.win) = l.n AND i.win = d.w[p.s:p.s + l.n - 1]),
hits AS (SELECT doc_id, count(DISTINCT s + k) AS n_hit FROM places, unnest(range(0, n)) AS q(k) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM places) GROUP BY doc_id)"""


@query("op7_decontamination", f"""
WITH {HITS_SQL}
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hits h ON d.doc_id = h.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


NEAR_SQL = """
words AS (SELECT doc_id, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') AS w FROM {docs}),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s:s + least({size}, len(w)) - 1], ' ') AS sh, least({size}, len(w)) AS n
  FROM words, unnest(range(1, greatest(1, len(w) - {size} + 1) + 1)) AS u(s) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n_shingles FROM shingles GROUP BY doc_id),
both_sizes AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.n = b.n AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM both_sizes JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * n >= {percent} * (x.n_shingles + y.n_shingles - n)),
reach AS (
  SELECT doc_id, doc_id AS root FROM {docs}
  UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id WHERE r.root < l.b),
grouped AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)"""


@query("op8_near_duplicates", f"""
WITH RECURSIVE {NEAR_SQL.format(lower=LOWER.format("coalesce(text, '')"), size=3, percent=85, docs="documents")}
SELECT g.doc_id, coalesce(n_shingles, 0) AS n_shingles, component_id, g.doc_id = component_id AS kept
FROM grouped g LEFT JOIN sizes s ON g.doc_id = s.doc_id
""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of all documents by shingles of three words."""
    return near_duplicates(documents(spark, sf_dir), size=3, percent=85)


PER_FILE = 4096


@query("op9_merkle_audit", f"""
WITH records AS (
  SELECT page_id, 'crawl-' || CAST(page_id // {PER_FILE} AS VARCHAR) AS file, substr(md5(CAST(page_id AS VARCHAR)), 1, 2) AS fate,
         'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Length: ' AS head,
         coalesce(html, '') AS body, chr(13) || chr(10) || chr(13) || chr(10) AS gap FROM pages),
written AS (SELECT *, head || CAST(strlen(body) AS VARCHAR) || gap || body || gap AS record FROM records),
placed AS (SELECT *, sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id) - strlen(record) AS start FROM written)
SELECT file, CAST(start AS BIGINT) AS "offset", sha256(record) AS left_digest,
       CASE WHEN fate = '07' THEN sha256(head || CAST(strlen(body) AS VARCHAR) || gap || reverse(body) || gap) END AS right_digest,
       CASE WHEN fate = '07' THEN 'altered' ELSE 'missing' END AS fault
FROM placed WHERE fate IN ('07', '08')
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as archive files, against a replica in which some records are reversed and some lost."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    fate = F.substring(F.md5(F.col("page_id").cast("string")), 1, 2)
    records = pages.select(
        "page_id", F.concat(F.lit("crawl-"), F.floor(F.col("page_id") / PER_FILE).cast("string")).alias("file"), fate.alias("fate"),
        F.octet_length(warc_record(F.col("url"), F.col("html"))).cast("long").alias("length"), F.sha2(warc_record(F.col("url"), F.col("html")), 256).alias("digest"),
        F.when(fate == "07", F.sha2(warc_record(F.col("url"), F.reverse("html")), 256)).alias("reversed"),
    )
    placed = lay_out(records, "file", ["page_id"], "length")
    second = placed.where(~F.col("fate").eqNullSafe("08")).withColumn("digest", F.coalesce("reversed", "digest"))
    columns = ["file", "offset", "length", "digest"]
    replicas = placed.select(F.lit("first").alias("replica"), *columns).unionByName(second.select(F.lit("second").alias("replica"), *columns))
    return audit(replicas, "first", "second")


@query("op10_main_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    found = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"), ["page_id", "url"])
    return found.withColumn("n_chars", F.length("text").cast("long"))


TREE_LEVELS = 9  # that the SQL has room for: 8 ** 9 documents in a language


def tree_sql(levels: int) -> str:
    """Leaves, levels of the trees by language and of the tree over these, and each leaf's siblings and refolded digest."""
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)::BIGINT)), "
           "lambda a, c: list_reduce(list_prepend(xor(a, c), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295::BIGINT)")
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || {c}, '-')"
    row = lambda text: "sha256(" + " || ".join([*map(field, ["doc_id", "source", "lang", "n_chars"]), field(text)]) + ")"
    parts = [f"""
leaves AS (SELECT doc_id, lang, {row("text")} AS d, CASE WHEN {crc} % 3 = 0 THEN {row(LOWER.format("text"))} ELSE {row("text")} END AS t FROM documents),
l0 AS (SELECT coalesce(lang, '') AS name, lang IS NULL AS none, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, d) - 1 AS p, d, t FROM leaves),
n0 AS (SELECT none, name, p, d FROM l0),
w0 AS (SELECT none, name, p AS leaf_p, p, t AS f, '' AS proof FROM l0)"""]

    def climb(node: str, walk: str, keys: str, leaf: str, at: int) -> None:
        on = " AND ".join(f"w.{k} = r.{k}" for k in keys.split(", "))
        parts.append(f"""
r{node}{at + 1} AS (SELECT {keys}, p // 8 AS run, list(d ORDER BY p) AS ds, sum(count(*)) OVER (PARTITION BY {keys}) > 1 AS many FROM {node}{at} GROUP BY {keys}, p // 8),
{node}{at + 1} AS (SELECT {keys}, run AS p, CASE WHEN many THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d FROM r{node}{at + 1}),
{walk}{at + 1} AS (SELECT {", ".join(f"w.{k}" for k in keys.split(", "))}, {leaf}, run AS p,
  CASE WHEN many THEN sha256(array_to_string(list_concat(list_concat(ds[:p % 8], [f]), ds[p % 8 + 2:]), '')) ELSE f END AS f,
  CASE WHEN many THEN proof || array_to_string(list_concat(ds[:p % 8], ds[p % 8 + 2:]), '') ELSE proof END AS proof
  FROM {walk}{at} w JOIN r{node}{at + 1} r ON {on} AND w.p // 8 = r.run)""")

    for at in range(levels):
        climb("n", "w", "none, name", "leaf_p", at)
    parts.append(f"""
m0 AS (SELECT 0 AS top, row_number() OVER (ORDER BY none DESC, encode(name)) - 1 AS p, d, none, name FROM n{levels}),
v0 AS (SELECT 0 AS top, w.none, w.name, w.leaf_p, m0.p, w.f, w.proof FROM w{levels} w JOIN m0 ON w.none = m0.none AND w.name = m0.name)""")
    for at in range(levels):
        climb("m", "v", "top", "w.none, w.name, w.leaf_p", at)
    return ",".join(parts)


@query("op11_merkle_manifest", f"""
WITH {tree_sql(TREE_LEVELS)}
SELECT doc_id, l.d AS leaf, n.d AS subroot, m.d AS root, sha256(v.proof) AS proof_sha256, v.f AS folded_root, v.f = m.d AS verified
FROM l0 l JOIN n{TREE_LEVELS} n ON l.none = n.none AND l.name = n.name
JOIN v{TREE_LEVELS} v ON l.none = v.none AND l.name = v.name AND l.p = v.leaf_p CROSS JOIN m{TREE_LEVELS} m
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A witness for every document, tried on what a tamperer leaves of it."""
    tried = proofs(documents(spark, sf_dir)).withColumn("folded_root", folded(F.col("tried"), F.col("path")))
    return tried.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op12_sentencepiece")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of all documents, and the texts that these decode to."""
    coded = encode(documents(spark, sf_dir))
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on their four leading components."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=4)
