"""Schemas of topics: the catalog, typed decoding of values, and compatibility."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.operators.ordered import ordered_scan

AVRO, JSON = "AVRO", "JSON"
CORRUPT = "_corrupt_record"

# Avro and JSON Schema primitive names and their Spark types (fixed values).
AVRO_TYPES = {
    "boolean": T.BooleanType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(),
    "double": T.DoubleType(), "string": T.StringType(), "bytes": T.BinaryType(), "null": T.NullType(),
    "enum": T.StringType(), "fixed": T.BinaryType(),
}
JSON_TYPES = {
    "boolean": T.BooleanType(), "integer": T.LongType(), "number": T.DoubleType(), "string": T.StringType(),
    "null": T.NullType(),
}
# Avro's widenings: a reader of the second type can read the first.
PROMOTIONS = [
    ("int", "long"), ("int", "float"), ("int", "double"), ("long", "float"), ("long", "double"),
    ("float", "double"), ("string", "bytes"), ("bytes", "string"),
]
JSON_PROMOTIONS = [("integer", "number")]
DELETED = "deleted"
RECURSIVE = "recursive"  # a record whose fields are being read


def full_name(schema: dict, namespace: str) -> tuple[str, str]:
    """The full name of a record, enum or fixed type ("" without a name), and the namespace that names inside it are read in."""
    name = schema.get("name", "")
    if name and "." not in name:
        space = schema.get("namespace", namespace)
        name = f"{space}.{name}" if space else name
    return name, name.rpartition(".")[0] if name else namespace


def named(known: dict, name: str, namespace: str):
    """What a name stands for that is no primitive type: in its namespace, or as it is."""
    for full in (f"{namespace}.{name}", name):
        if full in known:
            return known[full]
    raise ValueError(f"type {name!r} is not known")


def avro_type(schema, known: dict | None = None, namespace: str = "") -> T.DataType:
    """known: the types of the names that have been declared so far. A record inside itself has no Spark type: an error."""
    known = {} if known is None else known
    if isinstance(schema, list):
        kinds = [avro_type(s, known, namespace) for s in schema if s != "null"]
        return kinds[0] if len(kinds) == 1 else T.StringType()
    if isinstance(schema, str):
        found = AVRO_TYPES.get(schema) or named(known, schema, namespace)
        if found == RECURSIVE:
            raise ValueError(f"record {schema!r} holds itself and cannot be decoded")
        return found
    kind = schema["type"]
    if kind == "array":
        return T.ArrayType(avro_type(schema["items"], known, namespace))
    if kind == "map":
        return T.MapType(T.StringType(), avro_type(schema["values"], known, namespace))
    if kind in ("record", "enum", "fixed"):
        name, inner = full_name(schema, namespace)
        known[name] = RECURSIVE
        known[name] = AVRO_TYPES[kind] if kind != "record" else T.StructType(
            [T.StructField(f["name"], avro_type(f["type"], known, inner)) for f in schema["fields"]])
        return known[name]
    return avro_type(kind, known, namespace)


def json_schema_type(schema: dict) -> T.DataType:
    """A property that may be null is of its other type; one of several types is text, integers among numbers are numbers."""
    kind = schema.get("type", "object" if "properties" in schema else "string")
    if isinstance(kind, list):
        kinds = set(kind) - {"null"} - ({"integer"} if "number" in kind else set())
        return json_schema_type({**schema, "type": kinds.pop()}) if len(kinds) == 1 else T.StringType()
    if kind == "object":
        return T.StructType([T.StructField(n, json_schema_type(s)) for n, s in schema.get("properties", {}).items()])
    if kind == "array":
        return T.ArrayType(json_schema_type(schema.get("items", {})))
    return JSON_TYPES[kind]


def struct_of(text: str, schema_type: str = AVRO) -> T.StructType:
    """The Spark type that values of a schema decode to."""
    if schema_type == AVRO:
        return avro_type(json.loads(text))
    if schema_type == JSON:
        return json_schema_type(json.loads(text))
    raise ValueError(f"values of {schema_type} schemas cannot be decoded from JSON")


def required_fields(text: str, schema_type: str = AVRO) -> list[str]:
    """Top-level fields that a value must have: no default, and null is not among their types."""
    schema = json.loads(text)
    if schema_type == JSON:
        may_be_null = {n for n, rule in schema.get("properties", {}).items() if "null" in rule.get("type", [])}
        return [n for n in schema.get("required", []) if n not in may_be_null]
    return [
        f["name"] for f in schema["fields"]
        if "default" not in f and f["type"] != "null" and not (isinstance(f["type"], list) and "null" in f["type"])
    ]


def decode_topic(records: DataFrame, text: str, schema_type: str = AVRO, value: str = "value") -> DataFrame:
    """Records with `decoded`, a struct by the schema, or else `corrupt`, the value that does not fit it."""
    fields = struct_of(text, schema_type).fields
    wanted = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value).cast("string"), wanted, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = records.withColumn("_parsed", parsed)
    fits = F.col("_parsed").isNotNull() & F.col("_parsed").getField(CORRUPT).isNull()
    for name in required_fields(text, schema_type):
        fits = fits & F.col("_parsed").getField(name).isNotNull()
    typed = F.struct(*[F.col("_parsed").getField(f.name).alias(f.name) for f in fields])
    return out.select(
        *records.columns, F.when(fits, typed).alias("decoded"), F.when(~fits, F.col(value).cast("string")).alias("corrupt")
    )


# -- the catalog: schemas(id, subject, version, schema_type, schema[, deleted]) -----------------------
#
# Nothing is taken out of it: a deleted subject's rows are marked, so that their ids and versions are never given again
# and stored records go on to name the schema they were written with.


def live(schemas: DataFrame) -> DataFrame:
    """The rows that are not deleted."""
    return schemas.where(~F.coalesce(F.col(DELETED), F.lit(False))) if DELETED in schemas.columns else schemas


def subjects(schemas: DataFrame) -> DataFrame:
    return live(schemas).select("subject").distinct()


def versions(schemas: DataFrame, subject: str | None = None) -> DataFrame:
    """Versions per subject; an unknown subject gives no row."""
    schemas = live(schemas)
    if subject is not None:
        schemas = schemas.where(F.col("subject") == subject)
    return schemas.groupBy("subject").agg(F.array_sort(F.collect_list("version")).alias("versions"))


def schema_by_id(schemas: DataFrame, schema_id: int) -> DataFrame:
    return schemas.where(F.col("id") == schema_id).select("id", "schema_type", "schema").distinct()


def latest(schemas: DataFrame) -> DataFrame:
    newest = F.max(F.struct("version", "id", "schema_type", "schema")).alias("s")
    return live(schemas).groupBy("subject").agg(newest).select("subject", "s.*")


def schema_register(requests: DataFrame, schemas: DataFrame, arrival: list[str]) -> DataFrame:
    """The rows that requests (subject, schema_type, schema) add to the catalog.

    A text already known keeps its id everywhere, and its version under the same subject. New ids follow
    the highest id, new versions the subject's highest, both in the order of first arrival; what has been deleted counts.
    """
    order = F.struct(*arrival)
    text = ["schema_type", "schema"]
    firsts = requests.groupBy("subject", *text).agg(F.min(order).alias("_first"))
    fresh = firsts.join(live(schemas), ["subject", *text], "left_anti")

    known_ids = schemas.select("id", *text).distinct()
    new_texts = fresh.groupBy(*text).agg(F.min("_first").alias("_first")).join(known_ids, text, "left_anti")
    top_id = schemas.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")).first().top
    new_ids = ordered_scan(new_texts, [], ["_first"], number="_n").select(*text, (F.col("_n") + top_id + 1).alias("id"))
    ids = known_ids.withColumn("id", F.col("id").cast("bigint")).unionByName(new_ids.select("id", *text))

    top_version = schemas.groupBy("subject").agg(F.max("version").alias("_top"))
    return (
        ordered_scan(fresh, ["subject"], ["_first"], number="_n")
        .join(top_version, "subject", "left")
        .withColumn("version", (F.coalesce("_top", F.lit(0)) + F.col("_n") + 1).cast("int"))
        .join(ids, text)
        .select(F.col("id").cast("int").alias("id"), "subject", "version", *text)
    )


def schema_delete(schemas: DataFrame, deleted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the catalog with the rows of the deleted subjects marked, the versions that were removed)."""
    gone = deleted.select(F.col("subject").alias("_gone")).distinct()
    removed = versions(schemas.join(gone, F.col("subject") == F.col("_gone"), "left_semi"))
    before = F.coalesce(F.col(DELETED), F.lit(False)) if DELETED in schemas.columns else F.lit(False)
    marked = schemas.join(gone, F.col("subject") == F.col("_gone"), "left").withColumn(DELETED, before | F.col("_gone").isNotNull())
    return marked.drop("_gone"), removed


FIELDS = "array<struct<name:string,kinds:array<string>,has_default:boolean,aliases:array<string>>>"
Told = tuple[str, list[str], bool, list[str]]  # path, kinds, has default, other paths it is known by


def avro_fields(schema, paths: tuple[str, ...] = ("",), known: dict | None = None, namespace: str = "", inside: tuple = ()) -> list[Told]:
    """The fields of a record, those of records inside it included; a record inside itself is not entered again."""
    known = {} if known is None else known
    if not isinstance(schema, dict) or "fields" not in schema:
        return []
    full, space = full_name(schema, namespace)
    known[full], inside = schema, (*inside, id(schema))
    out = []
    for field in schema["fields"]:
        names, kinds = [f"{p}{n}" for p in paths for n in (field["name"], *field.get("aliases", []))], []
        for branch in field["type"] if isinstance(field["type"], list) else [field["type"]]:
            kind, record = avro_kind(branch, known, space)
            kinds.append(kind)
            if record is not None and id(record) not in inside:
                out += avro_fields(record, tuple(f"{n}." for n in names), known, space, inside)
        out.append((names[0], sorted(kinds), "default" in field, names[1:]))
    return out


def avro_kind(branch, known: dict, namespace: str) -> tuple[str, dict | None]:
    """(the name of a type, the record that it is or holds): a record is `record`, others that are no primitive are told in full."""
    if isinstance(branch, str) and branch not in AVRO_TYPES:
        branch = named(known, branch, namespace)
    if isinstance(branch, str):
        return branch, None
    kind = branch["type"]
    if kind == "record":
        return "record", branch
    if kind in ("array", "map"):
        inner = branch["items"] if kind == "array" else branch["values"]
        if isinstance(inner, list):
            return json.dumps(branch, sort_keys=True), None
        told, record = avro_kind(inner, known, namespace)
        return ("record" if record is not None else json.dumps({**branch, "items" if kind == "array" else "values": told}, sort_keys=True)), record
    if kind in ("enum", "fixed"):
        known[full_name(branch, namespace)[0]] = branch
        return json.dumps(branch, sort_keys=True), None
    return (kind if isinstance(kind, str) else json.dumps(branch, sort_keys=True)), None


def json_fields(schema: dict, path: str = "") -> list[Told]:
    """The same of the properties of a JSON Schema object; what is not required need not be there, as with a default."""
    out = []
    for name, rule in schema.get("properties", {}).items():
        kind = rule.get("type", "any")
        out.append((f"{path}{name}", sorted(kind) if isinstance(kind, list) else [kind], name not in schema.get("required", []), []))
        deeper = rule
        while "array" in deeper.get("type", []):
            deeper = deeper.get("items", {})
        if "object" in deeper.get("type", []):
            out += json_fields(deeper, f"{path}{name}.")
    return out


def fields_of(schemas: DataFrame, *keys: str) -> DataFrame:
    """One row per field of each schema: keys, name (a path), kinds (the types it may have), has_default, aliases.

    Texts are taken apart in Arrow batches, each of a batch's texts once."""
    kinds = {AVRO: avro_fields, JSON: json_fields}
    if not schemas.columns.count("schema_type"):
        schemas = schemas.withColumn("schema_type", F.lit(AVRO))

    def told(schema_type: str, text: str) -> list[dict]:
        if schema_type not in kinds:
            raise ValueError(f"compatibility of {schema_type} schemas is not covered")
        return [dict(zip(("name", "kinds", "has_default", "aliases"), f)) for f in kinds[schema_type](json.loads(text))]

    def work(batches):
        import pyarrow as pa

        text = pa.list_(pa.string())
        item = pa.list_(pa.struct([("name", pa.string()), ("kinds", text), ("has_default", pa.bool_()), ("aliases", text)]))
        for batch in batches:
            pairs = list(zip(batch.column("schema_type").to_pylist(), batch.column("schema").to_pylist()))
            found = {pair: told(*pair) for pair in set(pairs)}
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array([found[p] for p in pairs], item)], [*keys, "_fields"])

    read = schemas.select(*keys, "schema_type", "schema")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in read.schema.fields[:-2])
    return read.mapInArrow(work, f"{types}, _fields {FIELDS}").select(*keys, F.inline("_fields"))


def renamed(new: DataFrame, old: DataFrame) -> DataFrame:
    """New fields under the name of the old one that they have as an alias, if there is none of their own name."""
    was = old.select("subject", F.col("name").alias("_was"))
    strange = new.join(was, (new["subject"] == was["subject"]) & (new["name"] == was["_was"]), "left_anti")
    hits = strange.select("subject", "name", F.explode("aliases").alias("_was")).join(was, ["subject", "_was"])
    first = hits.groupBy("subject", "name").agg(F.min("_was").alias("_was"))
    return new.join(first, ["subject", "name"], "left").withColumn("name", F.coalesce("_was", "name")).drop("_was", "aliases")


def readable(old: Column, new: Column) -> Column:
    """Whether every type that may have been written is among the types now, or is widened to one of them."""
    pairs = [f"{a}>{b}" for a, b in PROMOTIONS + JSON_PROMOTIONS]
    return F.forall(old, lambda o: F.exists(new, lambda n: (o == n) | (n == "any") | F.concat_ws(">", o, n).isin(*pairs)))


def schema_changes(candidates: DataFrame, schemas: DataFrame) -> DataFrame:
    """Per subject with an earlier schema and per field: what the candidate (subject, schema[, schema_type]) changes.

    change is removed, added, added without default, now required, widened or retyped. Whether a reader with the
    candidate can read what was written before is `breaks`: by fields without default and by new types. A default of
    null is a default; a field that names an earlier one as its alias is that one. Types that may be several things are told with a bar between them.
    """
    old = fields_of(latest(schemas).join(candidates, "subject", "left_semi"), "subject").withColumnsRenamed({"kinds": "old", "has_default": "had"}).drop("aliases")
    new = fields_of(candidates.join(latest(schemas), "subject", "left_semi"), "subject").withColumnRenamed("kinds", "new")
    new = renamed(new, old)
    both = old.join(new, ["subject", "name"], "full")
    json_type = F.coalesce(F.col("had"), F.lit(False)) & ~F.col("has_default")
    change = (
        F.when(F.col("new").isNull(), "removed")
        .when(F.col("old").isNull() & ~F.col("has_default"), "added without default")
        .when(F.col("old").isNull(), "added")
        .when((F.col("old") != F.col("new")) & ~readable(F.col("old"), F.col("new")), "retyped")
        .when(json_type & F.col("_json"), "now required")
        .when(F.col("old") != F.col("new"), "widened")
    )
    kinds = candidates.select("subject", (F.col("schema_type") == JSON if "schema_type" in candidates.columns else F.lit(False)).alias("_json"))
    return (
        both.join(kinds, "subject").withColumn("change", change).where("change IS NOT NULL")
        .select("subject", "name", F.array_join("old", "|").alias("old_type"), F.array_join("new", "|").alias("new_type"), "change",
                F.col("change").isin("added without default", "now required", "retyped").alias("breaks"))
    )


def schema_compat_report(candidates: DataFrame, schemas: DataFrame) -> DataFrame:
    """Per candidate subject: is_compatible with the latest version (always, if there is none)."""
    breaking = schema_changes(candidates, schemas).groupBy("subject").agg(
        F.count("*").alias("changes"), F.count_if("breaks").alias("breaking")
    )
    return candidates.select("subject").join(breaking, "subject", "left").select(
        "subject", F.coalesce("changes", F.lit(0)).alias("changes"),
        F.coalesce("breaking", F.lit(0)).alias("breaking"),
        (F.coalesce("breaking", F.lit(0)) == 0).alias("is_compatible"),
    )


def decode_rate(records: DataFrame, text: str, schema_type: str = AVRO, by: list[str] | None = None) -> DataFrame:
    """How many stored records a candidate schema can decode."""
    decoded = decode_topic(records, text, schema_type)
    return decoded.groupBy(*(by or ["topic"])).agg(
        F.count("*").alias("records"), F.count_if(F.col("decoded").isNotNull()).alias("decodable")
    )
