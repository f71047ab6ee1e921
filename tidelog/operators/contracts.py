"""Data contracts: checking record values field by field."""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILURE = "struct<field_path:string,expected:string,actual:string,message:string>"

# JSON Schema type names.
TYPES = ["object", "array", "string", "integer", "number", "boolean", "null"]


# Keywords that are checked, and those that say nothing about validity.
BOUNDS = {"minimum": ">=", "maximum": "<=", "exclusiveMinimum": ">", "exclusiveMaximum": "<"}
CHECKED = {"type", "properties", "required", "additionalProperties", "items", "enum", "minLength", "maxLength", "pattern", *BOUNDS}
SILENT = {"$schema", "$id", "$comment", "title", "description", "default", "examples"}


class Field(NamedTuple):
    path: tuple[str, ...]
    rule: dict
    required: bool

    @property
    def name(self) -> str:
        return ".".join(self.path)


def contract_fields(contract: dict | str) -> list[Field]:
    """Each property of a JSON Schema object, nested ones included. A keyword that is not covered is an error."""
    schema = json.loads(contract) if isinstance(contract, str) else contract
    _check_rule(schema, "$")
    return list(_fields(schema, (), True))


def kinds_of(rule: dict) -> list[str]:
    """The types that a rule allows; none for any."""
    kind = rule.get("type", [])
    return [kind] if isinstance(kind, str) else list(kind)


def _check_rule(rule: dict, path: str) -> None:
    unknown = set(rule) - CHECKED - SILENT
    if unknown:
        raise ValueError(f"keywords not covered at {path}: {sorted(unknown)}")
    if not set(kinds_of(rule)) <= set(TYPES):
        raise ValueError(f"unknown type {rule['type']!r} of {path}")
    if "items" in rule:
        inner = rule["items"]
        if not isinstance(inner, dict) or {"properties", "items", "required", "additionalProperties"} & set(inner):
            raise ValueError(f"items of {path} may only have keywords of plain values")
        _check_rule(inner, f"{path}[]")
    if not isinstance(rule.get("additionalProperties", True), bool):
        raise ValueError(f"additionalProperties of {path} must be true or false")


def _fields(schema: dict, prefix: tuple[str, ...], needed: bool) -> Iterator[Field]:
    required = set(schema.get("required", []))
    for name, rule in schema.get("properties", {}).items():
        field = Field((*prefix, name), rule, needed and name in required)
        _check_rule(rule, field.name)
        yield field
        if "properties" in rule:
            yield from _fields(rule, field.path, field.required)


def variant_path(path: tuple[str, ...]) -> str:
    """The path as Spark's variant functions read it, names quoted, so that dots in them are part of them."""
    return "$" + "".join(f'["{p}"]' if "'" in p else f"['{p}']" for p in path)


def rule_failures(field: Field, value: Column, kind: Column) -> list[Column]:
    """What a value that is there does against its rule; each is null where nothing is wrong."""
    rule, name, out = field.rule, field.name, []
    exact, rough = (F.try_variant_get(value, "$", kind_) for kind_ in ("decimal(38,9)", "double"))
    text = F.when(kind == "string", F.variant_get(value, "$", "string"))
    for word, sign in BOUNDS.items():
        if word in rule:
            # Large integers differ by less than a double can tell; what a decimal cannot hold is compared as a double.
            pairs = ((exact, F.lit(str(rule[word])).cast("decimal(38,9)")), (rough, F.lit(float(rule[word]))))
            wrong = F.coalesce(*[{">=": n < b, "<=": n > b, ">": n <= b, "<": n >= b}[sign] for n, b in pairs])
            out.append(F.when(kind.isin("integer", "number") & wrong, failure(name, f"{sign} {rule[word]}", F.to_json(value), F.lit(f"{name} must be {sign} {rule[word]}"))))
    for word, wrong in (("minLength", F.length(text) < rule.get("minLength", 0)), ("maxLength", F.length(text) > rule.get("maxLength", 0))):
        if word in rule:
            out.append(F.when(wrong, failure(name, f"{word} {rule[word]}", F.length(text).cast("string"), F.lit(f"{name} breaks {word} {rule[word]}"))))
    if "pattern" in rule:
        out.append(F.when(~text.rlike(rule["pattern"]), failure(name, rule["pattern"], text, F.lit(f"{name} does not match"))))
    if "enum" in rule:
        allowed = [json.dumps(v, separators=(",", ":"), ensure_ascii=False) for v in rule["enum"]]
        out.append(F.when(~F.to_json(value).isin(*allowed), failure(name, "enum", F.to_json(value), F.lit(f"{name} is none of the allowed values"))))
    return out


def type_failures(field: Field, kind: Column) -> list[Column]:
    """What a value that is there fails by its type."""
    kinds, name = kinds_of(field.rule), field.name
    if not kinds:
        return []
    fits = kind.isin(*kinds, *(["integer"] if "number" in kinds else []))
    told = F.concat(F.lit(f"{name} must be {' or '.join(kinds)}, found "), kind)
    return [F.when(kind.isNotNull() & ~fits, failure(name, "|".join(kinds), kind, told))]


def item_failures(field: Field, value: Column) -> Column:
    """The failures of an array's elements by its rule of items, at path[index]."""
    one = Field((*field.path[:-1], f"{field.path[-1]}[]"), field.rule["items"], False)

    def checked(element: Column, index: Column) -> Column:
        kind = json_type(element)
        at = F.concat(F.lit(field.name), F.lit("["), index.cast("string"), F.lit("]"))
        found = type_failures(one, kind) + rule_failures(one, element, kind)
        empty = F.array().cast(f"array<{FAILURE}>")
        return F.transform(F.array_compact(F.array(*found)) if found else empty, lambda f: f.withField("field_path", at))

    elements = F.try_variant_get(value, "$", "array<variant>")
    return F.coalesce(F.flatten(F.transform(elements, checked)), F.array().cast(f"array<{FAILURE}>"))


def extra_failures(path: tuple[str, ...], rule: dict, value: Column, kind: Column) -> list[Column]:
    if rule.get("additionalProperties", True):
        return []
    names = F.array(*[F.lit(n) for n in rule.get("properties", {})]).cast("array<string>")
    extra = F.array_except(F.json_object_keys(F.to_json(value)), names)
    first = F.concat_ws(".", *[F.lit(p) for p in path], extra[0])
    told = F.concat(first, F.lit(" is not among the properties"))
    found = failure("", "nothing", F.lit("present"), told).withField("field_path", first)
    return [F.when((kind == "object") & (F.size(extra) > 0), found)]


def json_type(value: Column) -> Column:
    """JSON Schema's name for the type of a variant; null for no value."""
    shown = F.schema_of_variant(value)
    return (
        F.when(value.isNull(), None)
        .when(F.is_variant_null(value), "null")
        .when(shown.startswith("OBJECT"), "object")
        .when(shown.startswith("ARRAY"), "array")
        .when(shown == "STRING", "string")
        .when((shown == "BIGINT") | shown.rlike(r"^DECIMAL\(\d+,\s?0\)$"), "integer")  # beyond 64 bits it is a decimal
        .when(shown == "BOOLEAN", "boolean")
        .otherwise("number")
    )


def failure(path: str, expected: str | None, actual: Column, message: Column) -> Column:
    return F.struct(
        F.lit(path).alias("field_path"), F.lit(expected).alias("expected"),
        actual.alias("actual"), message.alias("message"),
    ).cast(FAILURE)


def contract_validate(records: DataFrame, contract: dict | str, value: str = "value") -> DataFrame:
    """Add valid and errors, an array of (field_path, expected, actual, message).

    The value may be text or bytes. Bytes that are not UTF-8, and text that is no JSON object, are
    one failure of the whole value, at path "$".
    """
    fields = contract_fields(contract)
    text = F.try_validate_utf8(F.col(value).cast("string"))
    staged = records.withColumn("_json", F.try_parse_json(text))
    parts = {f"_f{i}": F.try_variant_get("_json", variant_path(f.path), "variant") for i, f in enumerate(fields)}
    kinds = {f"_k{i}": json_type(F.col(f"_f{i}")) for i in range(len(fields))}
    staged = staged.withColumns({"_kind": json_type(F.col("_json")), **parts}).withColumns(kinds)

    schema = json.loads(contract) if isinstance(contract, str) else contract
    checks = extra_failures((), schema, F.col("_json"), F.col("_kind"))
    for i, field in enumerate(fields):
        path, kind, actual = field.name, "|".join(kinds_of(field.rule)) or None, F.col(f"_k{i}")
        if field.required:
            checks.append(F.when(actual.isNull(), failure(path, kind, F.lit("missing"), F.lit(f"{path} is required"))))
        checks += type_failures(field, actual)
        checks += rule_failures(field, F.col(f"_f{i}"), actual) + extra_failures(field.path, field.rule, F.col(f"_f{i}"), actual)
    whole = (
        F.when(F.col(value).isNull(), failure("$", "object", F.lit("missing"), F.lit("no value")))
        .when(text.isNull(), failure("$", "utf-8", F.lit("bytes"), F.lit("value is not UTF-8 text")))
        .when(F.col("_kind").isNull(), failure("$", "object", F.lit("invalid"), F.lit("value is not JSON")))
        .when(F.col("_kind") != "object", failure("$", "object", F.col("_kind"), F.lit("value is not an object")))
    )
    by_field = F.array_compact(F.array(*checks)) if checks else F.array().cast(f"array<{FAILURE}>")
    items = [item_failures(f, F.col(f"_f{i}")) for i, f in enumerate(fields) if "items" in f.rule]
    if items:
        by_field = F.concat(by_field, *items)
    errors = F.when(whole.isNotNull(), F.array(whole)).otherwise(by_field)
    return staged.withColumn("errors", errors).select(
        *records.columns, (F.size("errors") == 0).alias("valid"), "errors"
    )


def contract_quarantine(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write checked records in one pass, apart by folder; return (valid records, quarantine with errors)."""
    checked.write.mode("append").partitionBy("valid").parquet(path)
    stored = checked.sparkSession.read.schema(checked.schema).parquet(path)
    return stored.where("valid").drop("valid", "errors"), stored.where("not valid").drop("valid")
