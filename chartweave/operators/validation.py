"""Checks of extracted answers: provenance, schema, rules across variables, canonical hashes."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartweave.functions.dates import interval, surely_before

#: What a key's name says of it.
POINTER_SUFFIXES = ("evidence_chunk_id", "evidence_chunk", "evidence_pointer", "source_chunk_id")
STRUCTURAL = {"confidence", "reasoning", "notes", "schema_version", "variable", "type"}


def is_pointer(key: str) -> bool:
    return key.endswith(POINTER_SUFFIXES)


def _bears_value(key: str, value: object) -> bool:
    if is_pointer(key) or key in STRUCTURAL or key.startswith("_"):
        return False
    return value is not None and not isinstance(value, (dict, list)) and str(value).strip().lower() not in ("", "unknown")


def unprovenanced_paths(data: object, path: str = "$") -> list[str]:
    """Objects with a value-bearing leaf but no filled pointer at their own level, in document order."""
    out = []
    if isinstance(data, dict):
        values = any(_bears_value(k, v) or isinstance(v, list) and any(not isinstance(x, (dict, list)) and _bears_value(k, x) for x in v) for k, v in data.items())
        pointed = any(is_pointer(k) and v not in (None, "", []) for k, v in data.items())
        if values and not pointed:
            out.append(path)
        for k, v in data.items():
            out += unprovenanced_paths(v, f"{path}.{k}")
    elif isinstance(data, list):
        for i, v in enumerate(data):
            out += unprovenanced_paths(v, f"{path}[{i}]")
    return out


def unprovenanced(df: DataFrame, keys: list[str], data: str) -> DataFrame:
    """``(*keys, path)`` for JSON answers; text that is no JSON gives the path ``!``."""
    found = checked_json(df, keys, data, {})
    paths = F.when(F.array_contains("errors", "no JSON"), F.array(F.lit("!"))).otherwise(F.col("unprovenanced"))
    return found.select(*keys, F.explode(paths).alias("path"))


def unpointed_groups(leaves: DataFrame, keys: list[str], parent: str, key: str, value: str) -> DataFrame:
    """The same rule over flattened leaves, in the JVM: parents with a value but without a filled pointer."""
    pointer = F.lit(False)
    for s in POINTER_SUFFIXES:
        pointer = pointer | F.col(key).endswith(s)
    filled = F.coalesce(F.trim(F.col(value)) != "", F.lit(False))
    bears = ~pointer & ~F.col(key).isin(sorted(STRUCTURAL)) & ~F.col(key).startswith("_") & filled & (F.lower(F.trim(F.col(value))) != "unknown")
    g = leaves.groupBy(*keys, parent).agg(F.bool_or(bears).alias("__v"), F.bool_or(pointer & filled).alias("__p"))
    return g.where("__v and not __p").select(*keys, parent)


def schema_errors(data: object, schema: dict, path: str = "$", root: dict | None = None) -> list[str]:
    """Errors of a value under a JSON schema, sorted by path: type, enum, const, $ref, allOf, anyOf, oneOf, pattern, format (date),
    lengths, minimum, maximum, required, properties, additionalProperties, items and the numbers of items."""
    root = root or schema
    if "$ref" in schema:
        target: object = root
        for part in schema["$ref"].lstrip("#/").split("/"):
            target = target[part]  # type: ignore[index]
        return schema_errors(data, {**target, **{k: v for k, v in schema.items() if k != "$ref"}}, path, root)  # type: ignore[dict-item]
    kinds = {"object": dict, "array": list, "string": str, "boolean": bool, "null": type(None)}
    out: list[str] = []

    def fits(kind: str) -> bool:
        if kind in ("number", "integer"):
            return isinstance(data, (int, float)) and not isinstance(data, bool) and (kind == "number" or float(data).is_integer())
        return isinstance(data, kinds[kind])

    want = schema.get("type")
    if want and not any(fits(k) for k in ([want] if isinstance(want, str) else want)):
        return [f"{path}: not {want}"]
    if "enum" in schema and data not in schema["enum"]:
        out.append(f"{path}: not one of {schema['enum']}")
    if "const" in schema and data != schema["const"]:
        out.append(f"{path}: not {schema['const']!r}")
    for part in schema.get("allOf", []):
        out += schema_errors(data, part, path, root)
    for name, good in (("anyOf", lambda n: n > 0), ("oneOf", lambda n: n == 1)):
        if name in schema and not good(sum(not schema_errors(data, s, path, root) for s in schema[name])):
            out.append(f"{path}: fits {'none' if name == 'anyOf' else 'not exactly one'} of its forms")
    if isinstance(data, str):
        if "pattern" in schema and not re.search(schema["pattern"], data):
            out.append(f"{path}: doesn't match {schema['pattern']}")
        if schema.get("format") == "date" and not _is_day(data):
            out.append(f"{path}: no date")
        if not schema.get("minLength", 0) <= len(data) <= schema.get("maxLength", len(data)):
            out.append(f"{path}: too short or too long")
    if isinstance(data, (int, float)) and not isinstance(data, bool):
        if data < schema.get("minimum", data) or data > schema.get("maximum", data):
            out.append(f"{path}: out of range")
    if isinstance(data, dict):
        props = schema.get("properties", {})
        out += [f"{path}.{k}: missing" for k in schema.get("required", []) if k not in data]
        if schema.get("additionalProperties") is False:
            out += [f"{path}.{k}: not allowed" for k in data if k not in props]
        for k, v in data.items():
            if k in props:
                out += schema_errors(v, props[k], f"{path}.{k}", root)
    if isinstance(data, list):
        if not schema.get("minItems", 0) <= len(data) <= schema.get("maxItems", len(data)):
            out.append(f"{path}: too few or too many items")
        for i, v in enumerate(data if "items" in schema else []):
            out += schema_errors(v, schema["items"], f"{path}[{i}]", root)
    return sorted(set(out))


def _is_day(text: str) -> bool:
    try:
        return len(text) == 10 and bool(date.fromisoformat(text))
    except ValueError:
        return False


def checked_json(df: DataFrame, keys: list[str], data: str, schema: dict) -> DataFrame:
    """``(*keys, schema_ok, errors, unprovenanced, found)`` of JSON answers, in Arrow batches; equal texts of a batch are read once.
    Null gives no error of its own but is judged as the value null; text that is no JSON has the one error ``no JSON``."""
    out = T.StructType([*(df.schema[k] for k in keys), T.StructField("schema_ok", T.BooleanType()), T.StructField("errors", T.ArrayType(T.StringType())), T.StructField("unprovenanced", T.ArrayType(T.StringType())), T.StructField("found", T.IntegerType())])

    def judged(text: str | None) -> tuple[bool, list[str], list[str], int]:
        try:
            value = None if text is None else json.loads(text)
        except ValueError:
            return False, ["no JSON"], [], 0
        errors = schema_errors(value, schema)
        return not errors, errors, unprovenanced_paths(value), found_count(value)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = [None if t is None or t != t else t for t in pdf["__data"]]
            known = {t: judged(t) for t in set(texts)}
            rows = pd.DataFrame([known[t] for t in texts], columns=["schema_ok", "errors", "unprovenanced", "found"])
            yield pd.concat([pdf[keys].reset_index(drop=True), rows], axis=1)

    return df.select(*keys, F.col(data).alias("__data")).mapInPandas(run, out)


def is_ok(schema_ok: Column, failed_steps: Column, unprovenanced_count: Column) -> Column:
    return schema_ok & (failed_steps == 0) & (unprovenanced_count == 0)


def outcomes(df: DataFrame, keys: list[str], rules: dict[str, Callable[[], Column]]) -> DataFrame:
    """``(*keys, rule, outcome)``: passed, failed, or did_not_run where the rule's answer is null.  A rule whose expression
    can't be built counts as did_not_run for every row."""
    made = []
    for name, rule in rules.items():
        try:
            v = rule()
        except Exception:
            v = F.lit(None).cast("boolean")
        made.append(F.struct(F.lit(name).alias("rule"), F.when(v, "passed").when(~v, "failed").otherwise("did_not_run").alias("outcome")))
    return df.select(*keys, F.explode(F.array(*made)).alias("o")).select(*keys, "o.rule", "o.outcome")


def rule_tally(found: DataFrame) -> DataFrame:
    return found.groupBy("rule").agg(*[F.count_if(F.col("outcome") == o).alias(o) for o in ("passed", "failed", "did_not_run")])


def with_intervals(df: DataFrame, **dates: str) -> DataFrame:
    """Adds the interval of each date column under a name of its own, so that no rule reads a date twice."""
    return df.select("*", *[interval(F.col(c)).alias(name) for name, c in dates.items()])


def ordered(earlier: Column, later: Column) -> Column:
    """Interval ``earlier`` isn't surely after ``later``; null where a date is missing or no date."""
    return F.when(earlier.isNotNull() & later.isNotNull(), ~F.coalesce(surely_before(later, earlier), F.lit(False)))


def not_adjacent(a: Column, b: Column) -> Column:
    """Two intervals lie more than a calendar month apart; null where one is missing or wider than a month."""
    one = lambda x: F.trunc(x["lo"], "month") == F.trunc(x["hi"], "month")
    number = lambda x: F.year(x["lo"]) * 12 + F.month(x["lo"])
    return F.when(one(a) & one(b), F.abs(number(a) - number(b)) > 1)


def within(day: Column, first: Column, last: Column) -> Column:
    """Interval ``day`` is surely neither before ``first`` nor after ``last``; a missing bound bounds nothing, a missing day gives null."""
    bad = F.coalesce(surely_before(day, first), F.lit(False)) | F.coalesce(surely_before(last, day), F.lit(False))
    return F.when(day.isNotNull(), ~bad)


def gathered(results: DataFrame, entity: str, variable: str, value: str, roles: dict[str, tuple[str, ...]]) -> DataFrame:
    """One row per entity with a column per role: the value of the first of its variables that has one.  One shuffle on the
    entity; a variable that stands twice gives its greatest value."""
    wanted = sorted({v for names in roles.values() for v in names})
    wide = results.where(F.col(variable).isin(wanted)).groupBy(entity).agg(*[F.max(F.when(F.col(variable) == v, F.col(value))).alias(f"__{i}") for i, v in enumerate(wanted)])
    return wide.select(entity, *[F.coalesce(*[F.col(f"__{wanted.index(v)}") for v in names]).alias(role) for role, names in roles.items()])


def missing_targets(roles: dict[str, tuple[str, str]], declared: dict[str, set[str]]) -> list[str]:
    """What a rule would read and no recipe declares: a rule that reads nothing passes, so this must be empty before any runs."""
    out = []
    for role, (recipe, field) in sorted(roles.items()):
        if recipe not in declared:
            out.append(f"{role}: no recipe {recipe}")
        elif field not in declared[recipe]:
            out.append(f"{role}: {recipe} declares no {field}")
    return out


def lines_in_order(df: DataFrame, by: list[str], number: str, start: str) -> DataFrame:
    """``(*by, number, start, previous, ok)``: a therapy line doesn't start before the line numbered before it."""
    from pyspark.sql import Window as W

    w = W.partitionBy(*by).orderBy(number, start)
    out = df.withColumn("previous", F.lag(start).over(w))
    return out.withColumn("ok", F.coalesce(F.col("previous") <= F.col(start), F.lit(True)))


def cell_pointer(patient: Column, file_hash: Column, row_hash: Column, column: str) -> Column:
    return F.concat_ws(":", patient, F.lit("structured"), file_hash, F.lit("row"), row_hash, F.lit("column"), F.lit(column))


def row_hash(columns: list[str]) -> Column:
    """sha256 of the row as canonical JSON: keys sorted, compact, nulls kept."""
    parts = [F.concat(F.to_json(F.struct(F.lit(c).alias("k"))).substr(F.lit(6), F.length(F.lit(c)) + 2), F.lit(":"), F.coalesce(F.regexp_extract(F.to_json(F.struct(F.col(c).cast("string").alias("v"))), r"^\{\"v\":(.*)\}$", 1), F.lit("null"))) for c in sorted(columns)]
    fixed = [F.when(F.col(c).isNull(), F.concat(F.lit(json.dumps(c) + ":"), F.lit("null"))).otherwise(p) for c, p in zip(sorted(columns), parts)]
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(",", *fixed), F.lit("}")), 256)


def canonical_hash(data: object, skip: tuple[str, ...] = ()) -> str:
    """sha256 of sorted-key compact JSON; an envelope leaves out its own hash and time."""
    if isinstance(data, dict):
        data = {k: v for k, v in data.items() if k not in skip}
    return "sha256:" + hashlib.sha256(json.dumps(data, sort_keys=True, separators=(",", ":"), default=str, ensure_ascii=False).encode()).hexdigest()


def found_count(data: object) -> int:
    """How much an answer holds: its records, if it has exactly one list of records, else its value-bearing leaves."""
    lists, leaves = [], 0

    def walk(d: object) -> None:
        nonlocal leaves
        if isinstance(d, dict):
            for k, v in d.items():
                if isinstance(v, list) and v and all(isinstance(x, dict) for x in v):
                    lists.append(len(v))
                if isinstance(v, (dict, list)):
                    walk(v)
                leaves += _bears_value(k, v)
        elif isinstance(d, list):
            for x in d:
                walk(x)

    walk(data)
    return lists[0] if len(lists) == 1 else leaves


def artifact_report(artifacts: DataFrame, kind: str, payload: str, schemas: dict[str, dict]) -> DataFrame:
    """``(artifact_type, rows, invalid, example)`` of JSON payloads against the schema of their type; a type without one is
    invalid, as is text that is no JSON."""

    def errors(t: str | None, text: str | None) -> str | None:
        if t not in schemas:
            return "unknown type"
        try:
            found = schema_errors(json.loads(text), schemas[t]) if text else ["empty"]
        except ValueError:
            return "no JSON"
        return found[0] if found else None

    def run(t: pd.Series, text: pd.Series) -> pd.Series:
        return pd.Series([errors(a, b) for a, b in zip(t, text)], dtype=object)

    marked = artifacts.select(F.col(kind).alias("artifact_type"), F.pandas_udf(run, "string")(kind, payload).alias("e"))
    return marked.groupBy("artifact_type").agg(F.count("*").alias("rows"), F.count("e").alias("invalid"), F.min("e").alias("example"))
