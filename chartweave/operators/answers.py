"""Answer tables: nested answers as flat columns, long and wide, with their evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartweave.functions.text import is_blank


def header(schema: dict, defs: dict | None = None) -> tuple[list[str], str | None]:
    """``(columns, row axis)`` of a declared JSON schema: dotted leaves, allOf merged, null branches dropped, references
    resolved; exactly one array of objects is the row axis, with two there is none."""
    defs = defs or schema.get("$defs", schema.get("definitions", {}))

    def solve(s: dict) -> dict:
        while "$ref" in s:
            s = defs[s["$ref"].rsplit("/", 1)[-1]]
        for branch in ("anyOf", "oneOf"):
            if branch in s:
                real = [solve(x) for x in s[branch] if x.get("type") != "null"]
                if len(real) == 1:
                    s = {**{k: v for k, v in s.items() if k != branch}, **real[0]}
        for part in s.get("allOf", []):
            p = solve(part)
            s = {**p, **s, "properties": {**p.get("properties", {}), **s.get("properties", {})}}
        return s

    columns, axes = [], []

    def walk(s: dict, path: str) -> None:
        s = solve(s)
        if "properties" in s:
            for k, v in s["properties"].items():
                walk(v, f"{path}.{k}" if path else k)
        elif "items" in s and "properties" in solve(s["items"]):
            axes.append(path)
        else:
            columns.append(path)

    walk(schema, "")
    if len(axes) == 1:
        def inner(s: dict, parts: list[str]) -> dict:
            s = solve(s)
            return solve(s["items"]) if not parts else inner(s["properties"][parts[0]], parts[1:])
        item = inner(schema, axes[0].split("."))
        sub, _ = header(item, defs)
        return columns + [f"{axes[0]}.{c}" for c in sub], axes[0]
    return columns + axes, None


def as_text(c: Column, kind: T.DataType) -> Column:
    """A cell as text: booleans upper case, lists of scalars joined by ``; ``, nested values as JSON."""
    if isinstance(kind, T.BooleanType):
        return F.upper(c.cast("string"))
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType)):
        return F.array_join(F.transform(c, lambda x: x.cast("string")), "; ")
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(c)
    return c.cast("string")


def flat(df: DataFrame, keys: list[str], data: str) -> DataFrame:
    """A struct column as dotted text columns."""
    out = []

    def walk(c: Column, kind: T.DataType, path: str) -> None:
        if isinstance(kind, T.StructType):
            for f in kind.fields:
                walk(c[f.name], f.dataType, f"{path}.{f.name}" if path else f.name)
        else:
            out.append(as_text(c, kind).alias(path))

    walk(F.col(data), df.schema[data].dataType, "")
    return df.select(*keys, *out)


def by_row_axis(df: DataFrame, axis: str) -> DataFrame:
    """One row per record of the axis with its ``row_index``; an empty list still gives one row."""
    return df.select("*", F.posexplode_outer(axis).alias("row_index", "record")).drop(axis)


def by_only_axis(df: DataFrame, axes: list[str]) -> DataFrame:
    """One row per record where the answers have one list of records.  With two or more there is no telling which makes the rows:
    each answer stays one row, every list becomes a JSON cell and ``axis_note`` names them."""
    if len(axes) == 1:
        return by_row_axis(df, axes[0]).withColumn("axis_note", F.lit(None).cast("string"))
    some = [F.when(F.size(a) > 0, F.lit(a)) for a in axes]
    note = F.array_join(F.array_compact(F.array(*some)), "; ")
    return df.select(*[F.to_json(c).alias(c) if c in axes else F.col(c) for c in df.columns], F.when(note != "", note).alias("axis_note"))


def any_value(columns: list[str]) -> Column:
    hit = F.lit(False)
    for c in columns:
        hit = hit | ~is_blank(F.col(c).cast("string"))
    return hit


def long_table(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``(*keys, field, value)``, all as text."""
    pairs = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.field", "p.value")


def wide_table(long: DataFrame, keys: list[str], field: str, value: str, fields: list[str]) -> DataFrame:
    """One row per key, a column per field; several distinct values of a cell are joined by ``; `` in their order."""
    return long.groupBy(*keys).pivot(field, fields).agg(F.array_join(F.sort_array(F.collect_set(value)), "; "))


def with_evidence(answers: DataFrame, passages: DataFrame, key: list[str], pointers: str, separator: str = r";\s*") -> DataFrame:
    """Answers with ``evidence_text``: the shown passage of each pointer in order, joined by `` ;; ``; a pointer without one
    says so."""
    each = answers.select(*key, F.posexplode(F.split(pointers, separator)).alias("pos", "pointer")).where(~is_blank(F.col("pointer")))
    j = each.join(passages.select(F.col("chunk_id").cast("string").alias("pointer"), F.col("passage")), "pointer", "left")
    text = F.coalesce("passage", F.concat(F.lit("(not shown: "), F.col("pointer"), F.lit(")")))
    g = j.groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", text.alias("t")))), lambda x: x["t"]), " ;; ").alias("evidence_text"), F.count_if(F.col("passage").isNull()).alias("not_shown"))
    return answers.join(g, key, "left")


def undeclared(df: DataFrame, data: str, declared: list[str]) -> Column:
    """The extra keys of a map column as one JSON cell, null if there are none."""
    extra = F.map_filter(F.col(data), lambda k, v: ~k.isin(declared))
    return F.when(F.size(extra) > 0, F.to_json(extra))


def trust_columns(steps: str = "steps") -> list[Column]:
    """From an array of step structs (step_id, found, rejected): rejected citations, steps that returned nothing, finders."""
    s = F.col(steps)
    return [
        F.aggregate(s, F.lit(0), lambda a, x: a + x["rejected"].cast("int")).alias("rejected_citations"),
        F.array_join(F.transform(F.filter(s, lambda x: x["found"] == 0), lambda x: x["step_id"]), "; ").alias("steps_returning_nothing"),
        F.array_join(F.transform(F.filter(s, lambda x: x["found"] > 0), lambda x: x["step_id"]), "; ").alias("steps_with_findings"),
    ]


def run_metadata(df: DataFrame, variable: str, patient: str) -> DataFrame:
    return df.groupBy(variable).agg(F.count("*").alias("n_rows"), F.count_distinct(patient).alias("n_patients"))


def display_summary(df: DataFrame, key: list[str], field: str, value: str, confidence: str, pointer: str, pos: str) -> DataFrame:
    """Per answer: ``field=value`` pairs in order, the greatest confidence of 100, and the distinct pointers in order."""
    g = df.groupBy(*key).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(pos, F.concat_ws("=", field, value).alias("t")))), lambda x: x["t"]), "; ").alias("summary"),
        (F.max(confidence) / 100).alias("confidence"),
        F.array_join(F.array_distinct(F.transform(F.sort_array(F.collect_list(F.when(F.col(pointer).isNotNull(), F.struct(pos, F.col(pointer).alias("t"))))), lambda x: x["t"])), "; ").alias("pointers"),
    )
    return g
