"""Metadata filters, compiled to three-valued column expressions.

A filter answers true, false or "can't be answered" (null); a missing value is null or blank after trimming.  Filters are
joined by AND and a candidate is charged to the first filter that it fails.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartweave.functions.dates import interval, may_satisfy
from chartweave.functions.text import finite_number

#: The kind of each metadata field.
KINDS = {"document_date": "date", "age": "number", "author": "text", "linked_author": "text", "doc_type": "text", "title": "text", "encounter_id": "text", "specialty": "text"}
ORDERED = (">", ">=", "<", "<=")
OPS = ("==", "!=", "contains", "not_contains", "in", *ORDERED)


@dataclass(frozen=True)
class Filter:
    field: str
    op: str
    value: Any
    keep_if_missing: bool = False

    def checked(self, kinds: dict[str, str] | None = None) -> Filter:
        """Itself, if field and operator are known and fit each other."""
        kinds = kinds or KINDS
        if self.field not in kinds:
            raise ValueError(f"unknown field {self.field!r}")
        if self.op not in OPS:
            raise ValueError(f"unknown operator {self.op!r}")
        if self.op in ORDERED and kinds[self.field] == "text":
            raise ValueError(f"{self.op} needs a date or a number, {self.field} is text")
        if (self.op == "in") != isinstance(self.value, (list, tuple)):
            raise ValueError("'in' takes a list, every other operator one value")
        return self


def field_value(field: str) -> Column:
    return F.nullif(F.trim(F.col(field).cast("string")), F.lit(""))


def answer(f: Filter, kinds: dict[str, str] | None = None, days: Column | None = None) -> Column:
    """True, false or null (unanswerable) for a value that isn't missing.  ``days``: the field's interval, where it is at hand."""
    kind = (kinds or KINDS)[f.field]
    x = field_value(f.field)
    low = F.lower(x)
    value = f.value if isinstance(f.value, Column) else None
    text = lambda v: F.lower(F.trim(v if isinstance(v, Column) else F.lit(str(v))))
    if f.op in ("contains", "not_contains"):
        hit = F.contains(low, text(f.value) if value is not None else F.lit(str(f.value).lower()))
        return hit if f.op == "contains" else ~hit
    if f.op == "in" and kind != "number":
        return low.isin([str(v).strip().lower() for v in f.value])
    if kind == "number":
        n = finite_number(x)
        targets = list(f.value) if f.op == "in" else [f.value]
        parsed = [finite_number(t if isinstance(t, Column) else F.lit(str(t))) for t in targets]
        ok = n.isNotNull()
        for t in parsed:
            ok = ok & t.isNotNull()
        t = parsed[0]
        if f.op == "in":
            hit = F.lit(False)
            for t in parsed:
                hit = hit | (n == t)
        else:
            hit = {"==": n == t, "!=": n != t, ">": n > t, ">=": n >= t, "<": n < t, "<=": n <= t}[f.op]
        return F.when(ok, hit)
    plain = (low == text(f.value)) if f.op == "==" else (low != text(f.value))
    if kind == "date":
        a, b = (interval(x) if days is None else days), interval(f.value if value is not None else F.lit(str(f.value)))
        known = F.when(a.isNotNull() & b.isNotNull(), may_satisfy(a, f.op, b))
        return known if f.op in ORDERED else F.when(a.isNotNull() & b.isNotNull(), known).otherwise(plain)
    return plain


def verdicts(df: DataFrame, filters: list[Filter], kinds: dict[str, str] | None = None) -> DataFrame:
    """Adds ``first_failed`` (index of the first filter failed, null if none) and ``why`` (no_match, missing, unanswerable)."""
    kind = lambda f: (kinds or KINDS)[f.field]
    # values, intervals and answers are columns of their own, so that none is computed twice
    intervals = {f.field: interval(field_value(f.field)).alias(f"__days_{f.field}") for f in filters if kind(f) == "date"}
    out = df.select("*", *intervals.values())
    for f in filters:
        if not isinstance(f.value, Column):
            f.checked(kinds)
    got = [answer(f, kinds, F.col(f"__days_{f.field}") if f.field in intervals else None).alias(f"__got_{i}") for i, f in enumerate(filters)]
    out = out.select("*", *got)
    failed, why = [], []
    for i, f in enumerate(filters):
        missing, g = field_value(f.field).isNull(), F.col(f"__got_{i}")
        keep = F.when(missing | g.isNull(), F.lit(f.keep_if_missing)).otherwise(g)
        failed.append(F.when(~keep, F.lit(i)))
        why.append(F.when(~keep, F.when(missing, "missing").when(g.isNull(), "unanswerable").otherwise("no_match")))
    none = F.lit(None)
    out = out.select(*df.columns, F.coalesce(*failed, none.cast("int")).alias("first_failed"), F.coalesce(*why, none.cast("string")).alias("why"))
    return out


def kept(df: DataFrame, filters: list[Filter], kinds: dict[str, str] | None = None) -> DataFrame:
    return verdicts(df, filters, kinds).where(F.col("first_failed").isNull()).drop("first_failed", "why")


def drop_statistics(df: DataFrame, filters: list[Filter], key: str, kinds: dict[str, str] | None = None) -> DataFrame:
    """Per filter that dropped any: how many, how many of them as missing or unanswerable, and the smallest id as example."""
    v = verdicts(df, filters, kinds).where(F.col("first_failed").isNotNull())
    return v.groupBy(F.col("first_failed").alias("filter_index")).agg(
        F.count("*").alias("dropped"),
        F.count_if(F.col("why") == "missing").alias("dropped_missing"),
        F.count_if(F.col("why") == "unanswerable").alias("dropped_unparseable"),
        F.min(key).alias("example"),
    )


def kept_or_all(df: DataFrame, filters: list[Filter], by: list[str], kinds: dict[str, str] | None = None) -> DataFrame:
    """Per group the rows that pass, or all of its rows where none does; ``fell_back`` tells which."""
    v = verdicts(df, filters, kinds)
    passed = v.where(F.col("first_failed").isNull()).select(*by).distinct().withColumn("__some", F.lit(True))
    j = v.join(passed, by, "left")
    return j.where(F.col("first_failed").isNull() | F.col("__some").isNull()).withColumn("fell_back", F.col("__some").isNull()).drop("first_failed", "why", "__some")


def with_template_values(df: DataFrame, f: Filter, values: DataFrame, on: list[str], column: str) -> DataFrame:
    """Rows that pass a filter whose value comes from an upstream result per group.  An empty, missing or ``unknown``
    result skips the filter for its group (``filter_skipped``)."""
    v = values.select(*on, F.nullif(F.trim(F.col(column).cast("string")), F.lit("")).alias("__value"))
    j = df.join(v, on, "left")
    skip = F.col("__value").isNull() | F.lower("__value").isin("unknown")
    made = replace(f, value=F.col("__value"))
    missing = field_value(f.field).isNull()
    got = F.when(missing, F.lit(f.keep_if_missing)).otherwise(F.coalesce(answer(made), F.lit(f.keep_if_missing)))
    return j.withColumn("filter_skipped", skip).where(skip | got).drop("__value")


def stop_gate(df: DataFrame, expression: str) -> DataFrame:
    """Rows that go on to the next step: those for which the stop expression isn't true.  Null counts as not true, an expression
    that can't be resolved stops nothing, and a value that can't be cast or divided is null, so no row can fail the query."""
    conf = df.sparkSession.conf
    ansi = conf.get("spark.sql.ansi.enabled")
    try:
        # an expression keeps the mode that it is resolved in
        conf.set("spark.sql.ansi.enabled", "false")
        return df.where(~F.coalesce(F.expr(expression).cast("boolean"), F.lit(False)))
    except Exception:
        return df
    finally:
        conf.set("spark.sql.ansi.enabled", ansi)
