"""Retrieval metrics, value accuracy and comparisons of runs."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartweave.functions.text import casefolded

K_VALUES = (1, 3, 5, 10, 20)


def retrieval_metrics(candidates: DataFrame, gold: DataFrame, by: list[str], key: str = "chunk_id", k_values: tuple[int, ...] = K_VALUES) -> DataFrame:
    """Per query with gold: recall@k, reciprocal rank and nDCG@k with binary relevance, rounded to 6; queries without
    candidates score 0, queries without gold have no row here (they are counted as unannotated elsewhere)."""
    g = gold.select(*by, key).distinct()
    n = g.groupBy(*by).agg(F.count("*").cast("int").alias("n_relevant"))
    hits = candidates.select(*by, key, "rank").join(g, [*by, key], "left_semi")
    sums = [F.sum(F.when(F.col("rank") <= k, 1).otherwise(0)).alias(f"h{k}") for k in k_values]
    sums += [F.sum(F.when(F.col("rank") <= k, 1 / F.log2(F.col("rank") + 1)).otherwise(0.0)).alias(f"d{k}") for k in k_values]
    found = hits.groupBy(*by).agg(F.min("rank").alias("first"), *sums)
    out = n.join(found, by, "left")
    ideal = lambda k: F.aggregate(F.sequence(F.lit(1), F.least(F.lit(k), "n_relevant")), F.lit(0.0), lambda a, i: a + 1 / F.log2(i + 1))
    cols = [F.round(F.coalesce(F.col(f"h{k}"), F.lit(0)) / F.col("n_relevant"), 6).alias(f"recall_at_{k}") for k in k_values]
    cols += [F.round(F.coalesce(F.col(f"d{k}"), F.lit(0.0)) / ideal(k), 6).alias(f"ndcg_at_{k}") for k in k_values]
    return out.select(*by, "n_relevant", F.round(F.coalesce(1 / F.col("first"), F.lit(0.0)), 6).alias("mrr"), *cols)


def bundle_sufficiency(selected: Column, sets: Column) -> Column:
    """``struct(sufficient, first_set, unnecessary)``: whether the selected ids hold some minimum set whole, the index of the
    first such set, and how many selected ids aren't in it (all of them, if there is none)."""
    ok = F.transform(sets, lambda s: F.size(F.array_except(s, selected)) == 0)
    at = F.array_position(ok, True).cast("int")
    extra = F.size(F.array_except(selected, F.when(at > 0, F.get(sets, at - 1)).otherwise(F.array().cast("array<string>"))))
    return F.struct((at > 0).alias("sufficient"), F.when(at > 0, at - 1).alias("first_set"), extra.alias("unnecessary"))


def wilson(k: Column, n: Column, z: float = 1.959963984540054) -> Column:
    """``struct(low, high)``: the 95 % interval of k of n, clamped to 0..1 and rounded to 4; (0, 0) for n <= 0."""
    p = k / n
    d = 1 + z * z / n
    mid, half = (p + z * z / (2 * n)) / d, z / d * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    low = F.when(n > 0, F.round(F.greatest(F.lit(0.0), mid - half), 4)).otherwise(0.0)
    high = F.when(n > 0, F.round(F.least(F.lit(1.0), mid + half), 4)).otherwise(0.0)
    return F.struct(low.alias("low"), high.alias("high"))


def power(n: Column, low: Column, high: Column) -> Column:
    return F.when((n < 5) | (high - low > 0.35), "underpowered").otherwise("adequate")


def accuracy(df: DataFrame, by: list[str], correct: str) -> DataFrame:
    """Per group: scored, correct, accuracy with its Wilson interval and power; rows with a null verdict aren't scored."""
    g = df.groupBy(*by).agg(F.count(correct).alias("n"), F.count_if(F.col(correct)).alias("k"))
    g = g.withColumn("ci", F.when(F.col("n") > 0, wilson(F.col("k"), F.col("n"))).otherwise(F.struct(F.lit(0.0).alias("low"), F.lit(0.0).alias("high"))))
    return g.select(*by, "n", "k", F.when(F.col("n") > 0, F.round(F.col("k") / F.col("n"), 4)).alias("accuracy"), F.col("ci.low").alias("ci_low"), F.col("ci.high").alias("ci_high"), power(F.col("n"), F.col("ci.low"), F.col("ci.high")).alias("power"))


def field_accuracy(corrections: DataFrame, confirmations: DataFrame, case: str, field: str, right: str, across_runs: bool = False) -> DataFrame:
    """Per field: the corrected cases that name it, and every confirmed case without a correction, which agrees on all fields.
    Across runs a confirmation counts for nothing but what was scored of it already, so none is added."""
    fields = corrections.where(F.col(right).isNotNull()).groupBy(field).agg(F.count("*").alias("n"), F.count_if(F.col(right)).alias("k"))
    agreed = confirmations.select(case).distinct().join(corrections.select(case), case, "left_anti").agg((F.lit(0) if across_runs else F.count("*")).cast("long").alias("c"))
    both = fields.withColumn("__one", F.lit(1)).join(agreed.withColumn("__one", F.lit(1)), "__one")
    g = both.select(field, (F.col("n") + F.col("c")).alias("n"), (F.col("k") + F.col("c")).alias("k"))
    g = g.withColumn("ci", wilson(F.col("k"), F.col("n")))
    return g.select(field, "n", "k", F.round(F.col("k") / F.col("n"), 4).alias("accuracy"), F.col("ci.low").alias("ci_low"), F.col("ci.high").alias("ci_high"), power(F.col("n"), F.col("ci.low"), F.col("ci.high")).alias("power"))


def mismatch_patterns(df: DataFrame, patient: str, least: int = 2) -> DataFrame:
    """``(field, extracted, expected, patients, systematic)``: over distinct patients; combined before the shuffle."""
    g = df.groupBy("field", "extracted", "expected").agg(F.count_distinct(patient).alias("patients"))
    return g.withColumn("systematic", F.col("patients") >= least)


def miss_kind(relevant: Column, fed: Column, value_wrong: Column) -> Column:
    """Why an answer is wrong: what was relevant wasn't fed (retrieval), it was fed and misread (extraction), part of it was
    fed (both), or nobody said what is relevant."""
    hit = F.size(F.array_intersect(relevant, fed))
    return F.when(value_wrong & (F.coalesce(F.size(relevant), F.lit(0)) <= 0), "no_retrieval_gold").when(value_wrong & (hit == 0), "retrieval_miss").when(value_wrong & (hit == F.size(relevant)), "extraction_miss").when(value_wrong, "both")


def means_over_scored(df: DataFrame, by: list[str], metrics: list[str], status: str) -> DataFrame:
    """Means over the rows whose status is ``scored``; failed and unannotated ones are counted apart, not as zeros."""
    ok = F.col(status) == "scored"
    return df.groupBy(*by).agg(F.count_if(ok).alias("scored"), F.count_if(F.col(status) == "failed").alias("failed"), F.count_if(F.col(status) == "unannotated").alias("unannotated"), *[F.round(F.avg(F.when(ok, F.col(m))), 4).alias(m) for m in metrics])


def compared_runs(metrics: DataFrame, run: str, order: str, metric: str, value: str) -> DataFrame:
    """Adds ``delta`` to the first run and ``best`` (the first of the runs with the greatest value) per metric."""
    w = W.partitionBy(metric)
    first = F.first(value).over(w.orderBy(order))
    best = F.row_number().over(w.orderBy(F.desc_nulls_last(value), order)) == 1
    return metrics.withColumn("delta", F.round(F.col(value) - first, 6)).withColumn("best", best)


def fed_chunks(steps: DataFrame, by: list[str], ids: str) -> DataFrame:
    """The distinct chunk ids that any step was fed, sorted."""
    return steps.select(*by, F.explode(ids).alias("c")).distinct().groupBy(*by).agg(F.sort_array(F.collect_list("c")).alias("chunk_ids"))


def latest_entries(feedback: DataFrame, by: list[str], seq: str, value: str) -> DataFrame:
    """The last entry per key wins."""
    return feedback.groupBy(*by).agg(F.max_by(value, seq).alias(value))


def texts_match(extracted: Column, expected: Column) -> Column:
    """``values_match`` of plain texts in the JVM: folded, and a complete date for a partial one that it fits."""
    a, b = casefolded(F.trim(extracted)), casefolded(F.trim(expected))
    masked = b.rlike(r"^\d{4}-(\d\d|xx)-(\d\d|xx)$") & b.contains("xx") & a.rlike(r"^\d{4}-\d\d-\d\d$")
    part = lambda i, n: (F.substring(b, i, n) == "xx") | (F.substring(b, i, n) == F.substring(a, i, n))
    return (a == b) | (masked & (F.substring(a, 1, 4) == F.substring(b, 1, 4)) & part(6, 2) & part(9, 2))


def rescored(verdicts: DataFrame, by: list[str], extracted: str, reviewed: str) -> DataFrame:
    """Confirmations of another run scored anew; those that can't be scored leave the denominator."""
    ok = F.when(F.col(extracted).isNotNull() & F.col(reviewed).isNotNull(), texts_match(F.col(extracted), F.col(reviewed)))
    return verdicts.groupBy(*by).agg(F.count("*").alias("confirmed"), F.count(ok).alias("scorable"), F.count_if(ok).alias("still_right"))


def values_match(extracted: object, expected: object) -> bool:
    """Whether an extracted value stands for the expected one: texts folded; a complete date for a partial one that it fits
    (not the other way round); every expected key of an object; lists by a perfect matching."""
    if isinstance(expected, dict):
        return isinstance(extracted, dict) and all(k in extracted and values_match(extracted[k], v) for k, v in expected.items())
    if isinstance(expected, list):
        if not isinstance(extracted, list) or len(extracted) != len(expected):
            return False
        owner: dict[int, int] = {}

        def place(i: int, seen: set[int]) -> bool:
            for j, have in enumerate(extracted):
                if j not in seen and values_match(have, expected[i]):
                    seen.add(j)
                    if j not in owner or place(owner[j], seen):
                        owner[j] = i
                        return True
            return False

        return all(place(i, set()) for i in range(len(expected)))
    if isinstance(expected, str) and isinstance(extracted, str):
        a, b = extracted.strip().casefold(), expected.strip().casefold()
        if a == b:
            return True
        return len(b) == 10 and len(a) >= 10 and "xx" in b and all(x == y or y == "x" for x, y in zip(a, b))
    if isinstance(expected, bool) or isinstance(extracted, bool):
        return expected is extracted
    return extracted == expected


def json_match(extracted: Column, expected: Column) -> Column:
    """``values_match`` of two JSON columns, in Arrow batches; null where the expected side is null or either is no JSON."""

    def one(a: str | None, b: str | None) -> bool | None:
        if b is None:
            return None
        try:
            return values_match(None if a is None else json.loads(a), json.loads(b))
        except ValueError:
            return None

    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([one(x, y) for x, y in zip(a, b)], dtype=object)

    return F.pandas_udf(run, "boolean")(extracted, expected)


def feedback_labels(feedback: DataFrame, kind: str) -> DataFrame:
    """``(key columns, entry, label)``: entries of one type out of the feedback lists, agreement as 0 or 1."""
    return feedback.withColumn("entry", F.explode("feedback")).where(F.col("entry.type") == kind).withColumn("label", F.when(F.col("entry.agreed"), 1).otherwise(0))


def deep_diff(a: DataFrame, b: DataFrame, keys: list[str], path: str = "path", value: str = "value") -> DataFrame:
    """``(*keys, path, left, right, change)`` of flattened records that differ: added, removed or changed leaves."""
    l = a.select(*keys, path, F.col(value).alias("left"), F.lit(1).alias("__l"))  # noqa: E741
    r = b.select(*keys, path, F.col(value).alias("right"), F.lit(1).alias("__r"))
    j = l.join(r, [*keys, path], "full")
    change = F.when(F.col("__l").isNull(), "added").when(F.col("__r").isNull(), "removed").when(~F.col("left").eqNullSafe(F.col("right")), "changed")
    return j.withColumn("change", change).where(F.col("change").isNotNull()).select(*keys, path, "left", "right", "change")


def json_leaves(value: object, path: str = "$") -> dict[str, tuple[str, str | None]]:
    """path -> (type, text) of every leaf; a list's length and an empty object are leaves of their own."""
    if isinstance(value, dict):
        out: dict[str, tuple[str, str | None]] = {} if value else {path: ("object", "{}")}
        for k, v in value.items():
            out |= json_leaves(v, f"{path}.{k}")
        return out
    if isinstance(value, list):
        out = {f"{path}.length": ("length", str(len(value)))}
        for i, v in enumerate(value):
            out |= json_leaves(v, f"{path}[{i}]")
        return out
    kind = {str: "string", bool: "boolean", int: "number", float: "number", type(None): "null"}[type(value)]
    return {path: (kind, None if value is None else value if isinstance(value, str) else json.dumps(value))}


def json_diff(df: DataFrame, keys: list[str], left: str, right: str) -> DataFrame:
    """``(*keys, path, left, right, change)`` of two JSON columns: added, removed, changed, type_changed or length_changed leaves.
    A side that is null or no JSON has the value null."""
    schema = T.StructType([*(df.schema[k] for k in keys), *(T.StructField(n, T.StringType()) for n in ("path", "left", "right", "change"))])

    def leaves(text: str | None) -> dict[str, tuple[str, str | None]]:
        try:
            return json_leaves(None if text is None else json.loads(text))
        except ValueError:
            return json_leaves(None)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            at, rows = [], []
            for i, (x, y) in enumerate(zip(pdf["__l"], pdf["__r"])):
                a, b = leaves(x), leaves(y)
                for path in sorted(a.keys() | b.keys()):
                    p, q = a.get(path), b.get(path)
                    if p == q:
                        continue
                    change = "added" if p is None else "removed" if q is None else "length_changed" if p[0] == q[0] == "length" else "type_changed" if p[0] != q[0] else "changed"
                    at.append(i)
                    rows.append((path, p and p[1], q and q[1], change))
            yield pd.concat([pdf[keys].iloc[at].reset_index(drop=True), pd.DataFrame(rows, columns=["path", "left", "right", "change"])], axis=1)

    return df.select(*keys, F.col(left).alias("__l"), F.col(right).alias("__r")).mapInPandas(run, schema)


def flattened(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Records as ``(*keys, path, value)``, all values as text."""
    pairs = F.array(*[F.struct(F.lit(c).alias("path"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(*keys, F.explode(pairs).alias("p")).select(*keys, "p.path", "p.value")
