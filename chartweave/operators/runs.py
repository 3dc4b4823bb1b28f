"""Run state: an append-only log of transitions, merged on read and rolled up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def merged_log(fragments: list[DataFrame], canonical: Column | None = None) -> DataFrame:
    """Log fragments as one table, equal entries (by their canonical text, all columns by default) once."""
    every = fragments[0]
    for f in fragments[1:]:
        every = every.unionByName(f)
    if canonical is None:
        return every.dropDuplicates()
    return every.withColumn("__c", F.sha2(canonical, 256)).dropDuplicates(["__c"]).drop("__c")


def read_log(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Fragments of JSON lines, each entry once, and ``(dropped)``: how many lines fit no entry."""
    lines = spark.read.text(path).where(F.trim("value") != "").select(F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("e"))
    good = lines.where(F.col("e._bad").isNull()).select("e.*").drop("_bad")
    return merged_log([good]), lines.agg(F.count_if(F.col("e._bad").isNotNull()).alias("dropped"))


def in_order(log: DataFrame, ts: str, seq: str) -> DataFrame:
    """A log in the order of its entries; the sort is by ranges, so no task holds more than its share."""
    return log.orderBy(ts, seq)


def rollup(log: DataFrame, entity: list[str], step: str, state: str, ts: str, seq: str, completed: str, failed: str, chunks: DataFrame | None = None) -> DataFrame:
    """Per step: entities, those whose last state is completed or failed, the earliest and latest entry, and, from a table of
    ``(step, chunks)`` sums, its chunks."""
    last = log.groupBy(*entity, step).agg(F.max_by(state, F.struct(ts, seq)).alias("__last"), F.min(ts).alias("__first"), F.max(ts).alias("__latest"))
    out = last.groupBy(step).agg(F.count("*").alias("entities"), F.count_if(F.col("__last") == completed).alias("completed"), F.count_if(F.col("__last") == failed).alias("failed"), F.min("__first").alias("earliest"), F.max("__latest").alias("latest"))
    return out if chunks is None else out.join(chunks.groupBy(step).agg(F.sum("chunks").alias("chunks")), step, "left").withColumn("chunks", F.coalesce("chunks", F.lit(0)))


def last_states(log: DataFrame, by: list[str], state: str, ts: str, seq: str) -> DataFrame:
    """The last state of each entity: latest timestamp, ties by the sequence column."""
    return log.groupBy(*by).agg(F.max_by(state, F.struct(ts, seq)).alias("last_state"), F.max(ts).alias("last_ts"), F.count("*").alias("transitions"))


def state_counts(log: DataFrame, step: str, state: str) -> DataFrame:
    return log.groupBy(step, state).agg(F.count("*").alias("n"))


def run_status(failed: Column, worked: Column, tables: Column, extraction_failures: Column, skipped: Column) -> Column:
    """What a run ended as, first that holds: failed, no_work, tables_missing, extraction_failures, skipped, completed."""
    return F.when(failed > 0, "failed").when(worked == 0, "no_work").when(~tables, "tables_missing").when(extraction_failures > 0, "extraction_failures").when(skipped > 0, "skipped").otherwise("completed")


def durations(log: DataFrame, by: list[str], state: str, ts: str, seq: str, running: str, done: str, least: float = 0.05) -> DataFrame:
    """Per group: pairs of a ``done`` with the last unconsumed ``running`` before it, and their mean seconds over those longer
    than ``least``.  A group's stretch ends at each ``done``, so a running start is used once."""
    w = W.partitionBy(*by).orderBy(ts, seq)
    only = log.where(F.col(state).isin(running, done))
    part = only.withColumn("stretch", F.coalesce(F.sum((F.col(state) == done).cast("int")).over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    pairs = part.groupBy(*by, "stretch").agg(F.max(F.when(F.col(state) == running, F.col(ts))).alias("a"), F.max(F.when(F.col(state) == done, F.col(ts))).alias("z"))
    s = (F.unix_micros("z") - F.unix_micros("a")) / 1e6
    return pairs.where(F.col("a").isNotNull() & F.col("z").isNotNull()).groupBy(*by).agg(F.count("*").alias("pairs"), F.round(F.avg(F.when(s > least, s)), 3).alias("mean_seconds"))


def economics(calls: DataFrame, by: list[str]) -> DataFrame:
    """Token and time sums over steps; a group is cached only if all its calls were."""
    return calls.groupBy(*by).agg(F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"), F.count("*").alias("calls"), F.bool_and("cached").alias("all_cached"))


def sampling_frame(draws: DataFrame, key: str, position: str, rule: str) -> DataFrame:
    """Keyed union of draws, the first position kept; more than one rule is an error."""
    out = draws.groupBy(key).agg(F.min(position).alias("position"), F.min(rule).alias("rule"), F.max(rule).alias("__other"))
    return out.withColumn("rule", F.when(F.col("rule") != F.col("__other"), F.raise_error(F.lit("a sampling frame has one rule"))).otherwise(F.col("rule"))).drop("__other")


def unfinished(wanted: DataFrame, done: DataFrame, on: list[str], hashes: list[str]) -> DataFrame:
    """Work whose result isn't there, isn't ok or was made under other settings: every hash must be known and equal."""
    ok = done.where(F.col("ok"))
    for h in hashes:
        ok = ok.where(F.col(h).isNotNull())
    return wanted.join(ok.select(*on, *hashes).distinct(), [*on, *hashes], "left_anti")


def extraction_failures(results: DataFrame, by: list[str], ok: str) -> DataFrame:
    """Per group: answers, and those that aren't ok (false; a null one was never judged and is counted apart)."""
    return results.groupBy(*by).agg(F.count("*").alias("answers"), F.count_if(~F.col(ok)).alias("failures"), F.count_if(F.col(ok).isNull()).alias("unjudged"))


def versioned(wanted: DataFrame, known: DataFrame, key: str, version: str, value: str) -> DataFrame:
    """``wanted`` with the value known for its key and version (``key_vVERSION``), else the one known for the bare key, else null.
    A key that stands twice gives its greatest value."""
    best = known.groupBy(key).agg(F.max(value).alias("__value"))
    full = F.concat(F.col(key), F.lit("_v"), F.col(version).cast("string"))
    j = wanted.withColumn("__full", full).join(best.select(F.col(key).alias("__full"), F.col("__value").alias("__a")), "__full", "left")
    j = j.join(best.select(F.col(key), F.col("__value").alias("__b")), key, "left")
    return j.withColumn(value, F.coalesce("__a", "__b")).drop("__full", "__a", "__b")


def scoped_hashes(settings: dict, scopes: dict[str, list[str]], recipes: dict[str, dict] | None = None) -> dict[str, str]:
    """One hash per scope over the settings it names, and one per recipe over all of it: what a sealed run is compared by."""
    import hashlib
    import json

    of = lambda x: "sha256:" + hashlib.sha256(json.dumps(x, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()
    out = {name: of({k: settings.get(k) for k in sorted(keys)}) for name, keys in scopes.items()}
    return out | {f"recipe:{n}": of(r) for n, r in (recipes or {}).items()}


def time_left(progress: DataFrame, done: str, total: str, seconds: str, workers: int = 1) -> DataFrame:
    """Adds ``eta_seconds``: what is left times the mean seconds of one, over the workers; null where nothing is done yet."""
    return progress.withColumn("eta_seconds", F.round((F.col(total) - F.col(done)) * F.col(seconds) / workers, 3))


def corpus_may_be_reused(settings_now: dict, settings_then: dict, keys: list[str], map_edited: bool, changed_charts: int) -> bool:
    return all(settings_now.get(k) == settings_then.get(k) for k in keys) and not map_edited and changed_charts == 0


def drift(sealed: dict[str, str], now: dict[str, str]) -> list[str]:
    """The scopes whose hash isn't the sealed one any more."""
    return sorted(k for k in sealed.keys() | now.keys() if sealed.get(k) != now.get(k))
