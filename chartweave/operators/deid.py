"""De-identified exports: surrogates, closed vocabularies, small cells, content scans and the write gate."""

from __future__ import annotations

import hashlib
import hmac
import logging
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL = 11
# The closed vocabularies of an export.
VOCABULARIES = {
    "doc_type": "pathology radiology progress_note clinical_note discharge_summary operative_note consult laboratory medication diagnosis demographics encounter procedure order flowsheet immunization unknown".split(),
    "retriever": "bm25 embedding hybrid exact direct_parquet unknown".split(),
    "correction_type": "extraction_correction extraction_confirmation chunk_relevance".split(),
    "label": "relevant not_relevant unsure".split(),
    "signal_type": "parse_failure value_disagreement invariant_violation".split(),
    "value_shape": "scalar list object null".split(),
    "reviewer_tier": "expert trainee unknown".split(),
    "error_kind": "none parse_failure empty_evidence validation_failure deterministic_failure_no_retry transport_retries_exhausted non_retryable retries_exhausted truncation unknown".split(),
    "parse_failure_kind": "none empty_content json_decode_error not_a_json_object".split(),
    "finish_reason": "stop length tool_calls content_filter function_call error unknown".split(),
    "severity": "info warning error".split(),
}
# A part of a document type's name and the member it leads to; the first that occurs counts.
DOC_TYPE_PARTS = """
patholog=pathology radiolog=radiology imaging=radiology discharge=discharge_summary operative=operative_note
op note=operative_note consult=consult immuniz=immunization flowsheet=flowsheet med_admin=medication
med_order=medication medication=medication laborator=laboratory diagnos=diagnosis demographic=demographics
encounter=encounter procedure=procedure progress=progress_note order=order clinical=clinical_note
note=clinical_note lab=laboratory
"""
# Parts of an error message with the kind of error and of parse failure.
ERROR_PARTS = [
    ("jsondecode", "parse_failure", "json_decode_error"),
    ("empty content", "parse_failure", "empty_content"),
    ("not a json", "parse_failure", "not_a_json_object"),
    ("empty_evidence", "empty_evidence", "none"),
]
# The shapes of text that an export may hold at all.
TOKEN = r"^[A-Za-z0-9_.\-/]{1,80}$"
SAFE = [
    r"^$",
    r"^surr:v1:(run|study|site):[a-z][a-z0-9_]*:[0-9a-f]{24}$",
    r"^sha256:[0-9a-f]{3,64}$",
    r"^(\d{4}-\d{2}|unknown)$",
    r"^(v\d+(\.\d+)*|\d+\.\d+(\.\d+)*|[A-Za-z0-9_]+/v\d+)$",
]
BARE_HASH = r"^([0-9a-f]{16}|[0-9a-f]{64})$"
RUN_ID = r"^\d{8}_[A-Za-z0-9_]+$"
# What even a token mustn't hold, and the fields whose tokens may be names in capitals.
DIGIT_RUN = r"\d{5,}"
DATE_SHAPE = r"\d{1,4}[-/]\d{1,2}[-/]\d{1,4}|\b\d{8}\b"
CAPITALS_OK = ("site_id", "study_id")
FILE_NAME = r"(?i)\.(csv|tsv|xlsx?|xlsm|jsonl?|parquet|txt|pdf|docx?|html?|xml|rtf|dat|dcm|out|log)\b"
# Content that never may leave, with what it is.
FORBIDDEN = [
    (r"\b\d{4}-\d{2}-\d{2}\b", "absolute date"),
    (r"\b\d{3}-\d{2}-\d{4}\b", "social security number"),
    (r"(?i)\bMRN\s*[:=]?\s*\d+", "record number"),
    (r"(?i)\bDOB\s*[:=]?\s*\d", "birth date"),
    (r"(?i)date\s+of\s+birth\s*:", "birth date"),
    (r"(?i)patient_name\s*[:=]", "name"),
    (r"(?i)chief\s+complaint", "note text"),
    (r"(?i)history\s+of\s+present\s+illness", "note text"),
    (r"(?i)assessment\s+and\s+plan", "note text"),
    (r"(?i)patient\s+present", "note text"),
    (r"(?i)physical\s+exam", "note text"),
    (r"(?i)/ehr/|/mrns?/|clarity[_\-/]|ssn[:=]", "path"),
    (r"(?i)\b(gs\d+|id\d+|mrn\d+|pt[_-]?\d+)\b", "patient id"),
]


def surrogate(value: Column, key: bytes, scope: str, domain: str, field: str) -> Column:
    """``surr:v1:<scope>:<field>:<24 hex>`` by HMAC-SHA256; the key comes from the configuration, never from the data.  Equal
    domains give equal surrogates, which is how labels and selections join; null stays null."""

    def run(s: pd.Series) -> pd.Series:
        head = f"v1|{scope}|{domain}|{field}|".encode()
        return s.map(lambda x: None if x is None else f"surr:v1:{scope}:{field}:" + hmac.new(key, head + str(x).encode(), hashlib.sha256).hexdigest()[:24])

    return F.pandas_udf(run, "string")(value.cast("string"))


def _doc_type_parts() -> list[tuple[str, str]]:
    flat = " ".join(DOC_TYPE_PARTS.split())
    return re.findall(r"(\S[^=]*)=(\w+)", flat)


def canonical_doc_type(text: Column) -> Column:
    """An exact member of the vocabulary, else that of the first part which the text contains, else ``unknown``."""
    t = F.lower(F.trim(text))
    out = F.lit("unknown")
    for part, member in reversed(_doc_type_parts()):
        out = F.when(F.contains(t, F.lit(part)), member).otherwise(out)
    return F.when(t.isin(VOCABULARIES["doc_type"]), t).otherwise(F.coalesce(out, F.lit("unknown")))


def is_unmapped(text: Column) -> Column:
    """A text with something in it that leads to ``unknown``; these are counted in an export."""
    return F.coalesce(F.trim(text) != "", F.lit(False)) & (canonical_doc_type(text) == "unknown")


def error_bucket(message: Column, validation_passed: Column) -> Column:
    """``struct(error_kind, parse_failure_kind)`` by the type of an error alone: a message that names none of the known types is
    a validation failure only where the output didn't fit its schema; no message is ``unknown`` too."""
    t = F.lower(message)
    pair = lambda a, b="none": F.struct(F.lit(a).alias("error_kind"), F.lit(b).alias("parse_failure_kind"))
    out = F.when(t.isNull() | F.coalesce(validation_passed, F.lit(False)), pair("unknown")).otherwise(pair("validation_failure"))
    for part, kind, parse in reversed(ERROR_PARTS):
        out = F.when(F.contains(t, F.lit(part)), pair(kind, parse)).otherwise(out)
    return out


def small_cells(df: DataFrame, count: str, action: str = "drop", least: int = SMALL) -> DataFrame:
    """Aggregates without their small cells: dropped, or with a null count and the band ``<11``."""
    if action == "drop":
        return df.where(F.col(count) >= least)
    return df.withColumn("band", F.when(F.col(count) < least, f"<{least}")).withColumn(count, F.when(F.col(count) >= least, F.col(count)))


def has_safe_shape(text: Column, field: str = "") -> Column:
    """Whether a text has one of the few shapes of controlled values: a surrogate, a hash (a bare one holds a letter), a month,
    a version, a run id (in the field ``run_id`` alone), or a short token without a date, a run of five digits and, but for the
    site and the study, without capitals if it is letters only."""
    ok = F.lit(False)
    for p in SAFE:
        ok = ok | text.rlike(p)
    ok = ok | (text.rlike(BARE_HASH) & text.rlike("[a-f]"))
    if field == "run_id":
        ok = ok | text.rlike(RUN_ID)
    token = text.rlike(TOKEN) & ~text.rlike(DATE_SHAPE) & ~text.rlike(DIGIT_RUN)
    if field not in CAPITALS_OK:
        token = token & ~(text.rlike("^[A-Za-z]+$") & text.rlike("[A-Z]"))
    return ok | token


def violations(text: Column, field: str = "") -> Column:
    """What speaks against letting a text leave, as labels without the text: it has none of the safe shapes, or it has one and
    yet holds a file's name or forbidden content.  Null has nothing against it."""
    found = [F.when(~has_safe_shape(text, field), "no safe shape"), F.when(text.rlike(FILE_NAME), "file name")]
    kinds: dict[str, str] = {}
    for pattern, label in FORBIDDEN:
        kinds[label] = f"{kinds[label]}|(?:{pattern})" if label in kinds else f"(?:{pattern})"
    found += [F.when(text.rlike(p), label) for label, p in kinds.items()]
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*found)))


def is_forbidden(text: Column, field: str = "") -> Column:
    """Whether a text may not leave; null may."""
    bad = ~has_safe_shape(text, field) | text.rlike(FILE_NAME)
    for p, _ in FORBIDDEN:
        bad = bad | text.rlike(p)
    return F.coalesce(bad, F.lit(False))


def gated(df: DataFrame, columns: list[str], exempt: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows that may be written, and rejected rows with the names of the offending columns; a row is on one side or the other.
    ``exempt`` columns, such as numbers, aren't looked at."""
    why = F.filter(F.array(*[F.when(is_forbidden(F.col(c).cast("string"), c), F.lit(c)) for c in columns if c not in exempt]), lambda x: x.isNotNull())
    marked = df.withColumn("rejected_for", why)
    return marked.where(F.size("rejected_for") == 0).drop("rejected_for"), marked.where(F.size("rejected_for") > 0)


# The fields of a record beside its header; ? marks one that may be missing.
RUN_HEADER = "schema_version vocab_version site_id study_id run_id emitted_month encoder_fingerprint reranker_fingerprint extractor_fingerprint code_lock_hash chunking_config_id"
RECIPE_HEADER = RUN_HEADER + " recipe_id recipe_version variable_key archetype prompt_hash schema_hash"
REVIEW_HEADER = RUN_HEADER + " recipe_id recipe_version step_id"
RECORDS = {
    "selection_judgment": RECIPE_HEADER + " record_type group step_id retriever total_evidence_tokens? n_candidates n_in_bundle n_cited n_doc_type_unmapped rows",
    "clinical_invariant": RUN_HEADER + " record_type labeler_id labeler_version patient_surrogate outcomes n_violations",
    "method_provenance": RUN_HEADER + " record_type",
    "extraction_outcome": RECIPE_HEADER + " record_type patient_surrogate ok value_shape n_value_fields error_kind error_code? parse_failure_kind n_passes retry_attempts finish_reason? prompt_tokens? completion_tokens? total_tokens? cached",
    "relevance_label": REVIEW_HEADER + " record_type patient_surrogate reviewer_surrogate reviewer_tier chunk_surrogate label",
    "retriever_miss": REVIEW_HEADER + " record_type patient_surrogate reviewer_surrogate reviewer_tier chunk_surrogate was_in_retriever_pool retriever_rank_if_present? cross_encoder_rank_if_present? manual_search_used",
}


def valid_record(df: DataFrame, kind: str) -> DataFrame:
    """Adds ``valid``: every field of the kind is there and filled, but for those that may be missing, the month is a month or
    unknown, and closed fields hold members of their vocabularies.  A column that the kind doesn't have is an error."""
    fields = RECORDS[kind].split()
    names = {f.rstrip("?") for f in fields}
    if extra := set(df.columns) - names:
        raise ValueError(f"{kind} has no {sorted(extra)}")
    if absent := {f for f in fields if not f.endswith("?")} - set(df.columns):
        raise ValueError(f"{kind} lacks {sorted(absent)}")
    closed = {c: VOCABULARIES[c] for c in df.columns if c in VOCABULARIES}
    out = constrained(df, closed, [f for f in fields if not f.endswith("?")])
    return out.withColumn("valid", F.col("valid") & F.coalesce(F.col("emitted_month").rlike(r"^(\d{4}-\d{2}|unknown)$"), F.lit(False)) & (F.col("record_type") == kind))


def constrained(df: DataFrame, vocabularies: dict[str, list[str]], required: list[str]) -> DataFrame:
    """Adds ``valid``: the required fields are there and every closed field holds a member of its vocabulary."""
    ok = F.lit(True)
    for c in required:
        ok = ok & F.col(c).isNotNull()
    for c, words in vocabularies.items():
        ok = ok & F.coalesce(F.col(c).isin(words), F.lit(c not in required))
    return df.withColumn("valid", ok)


def month_stamp(run_id: Column) -> Column:
    """YYYY-MM out of a run id that starts with its day."""
    return F.concat_ws("-", F.regexp_extract(run_id, r"(\d{4})-?(\d{2})", 1), F.regexp_extract(run_id, r"(\d{4})-?(\d{2})", 2))


def selection_rows(candidates: DataFrame, by: list[str]) -> DataFrame:
    """One nested, text-free row per group with a flag per candidate: selected or not."""
    item = F.struct("rank", F.sha2(F.col("chunk_id").cast("string"), 256).alias("chunk_hash"), "selected")
    return candidates.groupBy(*by).agg(F.sort_array(F.collect_list(item)).alias("candidates"), F.count_if("selected").alias("n_selected"))


def holding_ids(long: DataFrame, value: str, keep: list[str], ids: DataFrame, id_column: str) -> DataFrame:
    """The columns ``keep`` of the rows whose text holds one of the ids anywhere in it.

    The parts of a text that are as long as some id are joined to the ids; lengths of ids are few, so this is an equi-join over
    short lists and no search of every text for every id.  Blank ids are none.
    """
    known = ids.select(F.col(id_column).cast("string").alias("__id")).where(F.trim("__id") != "").distinct()
    lengths = sorted(r.n for r in known.select(F.length("__id").alias("n")).distinct().collect())
    t = F.col(value)

    def parts(n: int) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.length(t) - n + 1), lambda i: F.substring(t, i, F.lit(n)))
        return F.when(F.length(t) >= n, cut).otherwise(F.array().cast("array<string>"))

    every = F.flatten(F.array(*map(parts, lengths))) if lengths else F.array().cast("array<string>")
    rows = long.withColumn("__row", F.monotonically_increasing_id()).select("__row", *keep, F.explode(F.array_distinct(every)).alias("__id"))
    return rows.join(known, "__id", "left_semi").dropDuplicates(["__row"]).select(*keep)


def verified_export(df: DataFrame, columns: list[str], patient_ids: DataFrame, id_column: str) -> DataFrame:
    """``(column, forbidden, with_id)``: cells of an export that hold forbidden content, and those that hold a known patient id
    anywhere in them; an empty result is a pass."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), is_forbidden(F.col(c).cast("string"), c).alias("bad")) for c in columns])
    long = df.select(F.explode(cells).alias("c")).select("c.*").where(F.col("value").isNotNull())
    counts = long.where("bad").groupBy("column").agg(F.count("*").alias("forbidden"), F.lit(0).cast("long").alias("with_id"))
    named = holding_ids(long, "value", ["column"], patient_ids, id_column).groupBy("column").agg(F.lit(0).cast("long").alias("forbidden"), F.count("*").alias("with_id"))
    return counts.unionByName(named).groupBy("column").agg(F.sum("forbidden").alias("forbidden"), F.sum("with_id").alias("with_id"))


def labelled_selections(selections: DataFrame, labels: DataFrame, on: tuple[str, ...] = ("run_id", "recipe_id", "step_id", "chunk_surrogate")) -> DataFrame:
    """The reviewed ones of the selected candidates: both sides name a chunk by the same surrogate, minted in the domain that
    chunks share.  A candidate with several labels has a row for each."""
    return selections.join(labels.select(*on, "label"), list(on))


def export_hash(spark: SparkSession, path: str) -> str:
    """sha256 over the names and contents of a table's files, hashed where they lie."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    rows = sorted((r.n, r.h) for r in files.select(F.element_at(F.split("path", "/"), -1).alias("n"), F.sha2("content", 256).alias("h")).collect())
    return "sha256:" + hashlib.sha256("\n".join(f"{n} {h}" for n, h in rows).encode()).hexdigest()


def egress_findings(spark: SparkSession, path: str, manifest: dict, record_types: set[str], patient_ids: DataFrame, id_column: str) -> list[str]:
    """Why a table of ``exhaust/<record type>.parquet`` may not leave; an empty list lets it.

    It must lie in a folder named exhaust, be of a known type, stand in the run's manifest with the hash it has now, and hold
    neither forbidden content nor a patient's id.  Findings name columns and counts, never values.
    """
    parts = path.rstrip("/").split("/")
    kind = parts[-1].removesuffix(".parquet")
    if len(parts) < 2 or parts[-2] != "exhaust" or not parts[-1].endswith(".parquet"):
        return ["outside the exhaust folder"]
    if kind not in record_types:
        return ["unknown record type"]
    entry = (manifest.get("record_types") or {}).get(kind)
    if not entry:
        return ["not in the manifest"]
    if entry.get("sha256") != export_hash(spark, path):
        return ["another hash than the manifest's"]
    df = spark.read.parquet(path)
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    nested = [f.name for f in df.schema.fields if f.dataType.simpleString().startswith(("struct", "array", "map"))]
    leaves = [F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in texts])).alias("c")] if texts else []
    found = []
    if leaves:
        found = [f"{r.column}: {r.forbidden} forbidden, {r.with_id} with a patient id" for r in sorted(verified_export(df, texts, patient_ids, id_column).collect())]
    for c in nested:
        inside = df.select(F.explode(F.regexp_extract_all(F.to_json(F.struct(c)), F.lit(r'"((?:[^"\\]|\\.)*)"'), F.lit(1))).alias(c))
        found += [f"{r.column}: {r.forbidden} forbidden, {r.with_id} with a patient id" for r in sorted(verified_export(inside, [c], patient_ids, id_column).collect())]
    return found


def fingerprint(settings: dict, allowed: list[str]) -> str:
    """A short hash of the allowed fields of a configuration."""
    import json

    kept = {k: settings.get(k) for k in sorted(allowed)}
    return hashlib.sha256(json.dumps(kept, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()[:16]


class Redacting(logging.Filter):
    """Hides the arguments of log records, unless values may be shown: a message keeps its wording only."""

    def __init__(self, show: bool = False):
        super().__init__()
        self.show = show

    def filter(self, record: logging.LogRecord) -> bool:
        if not self.show and record.args:
            record.msg, record.args = re.sub(r"%[-+#0 ]*\d*(?:\.\d+)?[a-zA-Z]", "[hidden]", str(record.msg)), None
        return True
