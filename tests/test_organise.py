"""What a run leaves behind, checks of configurations, and the smaller rules beside them."""

import pytest
from pyspark.sql import functions as F

from chartweave.operators import evaluation, ingest, intervals, runs, validation
from chartweave.plans import configs, organise
from chartweave.sources import sinks

SCHEMA = {"type": "object", "required": ["v"], "properties": {"v": {"type": "string"}, "evidence_chunk_id": {"type": "string"}}}


def run_tables(spark):
    steps = spark.createDataFrame(
        [("a", "r", 0, "s1", "complete", None, 1, 10, 0), ("a", "r", 1, "s2", "failed", "ValueError", 1, 5, 0), ("b", "r", 0, "s1", "complete", None, 1, 7, 1), ("c", "r", 0, "s1", "skipped", None, 0, 0, 0)],
        "g string, recipe string, ord int, step string, status string, error string, calls int, input_tokens int, rejected int",
    )
    answers = spark.createDataFrame([("a", "r", '{"v": "x", "evidence_chunk_id": "c1"}', "s1"), ("b", "r", '{"v": "x"}', "s1"), ("c", "r", '{"v": "x", "evidence_chunk_id": "c1"}', "s1"), ("d", "r", "no json", None), ("e", "r", None, None)], "g string, recipe string, data string, answered_by string")
    return steps, answers


def test_results_with_their_verdicts(spark, tmp_path):
    steps, answers = run_tables(spark)
    got = {r.g: r for r in organise.write_run(steps, answers, "g", {"r": SCHEMA}, str(tmp_path)).collect()}
    assert {g: r.ok for g, r in got.items()} == {"a": False, "b": False, "c": True, "d": False, "e": False}
    assert got["a"].errors == ["steps that failed: s2"] and got["a"].warnings == ["ValueError"] and got["a"].steps_that_errored == ["s2"]
    assert got["b"].errors == ["no source: $"] and got["d"].errors == ["no JSON"] and got["e"].errors == ["$: not object"]
    told = {(r.step, r.status): (r.groups, r.calls, r.input_tokens) for r in spark.read.parquet(f"{tmp_path}/telemetry").collect()}
    assert told["s1", "complete"] == (2, 2, 17) and spark.read.parquet(f"{tmp_path}/steps").count() == 4
    with pytest.raises(ValueError, match="no output schema"):
        organise.organised(steps, answers, "g", {})
    assert organise.organised(steps, answers.limit(0), "g", {"r": SCHEMA}).count() == 0


@pytest.mark.parametrize(("check", "config", "said"), [
    (configs.checked_ingest, {}, "run_id"), (configs.checked_ingest, {"run_id": "x", "files": "some"}, "list"), (configs.checked_ingest, {"run_id": "x", "files": [{"optional": True}]}, "stem"),
    (configs.checked_ingest, {"run_id": "x", "files": [{"stem": "a", "optional": 1}]}, "optional"), (configs.checked_ingest, {"run_id": "x", "files": [{"stem": "a", "columns": ["b"]}]}, "whole files"),
    (configs.checked_embed, {"run_id": "x"}, "encoder"), (configs.checked_embed, {"run_id": "x", "encoder": {}}, "model_id"), (configs.checked_embed, {"run_id": "x", "encoder": {"model_id": "m", "max_tokens": 100}, "chunker": {"kind": "token_window", "window": 101}}, "more than"),
    (configs.checked_embed, {"run_id": "x", "encoder": {"model_id": "m"}, "files": [{"stem": "a", "text_columns": ["b", "c"]}]}, "clash"), (configs.checked_index, {"run_id": "x", "index": 1}, "index"),
    (configs.checked_retrieval, {"retriever": {"kind": "magic"}}, "unknown"), (configs.checked_retrieval, {"retriever": {"kind": "bm25", "k": 0}}, "whole number"), (configs.checked_retrieval, {"filters": [{"field": "title", "op": ">", "value": 1}]}, "text"),
])
def test_wrong_configurations(check, config, said):
    with pytest.raises(ValueError, match=said):
        check(config)


def test_right_configurations():
    assert configs.checked_ingest({"run_id": "x", "files": "auto"}) and configs.checked_embed({"run_id": "x", "encoder": {"model_id": "m"}, "files": [{"stem": "a", "text_columns": ["b"], "embed": True}]})
    assert configs.checked_index({"run_id": "x"}) and configs.checked_retrieval({"retriever": {"kind": "hybrid", "k": 3}, "filters": [{"field": "age", "op": ">", "value": 1}]})


def test_schemas():
    s = {"$defs": {"d": {"type": "string", "format": "date"}}, "type": "object", "properties": {"a": {"$ref": "#/$defs/d"}, "b": {"oneOf": [{"type": "integer"}, {"const": "x"}]}, "c": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"allOf": [{"type": "string"}, {"minLength": 2}]}}}}
    assert validation.schema_errors({"a": "2024-02-29", "b": 3, "c": ["ab"]}, s) == [] == validation.schema_errors({"b": "x"}, s)
    assert validation.schema_errors({"a": "2023-02-29", "b": "y", "c": []}, s) == ["$.a: no date", "$.b: fits not exactly one of its forms", "$.c: too few or too many items"]
    assert validation.schema_errors({"c": ["a", "bc", "de"]}, s) == ["$.c: too few or too many items", "$.c[0]: too short or too long"]


def test_overlaps_like_brute_force(spark):
    import random
    from datetime import date, timedelta

    r = random.Random(4)
    rows = []
    for k in range(80):
        a = date(2024, 1, 1) + timedelta(days=r.randint(0, 60))
        rows.append((k, a, a + timedelta(days=r.randint(0, 9)), "x"))
    rows.append((90, date(9000, 1, 1), date(9000, 1, 3), "x"))
    df = spark.createDataFrame(rows, "k int, a date, b date, overlapping2 string")
    got = {x.k: x.overlapping for x in intervals.overlap_counts(df, df, "k", "a", "b").collect()}
    assert {k: n for k, n in got.items() if k < 90} == {k: sum(a <= e and s <= b and k != j for j, s, e, _ in rows) for k, a, b, _ in rows if k < 90}
    assert intervals.overlap_counts(df.limit(0), df, "k", "a", "b").count() == 0


def test_values_and_lookups(spark):
    df = spark.createDataFrame([("2020-05-17", "2020-05-XX", True), ("2020-XX-XX", "2020-05-17", False), (" Ab", "aB ", True), ("straße", "STRASSE", True), ("ΟΔΟΣ", "οδοσ", True), ("x", None, None)], "a string, b string, want boolean")
    assert df.where(~evaluation.texts_match(F.col("a"), F.col("b")).eqNullSafe(F.col("want"))).collect() == []
    j = spark.createDataFrame([('["a", "B"]', '["b", "A"]', True), ('["a"]', '["a", "a"]', False), (None, '"a"', False), ("{", '"a"', None), ('"a"', None, None)], "a string, b string, want boolean")
    assert j.where(~evaluation.json_match(F.col("a"), F.col("b")).eqNullSafe(F.col("want"))).collect() == []
    known = spark.createDataFrame([("k_v1", "h1"), ("k", "h"), ("z", "y")], "k string, h string")
    wanted = spark.createDataFrame([("k", 1), ("k", 2), ("n", 1), (None, 1)], "k string, v int")
    assert sorted(((r.k, r.v, r.h) for r in runs.versioned(wanted, known, "k", "v", "h").collect()), key=str) == sorted([("k", 1, "h1"), ("k", 2, "h"), ("n", 1, None), (None, 1, None)], key=str)
    a = runs.scoped_hashes({"x": 1, "y": 2, "z": 3}, {"s": ["x"], "t": ["y", "x"]}, {"r": {"steps": []}})
    b = runs.scoped_hashes({"x": 1, "y": 5, "z": 4}, {"s": ["x"], "t": ["y", "x"]}, {"r": {"steps": []}})
    assert runs.drift(a, b) == ["t"]
    assert validation.missing_targets({"dx": ("r", "d"), "dod": ("q", "d"), "x": ("r", "e")}, {"r": {"d"}}) == ["dod: no recipe q", "x: r declares no e"]


def test_issues_of_files(spark):
    files = spark.createDataFrame([("p", "notes", ["Date", "date ", "type"], None, True), ("q", "labs", ["age"], "ValueError", True), ("r", "labs", ["age"], None, False)], "p string, stem string, columns array<string>, error string, has_text boolean")
    people = spark.createDataFrame([("p",), ("q",), ("r",), ("s",)], "p string")
    got = {(r.p, r.issue): (r.blocking, r.detail) for r in ingest.file_issues(files, people, "p", ["notes"], ["text"], "has_text").collect()}
    assert got["s", "no_files"][0] and got["q", "missing_required_file"][0] and got["q", "unreadable"] == (True, "ValueError") and got["q", "no_text_to_embed"][0] and got["r", "no_text_to_embed"][0]
    assert got["p", "ambiguous_columns"] == (False, "date") and ("p", "no_text_to_embed") not in got and ("s", "missing_required_file") not in got and "age" in got["p", "metadata_column_not_found"][1]


def test_cells_that_a_workbook_cuts(spark):
    df = spark.createDataFrame([("x" * 40_000, 1), ("y", 2)], "t string, n int")
    assert [tuple(r) for r in sinks.cut_cells(df).collect()] == [("t", 1)]
