from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chartweave.functions.text import normalised
from chartweave.operators import chunks, deid, evaluation, ingest, packing, runs
from chartweave.streaming import state


def test_windows_cover_every_token(spark):
    rows = [(k, "  " + " ".join(f"w{i}é" for i in range(k)) + "\n") for k in range(0, 60)] + [(100, None), (101, " \n")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "id int, text string, chunk_idx string")
    got = {}
    for r in chunks.token_windows(df, ["id"], "text", 10, 3).orderBy("id", "chunk_idx").collect():
        got.setdefault(r.id, []).append(r)
    assert set(got) == set(range(1, 60))
    for k, ws in got.items():
        text = dict(rows)[k]
        seen = [t for w in ws for t in text[w.char_start : w.char_end].split()]
        assert set(seen) == set(text.split()) and all(w.num_chunks == len(ws) and w.parent_tokens == k for w in ws)
        assert len(ws) == (1 if k <= 10 else -(-(k - 10) // 7) + 1)
    n = spark.range(60).select("id", chunks.window_count(F.col("id"), 10, 3).alias("n"))
    assert all(r.n == len(got.get(r.id, [])) for r in n.collect())
    with pytest.raises(ValueError):
        chunks.budget(512, 2, 511)
    assert chunks.budget(512, 2) == 510


def test_resolving_and_rendering(spark):
    rows = spark.createDataFrame([(1, "héllo world"), (2, "changed"), (4, None)], "row_id int, text string")
    sha = lambda t: __import__("hashlib").sha256(t.encode()).hexdigest()
    c = spark.createDataFrame([("a", 1, sha("héllo world"), 1, 5), ("b", 2, sha("old"), 0, 3), ("c", 3, sha("x"), 0, 1), ("d", 1, "sha256:" + sha("héllo world"), 6, 11)], "chunk_id string, row_id int, source_text_sha256 string, char_start long, char_end long")
    got = {r.chunk_id: (r.status, r.chunk_text) for r in chunks.resolved(c, rows, ["row_id"], "text").collect()}
    assert got == {"a": ("ok", "éllo"), "b": ("stale", None), "c": ("gone", None), "d": ("ok", "world")}
    t = spark.createDataFrame([("1", " ", None, "x")], "a string, b string, c string, d string")
    assert t.select(chunks.rendered_row(t.columns)).first()[0] == "a: 1\nd: x"
    e = chunks.embedded(spark.createDataFrame([(1, "a b"), (2, None)], "id int, t string"), "id", "t", 8)
    assert chunks.embedding_report(e.withColumn("g", F.lit(1)), "g").first().zero == 1
    v = spark.createDataFrame([("g", [1.0, 0.0]), ("g", [float("nan"), 1.0]), ("g", [float("inf"), 0.0]), ("g", [3.0, 0.0]), ("g", None)], "g string, embedding array<float>")
    r = chunks.embedding_report(v, "g").first()
    assert (r.rows, r.missing, r.nan, r.infinite, r.off_norm, r.ok) == (5, 1, 1, 1, 1, False)


def test_ingest(spark):
    assert ingest.metadata_columns(["Visit", "TYPE", "author", "Author "])["document_date"] is None
    assert ingest.metadata_columns(["Note_Date ", "TYPE"])["document_date"] == "Note_Date " and ingest.ambiguous_columns(["A b", "a_b", "c"]) == {"a_b": ["A b", "a_b"]}
    assert ingest.role_columns(["Text", "MRN"], ["text"], ["mrn"]) == ["Text"]
    with pytest.raises(ValueError, match="never embedded"):
        ingest.role_columns(["Text", "MRN"], ["text", "mrn"], ["MRN "])
    assert ingest.metadata_columns(["date", "note_date", "Signed On"], site={"document_date": "signed on"})["document_date"] == "Signed On" and ingest.metadata_columns(["note_date"], site={"document_date": "signed on"})["document_date"] == "note_date"
    with pytest.raises(ValueError, match="no metadata fields"):
        ingest.metadata_columns(["date"], site={"dcument_date": "date"})
    assert ingest.drafted_map(["date", "note_text", "patient_id", "x"]) == {"fields": {"document_date": "date"}, "text": ["note_text"], "identifiers": ["patient_id"], "leftovers": ["x"]}
    df = spark.createDataFrame([(1, "5/3/21")], "row_id int, d string")
    with pytest.raises(Exception, match="two-digit year in d"):
        ingest.canonical_dates(df, ["d"]).collect()
    t = ingest.normalised_table(spark.createDataFrame([(1, "NA", None), (2, "5/3/2021", "x")], "row_id int, d string, e string"), "row_id", ["d"])
    assert [tuple(r) for r in t.collect()] == [(2, "2021-05-03", "x")]
    assert ingest.renamed(df, {"day": "d"}).columns == ["row_id", "day"]


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 500), st.integers(1, 500))
def test_wilson_bounds_by_formula(k, n):
    import math

    k = min(k, n)
    z, p = 1.959963984540054, k / n
    mid, half = (p + z * z / (2 * n)) / (1 + z * z / n), z / (1 + z * z / n) * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    assert 0 <= mid - half + 1e-9 and mid + half <= 1 + 1e-9 and mid - half <= p + 1e-9 and p <= mid + half + 1e-9


def test_evaluation(spark):
    ci = spark.createDataFrame([(0, 0), (5, 5), (3, 10)], "k int, n int").select(evaluation.wilson(F.col("k"), F.col("n")).alias("c")).collect()
    assert [(r.c.low, r.c.high) for r in ci] == [(0.0, 0.0), (0.5655, 1.0), (0.1078, 0.6032)]
    b = spark.createDataFrame([(["a", "b", "c"], [["x"], ["a", "c"]]), (["a"], [["b"]]), ([], [])], "s array<string>, m array<array<string>>").select(evaluation.bundle_sufficiency(F.col("s"), F.col("m")).alias("b")).collect()
    assert [tuple(r.b) for r in b] == [(True, 1, 1), (False, None, 1), (False, None, 0)]


def test_runs(spark):
    log = spark.createDataFrame([("p", "running", datetime(2024, 1, 1, 0, 0, 0), 1), ("p", "running", datetime(2024, 1, 1, 0, 0, 5), 2), ("p", "completed", datetime(2024, 1, 1, 0, 0, 7), 3), ("p", "completed", datetime(2024, 1, 1, 0, 0, 9), 4), ("q", "running", datetime(2024, 1, 1), 5)], "p string, s string, ts timestamp, n int")
    assert [tuple(r) for r in runs.durations(log, ["p"], "s", "ts", "n", "running", "completed").collect()] == [("p", 1, 2.0)]
    assert {(r.p, r.last_state) for r in runs.last_states(log, ["p"], "s", "ts", "n").collect()} == {("p", "completed"), ("q", "running")}
    assert runs.merged_log([log, log.limit(2)]).count() == 5
    with pytest.raises(Exception, match="one rule"):
        runs.sampling_frame(spark.createDataFrame([("a", 1, "r"), ("a", 2, "s")], "k string, pos int, rule string"), "k", "pos", "rule").collect()
    assert runs.drift({"a": "1", "b": "2"}, {"a": "1", "c": "3"}) == ["b", "c"] and runs.corpus_may_be_reused({"k": 1}, {"k": 1}, ["k"], False, 0)


def test_deidentification(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    s = [r[0] for r in df.select(deid.surrogate(F.col("v"), b"k", "study", "d", "f")).collect()]
    assert s[0] == s[1] and s[0].startswith("surr:v1:study:f:") and len(s[0].rsplit(":", 1)[1]) == 24 and s[2] is None
    assert df.select(deid.surrogate(F.col("v"), b"k", "study", "other", "f")).first()[0] != s[0]
    t = spark.createDataFrame([("2020-01-01",), ("2020-01",), ("mail a@b.org",), ("plain words",), (None,), (s[0],)], "v string")
    assert [r[0] for r in t.select(deid.is_forbidden(F.col("v"))).collect()] == [True, False, True, True, False, False]
    good, bad = deid.gated(t, ["v"])
    assert good.count() == 3 and bad.count() == 3
    c = deid.constrained(spark.createDataFrame([("a", 1), ("z", 1), (None, 1), ("a", None)], "k string, n int"), {"k": ["a", "b"]}, ["k", "n"])
    assert [r.valid for r in c.collect()] == [True, False, False, False]
    leaks = deid.verified_export(spark.createDataFrame([("00012", "x")], "a string, b string"), ["a", "b"], spark.createDataFrame([("00012",)], "p string"), "p")
    assert [tuple(r) for r in leaks.collect()] == [("a", 1, 1)]
    assert deid.fingerprint({"a": 1, "secret": 2}, ["a"]) == deid.fingerprint({"a": 1}, ["a"])
    assert spark.createDataFrame([("20240611-x",)], "r string").select(deid.month_stamp(F.col("r"))).first()[0] == "2024-06"


def test_only_safe_shapes_leave(spark):
    cases = {
        "BASSETT, KITTY": True, "Bassett": True, "bassett": False, "reports chest pain since Tuesday": True, "123456789": True, "1234": False, "01/15/2026": True, "20260115": True, "20260115_x": True,
        "report.csv": True, "a.PDF": True, "v1.2": False, "exhaust/v1": False, "sha256:abc123": False, "0123456789012345": True, "0123456789abcdef": False, "2024-05": False, "unknown": False, "": False, "pt_7": True, "id7": True, "note_type/x.y-z": False,
        "surr:v1:study:chunk_id:" + "a" * 24: False, "surr:v1:other:chunk_id:" + "a" * 24: True, "x" * 80: False, "x" * 81: True, "/ehr/x": True, "7" * 64: True, "é": True,
    }
    df = spark.createDataFrame([(k, w) for k, w in cases.items()] + [(None, False)], "v string, want boolean")
    assert [tuple(r) for r in df.select("v", deid.is_forbidden(F.col("v")).alias("got"), "want").where("got <> want").collect()] == []
    assert df.where(F.size(deid.violations(F.col("v"))) > 0).where("not want").count() == 0 == df.where(F.size(deid.violations(F.col("v"))) == 0).where("want").count()
    one = spark.createDataFrame([("NORTH", "20260115_x", "NORTH")], "site_id string, run_id string, other string")
    assert [r for r in one.select(*[deid.is_forbidden(F.col(c), c) for c in one.columns]).first()] == [False, False, True]


def test_egress(spark, tmp_path):
    ids = spark.createDataFrame([("00012",), ("",), (None,), ("7",)], "p string")
    path = f"{tmp_path}/exhaust/relevance_label.parquet"
    df = spark.createDataFrame([("ok_token", ["fine"], 1), ("x_00012", ["Jane Doe"], 2), (None, None, 3)], "a string, b array<string>, n int")
    df.write.parquet(path)
    good = {"record_types": {"relevance_label": {"sha256": deid.export_hash(spark, path)}}}
    check = lambda p, m: deid.egress_findings(spark, p, m, set(deid.RECORDS), ids, "p")
    assert check(path, good) == ["a: 1 forbidden, 1 with a patient id", "b: 1 forbidden, 0 with a patient id"]
    assert check(path, {"record_types": {"relevance_label": {"sha256": "sha256:0"}}}) == ["another hash than the manifest's"] and check(path, {}) == ["not in the manifest"]
    assert check(f"{tmp_path}/relevance_label.parquet", good) == ["outside the exhaust folder"] and check(f"{tmp_path}/exhaust/other.parquet", good) == ["unknown record type"]
    with pytest.raises(ValueError, match="lacks"):
        deid.valid_record(df.select(F.lit("x").alias("site_id")), "method_provenance")
    with pytest.raises(ValueError, match="has no"):
        deid.valid_record(df, "method_provenance")


def test_packets(spark):
    rows = [("q", 1, "c1", "text one", "note", "t", "2020-01-01", None, "s", 1.23456), ("q", 2, "c2", " ", None, None, None, None, "s", 1.0), ("q", 3, "c3", "x" * 400, None, None, None, "a", "s", None)]
    df = spark.createDataFrame(rows, "q string, final_rank int, chunk_id string, text string, doc_type string, title string, document_date string, author string, source string, score double")
    made = packing.blocks(df)
    p = packing.packets(made, ["q"], ceiling=50).first()
    assert p.n_blocks == 2 and p.status == "over_ceiling" and p.packet.startswith("[Evidence 1 | chunk_id=c1 | title=t | doc_type=note | date=2020-01-01 | author=— | linked_author=— | s | record — | chunk — | score 1.235]\ntext one\n\n[Evidence 3 | chunk_id=c3 | title=— |")
    assert {r.doc_type for r in packing.tokens_by_type(made, ["q"]).collect()} == {"note", "unknown"}
    with pytest.raises(Exception, match="over its ceiling"):
        packing.refused(packing.packets(made, ["q"], ceiling=50)).collect()
    assert spark.createDataFrame([(" A  ß\n",)], "t string").select(normalised(F.col("t"))).first()[0] == "a ss"


def test_streaming_keeps_the_latest_state(spark, tmp_path):
    schema = "k string, s string, ts timestamp, n long"
    for i, rows in enumerate([[("a", "x", datetime(2024, 1, 1), 1), ("a", "x", datetime(2024, 1, 1), 1), ("b", "y", datetime(2024, 1, 3), 2)], [("a", "z", datetime(2024, 1, 2), 3), ("b", "old", datetime(2024, 1, 2), 4)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        q = state.unique_transitions(stream, ["k", "n"], "ts", "5 days").writeStream.foreachBatch(state.keep_latest(str(tmp_path / "out"), ["k"], "s", "ts", "n")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
    last = max((tmp_path / "out").iterdir(), key=lambda p: int(p.name[2:]))
    assert {(r.k, r.s) for r in spark.read.parquet(str(last)).collect()} == {("a", "z"), ("b", "y")}
