import json

import pytest
from pyspark.sql import functions as F

from chartweave.operators import answers, evaluation, validation
from chartweave.plans import recipes as R


def _raw(**more):
    return {"name": "stage", "version": 1, "steps": [{"id": "a", "kind": "llm_only", "prompt": "x"}]} | more


def test_recipes_are_checked():
    assert R.parse_recipe(_raw(), "stage_v1").steps[0].kind == "llm_only"
    step = {"id": "a", "kind": "llm_only"}
    for bad in ({"draft": True}, {"extra": 1}, {"archetype": "poem"}, {"steps": [{"id": "a", "kind": "magic"}]}, {"steps": [step, step]}, {"steps": [step | {"reranking": {"weights": 1}}]}, {"steps": [step | {"filters": [{"field": "x", "op": "==", "value": 1}]}]}):
        with pytest.raises((ValueError, KeyError)):
            R.parse_recipe(_raw(**bad))
    with pytest.raises(ValueError):
        R.parse_recipe(_raw(), "stage_v2")


def test_plan_orders_and_finds_what_is_missing():
    make = lambda n, *d: R.Recipe(n, 1, (), d)
    rs = {r.name: r for r in (make("c", "b", "a"), make("b", "a"), make("a"), make("z"), make("m", "gone"))}
    assert R.planned(rs, ["c"]) == (["a", "b", "c"], []) and R.planned(rs, ["m"]) == (["m"], ["gone"])
    with pytest.raises(ValueError):
        R.planned({"a": make("a", "b"), "b": make("b", "a")}, ["a"])
    assert R.highest_version(["s_v2", "s_v10", "t_v1", "x"]) == {"s": "s_v10", "t": "t_v1"} and R.newest_run([]) is None


def test_prompts_and_salvage():
    p = R.loaded_prompt("---\nname: x\n---\nSYSTEM:\nbe brief\nUSER:\n{{ a.b }} and {{ c }}")
    assert p["meta"] == {"name": "x"} and R.render(p["user"], {"a": {"b": 1}, "c": "two"}) == "1 and two"
    with pytest.raises(KeyError):
        R.render("{{ nope }}", {})
    assert R.salvaged_json('so:\n```json\n{"a": "null", "b": ["x", "NULL"]}\n```') == {"a": None, "b": ["x", None]}
    assert R.salvaged_json('text {"a": "none"} more') == {"a": "none"} and R.salvaged_json("no json") is None


def test_grounding():
    data = {"v": 1, "evidence_chunk_id": "c9", "items": [{"source_chunk_id": ["c1", "c8"]}], "cell_evidence_pointer": "p:structured:x"}
    assert R.ungrounded(data, {"c1"}) == ["$.evidence_chunk_id", "$.items[0].source_chunk_id"]
    clean, n = R.without_fabricated(data, {"c1"})
    assert n == 2 and clean["evidence_chunk_id"] is None and clean["items"][0]["source_chunk_id"] == ["c1"]

    class Learns:
        calls = 0

        def chat(self, request):
            self.calls += 1
            if self.calls == 1:
                raise ConnectionError
            if self.calls == 2:
                return R.Response('{"evidence_chunk_id": "c9"}', truncated=True)
            return R.Response(json.dumps({"evidence_chunk_id": "c1" if "Cite only" in request.user else "c9"}))

    assert R.ask_until_grounded(Learns(), R.Request("", "q"), {"c1"}) == ({"evidence_chunk_id": "c1"}, 2)
    with pytest.raises(ValueError):
        R.EchoProvider(1).chat(R.Request("", "x" * 100))
    assert R.allowed_endpoint([{"name": "a", "attestation": "test"}], "a")
    with pytest.raises(ValueError):
        R.allowed_endpoint([], "a")


def test_prompting_loses_no_row(spark):
    class Fails:
        def chat(self, request):
            if "bad" in request.user:
                raise RuntimeError("x")
            return R.Response('{"value": 1}')

    df = spark.createDataFrame([(1, "ok", ["c"]), (2, "", None), (3, None, []), (4, "bad", ["c"])], "id int, packet string, shown array<string>")
    got = {r.id: (r.ok, r.error) for r in R.HANDLERS["retrieve_and_prompt"](df, ["id"], {}, Fails()).collect()}
    assert got == {1: (True, None), 2: (True, "empty_evidence"), 3: (True, "empty_evidence"), 4: (False, "RuntimeError")}
    steps = spark.createDataFrame([(1, 1, "a", "x"), (1, 2, "b", None), (2, 1, "a", None)], "id int, n int, step string, data string")
    assert sorted((r.id, r.data, r.answered_by) for r in R.last_answer(steps, ["id"], "n", "data", "step").collect()) == [(1, "x", "a"), (2, None, None)]
    m = spark.createDataFrame([("2020-XX-XX", "2020-05-01"), ("2020-05-02", "2020-05-01"), (None, "2020-XX-XX")], "a string, b string")
    assert [r[0] for r in m.select(R.merged_passes(F.col("a"), F.col("b"))).collect()] == ["2020-05-01", "2020-05-02", "2020-XX-XX"]
    assert R.matched_tables([("Labs.csv", "lab"), ("notes.csv", "note")], contains="lab") == ["Labs.csv"]
    out = R.HANDLERS["python"](df, ["id"], {"function": lambda p: p[["id"]].assign(n=1), "schema": "id int, n int"})
    assert out.count() == 4


def test_provenance_and_schema(spark):
    bad = {"sex": {"value": "F"}, "dx": {"value": "x", "evidence_chunk_id": "c1"}, "list": [{"value": 1}], "note": {"value": "unknown"}}
    assert validation.unprovenanced_paths(bad) == ["$.sex", "$.list[0]"]
    df = spark.createDataFrame([(1, json.dumps(bad)), (2, "oops"), (3, None)], "id int, data string")
    assert sorted(tuple(r) for r in validation.unprovenanced(df, ["id"], "data").collect()) == [(1, "$.list[0]"), (1, "$.sex"), (2, "!")]
    schema = {"type": "object", "required": ["a"], "additionalProperties": False, "properties": {"a": {"type": ["string", "null"], "pattern": "^x"}, "n": {"type": "integer", "minimum": 1}, "l": {"type": "array", "items": {"enum": [1, 2]}}}}
    assert validation.schema_errors({"a": "x", "n": 2, "l": [1]}, schema) == []
    assert [e.split(":")[0] for e in validation.schema_errors({"n": 0, "l": [3], "z": 1}, schema)] == ["$.a", "$.l[0]", "$.n", "$.z"]
    one = spark.createDataFrame([(1, 'é"x', None)], "b int, a string, c string").select(validation.row_hash(["b", "a", "c"])).first()[0]
    import hashlib

    assert one == hashlib.sha256('{"a":"é\\"x","b":"1","c":null}'.encode()).hexdigest()


def test_headers_and_matching():
    schema = {"properties": {"a": {"type": "string"}, "b": {"anyOf": [{"$ref": "#/$defs/q"}, {"type": "null"}]}, "rows": {"type": "array", "items": {"properties": {"x": {}, "y": {}}}}}, "$defs": {"q": {"properties": {"c": {}}}}}
    assert answers.header(schema) == (["a", "b.c", "rows.x", "rows.y"], "rows")
    two = {"properties": {"r": {"type": "array", "items": {"properties": {"x": {}}}}, "s": {"type": "array", "items": {"properties": {"y": {}}}}}}
    assert answers.header(two) == (["r", "s"], None)
    assert evaluation.values_match("2020-03-15", "2020-03-XX") and not evaluation.values_match("2020-03-XX", "2020-03-15")
    assert evaluation.values_match([{"a": "X"}, {"a": "y"}], [{"a": "y"}, {"a": "x"}]) and not evaluation.values_match([1, 1], [1, 2])
    assert evaluation.values_match({"a": 1, "b": 2}, {"a": 1}) and not evaluation.values_match(True, 1)


def test_counts_reports_and_hidden_values(spark, caplog):
    import logging

    from chartweave.operators.deid import Redacting

    assert validation.found_count({"rows": [{"a": 1}, {"a": None}], "note": "x"}) == 2
    assert validation.found_count({"a": 1, "b": {"c": "unknown", "d": "y"}, "e": None}) == 2
    df = spark.createDataFrame([("t", '{"a": 1}'), ("t", "{}"), ("t", "x"), ("u", "{}"), ("t", None)], "k string, p string")
    got = {tuple(r) for r in validation.artifact_report(df, "k", "p", {"t": {"type": "object", "required": ["a"]}}).collect()}
    assert got == {("t", 4, 3, "$.a: missing"), ("u", 1, 1, "unknown type")}
    record = logging.LogRecord("n", logging.INFO, "f", 1, "patient %s at %d", ("x", 3), None)
    Redacting().filter(record)
    assert record.getMessage() == "patient [hidden] at [hidden]"


def test_a_recipe_runs_and_every_setting_counts(spark):
    from chartweave.plans.runner import Corpus, run_recipes

    class Shows:
        def chat(self, request):
            if "boom" in request.user:
                raise RuntimeError("x")
            return R.Response(json.dumps({"saw": request.user}))

    docs = spark.createDataFrame([("a", 1, "fever old", "2001-01-01"), ("a", 2, "fever fever new", "2021-01-01"), ("a", 3, "fever late fever fever", "2022-05-01"), ("a", 4, "fever ancient", "1950-01-01"), ("b", 5, "nothing", None), ("c", 6, "fever boom", "2020-01-01")], "p string, chunk_id long, text string, document_date string")
    docs = docs.select("*", *(F.lit(None).cast("string").alias(c) for c in ("title", "doc_type", "author", "source")))
    orders = spark.createDataFrame([("a", 1, "x pill", "u"), ("a", 2, None, "u"), ("a", 3, "y pill", "v"), ("a", 4, "z pill", "u"), ("b", 5, "drop", "u"), ("b", 6, "w pill", "u")], "p string, row_id long, drug string, unit string")
    find = {"id": "find", "kind": "retrieve_and_prompt", "prompt": "?", "retrieval": {"kind": "exact", "query": "fever", "k": 4}, "filters": [{"field": "document_date", "op": ">=", "value": "2000-01-01"}], "reranking": {"top_n": 2, "chronological_order": True}, "stop_if": "data like '%late%'"}
    find["also_include_tables"] = [{"name": "orders", "filter": "drug contains 'pill'", "columns": ["drug"], "max_rows": 2}, {"name": "gone"}]
    rows = {"id": "rows", "kind": "direct_parquet", "table": "orders", "columns": ["drug"], "max_rows": 2}
    made = [{"name": "one", "version": 1, "steps": [find, rows]}, {"name": "two", "version": 1, "depends_on": ["one"], "steps": [{"id": "each", "kind": "map_table_rows_and_prompt", "prompt": "?", "table": "orders", "filter": "unit == 'u'"}, {"id": "sum", "kind": "llm_only", "prompt": "{{ one }}|{{ each }}"}]}]
    corpus = Corpus("p", spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "p string"), docs, {"orders": (orders, "row_id")})
    steps, answers = run_recipes({r["name"]: R.parse_recipe(r) for r in made}, ["two"], corpus, Shows())
    got = {(r.p, r.recipe, r.step): r for r in steps.collect()}
    assert len(got) == 16
    assert {p: (got[p, "one", "find"].status, got[p, "one", "rows"].status) for p in "abcd"} == {"a": ("stopped", "skipped"), "b": ("complete", "complete"), "c": ("failed", "complete"), "d": ("complete", "complete")}
    saw = json.loads(got["a", "one", "find"].data)["saw"]
    assert [line.split(" | ")[1].split("=")[1] for line in saw.split("\n") if " | " in line] == ["a:orders:1:TABLE", "a:orders:3:TABLE", "2", "3"]
    assert json.loads(got["b", "one", "rows"].data) == [{"row_id": 5, "drug": "drop"}, {"row_id": 6, "drug": "w pill"}] and got["d", "one", "find"].error == "empty_evidence"
    assert [x["row_id"] for x in json.loads(got["a", "two", "each"].data)] == [1, 2, 4]
    last = {(r.p, r.recipe): r for r in answers.collect()}
    assert last["a", "one"].answered_by == "find" and last["b", "one"].answered_by == "rows" and last["c", "one"].data is None
    assert last["a", "two"].answered_by == "sum" and "late" in last["a", "two"].data


def test_keys_that_a_kind_does_not_read_are_refused():
    for step in ({"kind": "llm_only", "max_rows": 3}, {"kind": "direct_parquet", "table": "t", "retrieval": {"kind": "exact", "query": "x"}}, {"kind": "retrieve_and_prompt", "retrieval": {"kind": "embedding", "query": "x"}}, {"kind": "retrieve_and_prompt", "retrieval": {"kind": "exact", "query": "x"}, "also_include_tables": [{"name": "t", "rows": 1}]}):
        with pytest.raises(ValueError):
            R.parse_recipe(_raw(steps=[{"id": "a"} | step]))


def test_each_group_asks_its_own_query(spark):
    from chartweave.plans.runner import Corpus, run_recipes

    docs = spark.createDataFrame([(g, f"{g}{k}", t) for g, ts in {"a": ["ankle pain", "cough again", "sleep well"], "b": ["ankle pain", "cough again", "sleep well"], "c": ["ankle pain"]}.items() for k, t in enumerate(ts)], "g string, chunk_id string, text string")
    docs = docs.selectExpr("g", "chunk_id", "text", "null as title", "null as doc_type", "null as document_date", "null as author", "'s' as source").selectExpr("g", "chunk_id", "text", *[f"cast({c} as string) as {c}" for c in ("title", "doc_type", "document_date", "author", "source")])
    asks = spark.createDataFrame([("a", 1, "ankle"), ("b", 2, "cough"), ("c", 3, "nothing here")], "g string, id int, topic string")

    class Says:
        def chat(self, request):
            return R.Response(json.dumps({"value": request.user.split("\n")[-1], "evidence_chunk_id": None}))

    steps = [{"id": "topic", "kind": "direct_parquet", "table": "asks", "columns": ["topic"]}, {"id": "find", "kind": "retrieve_and_prompt", "prompt": "p", "retrieval": {"kind": "bm25", "query_from": "topic", "k": 1}}]
    log, _ = run_recipes({"r": R.parse_recipe({"name": "r", "version": 1, "steps": steps})}, ["r"], Corpus("g", docs.select("g").distinct(), docs, {"asks": (asks, "id")}), Says())
    assert {r.g: r.data and json.loads(r.data)["value"] for r in log.where("step = 'find'").collect()} == {"a": "ankle pain", "b": "cough again", "c": None}
    for bad in ({"kind": "bm25"}, {"kind": "bm25", "query": "x", "query_from": "y"}, {"kind": "exact", "query_from": "y"}):
        with pytest.raises(ValueError, match="retrieval"):
            R.parse_recipe({"name": "r", "version": 1, "steps": [steps[1] | {"retrieval": bad}]})


def test_a_cached_provider_is_asked_once(spark, tmp_path):
    from chartweave.sources.sinks import ResponseCache

    log = tmp_path / "calls"
    log.mkdir()

    class Counts:
        def chat(self, request):
            import uuid

            (log / uuid.uuid4().hex).write_text(request.user)
            if "bad" in request.user:
                raise ValueError("never works")
            if "busy" in request.user:
                raise RuntimeError("works later")
            return R.Response(json.dumps({"value": request.user}))

    rows = spark.createDataFrame([(1, "a"), (2, "a"), (3, "bad"), (4, "busy"), (5, " "), (6, None)], "id int, p string")
    ask = lambda model: {r.id: (r.data, r.ok, r.error) for r in R.prompted(rows, ["id"], "sys", "p", None, R.Cached(Counts(), ResponseCache(spark, str(tmp_path / "cache")), model)).collect()}
    first = ask("m1")
    assert first[1] == first[2] == ('{"value": "a"}', True, None) and first[3] == (None, False, "ValueError") and first[4][2] == "RuntimeError" and first[5] == first[6] == (None, True, "empty_evidence")
    said = sorted(f.read_text() for f in log.iterdir())
    assert said == ["a", "bad", "busy"]
    assert ask("m1") == first and sorted(f.read_text() for f in log.iterdir()) == ["a", "bad", "busy", "busy"]
    ask("m2")
    assert len(list(log.iterdir())) == 7


def test_an_index_of_codes_finds_most(spark):
    import numpy as np

    from chartweave.operators import retrieval

    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    v = spark.createDataFrame([(i, r.tolist(), "x") for i, r in enumerate(x)] + [(5000, None, "x")], "id long, v array<double>, codes string").repartition(3)
    q = v.where("id % 30 = 0")
    pairs = lambda df: {(r.query_id, r.chunk_id) for r in df.collect()}
    exact = pairs(retrieval.knn(spark, v, "id", "v", q, "id", 10))
    index, book = retrieval.pq_index(v, "id", "v", parts=8, centres=32)
    assert index.count() == 900 and len(pairs(retrieval.pq_knn(index, book, v, "id", "v", q, "id", 10)) & exact) >= 0.9 * len(exact) == 0.9 * 300
    assert pairs(retrieval.pq_knn(index, book, v, "id", "v", q.limit(0), "id", 10)) == set()
