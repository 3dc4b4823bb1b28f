import json

import pytest
from pyspark.sql import types as T

from chartweave.sources import readers, sinks


def test_delimited_files(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('id,note,n\n001,"line one\nline ""two""",NA\n002,Unknown,1e5\n')
    df = readers.read_source(spark, str(p))
    assert [tuple(r) for r in df.orderBy("id").collect()] == [("001", 'line one\nline "two"', None), ("002", "Unknown", "1e5")]
    assert readers.header_of(spark, str(p)) == ["id", "note", "n"] and readers.row_count(spark, str(p)) == 2
    (tmp_path / "bad.tsv").write_text("a\tb\n1\t2\t3\n")
    with pytest.raises(Exception):
        readers.read_source(spark, str(tmp_path / "bad.tsv")).select("a").collect()
    with pytest.raises(ValueError):
        readers.read_source(spark, "x.doc")


def test_json_and_gold(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": {"c": 2}}, {"a": "null"}]')
    df = readers.read_source(spark, str(tmp_path / "a.json"))
    assert dict(df.dtypes)["a"] == "string" and dict(df.dtypes)["b"].startswith("struct")
    assert [r.a for r in df.collect()] == ["1", None]
    (tmp_path / "b.jsonl").write_text('{"a": 1}\n{"a": 2}\n')
    assert readers.read_source(spark, str(tmp_path / "b.jsonl")).count() == 2
    (tmp_path / "gold.jsonl").write_text('# a comment\n\n{"query_id": "q", "relevant": ["x"]}\n')
    assert readers.read_gold(spark, str(tmp_path / "gold.jsonl"), "query_id string, relevant array<string>").first().relevant == ["x"]


def test_discovery_takes_one_winner_per_stem(spark, tmp_path):
    for n in ("p1/notes.parquet", "p1/notes.CSV", "p1/.hidden.csv", "p1/readme.md", "p2/notes.json"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_text("x")
    got = {(r.patient_id, r.stem, r.extension) for r in readers.discovered(spark, str(tmp_path)).collect()}
    assert got == {("p1", "notes", "csv"), ("p2", "notes", "json")}


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("001", "a & <b>", None), ("002", "x" * 40_000, "\x00y")], "id string, t string, u string")
    sinks.write_workbook({"answers": df}, spark.createDataFrame([("run", 1)], "k string, v int"), str(tmp_path / "w.xlsx"))
    got = [tuple(r) for r in readers.read_source(spark, str(tmp_path / "w.xlsx")).collect()]
    assert got == [("001", "a & <b>", None), ("002", "x" * sinks.CELL_LIMIT, "y")]


def test_shards_logs_and_artifacts(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s" / "1.jsonl").write_text('{"a": 1}\nnot json\n{"a": 2}\n')
    said = sinks.compacted(spark, str(tmp_path / "s"), T.StructType([T.StructField("a", T.LongType())]), str(tmp_path / "out"))
    assert said == {"rows": 2, "failed": 1} and spark.read.parquet(str(tmp_path / "out")).count() == 2
    df = spark.createDataFrame([(1,)], "a long")
    sinks.append_log(df, str(tmp_path / "log")), sinks.append_log(df, str(tmp_path / "log"), "b")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2
    e = sinks.write_artifact(str(tmp_path / "x" / "a.json"), "t", {"a": 1}, [], "now", {"type": "object", "required": ["a"]})
    assert json.loads((tmp_path / "x" / "a.json").read_text()) == e and e["content_hash"].startswith("sha256:")
    with pytest.raises(ValueError):
        sinks.write_artifact(str(tmp_path / "b.json"), "t", {}, [], "now", {"type": "object", "required": ["a"]})
    with pytest.raises(ValueError):
        sinks.export_zip(spark.createDataFrame([("call 555-123-4567",)], "a string"), ["a"], str(tmp_path / "e.zip"))
    sinks.export_zip(spark.createDataFrame([("fine",)], "a string"), ["a"], str(tmp_path / "e.zip"))


def test_tables_replace_only_their_partitions(spark, tmp_path):
    p = str(tmp_path / "t")
    sinks.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string"), p, ["k"])
    sinks.write_table(spark.createDataFrame([(3, "b")], "v int, k string"), p, ["k"])
    assert sorted(r.v for r in spark.read.parquet(p).collect()) == [1, 3]


def test_response_cache(spark, tmp_path):
    c = sinks.ResponseCache(spark, str(tmp_path / "cache"))
    want = spark.createDataFrame([("k1", "m1"), ("k2", "m1"), ("k3", "m1")], "key string, fingerprint string")
    assert [r.response for r in c.get(want).collect()] == [None] * 3
    c.put(spark.createDataFrame([("k1", "m1", "old", 1), ("k1", "m1", "new", 2), ("k2", "m0", "other", 1)], c.SCHEMA))
    assert {r.key: r.response for r in c.get(want).collect()} == {"k1": "new", "k2": None, "k3": None}
    assert c.key({"a": 1}, {}) == c.key({"a": 1}, {}) != c.key({"a": 2}, {})
