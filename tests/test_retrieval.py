import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartweave.operators import ranking, retrieval


def plain_bm25(docs, query, k1=1.5, b=0.75):
    toks = {i: re.findall("[a-z0-9]+", t.lower()) for i, t in docs}
    n, avg = len(toks), sum(map(len, toks.values())) / len(toks)
    df = {}
    for t in toks.values():
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    idf = {w: math.log(n - d + 0.5) - math.log(d + 0.5) for w, d in df.items()}
    mean = sum(idf.values()) / len(idf)
    idf = {w: 0.25 * mean if v < 0 else v for w, v in idf.items()}
    out = {}
    for i, t in toks.items():
        s = sum(idf.get(w, 0) * t.count(w) * (k1 + 1) / (t.count(w) + k1 * (1 - b + b * len(t) / avg)) for w in re.findall("[a-z0-9]+", query.lower()))
        if s > 0:
            out[i] = s
    return out


def test_bm25_like_the_formula(spark):
    r = random.Random(1)
    docs = [(k, " ".join(r.choices("alpha beta gamma delta eps zeta eta theta".split(), [8, 4, 2, 1, 1, 1, 1, 1], k=r.randint(1, 30)))) for k in range(60)] + [(60, ""), (61, "é ß")]
    df = spark.createDataFrame([("g", *d) for d in docs] + [("h", 99, "alpha")], "g string, id long, t string")
    for q in ("gamma theta theta", "alpha", "nothing here", "  "):
        got = {r.chunk_id: r.score for r in retrieval.bm25(df, "g", "id", "t", q, None).where("g = 'g'").collect()}
        want = plain_bm25(docs, q)
        assert set(got) == set(want) and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_exact_counts_without_overlaps(spark):
    df = spark.createDataFrame([("g", 1, "aaa"), ("g", 2, "AA aa aa"), ("g", 3, None), ("g", 4, "b")], "g string, id long, t string")
    assert [(r.chunk_id, r.score, r.rank) for r in retrieval.exact(df, "g", "id", "t", "aa", 5).orderBy("rank").collect()] == [(2, 3.0, 1), (1, 1.0, 2)]
    assert retrieval.exact(df, "g", "id", "t", "  ", 5).collect() == []


def _vectors(spark, n=400, dim=16):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + 0.3 * rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x, spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(n, None)], "id long, v array<float>")


def test_knn_and_index(spark, monkeypatch):
    x, df = _vectors(spark)
    x = x.astype(np.float32).astype(np.float64)
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 7)
    q = df.where("id % 10 = 0")
    got = {}
    for r in retrieval.knn(spark, df, "id", "v", q, "id", 5).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.chunk_id)
    want = {}
    for i in range(0, 400, 10):
        s = x @ x[i]
        want[i] = [j for j in sorted(range(400), key=lambda j: (-round(s[j], 9), j)) if j != i][:5]
    assert got == want
    index, centres = retrieval.ivf_index(df, "id", "v", 12, sample=200)
    near = {}
    for r in retrieval.ivf_knn(index, centres, "id", "v", q.where("v is not null"), "id", 5, probes=4).collect():
        near.setdefault(r.query_id, set()).add(r.chunk_id)
    recall = sum(len(near.get(i, set()) & set(w)) for i, w in want.items()) / sum(map(len, want.values()))
    assert recall >= 0.9


def test_fusion_is_the_same_in_any_order_but_for_the_label(spark):
    a = spark.createDataFrame([("q", 1, 1, 2.0), ("q", 2, 2, 1.0)], "q string, chunk_id long, rank int, score double")
    b = spark.createDataFrame([("q", 2, 1, 9.0), ("q", 3, 2, 8.0)], "q string, chunk_id long, rank int, score double")
    one = retrieval.fused([("a", a), ("b", b)], ["q"], 5).orderBy("rank").collect()
    two = retrieval.fused([("b", b), ("a", a)], ["q"], 5).orderBy("rank").collect()
    assert [(r.chunk_id, round(r.score, 9)) for r in one] == [(r.chunk_id, round(r.score, 9)) for r in two]
    assert one[0].chunk_id == 2 and one[0].retriever == "a" and two[0].retriever == "b"
    ok, said = retrieval.run_members([("a", lambda: a), ("x", lambda: 1 / 0)])
    assert len(ok) == 1 and said[1]["error"] == "ZeroDivisionError"
    with pytest.raises(RuntimeError):
        retrieval.run_members([("x", lambda: 1 / 0)])


def test_clauses_and_configuration(spark):
    df = spark.createDataFrame([(1, "O'Brien"), (2, None), (3, "100%")], "row_id long, name string")
    ids = lambda e: [r.chunk_id for r in retrieval.table_rows(df, None, "row_id", e, 5).collect()]
    assert ids("name == 'O\\'Brien'") == [1] and ids("name != '100%'") == [1] and ids("name contains '%'") == [3] and ids(None) == [1, 2, 3]
    for bad in ("nope == 'x'", "name > 'x'", "name == 'x"):
        with pytest.raises(ValueError):
            retrieval.clause(df, bad)
    with pytest.raises(ValueError):
        retrieval.build_retriever({"kind": "magic"})
    assert retrieval.build_retriever({"kind": "exact"})(spark.createDataFrame([("g", 1, "x")], "g string, id long, t string"), "g", "id", "t", "x").count() == 1
    assert retrieval.encoder_alignment({"m": 1}, {"m": 1, "path": "x"}, True) == "ok" and retrieval.encoder_alignment({"m": 1}, {"m": 2}, True) == "mismatch" and retrieval.encoder_alignment({}, None, True) == "rebuild"
    with pytest.raises(ValueError):
        retrieval.index_is_consistent("a", "a", 1, 2, 3)


def test_the_best_ranked_copy_survives_and_the_limit_comes_after(spark):
    rows = [("q", k, k, 1.0, t, "s", None) for k, t in [(1, "Same  text"), (2, "same text "), (3, " "), (4, " "), (5, "straße"), (6, "STRASSE"), (7, None)]]
    df = spark.createDataFrame(rows, "q string, chunk_id long, rank int, score double, text string, source string, document_date string")
    out = ranking.rerank(df, ["q"], F.lit("zzz"), "text", "source", "document_date", 3)
    assert [(r.chunk_id, r.final_rank) for r in out.orderBy("final_rank").collect()] == [(1, 1), (3, 2), (4, 3)]
    assert ranking.without_copies(df.withColumn("new_rank", F.col("rank")), ["q"], "text").count() == 5
    assert ranking.allowed_number(8, 0) == 8 and ranking.allowed_number(8, 5) == 5
    with pytest.raises(ValueError):
        ranking.allowed_number(8, -1)
    with pytest.raises(ValueError):
        ranking.signals({"magic": 1})
    assert ranking.rank_method(None, False) == "combined" and ranking.rank_method(None, True) == "cross_encoder"
    s = ranking.cross_scored(df, ["q"], F.lit("a"), "text", lambda q, t: [len(x) for x in t])
    assert s.orderBy("new_rank").first().chunk_id == 1
