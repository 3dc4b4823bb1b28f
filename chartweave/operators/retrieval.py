"""Keyword, exact, vector and hybrid retrieval within groups, as DataFrame transformations.

A candidate is a row ``(group, chunk_id, rank, score, retriever)``; ranks are 1-based without gaps, ties go by id.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartweave.functions.text import ascii_tokens, non_overlapping_count
from chartweave.session import cut_lineage, spread

#: So many query vectors are sent to the workers at once.
QUERY_BLOCK = 8192


def ranked(df: DataFrame, by: list[str], order: list[Column], k: int | None = None) -> DataFrame:
    """Adds ``rank`` within ``by``; at most ``k`` rows of each remain (a per-group limit prunes before the shuffle)."""
    out = df.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(*order)))
    return out if k is None else out.where(F.col("rank") <= k)


def exact(docs: DataFrame, group: str, key: str, text: str, query: str, k: int, ignore_case: bool = True) -> DataFrame:
    """Texts that contain the query literally, by the number of its occurrences without overlaps.  A blank query finds nothing."""
    hits = docs.select(F.col(group), F.col(key).alias("chunk_id"), non_overlapping_count(F.col(text), query, ignore_case).cast("double").alias("score")) if query.strip() else docs.select(F.col(group), F.col(key).alias("chunk_id"), F.lit(0.0).alias("score"))
    found = ranked(hits.where("score > 0"), [group], [F.desc("score"), F.asc("chunk_id")], k)
    return found.withColumn("retriever", F.lit("exact"))


def bm25(docs: DataFrame, group: str, key: str, text: str, query: str, k: int | None, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """Okapi BM25 with statistics of exactly the rows given, per group; scores at or below zero are dropped.

    idf = ln(N - df + 0.5) - ln(df + 0.5); a negative one becomes a quarter of the mean idf over the group's vocabulary.
    Repeated query words count as often as they stand.  Ranks go by the score to 9 decimals (floating sums differ
    between engines beyond), then by id.  The shuffle carries (group, word) counts that are combined before it.
    """
    words = re.findall("[a-z0-9]+", query.lower())
    if not words:
        empty = docs.select(F.col(group), F.col(key).alias("chunk_id"), F.lit(0).alias("rank"), F.lit(0.0).alias("score"), F.lit("bm25").alias("retriever"))
        return empty.where(F.lit(False))
    wanted, docs = sorted(set(words)), spread(docs.select(group, key, text))
    stats = _group_statistics(docs, group, text, wanted)
    # texts without any of the words needn't be cut into words; what still has none scores 0
    some = docs.where(F.col(group).isNotNull() & F.lower(text).rlike("|".join(wanted)))
    tokens = some.select(F.col(group), F.col(key).alias("chunk_id"), ascii_tokens(F.col(text)).alias("__tokens"))
    hits = tokens.select(group, "chunk_id", F.size("__tokens").alias("__len"), F.filter("__tokens", lambda t: t.isin(wanted)).alias("__hits"))
    counted = hits.select(group, "chunk_id", "__len", *[F.size(F.filter("__hits", _equals(w))).alias(f"__tf{i}") for i, w in enumerate(wanted)])
    part = None
    for i, w in enumerate(wanted):
        df, t = F.col("__df")[i], F.col(f"__tf{i}")
        raw = F.log(F.col("__n") - df + 0.5) - F.log(df + 0.5)
        idf = F.when(raw < 0, 0.25 * F.col("__mean")).otherwise(raw)
        one = F.when(t > 0, words.count(w) * idf * t * (k1 + 1) / (t + k1 * (1 - b + b * F.col("__len") / F.col("__avgdl")))).otherwise(0.0)
        part = one if part is None else part + one
    scores = counted.join(stats, group).select(group, "chunk_id", part.alias("score")).where("score > 0")
    return ranked(scores, [group], [F.round("score", 9).desc(), F.asc("chunk_id")], k).withColumn("retriever", F.lit("bm25"))


def _equals(word: str) -> Callable[[Column], Column]:
    return lambda x: x == word


def _group_statistics(docs: DataFrame, group: str, text: str, wanted: list[str]) -> DataFrame:
    """``(group, __n, __avgdl, __mean, __df)``: texts, mean length, mean idf over the group's vocabulary and the document
    counts of the wanted words, in their order.

    One pass over the texts: each sends its distinct words and one empty word with its length; these are combined per
    (group, word), then per (group, document count), so a group's last row holds a histogram and not a vocabulary.
    """
    vocabulary = _vocabulary(docs, group, text)
    real = F.col("__word") != ""
    mine = F.when(F.col("__word").isin(wanted), F.col("__word"))
    histogram = vocabulary.groupBy(group, "__df").agg(F.count_if(real).alias("__words"), F.max(F.when(~real, F.col("__df"))).alias("__n"), F.max("__sum").alias("__sum"), F.collect_list(mine).alias("__mine"))
    g = histogram.groupBy(group).agg(
        F.max("__n").alias("__n"), F.max("__sum").alias("__sum"),
        F.collect_list(F.when(F.col("__words") > 0, F.struct("__df", "__words"))).alias("__h"),
        F.collect_list(F.when(F.size("__mine") > 0, F.struct("__df", "__mine"))).alias("__m"),
    )
    n = F.col("__n")
    total = F.aggregate("__h", F.lit(0.0), lambda a, x: a + x["__words"] * (F.log(n - x["__df"] + 0.5) - F.log(x["__df"] + 0.5)))
    size = F.aggregate("__h", F.lit(0).cast("long"), lambda a, x: a + x["__words"])
    df = F.transform(F.array(*map(F.lit, wanted)), lambda w: F.coalesce(F.get(F.filter("__m", lambda x: F.array_contains(x["__mine"], w)), F.lit(0))["__df"], F.lit(0)))
    return g.select(group, "__n", (F.col("__sum") / n).alias("__avgdl"), F.try_divide(total, size).alias("__mean"), df.alias("__df"))


def _vocabulary(docs: DataFrame, group: str, text: str) -> DataFrame:
    """``(group, __word, __df, __sum)``: in how many texts each word occurs; the empty word stands for the texts themselves."""
    tokens = docs.where(F.col(group).isNotNull()).select(F.col(group), ascii_tokens(F.col(text)).alias("__t"))
    sent = tokens.select(group, F.greatest(F.coalesce(F.size("__t"), F.lit(0)), F.lit(0)).alias("__len"), F.explode(F.concat(F.array(F.lit("")), F.coalesce(F.array_distinct("__t"), F.array().cast("array<string>")))).alias("__word"))
    return sent.groupBy(group, "__word").agg(F.count("*").alias("__df"), F.sum(F.when(F.col("__word") == "", F.col("__len"))).alias("__sum"))


def bm25_queries(docs: DataFrame, group: str, key: str, text: str, queries: DataFrame, query_key: str, question: str, k: int, k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """The same for a table of queries: ``(query_key, group, chunk_id, rank, score)``, each query asked in every group.

    The queries' distinct words are joined to the postings of the texts and to the groups' vocabularies, so the corpus is read
    twice however many queries there are.  Null and wordless queries find nothing.  Where ``query_key`` is ``group``, each group
    has a query of its own, which is asked in it alone.
    """
    docs = spread(docs.select(group, key, text))
    asked = queries.select(F.col(query_key), F.explode(ascii_tokens(F.col(question))).alias("__word")).groupBy(query_key, "__word").agg(F.count("*").alias("__times"))
    words = asked.select("__word").distinct()
    vocabulary = _vocabulary(docs, group, text)
    real = F.col("__word") != ""
    sizes = vocabulary.where(~real).select(group, F.col("__df").alias("__n"), (F.col("__sum") / F.col("__df")).alias("__avgdl"))
    raw = F.log(F.col("__n") - F.col("__df") + 0.5) - F.log(F.col("__df") + 0.5)
    # words of the same document count have the same idf, so a group's mean needs its histogram only
    histogram = vocabulary.where(real).groupBy(group, "__df").agg(F.count("*").alias("__words"))
    means = histogram.join(sizes, group).groupBy(group).agg((F.sum(raw * F.col("__words")) / F.sum("__words")).alias("__mean"))
    weights = vocabulary.where(real).join(words, "__word", "left_semi").join(sizes, group).join(means, group)
    weights = weights.select(group, "__word", "__avgdl", F.when(raw < 0, 0.25 * F.col("__mean")).otherwise(raw).alias("__idf"))
    tokens = docs.where(F.col(group).isNotNull()).select(F.col(group), F.col(key).alias("chunk_id"), ascii_tokens(F.col(text)).alias("__t"))
    postings = tokens.select(group, "chunk_id", F.size("__t").alias("__len"), F.explode("__t").alias("__word")).join(words, "__word", "left_semi")
    postings = postings.groupBy(group, "chunk_id", "__len", "__word").agg(F.count("*").alias("__tf"))
    t = F.col("__tf")
    part = F.col("__idf") * t * (k1 + 1) / (t + k1 * (1 - b + b * F.col("__len") / F.col("__avgdl")))
    by = list(dict.fromkeys([query_key, group]))
    scored = postings.join(weights, [group, "__word"]).select(group, "chunk_id", "__word", part.alias("__part")).join(asked, ["__word"] if query_key != group else [group, "__word"])
    scores = scored.groupBy(*by, "chunk_id").agg(F.sum(F.col("__times") * F.col("__part")).alias("score")).where("score > 0")
    return ranked(scores, by, [F.round("score", 9).desc(), F.asc("chunk_id")], k).withColumn("retriever", F.lit("bm25"))


def knn(spark: SparkSession, vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, k: int, exclude_self: bool = True) -> DataFrame:
    """``(query_id, chunk_id, rank, score)``: the k vectors of the largest inner product with each query, exactly.

    The queries go out in blocks of QUERY_BLOCK; in each partition a matrix product keeps the k best of it per query, and
    only those are shuffled to be ranked.  Null vectors match nothing; ties go by id.
    """
    q = queries.select(F.col(query_key).cast("long").alias("q"), F.col(vector).alias("v")).where(F.col("v").isNotNull())
    blocks = max(1, -(-q.count() // QUERY_BLOCK))
    data = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where(F.col("v").isNotNull())
    best = None
    for i in range(blocks):
        rows = (q.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == i) if blocks > 1 else q).toPandas()
        block = spark.sparkContext.broadcast((rows["q"].to_numpy(np.int64), np.array(rows["v"].tolist(), np.float64)))

        def run(batches: Iterator[pd.DataFrame], block=block) -> Iterator[pd.DataFrame]:
            ids, m = block.value
            for pdf in batches:
                if not len(pdf) or not len(ids):
                    continue
                x, own = np.array(pdf["v"].tolist(), np.float64), pdf["id"].to_numpy(np.int64)
                order = np.argsort(own, kind="stable")
                x, own = x[order], own[order]
                s = m @ x.T
                if exclude_self:
                    s[ids[:, None] == own] = -np.inf
                take = min(k, s.shape[1])
                # the k-th best value, then everything not below it, so that ties are settled by id later
                edge = -np.partition(-s, take - 1, axis=1)[:, take - 1]
                r, c = np.nonzero((s >= edge[:, None]) & (s > -np.inf))
                yield pd.DataFrame({"query_id": ids[r], "chunk_id": own[c], "score": s[r, c]})

        one = data.mapInPandas(run, "query_id long, chunk_id long, score double")
        best = one if best is None else best.unionByName(one)
    return ranked(best, ["query_id"], [F.round("score", 9).desc(), F.asc("chunk_id")], k)


def knn_then_filter(spark: SparkSession, vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, k: int, oversample: int, allowed: DataFrame) -> DataFrame:
    """kNN whose source filter comes after the search: k x oversample are pulled, those in ``allowed`` (ids) kept, at most k
    remain; fewer than k may be left, which is the rule."""
    pulled = knn(spark, vectors, key, vector, queries, query_key, k * oversample).drop("rank")
    kept = pulled.join(allowed.select(F.col(key).cast("long").alias("chunk_id")).distinct(), "chunk_id", "left_semi")
    return ranked(kept, ["query_id"], [F.round("score", 9).desc(), F.asc("chunk_id")], k)


def ivf_index(vectors: DataFrame, key: str, vector: str, cells: int, sample: int = 20_000, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """Every vector with its cell, and the cells' centres: spherical k-means fitted on at most ``sample`` vectors (by hash
    order, so the same ones each time); all vectors are indexed."""
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(vector).alias("v")).orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(sample).toPandas()
    x = np.array(rows["v"].tolist(), np.float64).reshape(len(rows), -1)
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(8):
        near = (x @ centres.T).argmax(1)
        for c in range(len(centres)):
            if (near == c).any():
                m = x[near == c].mean(0)
                centres[c] = m / max(np.linalg.norm(m), 1e-12)

    def assign(v: pd.Series) -> pd.Series:
        return pd.Series((np.array(v.tolist(), np.float64) @ centres.T).argmax(1).astype("int32"))

    cell = F.pandas_udf(assign, "int")
    return vectors.where(F.col(vector).isNotNull()).withColumn("cell", cell(vector)), centres


def ivf_knn(index: DataFrame, centres: np.ndarray, key: str, vector: str, queries: DataFrame, query_key: str, k: int, probes: int) -> DataFrame:
    """Approximate kNN: a query meets the vectors of its ``probes`` nearest cells (an equi-join on the cell)."""

    def nearest(v: pd.Series) -> pd.Series:
        s = np.array(v.tolist(), np.float64) @ centres.T
        return pd.Series(list(np.argsort(-s, 1)[:, :probes].astype("int32")))

    near = F.pandas_udf(nearest, "array<int>")
    q = queries.select(F.col(query_key).cast("long").alias("query_id"), F.col(vector).alias("qv"), F.explode(near(vector)).alias("cell"))
    dot = F.aggregate(F.zip_with("qv", vector, lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, b: a + b)
    pairs = q.join(index, "cell").where(F.col("query_id") != F.col(key)).select("query_id", F.col(key).cast("long").alias("chunk_id"), dot.alias("score"))
    return ranked(pairs, ["query_id"], [F.round("score", 9).desc(), F.asc("chunk_id")], k)


def pq_index(vectors: DataFrame, key: str, vector: str, parts: int = 16, centres: int = 64, sample: int = 20_000, seed: int = 3) -> tuple[DataFrame, np.ndarray]:
    """``(id, codes)`` of every vector, and the code book: product quantisation, a vector as one byte for each of its ``parts``.

    The book is fitted by k-means on at most ``sample`` vectors (by hash order, so the same ones each time); every vector is
    indexed.  A code is a sixteenth of a vector of 64 floats, and it is what a search reads.
    """
    rows = vectors.where(F.col(vector).isNotNull()).select(F.col(vector).alias("v")).orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(sample).toPandas()
    x = np.array(rows["v"].tolist(), np.float64).reshape(len(rows), -1)
    rng = np.random.default_rng(seed)
    book = []
    for p in np.array_split(np.arange(x.shape[1]), parts):
        sub = x[:, p]
        c = sub[rng.choice(len(sub), min(centres, len(sub)), replace=False)] if len(sub) else np.zeros((1, len(p)))
        for _ in range(12):
            near = _nearest(sub, c)
            c = np.stack([sub[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
        book.append(c)
    width = max((b.shape[1] for b in book), default=0)
    packed = np.full((parts, centres, width), np.nan)
    for i, b in enumerate(book):
        packed[i, : len(b), : b.shape[1]] = b
    shared = vectors.sparkSession.sparkContext.broadcast(packed)

    def encode(v: pd.Series) -> pd.Series:
        return pd.Series([bytes(r) for r in _codes(np.array(v.tolist(), np.float64), shared.value)])

    some = vectors.where(F.col(vector).isNotNull())
    return some.select(F.col(key).cast("long").alias("id"), F.pandas_udf(encode, "binary")(vector).alias("codes")), packed


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x @ c.T - 0.5 * (c * c).sum(1)).argmax(1) if len(x) else np.zeros(0, np.int64)


def _subs(book: np.ndarray, dim: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """The dimensions of each part and its centres."""
    out = []
    for p, b in zip(np.array_split(np.arange(dim), len(book)), book):
        real = b[~np.isnan(b[:, 0])] if b.size else b
        out.append((p, real[:, : len(p)]))
    return out


def _codes(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.stack([_nearest(x[:, p], c) for p, c in _subs(book, x.shape[1])], 1).astype(np.uint8)


def pq_knn(index: DataFrame, book: np.ndarray, vectors: DataFrame, key: str, vector: str, queries: DataFrame, query_key: str, k: int, deep: int = 20) -> DataFrame:
    """Approximate kNN: the ``deep`` x k nearest of each query by their codes, in each partition and then over all, are scored
    again by their vectors.  The queries go out in blocks, as in ``knn``."""
    q = queries.select(F.col(query_key).cast("long").alias("q"), F.col(vector).alias("v")).where(F.col("v").isNotNull())
    blocks, found, sc = max(1, -(-q.count() // QUERY_BLOCK)), None, index.sparkSession.sparkContext
    for i in range(blocks):
        rows = (q.where(F.pmod(F.xxhash64("q"), F.lit(blocks)) == i) if blocks > 1 else q).toPandas()
        block = sc.broadcast((rows["q"].to_numpy(np.int64), np.array(rows["v"].tolist(), np.float64), book))

        def run(batches: Iterator[pd.DataFrame], block=block) -> Iterator[pd.DataFrame]:
            ids, m, book = block.value
            if not len(ids):
                return
            tables = [m[:, p] @ c.T for p, c in _subs(book, m.shape[1])]
            for pdf in batches:
                if not len(pdf):
                    continue
                own = pdf["id"].to_numpy(np.int64)
                codes = np.frombuffer(b"".join(pdf["codes"]), np.uint8).reshape(len(own), -1)
                s = sum(t[:, codes[:, j]] for j, t in enumerate(tables))
                s[ids[:, None] == own] = -np.inf
                take = min(k * deep, s.shape[1])
                best = np.argpartition(-s, take - 1, axis=1)[:, :take]
                r = np.repeat(np.arange(len(ids)), take)
                yield pd.DataFrame({"query_id": ids[r], "id": own[best.ravel()], "near": s[r, best.ravel()]})

        one = index.mapInPandas(run, "query_id long, id long, near double").where(F.col("near") > float("-inf"))
        found = one if found is None else found.unionByName(one)
    near = ranked(found, ["query_id"], [F.desc("near"), F.asc("id")], k * deep).select("query_id", "id")
    dot = F.aggregate(F.zip_with("qv", "v", lambda a, b: a.cast("double") * b.cast("double")), F.lit(0.0), lambda a, b: a + b)
    pairs = near.join(vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")), "id").join(q.select(F.col("q").alias("query_id"), F.col("v").alias("qv")), "query_id")
    scored = pairs.select("query_id", F.col("id").alias("chunk_id"), dot.alias("score"))
    return ranked(scored, ["query_id"], [F.round("score", 9).desc(), F.asc("chunk_id")], k)


def fused(members: list[tuple[str, DataFrame]], by: list[str], k: int, method: str = "reciprocal_rank", weights: dict[str, float] | None = None, k0: int = 60) -> DataFrame:
    """One list of several retrievers' lists: sum of weight / (k0 + rank), or of weight x score with ``weighted_sum``.
    ``retriever`` is the first member, in the order given, that returned the chunk."""
    every = None
    for i, (kind, df) in enumerate(members):
        w = (weights or {}).get(kind, 1.0)
        value = F.lit(w) / (k0 + F.col("rank")) if method == "reciprocal_rank" else F.lit(w) * F.col("score")
        one = df.select(*by, "chunk_id", value.alias("part"), F.struct(F.lit(i).alias("i"), F.lit(kind).alias("kind")).alias("first"))
        every = one if every is None else every.unionByName(one)
    out = every.groupBy(*by, "chunk_id").agg(F.sum("part").alias("score"), F.min("first")["kind"].alias("retriever"))
    return ranked(out, by, [F.round("score", 9).desc(), F.asc("chunk_id")], k)


def member_depth(k: int) -> int:
    """How many candidates each member of a hybrid is asked for."""
    return max(2 * k, 10)


def run_members(members: list[tuple[str, Callable[[], DataFrame]]], keep: Callable[[DataFrame], DataFrame] | None = None) -> tuple[list[tuple[str, DataFrame]], list[dict[str, str]]]:
    """The members that work, and an outcome per member; an error is told by its class and a hash only.  Raises if none does.

    Most errors come up when rows are made, so with ``keep`` (such as ``cut_lineage``) each member's candidates, which are few,
    are made here and a member that fails then is left out, too; without it only those that can't be planned are.
    """
    import hashlib

    ok, outcomes = [], []
    for kind, make in members:
        try:
            ok.append((kind, keep(make()) if keep else make()))
            outcomes.append({"retriever": kind, "status": "ok"})
        except Exception as e:
            outcomes.append({"retriever": kind, "status": "failed", "error": type(e).__name__, "detail": hashlib.sha256(str(e).encode()).hexdigest()[:16]})
    if not ok:
        raise RuntimeError(f"all members failed: {[o['error'] for o in outcomes]}")
    return ok, outcomes


def hybrid(docs: DataFrame, group: str, key: str, text: str, query: str, k: int, members: list[dict] | None = None, method: str = "reciprocal_rank", weights: dict[str, float] | None = None, vectors: tuple[DataFrame, str, list[float]] | None = None, keep: Callable[[DataFrame], DataFrame] | None = cut_lineage) -> DataFrame:
    """The fused list of several retrievers, by default bm25 and embedding, each asked for ``member_depth(k)``.  ``vectors``:
    the texts' vectors by ``key``, their column, and the query's vector; ranks of the vector search are within each group."""
    depth = member_depth(k)

    def made(config: dict) -> DataFrame:
        extra = {n: v for n, v in config.items() if n not in ("kind", "k")}
        if config["kind"] == "embedding":
            table, vector, asked = vectors
            return vectors_in_groups(docs, group, key, table, vector, asked, depth)
        return {"bm25": bm25, "exact": exact}[config["kind"]](docs, group, key, text, query, depth, **extra)

    chosen = members or [{"kind": "bm25"}, {"kind": "embedding"}]
    found, _ = run_members([(c["kind"], lambda c=c: made(c)) for c in chosen], keep)
    return fused(found, [group], k, method, weights)


def vectors_in_groups(docs: DataFrame, group: str, key: str, vectors: DataFrame, vector: str, asked: list[float], k: int) -> DataFrame:
    """The k texts of each group whose vectors have the largest inner product with the asked one, as candidates."""
    dot = F.lit(0.0)
    for i, x in enumerate(asked):
        dot = dot + F.col(vector)[i].cast("double") * F.lit(float(x))
    some = vectors.where(F.col(vector).isNotNull()).select(F.col(key), dot.alias("score"))
    scored = docs.where(F.col(group).isNotNull()).select(F.col(group), F.col(key)).join(some, key).select(group, F.col(key).alias("chunk_id"), "score")
    return ranked(scored, [group], [F.round("score", 9).desc(), F.asc("chunk_id")], k).withColumn("retriever", F.lit("embedding"))


CLAUSE = re.compile(r"^\s*(\w+)\s*(==|!=|contains)\s*'((?:[^'\\]|\\.)*)'\s*$")


def clause(df: DataFrame, expression: str) -> Column:
    """``column == 'v'``, ``column != 'v'`` or ``column contains 'v'`` (literal); nulls match none of them."""
    m = CLAUSE.match(expression)
    if not m:
        raise ValueError(f"not a filter clause: {expression!r}")
    if m[1] not in df.columns:
        raise ValueError(f"no column {m[1]!r}")
    c, v = F.col(m[1]).cast("string"), F.lit(m[3].replace("\\'", "'"))
    return {"==": c == v, "!=": c != v, "contains": F.contains(c, v)}[m[2]]


def table_rows(df: DataFrame, group: str | None, row_id: str, expression: str | None, k: int) -> DataFrame:
    """The first k rows, in table order, that satisfy a clause, each with score 1."""
    kept = df.where(clause(df, expression)) if expression else df
    kept = kept.withColumn("chunk_id", F.col(row_id))
    if group is None:  # the global top k first, so that the numbering sees k rows only
        out = kept.orderBy(row_id).limit(k).withColumn("rank", F.row_number().over(W.orderBy(row_id)))
    else:
        out = ranked(kept, [group], [F.asc(row_id)], k)
    return out.withColumn("score", F.lit(1.0)).withColumn("retriever", F.lit("direct_parquet"))


def with_recent(candidates: DataFrame, docs: DataFrame, group: str, key: str, day: str, n: int, most: int) -> DataFrame:
    """Candidates followed by the n newest dated texts that aren't among them (day, then id, falling; undated ones by id rising
    after all dated ones); the rank goes on, their score is 0.  ``most``: how many candidates a group has at most (the limit that
    they were retrieved with)."""
    # the k candidates of a group are among its first k + n texts by day at worst, so these few are all that meets the candidates
    order = [F.desc_nulls_last("__day"), F.when(F.col("__day").isNotNull(), F.col("chunk_id")).desc_nulls_last(), F.asc("chunk_id")]
    dated = docs.where(F.col(group).isNotNull()).select(F.col(group), F.col(key).alias("chunk_id"), F.col(day).alias("__day"))
    sizes = candidates.select(group, "chunk_id", "rank", "score", "retriever", F.lit(None).cast(dated.schema["__day"].dataType).alias("__day"), F.lit(0).alias("__new"))
    newest = ranked(dated, [group], order, n + most).select(group, "chunk_id", F.lit(None).cast("int").alias("rank"), F.lit(0.0).alias("score"), F.lit("recent").alias("retriever"), "__day", F.lit(1).alias("__new"))
    w = W.partitionBy(group)
    every = sizes.unionByName(newest)
    every = every.withColumn("__first", F.min("__new").over(W.partitionBy(group, "chunk_id"))).where("__new = __first").withColumn("__last", F.coalesce(F.max("rank").over(w), F.lit(0)))
    numbered = every.withColumn("__r", F.row_number().over(w.orderBy(F.asc("__new"), *order)) - F.sum(1 - F.col("__new")).over(w))
    return numbered.where((F.col("__new") == 0) | (F.col("__r") <= n)).select(group, "chunk_id", F.when(F.col("__new") == 0, F.col("rank")).otherwise(F.col("__last") + F.col("__r")).alias("rank"), "score", "retriever")


def retrieval_record(candidates: DataFrame, by: list[str], config: str) -> DataFrame:
    """One text-free row per query: its candidates in order, the selected ids and the configuration."""
    item = F.struct("rank", "chunk_id", F.round("score", 6).alias("score"), "retriever")
    return candidates.groupBy(*by).agg(F.sort_array(F.collect_list(item)).alias("candidates")).withColumn("selected_chunk_ids", F.transform("candidates", lambda c: c["chunk_id"])).withColumn("config", F.lit(config))


def build_retriever(config: dict) -> Callable[..., DataFrame]:
    """The retriever of a configuration: kinds bm25, exact, embedding, hybrid and direct_parquet; k defaults to 10."""
    kinds = {"bm25": bm25, "exact": exact, "embedding": knn, "direct_parquet": table_rows, "hybrid": hybrid}
    kind = config.get("kind")
    if kind not in kinds:
        raise ValueError(f"unknown retriever {kind!r}; known: {sorted(kinds)}")
    extra = {k: v for k, v in config.items() if k != "kind"}
    extra.setdefault("k", 10)
    return lambda *args, **kw: kinds[kind](*args, **(extra | kw))


def encoder_alignment(query: dict, stored: dict | None, source_present: bool) -> str:
    """ok, mismatch, rebuild (nothing recorded, sources there) or fail, over the recorded fields; a path is no part of it."""
    if not stored:
        return "rebuild" if source_present else "fail"
    same = all(query.get(f) == v for f, v in stored.items() if f != "path")
    return "ok" if same else "mismatch"


def index_is_consistent(recorded_hash: str, now_hash: str, n_index: int, n_vectors: int, n_chunks: int) -> None:
    if recorded_hash != now_hash:
        raise ValueError("the index was built from other vectors")
    if not n_index == n_vectors == n_chunks:
        raise ValueError(f"index, vectors and chunks differ: {n_index}, {n_vectors}, {n_chunks}")
