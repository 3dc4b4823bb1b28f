"""Re-ranking, exact-text deduplication, trimming and reading order of candidates."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartweave.functions.dates import interval
from chartweave.functions.text import is_blank, normalised, word_set
from chartweave.session import spread

WEIGHTS = {"prior_rank": 0.4, "overlap": 0.4, "source": 0.2}


def signals(weights: dict[str, float] | None) -> dict[str, float]:
    """The default weights with those given in their place; an unknown name is an error."""
    if unknown := set(weights or {}) - set(WEIGHTS):
        raise ValueError(f"unknown signals {sorted(unknown)}")
    return WEIGHTS | (weights or {})


def combined(candidates: DataFrame, by: list[str], query: Column, text: str, source: str, source_weights: dict[str, float] | None = None, weights: dict[str, float] | None = None, k0: int = 60) -> DataFrame:
    """Rank by w1 / (k0 + prior rank) + w2 x share of the query's words in the text + w3 x weight of the source.
    Adds ``prior_rank``, ``combined`` and ``new_rank``; ties by prior rank, then id."""
    w = signals(weights)
    q, c = word_set(query), word_set(F.col(text))
    overlap = F.when(F.size(q) > 0, F.size(F.array_intersect(q, c)) / F.size(q)).otherwise(0.0)
    weight = F.lit(0.0)
    for s, v in (source_weights or {}).items():
        weight = F.when(F.col(source) == s, F.lit(float(v))).otherwise(weight)
    score = w["prior_rank"] / (k0 + F.greatest("rank", F.lit(1))) + w["overlap"] * F.coalesce(overlap, F.lit(0.0)) + w["source"] * weight
    out = candidates.withColumn("prior_rank", F.col("rank")).withColumn("combined", score)
    return out.withColumn("new_rank", F.row_number().over(W.partitionBy(*by).orderBy(F.round("combined", 6).desc(), "prior_rank", "chunk_id")))


def day_of(text: Column, newest: bool) -> Column:
    """The latest day that a date may denote when the newest go first, else the earliest."""
    i = interval(text)
    return i["hi"] if newest else i["lo"]


def by_date(candidates: DataFrame, by: list[str], date: str, newest: bool = True) -> DataFrame:
    """Rank by date, undated last, otherwise in the order of the pool (``rank``); the score is 1 / position."""
    d = day_of(F.col(date), newest)
    order = [F.desc_nulls_last("__d") if newest else F.asc_nulls_last("__d"), F.asc("rank"), F.asc("chunk_id")]
    out = candidates.withColumn("__d", d)
    return out.withColumn("new_rank", F.row_number().over(W.partitionBy(*by).orderBy(*order))).withColumn("date_score", 1.0 / F.col("new_rank")).drop("__d")


def without_copies(candidates: DataFrame, by: list[str], text: str, rank: str = "new_rank") -> DataFrame:
    """The best-ranked candidate of every text (white space and case folded); blank texts are no copies of each other."""
    same = F.when(is_blank(F.col(text)), F.concat(F.lit("\u0001"), F.col("chunk_id").cast("string"))).otherwise(F.sha2(normalised(F.col(text)), 256))
    out = candidates.withColumn("__same", same)
    out = out.withColumn("__best", F.row_number().over(W.partitionBy(*by, "__same").orderBy(rank, "chunk_id")))
    return out.where("__best = 1").drop("__same", "__best")


def copy_statistics(df: DataFrame, key: str, text: str, best: str) -> DataFrame:
    """Per text that occurs more than once: copies, dropped, the id kept (smallest by ``best``, then id) and a 12-digit hash.
    The copies of a text are combined before the shuffle."""
    n, df = normalised(F.col(text)), spread(df.select(key, text, best))
    g = df.where(~is_blank(F.col(text))).groupBy(F.sha2(n, 256).alias("h")).agg(F.count("*").alias("copies"), F.min(F.struct(best, key))[key].alias("kept_id"))
    return g.where("copies > 1").select(F.substring("h", 1, 12).alias("text_hash"), "copies", (F.col("copies") - 1).alias("dropped"), "kept_id")


def trimmed(candidates: DataFrame, by: list[str], top_n: int, rank: str = "new_rank") -> DataFrame:
    """The first top_n, numbered anew without gaps."""
    numbered = candidates.withColumn("final_rank", F.row_number().over(W.partitionBy(*by).orderBy(F.asc(rank), F.asc("chunk_id"))))
    return numbered.where(F.col("final_rank") <= top_n)


def reading_order(candidates: DataFrame, by: list[str], date: str, newest: bool = False, rank: str = "final_rank") -> DataFrame:
    """Adds ``read_pos``: by day, undated last, otherwise by rank; the rank itself stays."""
    d = day_of(F.col(date), newest)
    order = [F.desc_nulls_last(d) if newest else F.asc_nulls_last(d), F.asc(rank)]
    return candidates.withColumn("read_pos", F.row_number().over(W.partitionBy(*by).orderBy(*order)))


def allowed_number(top_n: int, ceiling: int | None) -> int:
    """How many may reach a prompt: top_n under the machine's ceiling; none or 0 is no ceiling, below 0 an error."""
    if ceiling is not None and ceiling < 0:
        raise ValueError("a ceiling can't be negative")
    return min(top_n, ceiling) if ceiling else top_n


def rank_method(rank_by: str | None, has_cross_encoder: bool) -> str:
    """Unset: the cross-encoder where there is one, else the combined score; what contradicts that is refused."""
    known = ("cross_encoder", "combined", "newest", "oldest")
    chosen = rank_by or ("cross_encoder" if has_cross_encoder else "combined")
    if chosen not in known:
        raise ValueError(f"unknown ranking {chosen!r}; known: {known}")
    if (chosen == "cross_encoder") != has_cross_encoder and (chosen == "cross_encoder" or rank_by is None):
        raise ValueError("a cross-encoder is asked for, but none is built")
    return chosen


def cross_scored(candidates: DataFrame, by: list[str], query: Column, text: str, scorer) -> DataFrame:
    """Rank by a scorer of (query, text) pairs: a function of two lists of texts to a list of numbers, run in Arrow batches;
    compared at 6 decimals, ties by prior rank, then id.  A number that isn't finite is an error."""
    def run(q: pd.Series, t: pd.Series) -> pd.Series:
        s = [float(x) for x in scorer(q.tolist(), t.fillna("").tolist())]
        if len(s) != len(q) or not all(map(math.isfinite, s)):
            raise ValueError("the scorer gave a wrong number of scores, or one that isn't finite")
        return pd.Series(s)

    out = candidates.withColumn("prior_rank", F.col("rank")).withColumn("logit", F.pandas_udf(run, "double")(query, F.col(text)))
    return out.withColumn("new_rank", F.row_number().over(W.partitionBy(*by).orderBy(F.round("logit", 6).desc(), "prior_rank", "chunk_id")))


def rerank(candidates: DataFrame, by: list[str], query: Column, text: str, source: str, date: str, top_n: int, method: str = "combined", source_weights: dict[str, float] | None = None, chronological: bool = False) -> DataFrame:
    """Rank all, drop copies, keep top_n, number anew, then put in reading order; the limit never goes below the dropping."""
    out = combined(candidates, by, query, text, source, source_weights) if method == "combined" else by_date(candidates, by, date, method == "newest")
    out = trimmed(without_copies(out, by, text), by, top_n)
    return reading_order(out, by, date) if chronological else out.withColumn("read_pos", F.col("final_rank"))
