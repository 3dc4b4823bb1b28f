"""Windows over texts, their addresses, and the way back to the text."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartweave.functions.text import is_blank, text_hash


def window_count(total: Column, window: int, overlap: int) -> Column:
    """How many windows of ``window`` tokens cover ``total`` tokens, the last being the first that reaches the end."""
    step = window - overlap
    return F.when(total <= 0, 0).when(total <= window, 1).otherwise(F.ceil((total - window) / F.lit(step)).cast("int") + 1)


def budget(model_max: int, special_tokens: int, window: int | None = None) -> int:
    """The window in tokens; by default all that the model leaves beside its special tokens."""
    most = model_max - special_tokens
    if window is not None and window > most:
        raise ValueError(f"a window of {window} tokens doesn't fit a model of {model_max} with {special_tokens} special tokens")
    return most if window is None else window


def token_windows(df: DataFrame, keys: list[str], text: str, window: int, overlap: int, pattern: str = r"\S+", first_only: bool = False) -> DataFrame:
    """``(*keys, chunk_idx, char_start, char_end, token_count, parent_tokens, num_chunks)`` of every non-blank text.

    Offsets are found in Arrow batches (one pass of the pattern over each text), whole texts of any length; no shuffle.
    Null and blank texts give no window.
    """
    if not 0 <= overlap < window:
        raise ValueError("0 <= overlap < window must hold")
    schema = T.StructType([*(df.schema[k] for k in keys), *(T.StructField(n, t) for n, t in [("chunk_idx", T.IntegerType()), ("char_start", T.LongType()), ("char_end", T.LongType()), ("token_count", T.IntegerType()), ("parent_tokens", T.IntegerType()), ("num_chunks", T.IntegerType())])])
    step = window - overlap

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import re

        find = re.compile(pattern)
        for pdf in batches:
            row, idx, a, z, count, parent, chunks = [], [], [], [], [], [], []
            for i, t in enumerate(pdf["__text"]):
                spans = [m.span() for m in find.finditer(t)]
                n = len(spans)
                k = 0 if not n else 1 if n <= window else -(-(n - window) // step) + 1
                for c in range(min(k, 1) if first_only else k):
                    lo, hi = c * step, min(c * step + window, n)
                    row.append(i), idx.append(c), a.append(spans[lo][0]), z.append(spans[hi - 1][1]), count.append(hi - lo), parent.append(n), chunks.append(k)
            out = pdf[keys].iloc[row].reset_index(drop=True)
            yield out.assign(chunk_idx=np.array(idx, np.int32), char_start=np.array(a, np.int64), char_end=np.array(z, np.int64), token_count=np.array(count, np.int32), parent_tokens=np.array(parent, np.int32), num_chunks=np.array(chunks, np.int32))

    return df.select(*keys, F.col(text).alias("__text")).where(~is_blank(F.col("__text"))).mapInPandas(run, schema)


def single_windows(df: DataFrame, keys: list[str], text: str, most: int) -> DataFrame:
    """One window per text, of its first ``most`` tokens: the no-chunker, whose cut is its purpose."""
    return token_windows(df, keys, text, most, 0, first_only=True).withColumn("num_chunks", F.lit(1))


def addressed(windows: DataFrame, patient: str, stem: str, row: str) -> DataFrame:
    """Adds ``chunk_id`` patient:stem:row:chunk."""
    return windows.withColumn("chunk_id", F.concat_ws(":", F.col(patient), F.col(stem), F.col(row).cast("string"), F.col("chunk_idx").cast("string")))


def chunk_counts(chunks: DataFrame, cell: list[str]) -> DataFrame:
    """Adds ``num_chunks``: the chunks of the same cell."""
    return chunks.withColumn("num_chunks", F.count("*").over(W.partitionBy(*cell)).cast("int"))


def duplicate_ids(chunks: DataFrame, key: str = "chunk_id") -> DataFrame:
    """``(chunk_id, copies)`` of the ids that occur more than once; a corpus must have none."""
    return chunks.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def resolved(chunks: DataFrame, rows: DataFrame, on: list[str], text: str, sha: str = "source_text_sha256") -> DataFrame:
    """Chunks with ``chunk_text`` cut out of their row, and ``status``: ok, stale (the row's text is another one now) or
    gone (no such row).  Stale and gone chunks have no text."""
    right = rows.select(*on, F.col(text).alias("__t"), F.sha2(F.col(text), 256).alias("__now"))
    j = chunks.join(right, on, "left")
    status = F.when(F.col("__now").isNull(), "gone").when(F.regexp_replace(sha, "^sha256:", "") != F.col("__now"), "stale").otherwise("ok")
    cut = F.substring(F.col("__t"), (F.col("char_start") + 1).cast("int"), (F.col("char_end") - F.col("char_start")).cast("int"))
    return j.withColumn("status", status).withColumn("chunk_text", F.when(F.col("status") == "ok", cut)).drop("__t", "__now")


def rendered_row(columns: list[str]) -> Column:
    """The row's cells as lines ``name: value``; null and blank cells are left out."""
    return F.concat_ws("\n", *[F.when(~is_blank(F.col(f"`{c}`").cast("string")), F.concat(F.lit(f"{c}: "), F.col(f"`{c}`").cast("string"))) for c in columns])


def row_hashes(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    return df.select(*keys, text_hash(F.col(text)).alias("source_text_sha256"))


def chunk_metadata(chunks: DataFrame, fields: list[str], tables: list[tuple[DataFrame, str, dict[str, str | None]]] = ()) -> DataFrame:
    """``(chunk_id, *fields)`` as text, of chunks and of whole table rows: each table is (rows, id column, field -> its column)."""
    view = lambda df, key, names: df.select(F.col(key).alias("chunk_id"), *[(F.nullif(F.col(names[f]).cast("string"), F.lit("")) if names.get(f) else F.lit(None).cast("string")).alias(f) for f in fields])
    out = view(chunks, "chunk_id", {f: f for f in fields})
    for rows, key, names in tables:
        out = out.unionByName(view(rows, key, names))
    return out


def embedded(df: DataFrame, key: str, text: str, dim: int = 64, encode: Callable[[list[str]], np.ndarray] | None = None) -> DataFrame:
    """``(key, embedding array<float>)`` of unit length by an encoder that takes a list of texts; by default feature hashing
    of words, which needs no model.  Null and blank texts give a zero vector."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf[text].fillna("").tolist()
            made = (encode or (lambda t: hashed_vectors(t, dim)))(texts).astype(np.float32)
            norm = np.linalg.norm(made.astype(np.float64), axis=1, keepdims=True)
            made = np.where(norm < 1e-12, made, made / np.maximum(norm, 1e-12)).astype(np.float32)
            yield pd.DataFrame({key: pdf[key], "embedding": list(made)})

    return df.select(key, text).mapInPandas(run, T.StructType([df.schema[key], T.StructField("embedding", T.ArrayType(T.FloatType()))]))


def pooled(tokens: Column, mask: Column, how: str = "mean") -> Column:
    """The vector of a text from those of its tokens (``array<array<float>>``), in doubles and of unit length: the mean over the
    tokens whose mask isn't 0, or with ``cls`` the first one.  Without any such token it is null."""
    wide = F.transform(tokens, lambda v: F.transform(v, lambda x: x.cast("double")))
    if how == "cls":
        v = F.get(wide, F.lit(0))
    elif how == "mean":
        shown = F.transform(F.filter(F.arrays_zip(wide.alias("v"), mask.alias("m")), lambda z: z["m"] != 0), lambda z: z["v"])
        zero = F.transform(F.get(wide, F.lit(0)), lambda x: x * 0.0)
        total = F.aggregate(shown, zero, lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
        v = F.when(F.size(shown) > 0, total)
    else:
        raise ValueError(f"unknown pooling {how!r}; known: mean, cls")
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(v, lambda x: F.when(norm < 1e-12, x).otherwise(x / norm))


def hashed_vectors(texts: list[str], dim: int) -> np.ndarray:
    import zlib

    out = np.zeros((len(texts), dim))
    for i, t in enumerate(texts):
        for w in t.lower().split():
            h = zlib.crc32(w.encode("utf-8", "surrogatepass"))
            out[i, h % dim] += 1 if h & 0x80000000 else -1
    return out


def embedding_report(df: DataFrame, group: str, vector: str = "embedding", least: int = 1, tolerance: float = 1e-3) -> DataFrame:
    """Per group: rows, and how many vectors hold a NaN, an infinite value, are zero or not of unit length; ``ok`` if none does."""
    v = F.col(vector)
    squares = F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    nan, inf = F.exists(v, lambda x: F.isnan(x)), F.exists(v, lambda x: F.abs(x) == float("inf"))
    norm = F.sqrt(squares)
    zero = ~nan & (norm < 1e-12)
    off = ~nan & ~inf & ~zero & (F.abs(norm - 1) > tolerance)
    marked = df.select(group, v.isNull().alias("m"), nan.alias("n"), inf.alias("i"), zero.alias("z"), off.alias("o"))
    count = lambda c: F.count_if(F.coalesce(F.col(c), F.lit(False)))
    out = marked.groupBy(group).agg(F.count("*").alias("rows"), count("m").alias("missing"), count("n").alias("nan"), count("i").alias("infinite"), count("z").alias("zero"), count("o").alias("off_norm"))
    return out.withColumn("ok", (F.col("rows") >= least) & (F.col("missing") + F.col("nan") + F.col("infinite") + F.col("zero") + F.col("off_norm") == 0))
