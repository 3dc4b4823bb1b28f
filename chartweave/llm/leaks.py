"""Held-out passages inside a training corpus.

Method: rare word n-grams of the passages are the seeds.  One scan of the corpus finds the documents that hold a seed
candidate, by a broadcast array of their hashes where these are few, else by a join of what a bitmap of bounded size lets
through; the number of documents with each candidate is counted over the whole corpus, and of every window of ``run``
words of a passage the rarest candidate becomes its seed.  The documents that hold a seed of an item are aligned with the
item by Smith-Waterman over words; the alignment's score finds and ranks paraphrased or edited copies, its longest
unbroken stretch decides an exact leak.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from chartweave.llm.words import Hasher, shingles, words_of
from chartweave.session import cut_lineage

#: Up to so many seed hashes go to the workers as they are (8 bytes each); more of them are joined, behind a bitmap of BITS bits.
FEW = 1_000_000
BITS = 1 << 27


def align(a: np.ndarray, b: np.ndarray, match: int = 2, mismatch: int = -1, gap: int = -2) -> tuple[int, int]:
    """Smith-Waterman over word hashes: the best local score, and the longest run of equal words on one diagonal.

    Row by row in numpy: the gap along a row is a running maximum of (score + gap penalty so far).
    """
    if not len(a) or not len(b):
        return 0, 0
    n = len(b)
    step = -gap * np.arange(n + 1)
    row, runs = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    best = longest = 0
    for x in a:
        equal = b == x
        new = np.zeros(n + 1, np.int64)
        new[1:] = np.maximum(0, np.maximum(row[:-1] + np.where(equal, match, mismatch), row[1:] + gap))
        new = np.maximum.accumulate(new + step) - step
        ahead = np.zeros(n + 1, np.int64)
        ahead[1:] = np.where(equal, runs[:-1] + 1, 0)
        row, runs = new, ahead
        best, longest = max(best, int(row.max())), max(longest, int(runs.max()))
    return best, longest


def _items(passages: DataFrame, key: str, text: str, seed: int, run: int) -> DataFrame:
    """``(item_id, at, seed)``: the seed candidates of every passage of at least ``run`` words, with their position."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            ids, at, seeds = [], [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                flat, _ = hasher.words([words_of(t or "")])
                if len(flat) >= run:
                    s = shingles(flat, seed)
                    ids += [i] * len(s)
                    at += range(len(s))
                    seeds.append(s)
            flat = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(at, pa.int32()), pa.array(flat.view(np.int64))], names=["item_id", "at", "seed"])

    return passages.select(F.col(key).cast("long"), text).mapInArrow(of, "item_id long, at int, seed long")


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """One truth value for each remainder of the seeds by BITS, gathered as a bitmap of BITS / 8 bytes."""
    at = (F.pmod("seed", F.lit(BITS)) + 1).alias("at")
    parts = seeds.select(at).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    out = np.zeros(-(-BITS // 32768) * 32768, bool)
    for r in parts.toLocalIterator():
        out[(r.bucket - 1) * 32768 : r.bucket * 32768] = np.unpackbits(np.frombuffer(r.bits, np.uint8), bitorder="little")[:32768]
    return out


def _hits(spark: SparkSession, docs: DataFrame, seeds: DataFrame, n: int) -> DataFrame:
    """``(doc_id, seed)``, each once per row, of every document that holds a seed: one scan, however many seeds there are."""
    distinct = seeds.select("seed").distinct()
    few = distinct.count() <= FEW
    if few:
        shared = spark.sparkContext.broadcast(np.sort(np.array([r.seed for r in distinct.toLocalIterator()], np.int64).view(np.uint64)))
    else:
        shared = spark.sparkContext.broadcast(np.packbits(_bitmap(distinct), bitorder="little"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), shared.value
        mask = np.zeros(1 << 20, bool)
        if few:  # a filter by the low bits spares most of the search
            mask[(table & np.uint64(len(mask) - 1)).astype(np.int64)] = True

        def may_be_seed(x: np.ndarray) -> np.ndarray:
            if few:
                return mask[(x & np.uint64(len(mask) - 1)).astype(np.int64)]
            at = (x & np.uint64(BITS - 1)).astype(np.int64)
            return (table[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0

        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                flat, ends = hasher.words([words_of(t) for t in part.column(1).to_pylist()])
                every = shingles(flat, n)
                maybe = np.flatnonzero(may_be_seed(every))
                if few and len(table):
                    k = np.minimum(np.searchsorted(table, every[maybe]), len(table) - 1)
                    maybe = maybe[table[k] == every[maybe]]
                doc = np.searchsorted(ends, maybe, "right")
                inside = maybe + n <= ends[doc] if len(maybe) else np.zeros(0, bool)
                pair = np.unique(np.stack([doc[inside].astype(np.int64), every[maybe[inside]].view(np.int64)], 1), axis=0)
                ids = part.column(0).take(pa.array(pair[:, 0]))
                yield pa.RecordBatch.from_arrays([ids, pa.array(pair[:, 1])], names=["doc_id", "seed"])

    found = docs.mapInArrow(scan, "doc_id long, seed long")
    return found if few else found.join(distinct, "seed", "left_semi")


def leaked_items(spark: SparkSession, docs: DataFrame, doc_key: str, doc_text: str, passages: DataFrame, item_key: str, item_text: str, run: int = 12, seed: int = 6, edited: int = 0, common: float = 0.02) -> DataFrame:
    """``(doc_id, item_id, score, longest)`` of every pair of a document and an item that share a rare seed: the alignment's
    score (2 for a word in common, -1 for another word, -2 for one left out or put in), and the most consecutive words of the
    passage that the document contains consecutively and in order.

    Every stretch of ``run`` words of a passage holds a seed, so no pair with ``longest >= run`` is missed.  With ``edited``
    every candidate in at most a share ``common`` of the documents is a seed, and a pair is one that shares so many of them:
    words changed in a copy leave most of its other seeds.  Null and blank
    texts and passages shorter than ``run`` words give no row; repeated documents each give theirs.
    """
    base = docs.select(F.col(doc_key).cast("long").alias("doc_id"), F.col(doc_text).alias("text")).where(F.col("text").isNotNull())
    seeds = cut_lineage(_items(passages.where(F.col(item_text).isNotNull()), item_key, item_text, seed, run))
    hits = cut_lineage(_hits(spark, base, seeds, seed))
    counts = hits.groupBy("seed").agg(F.count("*").alias("docs"))
    # the rarest candidate within each stretch of `run` words (ties: the first); passages are short, so are these windows
    ahead = W.partitionBy("item_id").orderBy("at").rowsBetween(W.currentRow, run - seed)
    counted = seeds.join(counts, "seed", "left")
    if edited:
        rare = counted.where(F.col("docs") <= max(1, common * base.count())).select("item_id", "seed").distinct()
        pairs = hits.distinct().join(rare, "seed").groupBy("doc_id", "item_id").agg(F.count("*").alias("n")).where(F.col("n") >= edited).select("doc_id", "item_id")
    else:
        rare = (
            counted.withColumn("best", F.min(F.struct(F.coalesce("docs", F.lit(0)).alias("docs"), "at", "seed")).over(ahead))
            .withColumn("last", F.max("at").over(W.partitionBy("item_id")))
            .where(F.col("at") <= F.col("last") - (run - seed))
            .select("item_id", F.col("best.seed").alias("seed"))
            .distinct()
        )
        pairs = hits.join(rare, "seed").select("doc_id", "item_id").distinct()
    pairs = cut_lineage(pairs)
    texts = base.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    items = passages.select(F.col(item_key).cast("long").alias("item_id"), F.col(item_text).alias("passage"))
    rows = pairs.join(texts, "doc_id").join(items, "item_id")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for pdf in batches:
            out = []
            for t, p in zip(pdf.text, pdf.passage):
                (a, b) = (hasher.words([words_of(x)])[0] for x in (p, t))
                # only the neighbourhood of words in common can take part in a local alignment
                common = np.flatnonzero(np.isin(b, a))
                lo, hi = (max(0, common[0] - len(a)), common[-1] + len(a) + 1) if len(common) else (0, 0)
                out.append(align(a, b[lo:hi]))
            yield pd.DataFrame({"doc_id": pdf.doc_id, "item_id": pdf.item_id, "score": [x for x, _ in out], "longest": [y for _, y in out]})

    return rows.mapInPandas(score, "doc_id long, item_id long, score int, longest int")
