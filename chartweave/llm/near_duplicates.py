"""Near-duplicate records by anchor points.

Method: a record's fingerprint is a word of 5 min-hash symbols of 64 bits.  The anchors are the code words of the [5, 4]
parity code over these symbols, that is the words whose symbols xor to 0.  It is a covering code of radius 1: with the
syndrome (the xor of all symbols) added to any one symbol, a word becomes a code word, and these 5 are all within the
radius.  A fingerprint is replicated to every one of them.  Two fingerprints within the threshold of one differing symbol
share the code word that the other four symbols fix; as it lies within the radius of both, replication beyond the radius
would bring no further pair within the threshold together (over such an alphabet there'd be no end of code words, either).
Several independent fingerprints make the chance that a similar pair meets nowhere as small as wanted.  At an anchor, a
128-bit sketch of the symbols is compared, and the pairs that pass are checked exactly on their shingle sets.

Copies (equal shingle sets) form a class; only one representative of a class goes to the anchors, so a group of
copies of any size costs one record per anchor.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartweave.llm.words import Hasher, mix, shingles, words_of
from chartweave.session import cut_lineage

N, K = 5, 4


def groups_for(threshold: float, miss: float) -> int:
    """How many fingerprints it takes that a pair of this similarity meets nowhere with a chance of at most ``miss``."""
    meet = threshold**N + N * threshold**K * (1 - threshold)
    return max(1, math.ceil(math.log(miss) / math.log(1 - meet))) if threshold < 1 else 1


def sketch_limit(threshold: float, symbols: int, deviations: float = 4.2) -> int:
    """Bits of the sketch that may differ: two of each symbol, so a pair at the threshold differs in 1 - threshold bits a symbol on
    average; so many standard deviations more are let pass."""
    differ = 1 - threshold
    return math.floor(symbols * differ + deviations * math.sqrt(symbols * (1.5 * differ - differ * differ)))


class Anchors:
    """``groups`` fingerprints of 5 symbols each, and a sketch of two bits of each of 64 symbols or more."""

    def __init__(self, groups: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.groups, self.symbols = groups, max(64, groups * N)
        self.salts = rng.integers(1, 2**63, self.symbols, dtype=np.int64).astype(np.uint64) | np.uint64(1)
        self.names = mix(rng.integers(1, 2**63, groups, dtype=np.int64).astype(np.uint64))

    def of(self, sets: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchors (row per set) and the two halves of the sketches of sets that lie in a row, none of them empty."""
        mins = np.empty((self.symbols, len(starts)), np.uint64)
        for i, s in enumerate(self.salts):
            # the sets hold mixed hashes, so a multiply and a rotation of halves permute them well enough
            h = sets * s
            h ^= h >> np.uint64(32)
            h *= s
            mins[i] = np.minimum.reduceat(h, starts)
        mins = mix(mins)
        at = np.arange(64, dtype=np.uint64)[:, None]
        halves = [(((mins[:64] >> np.uint64(b)) & np.uint64(1)) << at).sum(0, dtype=np.uint64) for b in (63, 62)]
        out = np.empty((len(starts), self.groups * N), np.int64)
        for g in range(self.groups):
            word = mins[g * N : (g + 1) * N]
            syndrome = np.bitwise_xor.reduce(word, 0)
            # a code word is told by its first four symbols, the fifth being their xor
            for j in range(N):
                name = np.full(len(starts), self.names[g])
                for i in range(K):
                    name = mix(name ^ (word[i] ^ syndrome if i == j else word[i]))
                out[:, g * N + j] = name.view(np.int64)
        return out, *halves


def title_and_text(title: Column, text: Column) -> Column:
    """Title, a blank and text; null title: the text alone; null or blank text: null."""
    return F.when(F.trim(F.regexp_replace(text, r"[\s ]+", " ")) != "", F.coalesce(F.concat(title, F.lit(" "), text), text))


def _fingerprints(anchors: Anchors, words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                ids = part.column(0).to_pylist()
                split = [words_of(t) for t in part.column(1).to_pylist()]
                flat, ends = hasher.words(split)
                every = shingles(flat, words)
                sets, keep, a = [], [], 0
                for i, z in enumerate(ends):
                    if z - a >= words:
                        sets.append(np.unique(every[a : z - words + 1]))
                        keep.append(i)
                    a = z
                if not sets:
                    continue
                sizes = np.array([len(s) for s in sets])
                starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
                flat_sets = np.concatenate(sets)
                at, left, right = anchors.of(flat_sets, starts)
                h1 = np.add.reduceat(mix(flat_sets), starts)
                h2 = np.add.reduceat(mix(flat_sets ^ np.uint64(0x9E3779B97F4A7C15)), starts)
                n = at.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([ids[i] for i in keep], pa.int64()), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)),
                        pa.array(left.view(np.int64)), pa.array(right.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.arange(0, len(keep) * n + 1, n, dtype=np.int32)), pa.array(at.ravel())),
                    ],
                    names=["id", "h1", "h2", "left", "right", "anchors"],
                )

    return run


def _similar(words: int, threshold: float):
    def of(text: str) -> frozenset:
        w = words_of(text)
        return frozenset(zip(*(w[i:] for i in range(words))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, frozenset] = {}
        for pdf in batches:
            keep = []
            for a, b, x, y in zip(pdf.a, pdf.b, pdf.text_a, pdf.text_b):
                if len(seen) > 200:
                    seen.clear()
                s = seen.get(a) or seen.setdefault(a, of(x))
                t = seen.get(b) or seen.setdefault(b, of(y))
                n = len(s & t)
                keep.append(n >= threshold * (len(s) + len(t) - n) - 1e-9)
            yield pdf.loc[keep, ["a", "b"]]

    return run


def similar_classes(df: DataFrame, key: str, text: Column, words: int = 5, threshold: float = 0.8, miss: float = 3e-4) -> tuple[DataFrame, DataFrame]:
    """``(members, pairs)``: members is ``(id, rep)`` of every row whose text has at least ``words`` words, rep being the
    smallest id among the rows with the same shingle set; pairs is ``(a, b)``, a < b, of representatives whose Jaccard
    similarity is at least ``threshold``, each checked exactly.

    Null, blank and too short texts have no shingles, so they are like nothing.  ``key`` must be unique and whole-numbered.
    A pair at the threshold meets at no anchor with a chance of at most ``miss``, a more similar one with less; the number of
    fingerprints and the bits that the sketches of a pair may differ in follow from ``threshold``.
    """
    base = df.select(F.col(key).cast("long").alias("id"), text.alias("text")).where(F.col("text").isNotNull())
    anchors = Anchors(groups_for(threshold, miss))
    limit = sketch_limit(threshold, 64)
    prints = cut_lineage(base.mapInArrow(_fingerprints(anchors, words), "id long, h1 long, h2 long, left long, right long, anchors array<long>"))
    reps = prints.groupBy("h1", "h2").agg(F.min("id").alias("rep"))
    members = prints.select("id", "h1", "h2").join(reps, ["h1", "h2"]).select("id", "rep")
    at = (
        prints.join(reps.select(F.col("rep").alias("id")), "id", "left_semi")
        .select("id", "left", "right", F.explode("anchors").alias("anchor"))
    )
    x, y = at.alias("x"), at.alias("y")
    met = (
        x.join(y, (F.col("x.anchor") == F.col("y.anchor")) & (F.col("x.id") < F.col("y.id")))
        .where(F.bit_count(F.col("x.left").bitwiseXOR(F.col("y.left"))) + F.bit_count(F.col("x.right").bitwiseXOR(F.col("y.right"))) <= limit)
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        .distinct()
    )
    met = cut_lineage(met)
    wanted = met.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    texts = base.join(wanted, "id", "left_semi")
    paired = (
        met.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
        .join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    )
    return members, paired.mapInPandas(_similar(words, threshold), "a long, b long")


def similar_rows(df: DataFrame, key: str, text: Column, words: int, threshold: float, miss: float = 3e-4) -> DataFrame:
    """``(a, b)``, a < b, of all rows whose similarity is at least ``threshold``: the pairs of classes with every member."""
    members, pairs = similar_classes(df, key, text, words, threshold, miss)
    m = members.select(F.col("id"), F.col("rep"))
    within = m.alias("x").join(m.alias("y"), (F.col("x.rep") == F.col("y.rep")) & (F.col("x.id") < F.col("y.id"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    x, y = m.select(F.col("id").alias("ia"), F.col("rep").alias("a")), m.select(F.col("id").alias("ib"), F.col("rep").alias("b"))
    across = pairs.join(x, "a").join(y, "b").select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"))
    return within.unionByName(across)
