import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartweave.llm.near_duplicates import Anchors, groups_for, similar_classes, similar_rows, sketch_limit, title_and_text
from chartweave.llm.words import words_of


def shingle_set(title, text, n):
    if text is None or not text.strip():
        return frozenset()
    w = words_of(text if title is None else title + " " + text)
    return frozenset(zip(*(w[i:] for i in range(n))))


def brute(rows, n, t):
    sets = [(i, shingle_set(a, b, n)) for i, a, b in rows]
    out = set()
    for x, (i, s) in enumerate(sets):
        for j, u in sets[x + 1 :]:
            if s and u and len(s & u) >= t * len(s | u) - 1e-9:
                out.add((min(i, j), max(i, j)))
    return out


def corpus(seed, size):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(3000)]
    rows = [(k, r.choice([None, "a title", ""]), " ".join(r.choices(vocab, k=r.randint(30, 120)))) for k in range(size)]
    for k in range(size, 3 * size):
        i, title, text = rows[r.randrange(size)]
        w = text.split()
        for _ in range(r.randint(0, 5)):
            p = r.randrange(len(w))
            w[p : p + r.randint(0, 1)] = r.choice([[], ["new" + str(r.randint(0, 99))]])
        rows.append((k, title, " ".join(w)))
    return rows


def test_all_pairs_with_edge_cases(spark):
    rows = corpus(1, 150) + [(1000, None, None), (1001, "t", "  \n"), (1002, None, "one two"), (1003, None, "one two"), (1004, None, "one two three"), (1005, "x", "same same same"), (1006, "x", "same same same"), (1007, None, "日本 語 テキスト 1 2 3 " * 2000), (1008, None, "日本 語 テキスト 1 2 3 " * 2001)]
    df = spark.createDataFrame([(*x, 5, "clash") for x in rows], "row_id long, title string, text string, id int, anchors string").repartition(3)
    got = {tuple(r) for r in similar_rows(df, "row_id", title_and_text(F.col("title"), F.col("text")), 3, 0.7).collect()}
    assert got == brute(rows, 3, 0.7)


def test_a_third_of_all_rows_are_copies(spark):
    rows = corpus(2, 60) + [(10_000 + k, None, "a group of copies holds a third of all rows here " * 3) for k in range(90)]
    df = spark.createDataFrame(rows, "row_id long, title string, text string")
    members, pairs = similar_classes(df, "row_id", title_and_text(F.col("title"), F.col("text")), 5, 0.8)
    assert members.where("rep = 10000").count() == 90
    assert pairs.where("a >= 10000 or b >= 10000").count() == 0
    want = {p for p in brute(rows, 5, 0.8)}
    got = {tuple(r) for r in similar_rows(df, "row_id", title_and_text(F.col("title"), F.col("text")), 5, 0.8).collect()}
    assert got == want


@pytest.mark.parametrize(("threshold", "edits"), [(0.5, 12), (0.9, 2)])
def test_recall_at_other_thresholds(spark, threshold, edits):
    r = random.Random(5)
    vocab = [f"w{k}" for k in range(3000)]
    rows = [(k, None, " ".join(r.choices(vocab, k=r.randint(40, 120)))) for k in range(200)]
    for k in range(200, 600):
        w = rows[r.randrange(200)][2].split()
        for _ in range(r.randint(0, edits)):
            w[r.randrange(len(w))] = "new" + str(r.randint(0, 99))
        rows.append((k, None, " ".join(w)))
    df = spark.createDataFrame(rows, "row_id long, title string, text string")
    got = {tuple(x) for x in similar_rows(df, "row_id", F.col("text"), 3, threshold).collect()}
    want = brute(rows, 3, threshold)
    assert got <= want and len(got) >= 0.999 * len(want) and len(want) > 300


def test_anchors_are_code_words_within_the_radius():
    """By brute force over a small alphabet: the five words are all the code words within one symbol."""
    r = random.Random(1)
    for _ in range(20):
        word = [r.randrange(8) for _ in range(5)]
        near = {c for c in product(range(8), repeat=5) if c[0] ^ c[1] ^ c[2] ^ c[3] ^ c[4] == 0 and sum(x != y for x, y in zip(c, word)) <= 1}
        s = word[0] ^ word[1] ^ word[2] ^ word[3] ^ word[4]
        assert near == {tuple(x ^ s if i == j else x for i, x in enumerate(word)) for j in range(5)}


def test_fingerprints_one_symbol_apart_share_an_anchor():
    sets = np.random.default_rng(2).integers(1, 2**63, 400, dtype=np.int64).astype(np.uint64)
    a = Anchors(30)
    at, left, right = a.of(np.concatenate([sets, sets[:-4]]), np.array([0, 400]))
    met = [len(set(at[0, g * 5 : g * 5 + 5]) & set(at[1, g * 5 : g * 5 + 5])) for g in range(30)]
    assert set(met) <= {0, 1, 5} and sum(m > 0 for m in met) >= 28 and bin(int(left[0] ^ left[1])).count("1") + bin(int(right[0] ^ right[1])).count("1") < 12


def test_how_many_fingerprints():
    assert groups_for(0.7, 3e-4) == 11 and groups_for(1.0, 3e-4) == 1 and groups_for(0.5, 3e-4) > 30
    assert sketch_limit(0.7, 64) == 39 and sketch_limit(0.5, 64) > sketch_limit(0.9, 64)


def test_empty(spark):
    df = spark.createDataFrame([], "row_id long, title string, text string")
    assert similar_rows(df, "row_id", F.col("text"), 3, 0.7).collect() == []
