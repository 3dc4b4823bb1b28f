import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from chartweave.llm import leaks
from chartweave.llm.leaks import align, leaked_items
from chartweave.llm.words import words_of


def longest_run(a, b):
    best = 0
    for i in range(len(a)):
        for j in range(len(b)):
            k = 0
            while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k]:
                k += 1
            best = max(best, k)
    return best


def plain_score(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1][j] - 2, h[i][j - 1] - 2)
    return max(map(max, h))


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=25), st.lists(st.integers(0, 4), max_size=40))
def test_alignment_like_the_textbook(a, b):
    assert align(np.array(a, np.uint64), np.array(b, np.uint64)) == (plain_score(a, b), longest_run(a, b))


def test_like_brute_force(spark, monkeypatch):
    r = random.Random(3)
    vocab = [f"v{k}" for k in range(60)]
    items = [(k, " ".join(r.choices(vocab, k=40)), "x") for k in range(30)] + [(100, None, "x"), (101, "", "x"), (102, "too short a passage", "x"), (103, "same " * 40, "x")]
    docs = []
    for k in range(300):
        w = r.choices(vocab, k=80)
        if k % 3 == 0:
            p = items[r.randrange(30)][1].split()
            n, at = r.choice([8, 11, 12, 13, 30]), r.randrange(10)
            w[20:20] = p[at : at + n]
        docs.append((k, (" ".join(w)).upper() if k % 2 else ", ".join(w), "clash"))
    docs += [(900, None, ""), (901, "", ""), (902, "same " * 11, ""), (903, "same " * 12, ""), (904, ("same " * 12 + "other ") * 2000, ""), (903, "same " * 12, "")]
    want = set()
    for i, t, _ in docs:
        for j, p, _ in items:
            if t and p and len(words_of(p)) >= 12:
                grams = {tuple(words_of(p)[x : x + 12]) for x in range(len(words_of(p)) - 11)}
                d = words_of(t)
                if any(tuple(d[x : x + 12]) in grams for x in range(len(d) - 11)):
                    want.add((i, j))
    df, pf = spark.createDataFrame(docs, "doc_id long, text string, seed string"), spark.createDataFrame(items, "item_id long, passage string, at string")
    for few in (10**6, 100):  # an array of the seeds, and a join behind a bitmap
        monkeypatch.setattr(leaks, "FEW", few)
        monkeypatch.setattr(leaks, "BITS", 1 << 16)
        got = {(x.doc_id, x.item_id) for x in leaked_items(spark, df, "doc_id", "text", pf, "item_id", "passage").where("longest >= 12").collect()}
        assert got == want
    assert leaked_items(spark, df.limit(0), "doc_id", "text", pf, "item_id", "passage").collect() == []
    assert leaked_items(spark, df, "doc_id", "text", pf.limit(0), "item_id", "passage").collect() == []


def test_edited_copies_are_found_by_their_score(spark):
    """Planted copies with every seventh word changed, left out or doubled hold no run of 12 words, yet all align; strangers don't."""
    r = random.Random(8)
    vocab = [f"v{k}" for k in range(4000)]
    items = [(k, " ".join(r.choices(vocab, k=r.randint(40, 90)))) for k in range(40)]
    docs, planted = [], set()
    for k in range(400):
        w = r.choices(vocab, k=120)
        if k % 2:
            i, passage = items[r.randrange(40)]
            copy = []
            for n, x in enumerate(passage.split()):
                copy += {0: ["edited"], 1: [], 2: [x, x]}[r.randrange(3)] if n % 7 == 6 else [x]
            w[50:50] = copy
            planted.add((k, i))
        docs.append((k, " ".join(w)))
    df, pf = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, passage string")
    found = {(x.doc_id, x.item_id): x for x in leaked_items(spark, df, "doc_id", "text", pf, "item_id", "passage", run=8, seed=4, edited=6, common=1.0).where("score >= 40").collect()}
    assert set(found) == planted and max(x.longest for x in found.values()) < 12
    words = {i: p.split() for i, p in items}
    for (k, i), x in list(found.items())[:5]:
        assert x.score == plain_score(words[i], docs[k][1].split())
