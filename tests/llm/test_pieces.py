import re

from hypothesis import given, settings
from hypothesis import strategies as st

from chartweave.llm.pieces import cut, split_oversized


def brute(text, limit, least, overlap):
    kinds = [r"(?:\r?\n)(?:\r?\n)", r"\n", r"[.!?] ", r"[ \t]"]
    out, s = [], 0
    while len(text) - s > limit:
        e = 0
        for k in kinds:
            ends = [m.end() for i in range(len(text)) if (m := re.compile(k).match(text, i)) and s + least < m.end() <= s + limit]
            if ends:
                e = max(ends)
                break
        e = e or s + limit
        out.append((s, e))
        s = e - overlap
    return [*out, (s, len(text))]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab. \t\n\r!?é👩", max_size=400), st.integers(0, 10), st.integers(10, 20), st.integers(1, 30))
def test_like_brute_force(text, overlap, least, more):
    assert cut(text, least + more, least, overlap) == brute(text, least + more, least, overlap)


def test_pieces_of_given_sizes_stay_under_the_limit():
    import numpy as np

    text = "one two three " * 200
    sizes = np.concatenate([[0], np.cumsum([c == " " for c in text])])  # a unit ends with each blank
    got = cut(text, 50, 20, 5, sizes)
    assert got[0][0] == 0 and got[-1][1] == len(text)
    assert all(sizes[e] - sizes[s] <= 50 for s, e in got) and all(b[0] < a[1] for a, b in zip(got, got[1:]))


def test_table(spark):
    rows = [(1, "x" * 4500, 7), (2, None, 7), (3, "", 7), (4, "y" * 2000, 7), (5, "z" * 2001, 7), (5, "z" * 2001, 7)]
    df = spark.createDataFrame(rows, "row_id long, text string, char_start int")
    got = sorted(tuple(r) for r in split_oversized(df, "row_id", "text").collect())
    assert got == [(1, 0, 2000), (1, 1800, 3800), (1, 3600, 4500), (5, 0, 2000), (5, 0, 2000), (5, 1800, 2001), (5, 1800, 2001)]
    assert split_oversized(df.limit(0), "row_id", "text").collect() == []
