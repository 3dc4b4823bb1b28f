import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from chartweave.llm.tokens import Encoder, decode, default_path, encode_corpus, offsets, tokenizer

pytestmark = pytest.mark.skipif(not os.path.exists(default_path()), reason="no vocabulary file")
ENC = Encoder(default_path()) if os.path.exists(default_path()) else None


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab1 \n\t\r'.,é日👩‍\xa0\x1c\x85"), st.characters(blacklist_categories=["Cs"])), max_size=60))
def test_like_the_library_and_back(text):
    ids, _ = ENC.encode([text])
    assert ids.tolist() == tokenizer(default_path()).encode(text, add_special_tokens=False).ids
    assert decode(ids.tolist(), default_path()) == text
    spans = offsets(text, ids.tolist(), default_path())
    assert all(a < z <= len(text) for a, z in spans)
    assert not text or (spans[0][0] == 0 and spans[-1][1] == len(text))


def test_part_of_a_character_decodes_to_the_mark_of_loss():
    ids = ENC.encode(["👩"])[0].tolist()
    assert len(ids) > 1 and decode(ids[:1], default_path()) == "�"


def test_table(spark):
    rows = [(1, "Hello world", 1), (2, None, 1), (3, "", 1), (4, " ", 1), (5, "<|endoftext|>", 1), (6, "word  " * 20_000, 1), (1, "Hello world", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted((r.doc_id, list(r.ids)) for r in encode_corpus(df, "doc_id", "text").collect())
    want = sorted((i, tokenizer(default_path()).encode(t, add_special_tokens=False).ids if t else []) for i, t, _ in rows)
    assert got == want and dict(got)[2] == [] == dict(got)[3] and 50256 not in dict(got)[5]
    assert encode_corpus(df.limit(0), "doc_id", "text").collect() == []


def test_runs_of_mixed_white_space_stay_whole():
    for space in "\xa0\u2002\u2003\u202f\u3000\t\n\r\x1c\x85":
        for run in (f" {space}", f"{space} ", f" {space} {space} ", f"{space} {space} {space}", f" {space} {space} {space} {space}"):
            for text in (f"a{run}b c", f"{run}a b", f"a b{run}"):
                assert ENC.encode([text])[0].tolist() == tokenizer(default_path()).encode(text, add_special_tokens=False).ids, repr(text)
