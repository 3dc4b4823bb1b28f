import re

import numpy as np
import pytest

from chartweave.llm import pii
from chartweave.llm.pii import LABELS, find_items, model_for, redact, redacted, viterbi
from chartweave.llm.pii_labels import COMMON_FAMILIES, GIVEN, labelled_rows


@pytest.fixture(scope="module")
def roster(spark):
    return spark.createDataFrame([(g, COMMON_FAMILIES[i % len(COMMON_FAMILIES)]) for i, g in enumerate(GIVEN)] + [(None, None)], "given_name string, family_name string")


def test_decoding_like_brute_force():
    from itertools import product

    rng = np.random.default_rng(0)
    emit, steps = rng.normal(size=(9, len(LABELS))).astype(np.float32), rng.normal(size=(len(LABELS),) * 2).astype(np.float32)
    got = viterbi(emit, np.array([0, 3, 5]), np.array([3, 5, 8]), steps)
    for a, z in ((0, 3), (3, 5), (5, 8)):
        score = lambda p: steps[0, p[0]] + steps[p[-1], 0] + sum(emit[a + i, x] for i, x in enumerate(p)) + sum(steps[x, y] for x, y in zip(p, p[1:]))  # noqa: E731, B023
        assert tuple(got[a:z]) == max(product(range(len(LABELS)), repeat=z - a), key=score)
    assert got[8] == 0


# Marked by hand, written apart from the labelled table and from any corpus.
MARKED = """
On arrival [name:Deborah Akinyemi] gave her number as [phone:(415) 902-7781] and her mother's as [phone:415-902-7790].
Referred by Dr. [name:Castellanos] for an opinion on a solid renal mass; the CT of 2023-04-11 (R23-40219) shows 34 x 29 mm.
The caretaker, [name:R. Okonkwo], can be written to at [email:okonkwo.r@hillcrest.example] or [address:88 Quarry Bank Road, Dunford, OH 44021].
MRN [id:00417723] was merged with a duplicate; social security no. [id:523-48-1190] matches.
Apgar score 9 at one minute, 10 at five; a Foley catheter stayed in until noon, lot 4471-203-B.
Mr. [name:Lindgren] declined the colonoscopy, his wife [name:Astrid Lindgren] was present.
Member no. [id:KPL4410-2231-7] is valid until December. Order 77120431 replaces order 77120398.
He grows roses and keeps pigeons; knee pain is worse since the move. Sodium 139, potassium 4.1.
Please fax to [name:Yolanda Pruitt], [phone:212.555.0188], before Friday.
Discharged to [address:P.O. Box 911, Larkton, TX 75001]; visiting nurse [name:Tamika Rowe] will come on 2024-02-02 at 10:30.
[name:HOLLOWAY, JUNE] SSN [id:604 22 9917] DOB 1950-03-02
Protocol NRG-12-04, arm A: paclitaxel 80 mg weekly was tolerated, neutrophils 1.9.
E-mail: [email:june (at) holloway.test], cell [phone:+44 20 7123 4567].
Hodgkin lymphoma stage II, Karnofsky index 90; Swan-Ganz line removed.
Ms. [name:Ferraro] lives at [address:Lindenweg 12, 40210 Altdorf] and works nights.
"""


def marked(line):
    text, spans = "", []
    for part in re.split(r"(\[\w+:[^\]]*\])", line):
        if m := re.fullmatch(r"\[(\w+):([^\]]*)\]", part):
            spans.append((len(text), len(text) + len(m[2]), m[1]))
            part = m[2]
        text += part
    return text, spans


def test_held_out_accuracy(spark, roster):
    table = [marked(line) for line in MARKED.strip().split("\n")]
    found = model_for(roster).find([t for t, _ in table])
    right = sum(len(set(s) & set(f)) for (_, s), f in zip(table, found))
    said, true = sum(map(len, found)), sum(len(s) for _, s in table)
    assert right >= 0.8 * true and right >= 0.8 * said, [(t[a:z], k) for (t, s), f in zip(table, found) for a, z, k in set(s) ^ set(f)]


def test_the_generator_is_learnt(spark, roster):
    table = labelled_rows(400, seed=987, given=GIVEN, family=COMMON_FAMILIES)
    found = model_for(roster).find([t for _, t, _ in table])
    right = sum(len(set(s) & set(f)) for (_, _, s), f in zip(table, found))
    assert right > 0.96 * sum(map(len, found)) and right > 0.96 * sum(len(s) for *_, s in table)


def test_spans_and_placeholders(spark, roster):
    text = "Dr. Odette Page, MD paged on (292) 555-0151 regarding sodium 3.6.\nPatient: WINTER, CALLA, SSN 666-20-6375, seen 2024-09-01 at 06:16. Copy of this letter to Hollis Field, page.h@valroche.invalid. Order 11682186 replaces order 7143974."
    df = spark.createDataFrame([(1, text, "Jun Field, RN", 1), (2, None, None, 1), (3, "", "  ", 1), (4, "plain " * 5000, "INFUSION DESK", 1), (1, text, "Jun Field, RN", 1)], "row_id long, text string, author string, kind int")
    got = {(r.row_id, r.field_name, r.kind, (text if r.field_name == "text" else "Jun Field, RN")[r.char_start : r.char_end]) for r in find_items(spark, df, "row_id", ["text", "author"], roster).collect()}
    assert got == {
        (1, "text", "name", "Odette Page"), (1, "text", "phone", "(292) 555-0151"), (1, "text", "name", "WINTER, CALLA"), (1, "text", "id", "666-20-6375"),
        (1, "text", "name", "Hollis Field"), (1, "text", "email", "page.h@valroche.invalid"), (1, "author", "name", "Jun Field"),
    }
    clean = {r.row_id: r for r in redacted(spark, df, "row_id", ["text", "author"], roster).collect()}
    assert clean[1].text.startswith("Dr. [NAME], MD paged on [PHONE] regarding sodium 3.6.") and clean[1].author == "[NAME], RN"
    assert clean[2].text is None and clean[4].text == "plain " * 5000
    assert find_items(spark, df.limit(0), "row_id", ["text", "author"], roster).collect() == []


def test_placeholders():
    assert redact("a b c", [(4, 5, "name"), (0, 1, "id")]) == "[ID] b [NAME]" and redact(None, []) is None


def test_the_checks_of_a_span():
    assert pii.checked("(030 555 0101).", 0, 15, "phone") == (1, 13, "phone") or pii.checked("(030 555 0101).", 0, 15, "phone")[2] == "phone"
    assert pii.checked("Dr. MD", 0, 6, "name") is None and pii.checked("12345", 0, 5, "id") is None


def test_forgetting_tokens_changes_nothing(roster):
    whole = model_for(roster)
    texts = [t for _, t, _ in labelled_rows(60, seed=31, given=GIVEN, family=COMMON_FAMILIES)]
    want, f = whole.find(texts), whole.features
    for most in (0, 50, 10_000):
        small = pii.Model(f, whole.weights, whole.tri, whole.steps, most)
        assert [s for k in range(0, 60, 7) for s in small.find(texts[k : k + 7])] == want


def test_decoding_is_that_of_whole_texts():
    rng, words = np.random.default_rng(3), ["ann", "lee", "saw", "ida", "ray"]
    known = {"w" + w: i for i, w in enumerate(words)}
    weights, steps = np.zeros((7, 5, len(LABELS)), np.float32), np.zeros((len(LABELS),) * 2, np.float32)
    b, i = LABELS.index("B-name"), LABELS.index("I-name")
    weights[3, :, 1:] = -9
    weights[3, 0, b] = weights[3, 1, i] = -4
    steps[b, i] = 10
    plain_tri = np.zeros((pii.TRI, len(LABELS)), np.float32)
    assert pii.Model(pii.Features(known, set(words), set(), set()), weights, plain_tri, steps).find(["saw ann lee"]) == [[(4, 11, "name")]]
    for k in range(20):
        weights, steps = rng.normal(0, 4, (7, 5, len(LABELS))).astype(np.float32), rng.normal(0, 2, steps.shape).astype(np.float32)
        weights[:, :, 0] += k / 4
        texts = [" ".join(rng.choice(words, 30)) for _ in range(10)]
        model = pii.Model(pii.Features(known, set(words), set(), set()), weights, plain_tri, steps)
        got = model.find(texts)
        model.before = model.behind = (np.full(len(LABELS), np.inf, np.float32),) * 2
        assert got == model.find(texts)


def test_every_name_of_a_long_roster_counts(spark, monkeypatch):
    monkeypatch.setattr(pii, "_trained", lambda given, family: (given, family))
    long = spark.createDataFrame([(f"G{i % 7}", f"Name{i:05}") for i in range(6000)] + [("Zoe", "Zysk"), ("Zoe", None), (None, "")], "given_name string, family_name string")
    given, family = model_for(long)
    assert given == tuple(f"G{i}" for i in range(7)) + ("Zoe",) and len(family) == 6001 and family[-1] == "Zysk"
