import hashlib

from chartweave.llm.encodings import CHAINS, Classifier, garble, garbled_texts, restore

CLEAN = [
    "Die Patientin klagt seit Tagen über Übelkeit; Größe unverändert, Füße mäßig durchblutet, täglich gegeben – „gut“.",
    "La señora explicó que mañana hará análisis; ¿presenta alergias? El riñón está bien, según el año anterior.",
    "L’échographie révèle une lésion, stable depuis l’été dernier; Âgée, fièvre à 37 °C, traitement arrêté.",
    "Avaliação: a lesão do pulmão mede pouco e a dor já não impede o sono; manhã sem queixas, reação nenhuma.",
    "Zmiana w płucu, ból głowy i nudności; ciśnienie, stężenie potasu, zalecono odstawić, następna kontrola.",
    "Назначен препарат, контроль анализа крови через неделю; пациент осмотрен, жалобы на слабость, динамики нет.",
    "次回の採血は来週に予定し、血圧は安定であった。患者は発熱で来院し、超音波検査では結節を認める。",
    "Target ≤ 9 µmol/L; measured 7.0 ± 14.0 – naïve, the family’s main worry is “headache”, 4.0 × 10⁹/L at 37 °C.",
]
MODEL = Classifier.train([f"{a} {b}" for a in CLEAN for b in CLEAN])


def test_every_chain_is_undone_whole_and_in_part():
    for text in CLEAN:
        for chain in CHAINS:
            made = garble(text, chain)
            if made is None or made == text:
                continue
            if CHAINS[chain][0] != "utf-8" and not any("а" <= c <= "я" for c in text):
                continue  # single bytes of a script that nobody misreads this way
            assert restore(made, MODEL) == text, (chain, text)
            assert restore(text + " plain words between. " + made, MODEL) == text + " plain words between. " + text, (chain, text)


def test_clean_texts_stay():
    for text in [*CLEAN, "⚠️ 👩‍⚕️ «Élan» → ½ ₂", "", "ASCII only", "L’état d’été – «É»"]:
        assert restore(text, MODEL) is None, text


def test_table(spark):
    garbled = [(k, garble(t, "utf8_cp1252"), 1) for k, t in enumerate(CLEAN)]
    rows = [(100 + k, f"{a} {b}", 1) for k, (a, b) in enumerate((a, b) for a in CLEAN for b in CLEAN)]
    extra = [(900, None, 1), (901, "", 1), (902, "plain", 1), (903, "fi�vre", 1), (904, garble(CLEAN[0], "utf8_latin1") * 300, 1), (0, garbled[0][1], 1)]
    df = spark.createDataFrame(garbled + rows + extra, "doc_id long, text string, restored_md5 int")
    got = sorted((r.doc_id, r.restored_md5) for r in garbled_texts(spark, df, "doc_id", "text").collect())
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    assert got == sorted([*((k, md5(t)) for k, t in enumerate(CLEAN)), (0, md5(CLEAN[0])), (903, "lost"), (904, md5(CLEAN[0] * 300))])
    assert garbled_texts(spark, df.limit(0), "doc_id", "text").collect() == []


def test_short_stretches_and_deep_garbling():
    russian = CLEAN[5]
    for chain in ("cp1251_latin1", "koi8_cp1251", "koi8_cp1252", "utf8_cp1251"):
        for word in ("через", "крови", "на"):
            made = f"{russian} Lab value 5.1 " + garble(word, chain) + " and plain words."
            want = made.replace(garble(word, chain), word)
            got = restore(made, MODEL)
            assert got == want or len(word) == 2 and got is None, (chain, word, got)
    deep = CLEAN[0]
    for _ in range(6):
        deep = garble(deep, "utf8_cp1252")
    assert restore(deep, MODEL) == CLEAN[0]


def test_neighbouring_code_pages_are_told_apart():
    polish = "Ciśnienie stężenie odstawić płucu nudności zgłasza"
    for chain in ("utf8_cp437", "utf8_cp850", "utf8_cp1250"):
        assert restore(garble(polish, chain), MODEL) == polish, chain


def test_a_stretch_beside_wide_characters():
    text = CLEAN[6] + garble("血圧は安定", "utf8_cp1252")
    assert restore(text, MODEL) == CLEAN[6] + "血圧は安定"


def test_counts_are_summed_where_the_records_lie(spark):
    import numpy as np

    from chartweave.llm.encodings import bigram_counts, training_counts

    df = spark.createDataFrame([(k, t * 40) for k, t in enumerate(CLEAN)] + [(50, "ascii"), (51, None), (52, garble(CLEAN[0], "utf8_latin1"))], "k long, t string").repartition(3)
    assert np.allclose(training_counts(df, "k", "t", 600), bigram_counts([t * 40 for t in CLEAN]))
    assert training_counts(df.limit(0), "k", "t", 600).sum() == 0
    many = df.select("t").crossJoin(spark.range(400)).selectExpr("id * 11 + hash(t) % 7 as k", "t").where("t is not null")
    assert 0 < training_counts(many, "k", "t", 20).sum() < 0.2 * training_counts(many, "k", "t", 10**6).sum()
