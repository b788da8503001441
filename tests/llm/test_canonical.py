import random
import unicodedata

from quirewright.llm.canonical import canonical_texts, canonical_words

CASES = {
    "ｗｉｔｈ": "with", "Reсognіtion": "Recognition", "u\xadntil": "until", "muﬆ": "must", "insuﬃsante": "insuffisante", "été": "été",
    "siɡn": "sign", "Offіϲe": "Office", "की　जाँच": "की जाँच", "a﻿b⁣": "ab", "Straβe": "Straße", "７８８": "788", "Aрхив": "Архив",
    "क्‍या": "क्‍या", "χάρ‌της": "χάρτης", "x̄": "x̄", "ậ": "ậ", "ậ": "ậ", "βιβλίο": "βιβλίο", "α": "α",
    "Архив": "Архив", "m²": "m²", "½": "½", "№": "№", "™": "™", "“outer”": "“outer”", "Å": "Å", "ⁿ": "ⁿ", "한글": "한글", "Übersicht": "Übersicht",
    "क़": "क़", "क़": "क़", "ऩ": "ऩ", "​": "", "О​ffiсе": "Office",
}


def test_cases(spark):
    got = {r.word: r.plain for r in canonical_words(spark.createDataFrame([(k,) for k in CASES], "word string")).collect()}
    assert got == CASES


def test_composition_equals_nfc(spark):
    r = random.Random(6)
    words = {"".join(r.choice("aeioucsnzAE") + "".join(r.choice("̧̛̣́̀̈̂̄") for _ in range(r.randrange(4))) for _ in range(r.randrange(1, 5))) for _ in range(400)}
    got = canonical_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()
    assert len(got) == len(words) and all(x.plain == unicodedata.normalize("NFC", x.word) for x in got)


def test_texts(spark):
    long = "abc ｄ " * 40_000
    rows = [(1, None, "w"), (2, "", "w"), (3, "plain\ntext", "w"), (4, "ｔｈｅ end", "w"), (4, "ｔｈｅ end", "w"), (5, "a b ｃ.", "w"), (6, long, "w"), (7, "Том é ™", "w"), (8, "\U0001d400x 😀 ｙ", "w")]
    df = spark.createDataFrame(rows, "k int, text string, word string")
    got = sorted(canonical_texts(df).select("k", "canonical", "canonical_changed").collect())
    assert [tuple(x) for x in got] == [(1, None, False), (2, "", False), (3, "plain\ntext", False), (4, "the end", True), (4, "the end", True), (5, "a b c.", True), (6, "abc d " * 40_000, True), (7, "Том é ™", False), (8, "Ax 😀 y", True)]
    assert canonical_texts(df.limit(0)).count() == 0
