import random

import tiktoken

from quirewright.llm.encoding import Encoder, encode_texts

ALPHABETS = ["ab", "ab c\n", "  \n\t", "éßक ि।", "the quick", "0123 ", "'s 'll", "-=_ ", "漢字 한글"]


def test_pieces_join_to_the_tokenizers_own_ids():
    e, r = Encoder(), random.Random(3)
    for _ in range(120):
        text = "".join(r.choice(r.choice(ALPHABETS)) for _ in range(r.randrange(1, 4000)))
        want = e.bpe.encode_ordinary(text)
        assert e.ids(text).tolist() == want
        step = r.choice([7, 50, 400])
        assert e.join_all([e.piece(text[a : a + step]) for a in range(0, len(text), step)]) == want


def test_unsplit_runs():
    e, r = Encoder(), random.Random(4)
    for text in ("x" * 30_000, "".join(r.choice("abcdefgh") for _ in range(30_000)), " " * 20_000 + "a", "=" * 9_001, "ी" * 5_000):
        want = e.bpe.encode_ordinary(text)
        assert e.ids(text).tolist() == want
        assert e.join_all([e.piece(text[a : a + 1000]) for a in range(0, len(text), 1000)]) == want


def test_whole_tables(spark):
    r = random.Random(5)
    rows = [(1, None, "k"), (2, "", "k"), (3, "hello world", "k"), (3, "hello world", "k"), (None, "<|endoftext|>", "k")]
    rows += [(10 + k, "".join(r.choice(r.choice(ALPHABETS)) for _ in range(n)), "k") for k, n in enumerate((999, 1001, 2500, 20_000))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, key string")
    e = Encoder()
    want = sorted((k or -1, e.bpe.encode_ordinary(t or "")) for k, t, _ in rows)
    assert sorted((x.doc_id or -1, x.ids) for x in encode_texts(df, piece_chars=500).collect()) == want
    assert sorted((x.doc_id or -1, x.tokens) for x in encode_texts(df, piece_chars=500, counts_only=True).collect()) == [(k, len(i)) for k, i in want]
    assert encode_texts(df.limit(0)).count() == 0
    assert isinstance(e.bpe, tiktoken.Encoding)
