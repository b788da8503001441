import random

import numpy as np

from quirewright.llm import truncation
from quirewright.llm.truncation import _fit, censoring_limits, source_limits, truncated_texts, truncation_by_source

NOUNS = ["ledger", "harbour", "archive", "station", "drawing", "committee", "estimate", "signature"]


def sentence(r):
    return f"The {r.choice(NOUNS)} of the {r.choice(NOUNS)} was found in the {r.choice(NOUNS)} and returned."


def test_censored_fit_recovers_the_density():
    x = np.round(np.exp(np.random.default_rng(1).normal(6, 0.5, 20_000)))
    n, c = np.unique(np.minimum(x, 500), return_counts=True)
    _, mu, sd = _fit(n, c.astype(float), 500)
    assert abs(mu - 6) < 0.03 and abs(sd - 0.5) < 0.03


def test_limits_are_found_and_smooth_lengths_have_none():
    x = np.round(np.exp(np.random.default_rng(2).normal(6, 0.5, 3000)))
    n, c = np.unique(x, return_counts=True)
    assert censoring_limits(n, c.astype(float)) == []
    n, c = np.unique(np.minimum(x, 640), return_counts=True)
    (a, z, p), *_ = censoring_limits(n, c.astype(float))
    assert a <= 640 <= z and p > 0.9


def test_endings_and_limits(spark):
    r = random.Random(4)
    rows, want = [], {}
    for k in range(900):
        t = " ".join(sentence(r) for _ in range(r.randrange(3, 20)))
        kind = k % 6
        if kind == 0 and len(t) > 500:
            t = t[:500]
        elif kind == 1:
            t = t[: r.randrange(60, len(t) - 5)] + r.choice(["", "…", " [...]", " (more)"])
        elif kind == 2:
            t += r.choice(["\n\nJ. Marlow\nHarbour Station", "\n\nMarwick, June 1931", "\n\nRef. B2-33/C", "\n\n- 12 ledger\n- 3 station", "\n\nscan --dpi 300 --out archive", "\n\nledger | Marwick | 12\nharbour | Marwick | 3"])
        body = t.rstrip("… )").removesuffix(" [...]").removesuffix(" (more").removesuffix(" [...").strip()
        want[k] = kind < 2 and not body.endswith(".")
        rows.append((k, t, "a" if kind else "b", "x"))
    rows += [(1000, None, "a", "x"), (1001, "", None, "x"), (1002, " \n", "a", "x"), (1003, "Harbour and Archive", "a", "x"), (1004, "x" * 300_000, "a", "x"), (0, *rows[0][1:])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string, word string")
    judged = truncated_texts(df)
    got = judged.toPandas()
    assert len(got) == len(rows)
    found = dict(zip(got.doc_id, got.cut))
    wrong = [k for k in want if bool(found[k]) != want[k]]
    assert len(wrong) <= 0.02 * len(want)
    assert not any(found[k] for k in (1000, 1001, 1002, 1003))
    shares = truncation_by_source(judged).toPandas()
    assert shares.texts.sum() == len(rows) and set(shares.source.fillna("")) == {"a", "b", ""}
    assert truncated_texts(df.limit(0)).count() == 0


def test_a_certain_pile_overrules_endings_of_whole_words(spark):
    r = random.Random(5)
    rows, cut = [], set()
    for k in range(1200):
        if k % 4 == 0:  # one line, cut at 40 behind whole words
            t = ("found in the " + " ".join(r.choice(NOUNS) for _ in range(9)))[:40]
            if not t.endswith(" ") and any(t.endswith(" " + w) for w in NOUNS):
                cut.add(k)
            rows.append((k, t, "cards"))
        elif k % 4 == 1:
            rows.append((k, "in the " + r.choice(NOUNS) + " " + "x" * r.randrange(1, 9) + " " + r.choice(NOUNS), "cards"))
        elif k % 4 == 2:  # cut behind an abbreviation that no list holds, in a pile of texts cut at 500
            t = " ".join(sentence(r) for _ in range(12))
            rows.append((k, t[:490] + " " * 2 + "xabbrvt." if k % 40 == 2 else t[:500], "letters"))
            if k % 40 == 2:
                cut.add(k)
        else:
            rows.append((k, " ".join(sentence(r) for _ in range(r.randrange(2, 6))) + f" It took xabbrvt. {r.choice(NOUNS)} and ended.", "letters"))
    judged = {x.doc_id: x for x in truncated_texts(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert len(cut) > 60 and sum(judged[k].cut for k in cut) > 0.95 * len(cut)
    assert {judged[k].ending.split(":")[0] for k in cut} >= {"single", "inner_stop"}
    assert not any(judged[k].cut for k, _, _ in rows if k % 4 in (1, 3))


def test_limits_of_long_texts_and_more_than_eight(spark):
    r = np.random.default_rng(6)
    n = np.minimum(np.round(np.exp(r.normal(11.4, 0.3, 600))), 100_000)
    rows = [("a", int(k), 3 * int(k)) for k in n]
    found = source_limits(spark.createDataFrame(rows, "source string, chars int, bytes int")).collect()
    for unit, limit in (("chars", 100_000), ("bytes", 300_000)):
        assert any(x.unit == unit and x.from_length <= limit <= x.to_length for x in found)
    smooth = np.round(np.exp(r.normal(7, 0.6, 4000)))
    limits = [300 + 170 * k for k in range(14)]
    n, c = np.unique(np.r_[smooth, np.repeat(limits, 60)], return_counts=True)
    found = censoring_limits(n, c.astype(float))
    assert all(any(a <= k <= z for a, z, _ in found) for k in limits)


def test_long_last_lines_and_paragraphs_are_read_whole(spark):
    r = random.Random(7)
    long = " ".join(r.choice(NOUNS) for _ in range(80))
    row = " | ".join(f"{r.choice(NOUNS)} {r.choice(NOUNS)}" for _ in range(40))
    assert len(long) > 500 and len(row) > 600
    whole = {1: f"A list of the archive:\n- {long}", 2: f"Remark: {long}", 3: f"scan --dpi 300 --names {long}", 4: f"{row}\n{row}"}
    cut = {11: f"{row}\n{row[: row.rindex(' | ', 0, 560)]}", 12: f"{long}\n\nIt was found. {' '.join([long] * 4)}\nHarbour Archive"}
    rows = [(k, t, "s") for k, t in (whole | cut).items()] + [(100 + k, sentence(r), "s") for k in range(60)]
    judged = {x.doc_id: x for x in truncated_texts(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
    assert {k for k in whole if judged[k].cut} == set() and {k for k in cut if not judged[k].cut} == set()


def test_a_pile_of_whole_titles_is_no_limit(spark):
    r = random.Random(8)
    rows = [(k, "जुनपुर का " + "क" * r.randrange(14, 17) + " हस्तलिखित", "s") for k in range(12)] + [(100 + k, " ".join(sentence(r) for _ in range(r.randrange(3, 20))), "s") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    judged = {x.doc_id: x for x in truncated_texts(df).collect()}
    assert any(judged[k].posterior for k in range(12)) and not any(judged[k].cut for k in range(12))


def cards(r):
    """One-line cards, half of them cut at 40: some behind a whole word, as uncut cards end too."""
    rows = []
    for k in range(800):
        t = "found in the " + " ".join(r.choice(NOUNS) for _ in range(9))
        rows.append((k, t[:40] if k % 2 else "in the " + r.choice(NOUNS) + " " + "x" * r.randrange(1, 9) + " " + r.choice(NOUNS), "cards"))
    return rows


def test_length_and_ending_both_decide(spark, monkeypatch):
    rows = cards(random.Random(9))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    judged = {x.doc_id: x for x in truncated_texts(df).collect()}
    at_limit = {k for k, t, _ in rows if k % 2 and any(t.endswith(" " + w) for w in NOUNS)}
    same_ending = {k for k, x in judged.items() if k % 2 == 0 and x.ending in {judged[j].ending for j in at_limit}}
    assert len(at_limit) > 20 and len(same_ending) > 200
    assert sum(judged[k].cut for k in at_limit) > 0.95 * len(at_limit) and not any(judged[k].cut for k in same_ending)
    # the same sums by jobs
    monkeypatch.setattr(truncation, "GROUPS_HERE", 0)
    assert {x.doc_id: x.cut for x in truncated_texts(df).collect()} == {k: x.cut for k, x in judged.items()}
    monkeypatch.undo()
    # without lengths what ends alike is judged alike
    monkeypatch.setattr(truncation, "censoring_limits", lambda length, count: [])
    blind = {x.doc_id: x.cut for x in truncated_texts(df).collect()}
    assert len({blind[k] for k in at_limit | same_ending}) == 1 and sum(blind[k] != x.cut for k, x in judged.items()) > 20
    monkeypatch.undo()
    # without what endings were found to say nothing tells cut texts from whole ones of their length
    monkeypatch.setattr(truncation, "_shares", lambda counts: np.ones((2, len(truncation.CELLS))))
    assert sum(x.cut != judged[x.doc_id].cut for x in truncated_texts(df).collect()) > 20
