import random

from quirewright.llm import scan_noise as module
from quirewright.llm.scan_noise import Editor, Furniture, aligned_pairs, missing_from, repaired, repaired_texts, scan_noise, train_editor, train_linear

NOUNS = "ledger harbour archive station drawing committee estimate signature document telescope catalogue measurement".split()


def sentence(r):
    return f"The {r.choice(NOUNS)} of the {r.choice(NOUNS)} was returned with a multi-volume {r.choice(NOUNS)} and numbered again."


def test_editor_corrects_held_out_words():
    r = random.Random(1)
    swaps = [("t", "f"), ("r", "v"), ("e", "c"), ("l", "1"), ("m", "rn"), ("d", "cl")]
    train, held = NOUNS[:8], NOUNS[8:]

    def spoil(w):
        a, b = r.choice([s for s in swaps if s[0] in w])
        return w.replace(a, b, 1)

    pairs = [(spoil(w), w) for w in train for _ in range(30)] + [(w, w) for w in train for _ in range(30)]
    e = train_editor(pairs, [("led", "ger", "drop"), ("multi", "volume", "keep"), ("the", "archive", "apart")] * 5)
    for w in held:
        assert e.proposals(spoil(w)).get(w, (0, 0))[0] > 0, w
    for w in train:
        assert all(gain < 0 for gain, _ in e.proposals(w).values()), w  # right words win by keeping
    assert e.join("multi", "volume") == "keep" and e.join("led", "ger") == "drop"


def tables(spark, r):
    cal = "page_key bigint, document_id string, page int, reference_text string, tesseract_text string, text string"
    rows, want = [], set()
    for k in range(60):
        clean = " ".join(sentence(r) for _ in range(4))
        words = clean.split(" ")
        noise = set()
        if k % 3 == 0:
            i = next(i for i, w in enumerate(words) if "e" in w and len(w) > 5 and w.isalpha())
            words[i] = words[i][::-1].replace("e", "c", 1)[::-1]
            noise.add("misread")
        lines = [" ".join(words[i : i + 9]) for i in range(0, len(words), 9)]
        if k % 4 == 0:
            lines[0] = lines[0] + " tele-"
            lines[1] = "scope " + lines[1]
            whole = clean.split(" ")
            clean = " ".join([*whole[:9], "telescope", *whole[9:]])
            noise.add("hyphenation")
        doc, page = f"d{k // 10}", k % 10 + 1
        if k // 10 in (1, 3):  # headers without a number, on some pages of a document
            if k % 10 in ((2, 5) if k // 10 == 3 else range(1, 9)):
                lines = [["Station Drawings", "station drawings"][k % 2], *lines]
                noise.add("running_header")
        elif k // 10 % 2 == 0:
            lines = [["Harbour Report", "HARBOUR  REPORT"][k % 2] + f" | {page + 40}", "", *lines]
            noise |= {"running_header", "page_number"}
        rows.append((k, doc, page, clean, "\n".join(lines), "x"))
        want |= {("calibration_pages", k, n) for n in noise}
    rows += [(100, "z", 1, None, None, None), (101, "z", None, "", "", None), (102, None, 1, None, "  ", None), (103, "z", 2, None, "y" * 200_000, None)]
    pending = spark.createDataFrame([(1, "p", 1, None), (2, "p", 2, "1890-\n1998 were kept.\n\nii"), (2, "p", 2, "1890-\n1998 were kept.\n\nii")], "pending_id bigint, document_id string, page int, tesseract_text string")
    blocks = spark.createDataFrame([(1, "b", 1, "Harbour Report", 0, [1.0, 20.0, 30.0, 40.0], 792.0, None), (2, "b", 2, "harbour report", 0, None, 792.0, "paragraph"), (3, "b", 2, None, 1, None, None, None)], "block_key bigint, document_id string, page int, text string, reading_order int, bbox array<double>, page_height double, block_type string")
    want |= {("pending_surya_pages", 2, "page_number"), ("structure_blocks", 1, "running_header"), ("structure_blocks", 2, "running_header")}
    return (spark.createDataFrame(rows, cal), pending, blocks), want


def test_whole_tables(spark):
    t, want = tables(spark, random.Random(2))
    got = {tuple(x) for x in scan_noise(*t).select("table_name", "row_key", "noise").distinct().collect()}
    assert got == want
    fixed = {(x.table_name, x.row_key): x.text for x in repaired_texts(*t).collect()}
    clean = {r.page_key: r.reference_text for r in t[0].collect()}
    assert [(fixed["calibration_pages", k], clean[k]) for k in range(60) if fixed["calibration_pages", k] != clean[k]] == [] and fixed["calibration_pages", 100] is None
    assert scan_noise(*(x.limit(0) for x in t)).count() == 0


def test_the_weights_decide(spark):
    """Nothing is found without what was learnt; the lexicon and the place alone don't make a case."""
    t, want = tables(spark, random.Random(2))
    blank = scan_noise(*t, editor=Editor(), learnt=Furniture()).select("noise").distinct().collect()
    assert {x.noise for x in blank} <= {"hyphenation"}  # zero weights: any break is joined by the first operation
    sample = module.training_sample(t[0])
    editor = train_editor([p for own in aligned_pairs([(c, s) for _, c, s in sample])[0] for p in own], [])
    editor.words = {}
    still = Editor(editor.operations, {op: {f: 0.0 for f in w} for op, w in editor.weights.items()}, {})
    for e, some in ((editor, True), (still, False)):
        found = {x.row_key for x in scan_noise(*t, editor=e, learnt=Furniture()).filter("noise = 'misread'").select("row_key").collect()}
        assert bool(found & {k for n, k, x in want if x == "misread"}) == some
    r = random.Random(3)
    odd = Furniture(*({f: r.uniform(-1, 1) for f in w} for w in vars(learned(spark, t, sample)).values()))
    other = {tuple(x) for x in scan_noise(*t, editor=editor, learnt=odd).filter("noise IN ('running_header', 'page_number')").select("table_name", "row_key", "noise").distinct().collect()}
    assert len(other ^ {w for w in want if w[2] in ("running_header", "page_number")}) > 15


def learned(spark, t, sample):
    return module.learn_furniture(module.settled(module.edge_features(module.edge_signs(module.edge_lines(module._texts(*t).filter("length(text) > 0")))), "edges"), sample)


def test_missing_lines_and_linear_weights():
    clean = "The first words of the page stand here. And it ends with 12 words."
    assert missing_from(clean, [("Harbour Report", "top", 0), ("The first w0rds of the", "top", 1), ("12 words.", "bottom", 0), ("7", "bottom", 0), ("words.", "bottom", 1)]) == [True, False, False, True, False]
    w = train_linear([(["b", "x"], True), (["b", "y"], False)] * 20)
    assert w["x"] + w.get("b", 0) > 0 > w["y"] + w.get("b", 0)


def test_repaired():
    assert repaired("Head 3\n\na multi-\nvolume b\n\nc", [("running_header", "Head 3"), ("hyphenation", "multi\tvolume\tkeep")]) == "a multi-volume b\n\nc"
    assert repaired("kept 1890-\n1998 and\n1999", []) == "kept 1890-1998 and 1999"
    assert aligned_pairs([("one telescope", "one tele-\nscope")])[1] == [("tele", "scope", "drop")]
