import numpy as np

import quirewright.llm.markup as markup
from quirewright.llm.markup import FAMILIES, Labeller, Leaves, clean_text, label_documents, labelled_blocks, trained
from quirewright.llm.markup_samples import sample_document

CASES = [
    ("<p>Some text.</p>", ["html"]), ("&lt;p&gt;Some text.&lt;/p&gt;", ["html"]), ("A < B and C > D; R&D x.", []), ("It cost $14 to $54 per sheet.", []), ("See a_b_v3.pdf in C:\\temp\\new\\2.", []),
    ("# A Title\n\nSome text.", ["markdown"]), ("A Title\n=======\nSome text here.", ["markdown"]), ("The '''word''' is ''old''.", ["wiki"]), ("== A Title ==\nText.", ["wiki"]), ("* [[x]]: text\n* more", ["wiki"]),
    ("Let $\\frac{a}{b}$ be given.", ["latex"]), ("$$a^{2} \\cdot 5 = 4$$", ["latex"]), ('<math display="block">\\sqrt{d_3}</math>', ["html", "latex"]), ("<p>A **word** was.</p>", ["html", "markdown"]), ("| a | b |\n|---|---|\n| c | d |", ["markdown"]),
]


def test_cases():
    assert label_documents(trained(), [[c] for c, _ in CASES]) == [[want] for _, want in CASES]


def test_gradients_are_those_of_the_loss():
    net, r = Labeller(1), np.random.default_rng(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = r.normal(size=(2, 5, net.p["fx"].shape[0]))
    mask = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0]], float)
    owner = np.array([[0, 0, 1, 1, 1], [2, 2, 3, -1, -1]])
    y = r.integers(0, 2, (4, len(FAMILIES))).astype(float)
    _, g = net.gradients(x, mask, owner, y)
    for name in net.p:
        flat = net.p[name].ravel()
        for k in r.integers(0, flat.size, 4):
            old = flat[k]
            flat[k] = old + 1e-4
            up = net.gradients(x, mask, owner, y)[0]
            flat[k] = old - 1e-4
            down = net.gradients(x, mask, owner, y)[0]
            flat[k] = old
            assert abs((up - down) / 2e-4 - g[name].ravel()[k]) < 2e-3 * max(1, abs(g[name].ravel()[k])) + 2e-4, name


def held_out(net):
    """True families found, families found, true families, over documents whose families their maker knows."""
    r = np.random.default_rng(99)
    documents = [sample_document(r) for _ in range(150)]
    got = label_documents(net, [[t for t, _ in d] for d in documents])
    pairs = [(set(f), w) for d, g in zip(documents, got) for (_, w), f in zip(d, g)]
    return sum(len(f & w) for f, w in pairs), sum(len(f) for f, _ in pairs), sum(len(w) for _, w in pairs)


def test_held_out_accuracy():
    both, found, true = held_out(trained())
    assert both / true > 0.97 and both / found > 0.97


def test_the_network_decides():
    """Without what was learnt there is no result: random weights find something else, zero weights nothing."""
    both, found, true = held_out(Labeller(3))
    assert both < 0.7 * true or both < 0.7 * found
    still = Labeller(3)
    still.p = {k: np.zeros_like(v) - (1 if k == "c" else 0) for k, v in trained().p.items()}
    assert held_out(still)[1] == 0


def test_context_of_the_whole_document_in_any_stretches(monkeypatch):
    r = np.random.default_rng(5)
    blocks = [t for _ in range(40) for t, _ in sample_document(r)]
    whole = trained().logits([Leaves(blocks)])[0]
    monkeypatch.setattr(markup, "STRETCH", 7)
    assert np.allclose(whole, trained().logits([Leaves(blocks)])[0], atol=1e-3)
    side_by_side = trained().logits([Leaves(blocks[:3]), Leaves(blocks)])[1]
    assert np.allclose(whole, side_by_side, atol=1e-3)


def test_clean_text():
    t = clean_text
    assert t("<h2>Title</h2><p>A &amp; <b>b</b></p><ul><li>x</li><li>y</li></ul>", ["html"]) == "## Title\n\nA & b\n\n- x\n- y"
    assert t("<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>", ["html"]) == "A | B\n\n1 | 2"
    assert t("<style>x</style><pre><code>a\n  b</code></pre>", ["html"]) == "    a\n      b"
    assert t("&lt;p&gt;Text&lt;/p&gt;", ["html"]) == "Text"
    assert t("== T ==\n'''b''' [[X|y]]\n* i\n** j", ["wiki"]) == "## T\nb y\n- i\n  - j"
    assert t("\\section{T}\\textbf{a} $x^2$ 5\\% \\\"{o}", ["latex"]) == "## T\na $x^2$ 5% ö"
    assert t("T\n===\n**a** [b](c) `d_e`\n\n```\nx = 1\n```", ["markdown"]) == "# T\na b d_e\n\n    x = 1"
    assert t(None, []) is None and t("", []) == "" and t(" 2 < 3 ", []) == "2 < 3"


def test_whole_tables(spark):
    schema = "result_id bigint, html string, predictions array<struct<blocks:array<struct<label:string,html:string>>>>"
    rows = [
        (1, "x", [{"blocks": [{"label": "a", "html": "<p>x</p>"}, None, {"label": "a", "html": None}, {"label": "a", "html": ""}]}, None, {"blocks": None}, {"blocks": [{"label": None, "html": "'''a''' ''b''"}]}]),
        (2, "x", None), (3, "x", []), (None, "x", [{"blocks": [{"label": "a", "html": "word " * 30_000 + "\n**bold** text"}]}]),
    ]
    df = spark.createDataFrame([*rows, rows[0]], schema)
    got = [(r.result_id, r.prediction_no, r.block_no, r.families) for r in labelled_blocks(df).collect()]
    one = [(1, 1, 1, ["html"]), (1, 1, 3, []), (1, 1, 4, []), (1, 4, 1, ["wiki"])]
    assert sorted(x for x in got if x[0]) == sorted(one * 2) and [x for x in got if x[0] is None] == [(None, 1, 1, ["markdown"])]
    assert labelled_blocks(df.limit(0)).count() == 0


def test_all_named_character_references():
    blocks = ["The fa&ccedil;ade was opened.", "The angle &alpha; is small.", "AT&T; 3 & 4, R&D; Q&A;"]
    assert label_documents(trained(), [[b] for b in blocks]) == [[["html"]], [["html"]], [[]]]
