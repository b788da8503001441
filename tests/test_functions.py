import difflib
import random

import pytest
from pyspark.sql import functions as F

from quirewright.functions import geometry as G
from quirewright.functions import measures as M
from quirewright.functions import text as T


def values(spark, rows, schema, **columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()]).collect()]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_text(spark):
    rows = [("  a\t b c ",), (None,), ("",), ("Don't stop — 5 % ­x",), ("ﷺ\x01a",)]
    got = values(spark, rows, "t string", c=T.collapse("t"), g=T.garbage_ratio("t"), p=T.private_use_count("t"), w=F.size(T.words("t")))
    assert got[0] == ("a b c", 0.0, 0, 3) and got[1] == ("", 0.0, 0, 0) == got[2]
    assert got[4][1:3] == (0.5, 1)
    assert values(spark, rows, "t string", x=T.tokens(T.evaluation_text("t")))[3] == (["dont", "stop", "5", "x"],)
    assert values(spark, [("Straße don't",)], "t string", x=T.agreement_tokens("t")) == [(["strasse", "don", "t"],)]
    assert values(spark, [("paid −$ 1,200.50 (5 %) in 2020",)], "t string", x=T.critical_values("t"))[0][0][-1] == "2020"
    assert values(spark, [("é",), ("ascii",), (None,)], "t string", x=T.composed(F.col("t"))) == [("é",), ("ascii",), (None,)]


def test_html(spark):
    assert T.html_lines("<p>a  b</p><table><tr><td>1</td><td>2 &amp; 3</td></tr></table>") == "a b\n1 2 & 3"
    assert T.html_lines(None) == "" == T.html_lines("  ")
    cell = lambda t, h=False, r=1, c=1: {"text": t, "is_header": h, "rowspan": r, "colspan": c}
    assert T.table_rows("<table><tr><th colspan=2>H</th></tr><tr><td>a<table><tr><td>x</td></tr></table></td><td rowspan='0'>b<br>c</td></tr></table>") == [[cell("H", True, 1, 2)], [cell("ax"), cell("b\nc")]]  # the inner table is no table of its own, its text stays
    assert T.table_rows("<p>no</p>") is None and T.table_rows("<table><tr><td>open") is None
    assert T.table_rows("<table><td>no row</td><tr><td>a<td>b</td></tr><tr><td>lost</table>") == [[cell("b")]]
    texts = ["<p>a  b</p><table><tr><td>1</td><td>2 &amp; 3</td></tr></table>", "a<br/>b <i>c</i><!-- d\ne -->", "&amp;lt;p&amp;gt; &mdash;", "1 < 2 > 1", "<style>.a{}</style>x\u00a0 y", "", None]
    for any_space in (False, True):
        assert [x for x, in values(spark, [(t,) for t in texts], "t string", x=T.html_text("t", any_space))] == [T.html_lines(t, any_space) for t in texts]
    assert values(spark, [("<b>a</b><br>c&amp;d",)], "t string", x=T.stripped_html("t")) == [("a c&d",)]
    assert values(spark, [("a\n---\nb\n\n***\n",)], "t string", x=T.paginated_markdown("t"))[0][0] == ["a", "b\n"]


def test_labels_and_lines(spark):
    got = values(spark, [("Section-Header",), ("Text",), ("odd Thing",), (None,), (" ",)], "t string", x=T.canonical_label("t"))
    assert got == [("section_heading",), ("paragraph",), ("oddthing",), (None,), (None,)]
    lines = [("12",), ("100 GENERAL WORKS",), ("100.2 Scope",), ("Figure 3. x",), ("NOTE: x",), ("a) x",), ("plain",)]
    assert [x for x, in values(spark, lines, "t string", x=T.line_kind("t"))] == ["page_number", "section_heading", "section_heading", "caption", "table_like", "table_like", "text"]


def test_distances(spark):
    r = random.Random(1)
    words = ["a", "b", "cc", "ß", "d"]
    rows = [([r.choice(words) for _ in range(r.randrange(9))], [r.choice(words) for _ in range(r.randrange(9))]) for _ in range(60)] + [([], []), (["a"], [])]
    got = values(spark, rows, "a array<string>, b array<string>", d=M.token_distance(F.col("a"), F.col("b")), j=M.token_jaccard(F.col("a"), F.col("b")))
    from collections import Counter

    for (a, b), (d, j) in zip(rows, got):
        assert d == distance(a, b)
        want = (Counter(a) & Counter(b)).total() / (Counter(a) | Counter(b)).total() if a and b else 0.0
        assert j == pytest.approx(want)
    rate = values(spark, [(0, 0, 0), (3, 0, 3), (2, 4, 5)], "d int, r int, h int", x=M.error_rate(F.col("d"), F.col("r"), F.col("h")))
    assert rate == [(0.0,), (1.0,), (0.5,)]
    win = values(spark, [(1.0, 2.0), (2.0, 2.0), (None, 1.0), (float("nan"), 1.0)], "a double, b double", x=M.winner(F.col("a"), F.col("b"), "l", "r", True))
    assert win == [("l",), ("tie",), ("unavailable",), ("unavailable",)]


def test_geometry(spark):
    rows = [([0.0, 0.0, 10.0, 10.0], [5.0, 5.0, 15.0, 15.0]), ([0.0, 0.0, 0.0, 5.0], [0.0, 0.0, 1.0, 1.0]), ([1.0], [0.0, 0.0, 1.0, 1.0])]
    got = values(spark, rows, "a array<double>, b array<double>", i=G.iou(G.coerced(F.col("a")), F.col("b")), w=G.word_in_region(G.coerced(F.col("a")), F.col("b")))
    assert got[0] == (pytest.approx(25 / 175), pytest.approx(2.25)) and got[1][0] is None and got[2] == (None, None)
    raster = "raster struct<raster_width:int,raster_height:int,pdf_bbox:array<double>>, b array<double>, m array<double>"
    moved = values(spark, [((200, 100, [0.0, 0.0, 100.0, 50.0]), [20.0, 20.0, 40.0, 60.0], [0.0, 1.0, -1.0, 0.0, 50.0, 0.0]), ((0, 1, None), [1.0, 1.0, 2.0, 2.0], None)], raster, a=G.box_to_points(F.col("b"), F.col("raster")), r=G.box_to_points(F.col("b"), F.col("raster"), matrix=F.col("m")))
    assert moved == [([10.0, 10.0, 20.0, 30.0], [20.0, 10.0, 40.0, 20.0]), (None, None)]
    upright = values(spark, [((100, 200, [0.0, 0.0, 200.0, 100.0]), [60.0, 20.0, 80.0, 40.0], t) for t in (90, 270, 0, None)], raster.replace("m array<double>", "m int"), a=G.box_to_points(F.col("b"), F.col("raster"), F.col("m")), p=G.polygon_to_points(F.array(F.array(F.lit(60.0), F.lit(20.0)), F.array(F.lit(80.0), F.lit(20.0))), F.col("raster"), F.col("m")))
    assert upright[0] == ([20.0, 20.0, 40.0, 40.0], [[20.0, 40.0], [20.0, 20.0]]) and upright[1][0] == [160.0, 60.0, 180.0, 80.0] and upright[2][0] == [120.0, 10.0, 160.0, 20.0] == upright[3][0]
    items = values(spark, [([("w", [60.0, 20.0, 80.0, 40.0])], (100, 200, [0.0, 0.0, 200.0, 100.0]), 90)], "i array<struct<text:string,bbox:array<double>>>, raster struct<raster_width:int,raster_height:int,pdf_bbox:array<double>>, r int", x=G.items_to_points(F.col("i"), F.col("raster"), F.col("r")))[0][0][0]
    assert items.bbox == [20.0, 20.0, 40.0, 40.0] and items.source_bbox == [60.0, 20.0, 80.0, 40.0] and items.coordinate_space == "pdf_points"
    assert values(spark, [([[0.0, 0.0, 1.0, 1.0], [2.0, -1.0, 3.0, 0.5], [9.0]],), ([],)], "b array<array<double>>", x=G.envelope(F.col("b"))) == [([0.0, -1.0, 3.0, 1.0],), (None,)]
    frame = "struct<coordinate_space:string,frame:string,page_bbox:array<double>,bbox:array<double>>"
    box = ("pdf_points", "f", [0.0, 0.0, 9.0, 9.0], [1.0, 1.0, 2.0, 2.0])
    others = [box, ("pdf_points", "f", [0.0, 0.0, 9.005, 9.0], box[3]), (None, "f", *box[2:]), ("pdf_points", None, *box[2:]), ("pdf_points", "g", *box[2:]), ("pdf_points", "f", [0.0, 0.0, 8.0, 9.0], box[3]), ("pdf_points", "f", box[2], None), None]
    status = [x for x, in values(spark, [(box, o) for o in others], f"l {frame}, r {frame}", x=G.geometry_status(F.col("l"), F.col("r")))]
    assert status == ["compatible_normalized_pdf_points"] * 2 + ["non_normalized_coordinate_space", "missing_coordinate_frame", "different_coordinate_frames", "different_or_missing_page_bbox", "missing_block_bbox", "missing_geometry_metadata"]
    assert values(spark, [(None, [1.0, 2.0, 3.0, 4.0, 5.0])], "a array<double>, b array<double>", x=G.first_box(F.col("a"), F.col("b"))) == [([1.0, 2.0, 3.0, 4.0],)]
    inside = values(spark, [([0.0, 0.0, 5.0, 5.0],), ([0.0, 0.0, 50.0, 5.0],), ([3.0, 0.0, 1.0, 5.0],), (None,), ([float("nan"), 0.0, 1.0, 1.0],)], "b array<double>", x=G.inside_page(F.col("b"), F.array(*map(F.lit, (0.0, 0.0, 10.0, 10.0)))))
    assert [x for x, in inside] == [True, False, False, False, False]
    assert values(spark, [([[1.0, 2.0], [3.0, 0.0]],), ([],)], "p array<array<double>>", x=G.from_polygon(F.col("p"))) == [([1.0, 0.0, 3.0, 2.0],), (None,)]


def test_agreement(spark):
    from quirewright.operators.hybrid import agreement

    rows = [("a b c 5 %", "a c b 5 %"), ("", ""), ("x 10", "x 11"), (None, "x")]
    got = agreement(spark.createDataFrame(rows, "l string, r string"), "l", "r").collect()
    assert got[0].f1 == 1.0 and got[0].critical_values_match and got[0].sequence_ratio == pytest.approx(difflib.SequenceMatcher(None, "a b c 5".split(), "a c b 5".split(), autojunk=False).ratio())
    assert got[1].f1 == 0.0 and got[1].sequence_ratio == 1.0 and not got[2].critical_values_match and got[3].recall == 0.0
