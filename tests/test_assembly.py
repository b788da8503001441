import json

import pytest
from pyspark.sql import functions as F

from quirewright.operators import assembly as Y


def test_layout_blocks(spark):
    block = "struct<label:string,raw_label:string,reading_order:int,html:string,bbox:array<double>,polygon:array<array<double>>,skipped:boolean,error:boolean>"
    b = lambda label, order, html, box=None, polygon=None, skipped=None, error=None: (label, None, order, html, box, polygon, skipped, error)
    rows = [(1, [([b("Text", None, "<p>last</p>line"), b("Title", 2, "x", [0.0, 0.0, 1.0, 1.0]), None, b("Picture", 1, None, None, [[1.0, 2.0], [3.0, 4.0]]), b("Text", 0, " "), b("Text", 0, "gone", skipped=True), b("Text", 3, None, error=True)],), None]), (2, None)]
    got = Y.layout_blocks(spark.createDataFrame(rows, f"k int, predictions array<struct<blocks:array<{block}>>>"), ["k"]).orderBy("rank").collect()
    assert [(r.rank, r.block_type, r.text, r.failed) for r in got] == [(1, "paragraph", "gone", False), (2, "picture", "", False), (3, "heading", "x", False), (4, "paragraph", "", True), (5, "paragraph", "last\nline", False)]
    assert [r.rank for r in got if r.skipped] == [1] and got[1].bbox == [1.0, 2.0, 3.0, 4.0]


def test_page_structure():
    line = lambda text, y, h=10.0: {"text": text, "bbox": [0.0, float(y), 100.0, y + h]}
    lines = [line("Repeated Title", 10), line("100 GENERAL", 120), line("first part", 140), line("goes on", 152), line("Table 3 x", 300), line("AB: 1", 400), line("CD: 2", 412), line("EF: 3", 424), line("no", 500), line("7", 950)]
    got = Y.page_structure(lines, 1000.0, {"repeated title"})
    assert [(b["block_type"], b["text"]) for b in got] == [("page_header", "Repeated Title"), ("section_heading", "100 GENERAL"), ("paragraph", "first part goes on"), ("table_caption", "Table 3 x"), ("table", "AB: 1\nCD: 2\nEF: 3"), ("page_footer", "7")]
    assert [b["reading_order"] for b in got] == list(range(6)) and Y.page_structure([], 1.0, set()) == []
    assert [x["text"] for x in Y.merged_headings([line("100", 5), line("GENERAL WORKS", 6), line("x", 20)])] == ["100 GENERAL WORKS", "x"]


def test_structured_pages(spark):
    words = [("d", p, 1000.0, t, [x, y, x + 9.0, y + 10.0]) for p in (1, 2) for t, x, y in (("Same", 0.0, 10.0), ("Head", 20.0, 10.5), (f"body{p}", 0.0, 300.0))] + [("d", 3, 1000.0, "x", None)]
    got = Y.structured_pages(spark.createDataFrame(words, "doc string, page int, page_height double, text string, bbox array<double>"), ["doc", "page"], "doc").collect()
    assert sorted((r.page, r.block_type, r.text) for r in got) == [(1, "page_header", "Same Head"), (1, "paragraph", "body1"), (2, "page_header", "Same Head"), (2, "paragraph", "body2")]


def test_drift_language_candidates(spark):
    jobs = spark.createDataFrame([(1, ("eng", 200)), (2, ("eng", 300)), (3, ("eng", 200)), (4, None), (5, (None, 200))], "id int, config struct<language:string,dpi:int>")
    assert [tuple(r) for r in Y.configuration_drift(jobs, "id", "config").select("id", "setting", "value", "usual").collect()] == [(2, "dpi", "300", "200")]
    assert Y.configuration_drift(jobs, "id", "config", {"dpi": 300}).count() == 3
    langs = spark.createDataFrame([("eng + HIN",), ("eng",), (None,)], "l string").select(Y.wants_hindi(F.col("l")).alias("h")).collect()
    assert [r.h for r in langs] == [True, False, None]
    assert Y.parsed_candidate("a:65:0.7:60") == ("a", 65.0, 0.7, 60.0)
    for bad in ("a:65", "a:165:0.7:60", ":1:0:1"):
        with pytest.raises(ValueError):
            Y.parsed_candidate(bad)


def test_gate_and_payloads(spark):
    e = "array<struct<start_x:double,line_count:int,top:double,bottom:double>>"
    rows = [([(1.0, 4, 0.0, 9.0)], [1], [(2, 2)]), ([], [], [(1, 9)]), (None, None, None)]
    got = spark.createDataFrame(rows, f"c {e}, t array<int>, n array<struct<row_count:int,column_count:int>>").select(Y.structure_gate(F.col("c"), F.col("t"), F.col("n")).alias("g")).select("g.*").collect()
    assert got[0].reasons == ["repeated_aligned_columns", "multiple_text_columns", "strict_native_table"] and not got[1].escalate and not got[2].escalate
    node = {"children": [{"html": "<p>a</p>"}, {"items": [{"markdown": "b"}, {"text_lines": [{"text": "c"}]}]}], "words": [{"text": "w", "bbox": [1, 2, 3, 4], "score": 0.5}, {"text": " "}]}
    assert Y.deep_text(node) == "a b c" and list(Y.deep_words(node)) == [("w", [1.0, 2.0, 3.0, 4.0], 0.5), (" ", None, None), ("c", None, None)]
    deep = {"text": "x"}
    for _ in range(5_000):
        deep = {"children": [deep]}
    assert Y.deep_text(deep) == "x" and Y.deep_text([1]) == "" == Y.deep_text({"text": None, "html": ""})
    texts = spark.createDataFrame([(json.dumps(node),), ("{",), (None,)], "j string").select(Y.payload_text("j").alias("t")).collect()
    assert [r.t for r in texts] == ["a b c", None, None]
    parts = Y.exported_pages(spark.createDataFrame([(1, 2, "b"), (1, 1, None), (1, 257, "c")], "d int, page int, text string"), ["d"], ["page", "text"]).orderBy("part_no").collect()
    assert [(p.part_no, json.loads(p.document)) for p in parts] == [(0, {"page_count": 2, "pages": [{"page": 1}, {"page": 2, "text": "b"}]}), (1, {"page_count": 1, "pages": [{"page": 257, "text": "c"}]})]


def test_records_and_settings(spark):
    rows = [(1, "tesseract", None, "t"), (2, "tesseract", "surya", None)]
    df = spark.createDataFrame(rows, "page int, classifier string, executed string, text string")
    got = df.select(Y.page_record(F.col("page"), F.lit("e"), F.lit("o"), F.col("classifier"), F.col("executed"), F.col("text")).alias("r")).select("r.*").orderBy("page").collect()
    assert [(r.route, r.classifier_route, r.text) for r in got] == [("tesseract", None, "t"), ("surya", "tesseract", "")]
    assert spark.range(1).select(Y.unknown_settings(F.lit('{"a": 1, "zz": 2}'), ["a", "b"]).alias("x")).first().x == ["zz"]


def test_line_kinds_agree_with_their_patterns(spark):
    from quirewright.functions import text as T

    lines = ["12", "100 GENERAL WORKS", "100.2 Scope", "Figure 3. x", "NOTE: x", "a) x", "plain", "1234 Not all"]
    kinds = [r.k for r in spark.createDataFrame([(x,) for x in lines], "t string").select(T.line_kind("t").alias("k")).collect()]
    by_pattern = [next((n for n, p in Y._KIND.items() if p.match(x)), "text") for x in lines]
    assert kinds == by_pattern
