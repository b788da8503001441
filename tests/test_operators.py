import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from quirewright.operators import evidence as E
from quirewright.operators import hybrid as H
from quirewright.operators import layout as L
from quirewright.operators import matching as X
from quirewright.operators import routing as R
from quirewright.sources import artifacts as A


def test_routing_at_the_thresholds(spark):
    text = " ".join(["word"] * 16)  # 79 characters
    rows = [(text + "s", 0, 0.0), (text, 0, 0.0), (text + "s", 1, 0.55), (text, 1, 0.1), (None, 0, 0.6), (None, None, None)]
    df = spark.createDataFrame(rows, "t string, n int, a double")
    got = [r.c for r in df.select(R.classify(R.text_signals("t"), F.col("n"), F.col("a")).alias("c")).collect()]
    assert got == ["DIGITAL", "OCR_NEEDED", "MIXED", "SCANNED", "SCANNED", "OCR_NEEDED"]
    with pytest.raises(ValueError):
        R.Gates(max_garbage=2.0)


def test_quality_reasons(spark):
    rows = [("some plain words stand here", [65.0, 65.0, 65.0, 59.9]), ("some plain words stand here", []), ("x", None), ("some plain words stand here", [90.0, None, 90.0])]
    got = spark.createDataFrame(rows, "t string, c array<double>").select(R.recognition_quality(R.text_signals("t"), F.col("c")).alias("q")).select("q.*").collect()
    assert got[0].rejection_reasons == ["low_mean_confidence"] and got[1].rejection_reasons == ["no_word_confidences", "low_confident_word_ratio"]
    assert got[2].rejection_reasons == ["too_few_characters", "too_few_words", "no_word_confidences", "low_confident_word_ratio"] and got[3].accepted


def test_assignment_against_all_matchings():
    r = random.Random(3)
    for _ in range(150):
        edges = [(a, b, r.random()) for a in range(4) for b in range(4) if r.random() < 0.5]
        best = (0, 0.0)
        for n in range(len(edges) + 1):
            for pick in itertools.combinations(edges, n) if n <= 4 else ():
                if len({e[0] for e in pick}) == len({e[1] for e in pick}) == n:
                    best = max(best, (n, sum(e[2] for e in pick)))
        got = [edges[k] for k in X.best_assignment(edges)]
        assert len({e[0] for e in got}) == len({e[1] for e in got}) == len(got)
        assert (len(got), pytest.approx(sum(e[2] for e in got))) == (best[0], best[1])


def test_order_scores(spark):
    m = spark.createDataFrame([("p", 1, 3), ("p", 2, 2), ("p", 3, 1), ("q", 1, 1)], "page string, ref int, hyp int")
    counts = spark.createDataFrame([("p", 3, 3), ("q", 4, 4), ("r", 2, 2)], "page string, refs int, hyps int")
    got = {r.page: r for r in X.order_scores(m, ["page"], counts).collect()}
    assert got["p"].inversion_rate == 1.0 and got["q"].status == "inconclusive" and got["r"].matched == 0


def test_latest_pending_and_pareto(spark):
    log = spark.createDataFrame([(1, 1, "complete", 1), (1, 1, "COMPLETE ", 2), (1, 1, "failed", 3), (1, 2, None, 4), (None, 3, "pending", 5)], "job int, page int, status string, seq int")
    assert [r.seq for r in E.latest_complete(log, ["job", "page"], ["seq"], ["seq", "status"]).collect()] == [2]
    assert [r.status for r in E.latest_complete(log.withColumn("job", F.lit(None).cast("int")), ["job", "page"], ["seq"], ["status"]).collect()] == ["COMPLETE "]
    done = log.filter("lower(trim(status)) = 'complete'")
    assert sorted(r.seq for r in E.pending(log, done, ["job", "page"]).collect()) == [4, 5]
    r = random.Random(2)
    rows = [(str(k), r.randrange(6), r.randrange(6)) for k in range(40)]
    got = {x.candidate: x.on_frontier for x in E.pareto_frontier(spark.createDataFrame(rows, "candidate string, false_accepts int, accepted int")).collect()}
    for n, f, a in rows:
        assert got[n] == (not any(g <= f and b >= a and (g < f or b > a) for _, g, b in rows))


def test_alignment_differences_issues(spark):
    a = spark.createDataFrame([(1, "x"), (2, None), (2, None)], "page int, v string")
    b = spark.createDataFrame([(1, "y"), (3, None)], "page int, v string")
    assert sorted(map(tuple, E.page_alignment(a, b, ["page"]).collect())) == [(2, "duplicate_left"), (2, "missing"), (3, "unexpected")]
    assert [tuple(r) for r in E.differing(a, b, ["page"], ["v"]).collect()] == [(1, "v", "x", "y")]
    assert sorted(r.page for r in E.issues(a, ["page"], {"no_v": F.col("v").isNotNull()}).collect()) == [2, 2]


def test_regions(spark):
    regions = spark.createDataFrame([(1, 1, [0.0, 0.0, 10.0, 10.0]), (1, 2, [0.0, 0.0, 10.0, 10.0]), (1, 3, [20.0, 0.0, 30.0, 10.0])], "page int, region int, bbox array<double>")
    words = spark.createDataFrame([(1, 1, [1.0, 1.0, 2.0, 2.0]), (1, 2, [21.0, 1.0, 22.0, 2.0]), (1, 3, [50.0, 1.0, 52.0, 2.0]), (1, 4, None)], "page int, word int, bbox array<double>")
    assert sorted((r.word, r.region) for r in H.owned_words(words, regions, ["page"]).collect()) == [(1, 1), (2, 3), (3, None), (4, None)]
    assert [(r.left_region, r.right_region, r.share) for r in H.overlapping_regions(regions, ["page"]).collect()] == [(1, 2, 1.0)]


def test_lines_rows_and_columns():
    w = lambda x, y, t="w": {"text": t, "bbox": [x, y, x + 8.0, y + 10.0], "line": y}
    words = [w(30, 0, "b"), w(10, 1, "a"), w(10, 20, "c"), w(30, 21.5, "d")]
    assert [x["text"] for x in L.visual_lines(words)] == ["a b", "c d"]
    assert [[x["text"] for x in r] for r in L.rows_of_words(words)] == [["a", "b"], ["c", "d"]]
    table = [w(x, y) for y in (0.0, 20.0, 40.0, 60.0, 80.0) for x in (10.0, 60.0)]
    found = L.aligned_columns(table, 100.0, 100.0)
    assert len(found) == 1 and found[0]["line_count"] == 5 and found[0]["start_x"] == 60.0
    assert L.aligned_columns([], 100.0, 100.0) == [] == L.rows_of_words([]) and L.visual_lines([]) == []
    flat = [{"text": t, "bbox": [x, 5.0, x + 1.0, 5.0]} for t, x in (("b", 2.0), ("a", 0.0))]  # without a height
    assert [x["text"] for x in L.visual_lines(flat)] == ["a b"]


def test_tsv_and_provider(spark):
    tsv = 'level\tpage\n5\t1\t1\t1\t1\t1\t10\t20\t30\t-4\t91.5\ta"b\tc\n5\t1\t1\t1\t1\t2\t0\t0\t1\t1\t-1\tx\n4\t1\n5\t1\t1\t1\t2\t1\t0\t0\t1\t1\t50\t \n5\t1\t1\t1\t2\t1\t0\t0\t1\t1\t50\ty'
    r = spark.createDataFrame([(tsv,)], "t string").select(A.tsv_words(F.col("t")).alias("w"), A.tsv_text(F.col("t")).alias("x")).first()
    assert [x.text for x in r.w] == ['a"b\tc', "x", "y"] and r.w[0].bbox == [10.0, 20.0, 40.0, 20.0] and r.w[1].confidence is None and r.x == 'a"b\tc x\ny'
    rows = [('{"result": {"children": [{"block_type": "Page", "page": 2, "children": [{"block_type": "Text", "html": "<p>a</p>"}, {"block_type": "Text", "text": " "}]}, {"block_type": "Other"}]}}',), ('{"markdown": "a\\n---\\nb"}',), ("broken",)]
    got = [x.p for x in spark.createDataFrame(rows, "r string").select(A.provider_pages(F.col("r")).alias("p")).collect()]
    assert got[0][0].page == 2 and [b.text for b in got[0][0].blocks] == ["<p>a</p>"] and [p.text for p in got[1]] == ["a", "b"] and not got[2]


def test_files_and_logs(spark, tmp_path):
    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "sub" / "a.PDF").write_bytes(b"x")
    (tmp_path / "in" / "b.txt").write_bytes(b"x")
    got = A.source_files(spark, str(tmp_path / "in")).collect()
    assert [(x.file_name, x.job, x.size_bytes) for x in got] == [("a.PDF", "sub/a", 1)]
    (tmp_path / "log.jsonl").write_text('{"page": 1}\n\n[1]\n{"page": 0}\nbroken\n')
    good, bad = A.log_lines(spark, str(tmp_path / "log.jsonl"))
    assert good.count() == 1 and sorted(x.code for x in bad.collect()) == ["bad_page", "not_an_object", "not_an_object"]


def test_stream(spark, tmp_path):
    from quirewright.streaming.manifest import first_deliveries, hourly_counts, latest, merged_latest, page_log

    t = lambda s: dt.datetime(2025, 1, 1) + dt.timedelta(seconds=s)
    schema = "message_id string, delivered_at timestamp, delivery_id bigint, job_id bigint, page int, status string"
    batches = [[("m1", t(0), 1, 1, 1, "complete"), ("M1 ", t(5), 2, 1, 1, "complete"), (None, t(6), 3, 1, 2, "failed")], [("m2", t(9), 4, 1, 1, "COMPLETE"), ("m1", t(9), 5, 1, 1, "complete")]]
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    log = page_log(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, files_per_trigger=1)
    merged_latest(log, str(tmp_path / "out"), str(tmp_path / "cp"), ["job_id", "page"], ["delivered_at", "delivery_id"]).awaitTermination()
    assert [(x.job_id, x.page, x.delivery_id) for x in latest(spark, str(tmp_path / "out")).collect()] == [(1, 1, 5)]
    from quirewright.streaming.manifest import vacuum

    assert vacuum(spark, str(tmp_path / "out")) == 1 and latest(spark, str(tmp_path / "out")).count() == 1
    q = first_deliveries(log).writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").filter("message_id IS NOT NULL").count() == 2
    assert hourly_counts(log).isStreaming


def test_text_columns(spark):
    words = [("p", b, line, [x + 40.0 * k, 20.0 * line, x + 40.0 * k + 30, 20.0 * line + 10], 1000.0, 400.0) for b, x in ((1, 0.0), (2, 500.0)) for line in range(6) for k in range(8)]
    schema = "page string, block int, line int, bbox array<double>, page_width double, page_height double"
    assert [(r.left_block, r.right_block) for r in L.text_columns(spark.createDataFrame(words, schema), ["page"]).collect()] == [(1, 2)]
    assert L.text_columns(spark.createDataFrame(words[:40], schema), ["page"]).count() == 0


def layout(spark, texts, words):
    """Regions one above the other with their texts, and (region, text, confidence) words inside them."""
    r = [("p", i, kind, t, [0.0, 100.0 * i, 100.0, 100.0 * i + 50], skipped, False) for i, (t, kind, skipped) in enumerate(texts)]
    w = [("p", k, t, None if region is None else [9.0 * k, 100.0 * region + 10, 9.0 * k + 5, 100.0 * region + 20], c, k) for k, (region, t, c) in enumerate(words)]
    return spark.createDataFrame(r, "page string, region int, block_type string, text string, bbox array<double>, skipped boolean, failed boolean"), spark.createDataFrame(w, "page string, word int, text string, bbox array<double>, confidence double, reading_order int")


def test_hybrid_is_all_or_nothing(spark):
    def decided(texts, words):
        d = H.hybrid_decisions(*layout(spark, texts, words), ["page"]).first()
        return d.applied, d.skip_reason

    good = [(0, "A", 90.0), (0, "B", 90.0), (1, "C", 90.0), (0, "low", 10.0)]
    texts = [("A B", "paragraph", False), ("C", "heading", False), ("", "picture", True)]
    assert decided(texts, good) == (True, None)
    assert decided([*texts, ("seen", "picture", False)], good) == (False, "non_tesseract_textual_surya_regions")
    assert decided([("", "paragraph", False)], good[:1]) == (False, "no_textual_surya_regions")
    assert decided(texts, good[:2]) == (False, "insufficient_per_region_agreement")
    assert decided(texts, [*good, (None, "extra", 90.0)]) == (False, "too_many_unassigned_tesseract_words")
    assert decided([("A C B", "paragraph", False)], [(0, "A", 90.0), (0, "B", 90.0), (0, "C", 90.0)])[1] == "insufficient_per_region_agreement"
    r, w = layout(spark, [("Balance -100", "paragraph", False)], [(0, "Balance", 90.0), (0, "100", 90.0)])
    assert H.hybrid_regions(r, w, ["page"]).first().reasons == ["critical_value_token_mismatch"]
    r, w = layout(spark, texts, good)
    got = {x.region: (x.text, x.text_engine) for x in H.hybrid_blocks(r, w, ["page"]).collect()}
    assert got == {0: ("A B", "tesseract5"), 1: ("C", "tesseract5"), 2: ("", "surya")}


def test_table_regions_are_read_row_by_row(spark):
    regions = spark.createDataFrame([("p", 1, "table", "A1 B1 A2 B2", [0.0, 0.0, 100.0, 100.0], False, False)], "page string, region int, block_type string, text string, bbox array<double>, skipped boolean, failed boolean")
    words = [("p", k, t, [x, y, x + 10, y + 10], 90.0, k) for k, (t, x, y) in enumerate([("A1", 0.0, 0.0), ("A2", 0.0, 20.0), ("B1", 50.0, 1.0), ("B2", 50.0, 21.0)])]
    w = spark.createDataFrame(words, "page string, word int, text string, bbox array<double>, confidence double, reading_order int")
    assert [(x.text, x.words, x.reasons) for x in H.hybrid_regions(regions, w, ["page"]).collect()] == [("A1 B1 A2 B2", 4, [])]
    assert H.hybrid_decisions(regions.limit(0), w, ["page"]).count() == 0


def test_evaluation_blocks_and_texts(spark):
    from quirewright.operators import scoring as S

    schema = "page int, pos int, label string, raw_label string, reading_order int, html string, text string, bbox array<double>, skipped boolean, error boolean"
    box = [0.0, 0.0, 1.0, 1.0]
    rows = [
        (1, 1, "Text", None, 2, "<p>b&amp;c</p>", "plain", None, None, False), (1, 2, None, "Title", 1, None, "a", None, None, None), (1, 3, "Picture", None, 0, "seen", None, box, None, None),
        (1, 4, "Text", None, 3, "", None, box, None, None), (1, 5, None, None, 4, "", None, box, None, None), (1, 6, "Text", None, 5, "x", None, box, True, None), (2, 1, "Picture", None, 0, "seen", None, box, None, None),
    ]
    blocks, pages = spark.createDataFrame(rows, schema), spark.createDataFrame([(1, "one"), (2, "two"), (3, " three "), (4, "")], "page int, text string")
    got = sorted((r.page, r.rank, r.label, r.text) for r in S.evaluation_blocks(blocks, ["page"], pages).collect())
    assert got == [(1, 1, "heading", "a"), (1, 2, "paragraph", "b&c"), (1, 3, "paragraph", ""), (3, 1, None, "three")]
    assert S.evaluation_blocks(blocks, ["page"], markup_first=False).filter("rank = 2").first().text == "plain"
    trusted = S.trusted_text(blocks.selectExpr("page", "pos", "reading_order", "text", "lower(label) AS block_type").replace("text", "paragraph", "block_type"), ["page"]).collect()
    assert [(r.page, r.text) for r in trusted] == [(1, "plain")]
    rates = S.plain_rates(spark.createDataFrame([("a B", "a b"), ("", "x"), (None, None)], "r string, h string"), "r", "h").select("cer", "wer").collect()
    assert [tuple(r) for r in rates] == [(pytest.approx(1 / 3), 0.5), (1.0, 1.0), (0.0, 0.0)]


def test_corpus_scores_and_winners(spark):
    from quirewright.operators import scoring as S

    pages = spark.createDataFrame([("a", "abcd", "abxd", 0.5, None), ("a", "", "", None, 1.0), ("b", "ab", "cd", None, None)], "engine string, r string, h string, inversion_rate double, macro_f1 double")
    got = {r.engine: r for r in S.corpus_scores(S.scored_pages(pages, "r", "h"), ["engine"]).collect()}
    assert (got["a"].cer, got["a"].inversion_rate, got["a"].ordered_pages, got["a"].macro_f1, got["a"].pages) == (0.25, 0.5, 1, 1.0, 2) and got["b"].cer == 1.0 and got["b"].macro_f1 is None
    schema = "k int, engine string, pages int, page_ids array<int>, digest string, cer double, wer double, inversion_rate double, macro_f1 double, orders map<int,double>"
    a = spark.createDataFrame([(k, "x", 2, [1, 2], d, 0.1, 0.2, 0.3, 0.4, {1: 0.0, 2: 1.0}) for k, d in ((1, "d"), (2, None), (3, "e"), (4, "d"))], schema)
    b = spark.createDataFrame([(k, "y", n, ids, "d", 0.1, None, 0.1, 0.5, {2: 0.5}) for k, n, ids in ((1, 2, [2, 1]), (2, 2, [1, 2]), (3, 2, [1, 2]), (4, 1, [1]))], schema)
    c = S.comparability(a, b, ["k"], ["digest"])
    assert sorted((r.k, r.comparability) for r in c.collect()) == [(1, "verified"), (2, "unverified"), (3, "different_protocols"), (4, "different_page_counts")]
    won = {(r.k, r.metric): r.winner for r in S.winners(c, ["k"], text_only=F.lit(True)).collect()}
    assert [won[1, m] for m in S.METRICS] == ["tie", "unavailable", "y", "y"] and {won[k, "cer"] for k in (2, 3, 4)} == {None}
    assert {r.winner for r in S.winners(c, ["k"]).filter("k = 1 AND metric IN ('inversion_rate', 'macro_f1')").collect()} == {"inconclusive"}
    assert {r.metric: r.winner for r in S.winners(c, ["k"], allow_unverified=True).filter("k = 2").collect()}["macro_f1"] == "y"
    routed = S.routed_pages(spark.createDataFrame([(1,), (2,)], "page int"), spark.createDataFrame([(2, "e"), (3, "f")], "page int, engine string"), ["page"])
    assert sorted((r.page, r.status) for r in routed.collect()) == [(1, "unavailable"), (2, "evaluated"), (3, "unreviewed")]


def test_verification(spark):
    from quirewright.operators import verification as V

    b = spark.createDataFrame([(1, 1, 1, [0.0, 0.0, 5.0, 5.0]), (1, 2, 3, None), (2, 3, None, [0.0, 0.0, 50.0, 5.0]), (2, 4, 1, [float("nan"), 0.0, 1.0, 1.0])], "page int, k int, reading_order int, bbox array<double>")
    page_box = F.array(*[F.lit(float(x)) for x in (0, 0, 10, 10)])
    got = sorted((r.page, r.k or 0, r.code) for r in V.block_issues(b, ["page"], "k", page_box).collect())
    assert got == [(1, 0, "noncontiguous_block_order"), (2, 3, "invalid_block_bbox"), (2, 3, "invalid_block_order"), (2, 4, "invalid_block_bbox")]
    quality = "struct<accepted:boolean>"
    rows = [
        (1, "native_text_accepted", "pymupdf", "native_text", None, None, None, None, "t", "surya"), (2, "tesseract_accepted", "tesseract5", "tesseract", None, None, None, (False,), "t", "none"),
        (3, "tesseract_rejected_no_fallback", "none", "tesseract", None, None, None, None, "t", "surya"), (4, "surya_primary", "surya", "surya", "tesseract", "primary", None, None, "t", "none"),
        (5, "surya_escalated", "surya", "tesseract", None, "quality", 3, (True,), "t", None), (6, None, None, None, None, None, None, None, None, None),
    ]
    records = spark.createDataFrame(rows, f"page int, outcome string, engine string, route string, classifier_route string, escalation_reason string, surya_batch int, tesseract_quality {quality}, text string, fallback string")
    got = {}
    for r in V.outcome_issues(records, ["page"], fallback=F.col("fallback")).collect():
        got.setdefault(r.page, set()).add(r.code)
    assert got == {2: {"tesseract_quality"}, 3: {"compact_text", "compact_setting"}, 4: {"surya_batch"}, 6: {"unknown_outcome"}}
    log = records.select("page", "engine", "outcome")
    artifact = spark.createDataFrame([(1, "pymupdf", "other"), (7, "x", "y")], "page int, engine string, outcome string")
    found = sorted((r.page, r.code) for r in V.published_issues(artifact, log.filter("page < 3"), ["page"], ["engine", "outcome"]).collect())
    assert found == [(1, "outcome_differs"), (2, "page_not_published"), (7, "page_not_in_log")]
    assert [r.page for r in V.batch_issues(records, artifact, ["page"]).collect()] == [5]
    issues = spark.createDataFrame([("d", "page_not_published"), ("e", "outcome_differs")], "d string, code string")
    assert sorted((r.d, r.valid) for r in V.verdict(issues, ["d"], strict=False).collect()) == [("d", True), ("e", False)]
    ranked = b.withColumn("rank", F.col("k"))
    assert sorted((r.page, r.contiguous, r.backtracks) for r in V.order_report(ranked, ["page"]).collect()) == [(1, True, 0), (2, False, 0)]


def test_xhtml_and_unions(spark, tmp_path):
    word = lambda t, x: f'<word xMin="{x}" yMin="1" xMax="{x + 5}" yMax="9">{t}</word>'
    page = f'<page width="100" height="200"><flow><block xMin="0" yMin="0" xMax="9" yMax="9"><line xMin="0" yMin="0" xMax="9" yMax="9">{word("a", 0)}{word(" ", 6)}{word("b", 12)}</line><line xMin="0" yMin="0" xMax="9" yMax="9">{word("c", 0)}</line></block></flow><flow><block xMin="0" yMin="0" xMax="9" yMax="9"><line xMin="0" yMin="0" xMax="9" yMax="9">{word("d", 0)}</line></block></flow></page>'
    (tmp_path / "x.xhtml").write_text(f"<html><body><doc>{page}</doc></body></html>")
    r = A.layout_pages(spark, str(tmp_path / "x.xhtml")).first()
    assert (r.width, r.height) == (100.0, 200.0) and [(w.text, w.block, w.line) for w in r.words] == [("a", 1, 1), ("b", 1, 1), ("c", 1, 2), ("d", 2, 1)] and r.words[1].bbox == [12.0, 1.0, 17.0, 9.0]
    a, b = spark.createDataFrame([(1, 2)], "x int, y int"), spark.createDataFrame([(3, "z")], "x int, w string")
    assert A.union_of_rows([a, b]).columns == ["x", "y", "w"] and A.union_of_rows([]) is None


def test_tsv_line_blocks(spark):
    rows = ["level\tpage", "5\t1\t1\t1\t1\t1\t10\t20\t30\t10\t90\tFirst", "5\t1\t1\t1\t1\t2\t50\t18\t30\t10\t90\tline", "5\t1\t1\t1\t2\t1\t10\t40\t30\t10\t90\tSecond"]
    got = spark.createDataFrame([("\n".join(rows),), ("",), (None,)], "t string").select(A.tsv_blocks(F.col("t")).alias("b")).collect()
    assert [(b.text, b.bbox, b.reading_order, b.line) for b in got[0].b] == [("First line", [10.0, 18.0, 80.0, 30.0], 1, 1), ("Second", [10.0, 40.0, 40.0, 50.0], 2, 2)] and got[1].b == [] and not got[2].b


def test_json_files_and_published_tables(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": [1]}')
    (tmp_path / "b.json").write_text("[1]")
    (tmp_path / "c.json").write_text("broken")
    got = {r.path.rsplit("/", 1)[1]: r for r in A.json_objects(spark, str(tmp_path / "*.json")).collect()}
    assert [got[n].is_object for n in ("a.json", "b.json", "c.json")] == [True, False, False] and len(got["a.json"].sha256) == 64
    rows = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    for kind in ("json", "csv", "parquet"):
        A.published(rows, str(tmp_path / kind), kind)
        assert (tmp_path / kind / "_SUCCESS").exists()
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 2 and spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["k", "v"]
