import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quirewright.operators import hybrid as H
from tests.conftest import DATA


@pytest.mark.parametrize("name", ["hybrid_text_engines", "hybrid_decisions"])
def test_layouts_are_read_once_and_never_joined(spark, name):
    """Plans of dozens of shuffles and joins of the same layout were more than the driver could hold."""
    import __spark_entry__

    plan = __spark_entry__.queries()[name](spark, f"{DATA}/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "Join" not in plan and plan.count("Exchange") <= 3


def boxes(n: int) -> list[list[float | None] | None]:
    rnd = random.Random(n)
    corner = lambda: rnd.choice([None, float("nan"), *[float(x) for x in range(8)] * 4])
    return [rnd.choice([None, *[[corner() for _ in range(4)]] * 9]) for _ in range(n)]


def test_words_find_the_regions_that_the_join_finds(spark):
    regions = spark.createDataFrame([(k % 5, k, "paragraph", "x", b, False, False) for k, b in enumerate(boxes(60))], "page int, region int, block_type string, text string, bbox array<double>, skipped boolean, failed boolean")
    words = spark.createDataFrame([(k % 6, k, f"w{k}", b, 90.0, None) for k, b in enumerate(boxes(300))], "page int, word int, text string, bbox array<double>, confidence double, reading_order int")
    placed = words.filter("bbox IS NOT NULL AND NOT exists(bbox, x -> x IS NULL)")
    owned = {(r.page, r.region): r.n for r in H.owned_words(placed, regions, ["page"]).filter("region IS NOT NULL").groupBy("page", "region").agg(F.count("*").alias("n")).collect()}
    got = {(r.page, r.region): r for r in H.hybrid_regions(regions, words, ["page"]).collect()}
    assert len(got) == 60 and {k: r.words for k, r in got.items() if r.words} == owned
    assert all(len(r.text.split()) == r.words for r in got.values())
    crossing = {r.page for r in H.overlapping_regions(regions, ["page"]).collect()}
    assert crossing == {r.page for r in H.hybrid_decisions(regions, words, ["page"]).filter("skip_reason = 'overlapping_surya_text_regions'").collect()}


def test_pairs_in_blocks(monkeypatch):
    rnd = np.random.default_rng(1)
    words, regions = np.sort(rnd.random((50, 2, 2)), axis=1).reshape(50, 4), np.sort(rnd.random((9, 2, 2)), axis=1).reshape(9, 4)
    first, count = rnd.integers(0, 5, 50), rnd.integers(0, 5, 50)
    with np.errstate(all="ignore"):
        whole = H._owners(words, regions, np.ones((9, 4), bool), first, count)
        monkeypatch.setattr(H, "PAIRS_AT_ONCE", 3)
        assert (whole == H._owners(words, regions, np.ones((9, 4), bool), first, count)).all() and len(set(whole)) > 2


def test_texts_alike_but_for_space_still_differ_in_numbers(spark):
    """Tokens are the same then, but a sign may stand next to its number or not; a text without tokens agrees with nothing."""
    texts = ["pay\n12", "(\u00a05)", "—"]
    regions = spark.createDataFrame([("p", k, "paragraph", t, [0.0, 10.0 * k, 9.0, 10.0 * k + 5], False, False) for k, t in enumerate(texts)], "page string, region int, block_type string, text string, bbox array<double>, skipped boolean, failed boolean")
    words = [("p", 10 * k + i, w, [float(i), 10.0 * k, i + 1.0, 10.0 * k + 5], 90.0, i) for k, t in enumerate(texts) for i, w in enumerate(t.split())]
    w = spark.createDataFrame(words, "page string, word int, text string, bbox array<double>, confidence double, reading_order int")
    assert {r.text: r.reasons for r in H.hybrid_regions(regions, w, ["page"]).collect()} == {"pay 12": [], "( 5)": ["critical_value_token_mismatch"], "—": ["low_token_f1"]}
