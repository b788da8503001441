"""Evaluation of recognised pages: the blocks that are scored, reference text, corpus scores, routing strata, comparison of two reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirewright.functions import geometry as G
from quirewright.functions import measures as M
from quirewright.functions import text as T
from quirewright.operators import layout as L

# Fixed values.
#: Types of reference blocks whose text is trusted for scoring.
REFERENCE_TYPES = ("section_heading", "heading", "paragraph", "table", "table_caption", "figure_caption", "list")
#: Metrics of a comparison: whether lower wins, and whether it is one of layout.
METRICS = {"cer": (True, False), "wer": (True, False), "inversion_rate": (True, True), "macro_f1": (False, True)}
# End of the fixed values.


def evaluation_blocks(blocks: DataFrame, page: list[str], pages: DataFrame | None = None, page_text: str = "text", markup_first: bool = True) -> DataFrame:
    """The blocks of recognised pages that are scored: page, rank, label, text, bbox.

    ``blocks``: pos, label, raw_label, reading_order, html, text, bbox, skipped, error. Skipped and failed blocks and
    pictures aren't scored, nor blocks with neither text nor both a label and a box. Text is that of the html, else the
    plain one; the other way round unless ``markup_first``. A page of ``pages`` without any block is one block of its
    own ``page_text``; one whose blocks all fell away has none, so that no picture's description comes back.
    """
    named = lambda c: F.when(F.trim(c) != "", c)
    label = T.canonical_label(F.coalesce(named(F.col("label")), named(F.col("raw_label"))))
    plain, marked = T.evaluation_text("text"), T.stripped_html("html")
    text = F.when(F.col("html").isNotNull(), marked).otherwise(plain) if markup_first else F.when(plain != "", plain).otherwise(marked)
    off = F.coalesce(F.col("skipped"), F.lit(False)) | F.coalesce(F.col("error"), F.lit(False))
    rows = blocks.filter(~off).select(*page, "pos", "reading_order", label.alias("label"), text.alias("text"), G.coerced(F.col("bbox")).alias("bbox"))
    rows = rows.filter(~F.coalesce(F.col("label").isin(*T.VISUAL), F.lit(False))).filter((F.col("text") != "") | (F.col("label").isNotNull() & F.col("bbox").isNotNull()))
    out = L.reading_ordered(rows, page).select(*page, "rank", "label", "text", "bbox")
    if pages is None:
        return out
    none = lambda kind: F.lit(None).cast(kind)
    alone = pages.join(blocks.select(*page).distinct(), page, "left_anti").select(*page, F.lit(1).alias("rank"), none("string").alias("label"), T.evaluation_text(page_text).alias("text"), none("array<double>").alias("bbox"))
    return out.unionByName(alone.filter("text <> ''"))


def trusted_text(blocks: DataFrame, page: list[str], order: str = "reading_order", at: str = "pos") -> DataFrame:
    """Reference text of each page from the blocks of trusted types alone, in order, a line each: page, text, blocks."""
    kept = blocks.filter(F.col("block_type").isin(*REFERENCE_TYPES)).select(*page, order, at, T.evaluation_text("text").alias("text")).filter("text <> ''")
    row = F.struct(F.col(order).isNull(), F.col(order), F.col(at), F.col("text"))
    return kept.groupBy(*page).agg(F.array_join(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["text"]), "\n").alias("text"), F.count("*").alias("blocks"))


def scored_pages(pages: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """``pages`` with char_distance, ref_chars, hyp_chars, word_distance, ref_words, hyp_words of the two texts, both normalised."""
    rows = pages.withColumns({"_r": T.evaluation_text(reference), "_h": T.evaluation_text(hypothesis)})
    rows = rows.withColumns({"_rt": T.tokens(F.col("_r")), "_ht": T.tokens(F.col("_h"))})
    return rows.withColumns(
        {
            "char_distance": M.character_distance(F.col("_r"), F.col("_h")), "ref_chars": F.length("_r"), "hyp_chars": F.length("_h"),
            "word_distance": M.token_distance(F.col("_rt"), F.col("_ht")), "ref_words": F.size("_rt"), "hyp_words": F.size("_ht"),
        }
    ).drop("_r", "_h", "_rt", "_ht")


def plain_rates(pages: DataFrame, reference: str, hypothesis: str) -> DataFrame:
    """``pages`` with ``cer`` over the texts as they are and ``wer`` over words parted by white space, letter case counting."""
    r, h = (F.coalesce(F.col(c), F.lit("")) for c in (reference, hypothesis))
    words = lambda x: F.filter(F.split(T.collapse(x), " "), lambda w: w != "")
    rate = lambda d, a, b: M.error_rate(d, a, b)
    rows = pages.withColumns({"_rw": words(r), "_hw": words(h)})
    return rows.withColumns({"cer": rate(M.character_distance(r, h), F.length(r), F.length(h)), "wer": rate(M.token_distance(F.col("_rw"), F.col("_hw")), F.size("_rw"), F.size("_hw"))}).drop("_rw", "_hw")


def macro_f1(by_type: DataFrame, page: list[str]) -> DataFrame:
    """Mean F1 of each page over the types that either side has, from ``structure_scores``."""
    return by_type.filter("refs + hyps > 0").groupBy(*page).agg(F.avg("f1").alias("macro_f1"), F.count("*").alias("types"))


def corpus_scores(pages: DataFrame, engine: list[str]) -> DataFrame:
    """One report a group: pages, weighted and mean error rates, means of the layout metrics over the pages where they are measured.

    ``pages``: the columns of :func:`scored_pages`, inversion_rate and macro_f1 (null where not measured).
    """
    total = lambda c: F.sum(c).alias(f"_{c}")
    rate = lambda kind, unit: M.error_rate(F.col(f"_{kind}_distance"), F.col(f"_ref_{unit}"), F.col(f"_hyp_{unit}"))
    sums = ("char_distance", "ref_chars", "hyp_chars", "word_distance", "ref_words", "hyp_words")
    own = M.error_rate(F.col("char_distance"), F.col("ref_chars"), F.col("hyp_chars"))
    grouped = pages.withColumn("_own", own).groupBy(*engine).agg(
        F.count("*").alias("pages"), *[total(c) for c in sums], F.avg("_own").alias("mean_cer"), F.avg("inversion_rate").alias("inversion_rate"),
        F.count("inversion_rate").alias("ordered_pages"), F.avg("macro_f1").alias("macro_f1"),
    )
    return grouped.withColumns({"cer": rate("char", "chars"), "wer": rate("word", "words")}).drop(*[f"_{c}" for c in sums])


def routed_pages(truth: DataFrame, rich: DataFrame, key: list[str]) -> DataFrame:
    """Reviewed and published pages side by side: key, status (evaluated, unavailable, unreviewed), the columns of both.

    Truth that no published page answers is unavailable, a published page without truth unreviewed; neither is scored.
    """
    both = truth.withColumn("_t", F.lit(True)).join(rich.withColumn("_r", F.lit(True)), key, "full")
    status = F.when(F.col("_r").isNull(), "unavailable").when(F.col("_t").isNull(), "unreviewed").otherwise("evaluated")
    return both.withColumn("status", status).drop("_t", "_r")


def comparability(left: DataFrame, right: DataFrame, key: list[str], digests: list[str]) -> DataFrame:
    """Whether two reports may be compared: key, comparability, reason and both sides' columns (l, r as structs).

    Reports need engine, pages, page_ids (distinct, positive, as many as pages) and the digests. A report without all of
    them leaves the pair unverified; complete ones that differ, or page counts that differ, are an error.
    """
    side = lambda df, name: df.select(*key, F.struct(*[c for c in df.columns if c not in key]).alias(name))
    both = side(left, "l").join(side(right, "r"), key)
    complete = lambda s: (
        F.forall(F.array(*[F.col(f"{s}.{d}").isNotNull() & (F.col(f"{s}.{d}") != "") for d in digests]), lambda x: x)
        & (F.size(F.array_distinct(f"{s}.page_ids")) == F.col(f"{s}.pages")) & (F.size(f"{s}.page_ids") == F.col(f"{s}.pages")) & F.forall(f"{s}.page_ids", lambda p: p > 0)
    )
    known = F.coalesce(complete("l") & complete("r"), F.lit(False))
    equal = F.forall(F.array(*[F.col(f"l.{d}").eqNullSafe(F.col(f"r.{d}")) for d in digests], F.array_sort("l.page_ids").eqNullSafe(F.array_sort("r.page_ids"))), lambda x: x)
    kind = F.when(~F.col("l.pages").eqNullSafe(F.col("r.pages")), "different_page_counts").when(~known, "unverified").when(~equal, "different_protocols").otherwise("verified")
    return both.withColumn("comparability", kind)


def winners(compared: DataFrame, key: list[str], allow_unverified: bool = False, text_only: Column | None = None) -> DataFrame:
    """The better report of each comparable pair by metric: key, comparability, metric, winner (an engine, tie, unavailable, inconclusive or null).

    Unverified pairs have no winners unless allowed. Layout metrics have one only if blocks were matched by text alone
    (``text_only``), as boxes may help one engine only; the order is judged by the pages that both measured
    (``l``/``r``.orders, maps of page to rate).
    """
    may = (F.col("comparability") == "verified") | ((F.col("comparability") == "unverified") & F.lit(allow_unverified))
    layout = F.coalesce(text_only, F.lit(False)) if text_only is not None else F.lit(False)
    layout |= (F.col("comparability") == "unverified") & F.lit(allow_unverified)
    shared = F.array_intersect(F.map_keys("l.orders"), F.map_keys("r.orders"))
    paired = lambda s: F.aggregate(shared, F.lit(0.0), lambda a, p: a + F.element_at(f"{s}.orders", p)) / F.size(shared)
    rows = []
    for name, (lower, of_layout) in METRICS.items():
        a, b = F.col(f"l.{name}"), F.col(f"r.{name}")
        better = M.winner(a, b, "left", "right", lower)
        if name == "inversion_rate":
            better = F.when(F.size(shared) > 0, M.winner(paired("l"), paired("r"), "left", "right", lower)).otherwise("inconclusive")
        if of_layout:
            better = F.when(layout, better).otherwise("inconclusive")
        better = F.when(better == "left", F.col("l.engine")).when(better == "right", F.col("r.engine")).otherwise(better)
        rows.append(F.struct(F.lit(name).alias("metric"), F.when(may, better).alias("winner")))
    return compared.select(*key, "comparability", F.explode(F.array(*rows)).alias("x")).select(*key, "comparability", "x.metric", "x.winner")
