"""Recognised words laid into layout regions: ownership by place, then agreement of each region's text."""

from __future__ import annotations

import difflib
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructType

from quirewright.functions import geometry as G
from quirewright.functions import text as T
from quirewright.operators import layout as L

#: Share of the smaller of two regions that may overlap.
MOST_OVERLAP = 0.15


def owned_words(words: DataFrame, regions: DataFrame, page: list[str]) -> DataFrame:
    """Each word's region: the one of the highest score, ties to the first; words that lie in none keep a null region.

    ``words`` needs word (number) and bbox, ``regions`` region (number) and bbox. Equi-join on the page with the overlap
    as residual condition; only the winning region is kept, by a partial aggregate.
    """
    w = words.select(*page, "word", F.col("bbox").alias("wb"))
    r = regions.select(*page, "region", F.col("bbox").alias("rb"))
    near = w.join(r, page).withColumn("score", G.word_in_region(F.col("wb"), F.col("rb"))).filter("score IS NOT NULL")
    best = near.groupBy(*page, "word").agg(F.max_by(F.struct("region", "score"), F.struct("score", -F.col("region"))).alias("b"))
    return w.select(*page, "word").join(best.select(*page, "word", "b.region", "b.score"), [*page, "word"], "left")


def overlapping_regions(regions: DataFrame, page: list[str]) -> DataFrame:
    """Pairs of a page's regions that overlap by ``MOST_OVERLAP`` of the smaller or more."""
    a, b = regions.alias("a"), regions.alias("b")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in page]
    smaller = F.least(G.area(F.col("a.bbox")), G.area(F.col("b.bbox")))
    share = F.when(smaller > 0, G.overlap(F.col("a.bbox"), F.col("b.bbox")) / smaller)
    pairs = a.join(b, [*on, F.col("a.region") < F.col("b.region"), share >= MOST_OVERLAP])
    return pairs.select(*[F.col(f"a.{c}").alias(c) for c in page], F.col("a.region").alias("left_region"), F.col("b.region").alias("right_region"), share.alias("share"))


@pandas_udf(StructType().add("shared", LongType()).add("left", LongType()).add("right", LongType()).add("sequence_ratio", DoubleType()))
def token_agreement(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    """Of two token arrays: tokens in both (as multisets), the numbers of either, and the ratio of their matching blocks."""
    rows = []
    for x, y in zip(a, b):
        x, y = list(x), list(y)
        if x == y:
            rows.append((len(x), len(x), len(y), 1.0))
        else:
            rows.append(((Counter(x) & Counter(y)).total(), len(x), len(y), difflib.SequenceMatcher(None, x, y, autojunk=False).ratio()))
    return pd.DataFrame(rows, columns=["shared", "left", "right", "sequence_ratio"])


def agreement(rows: DataFrame, left: str, right: str) -> DataFrame:
    """``rows`` with precision, recall, f1, jaccard, sequence ratio and equality of critical values of two texts.

    The sequence ratio has no form in Catalyst; the multiset counts ride along in the same Arrow batch.
    """
    rows = rows.withColumn("_o", token_agreement(T.agreement_tokens(left), T.agreement_tokens(right)))
    shared, na, nb = F.col("_o.shared"), F.col("_o.left"), F.col("_o.right")
    share = lambda n: F.when(n > 0, shared / n).otherwise(0.0)
    return rows.withColumns(
        {
            "precision": share(nb), "recall": share(na), "f1": F.when(na + nb > 0, 2 * shared / (na + nb)).otherwise(0.0),
            "jaccard": F.when((na > 0) & (nb > 0), shared / (na + nb - shared)).otherwise(0.0), "sequence_ratio": F.col("_o.sequence_ratio"),
            "critical_values_match": T.critical_values(left) == T.critical_values(right),
        }
    ).drop("_o")


#: Confidence from which a recognised word counts, and what a region's text must reach (fixed values).
CONFIDENT, LEAST_F1, LEAST_SEQUENCE = 60.0, 1.0, 1.0


#: Pages that are laid at once, and pairs of boxes that are compared at once.
PAGES_AT_ONCE, PAIRS_AT_ONCE = 1000, 500_000


def region_pages(regions: DataFrame, page: list[str]) -> DataFrame:
    """A row for each page with its ``regions`` as one array; ``_eligible`` marks those whose text words may replace."""
    marked = regions.withColumns({"_eligible": _eligible(), "_table": F.coalesce(F.col("block_type") == "table", F.lit(False))})
    return marked.groupBy(*page).agg(F.collect_list(F.struct(*[c for c in marked.columns if c not in page])).alias("regions"))


def layout_pages(regions: DataFrame, words: DataFrame, page: list[str]) -> DataFrame:
    """:func:`region_pages` with the ``words`` of each page as another array."""
    word = F.struct("word", "text", F.col("bbox").cast("array<double>").alias("bbox"), F.col("confidence").cast("double").alias("confidence"), "reading_order")
    return region_pages(regions, page).join(words.filter(F.trim("text") != "").groupBy(*page).agg(F.collect_list(word).alias("words")), page, "left")


def fields(lists: pa.ListArray) -> dict[str, pa.Array]:
    """The fields of all structs in an array of lists."""
    return dict(zip([f.name for f in lists.type.value_type], lists.flatten().flatten()))


def corners(boxes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The first four numbers of each box, and which of them there are."""
    size = pc.fill_null(pc.list_value_length(boxes), 0).to_numpy(zero_copy_only=False)
    flat = boxes.flatten()
    values = np.r_[flat.to_numpy(zero_copy_only=False).astype(float), np.nan]
    known = np.r_[flat.is_valid().to_numpy(zero_copy_only=False), False]
    at = np.where(np.arange(4) < size[:, None], (np.cumsum(size) - size)[:, None] + np.arange(4), len(flat))
    return values[at], known[at]


def _reaches(x: np.ndarray, y: np.ndarray | float) -> np.ndarray:
    """``x >= y`` as Spark compares: NaN is the largest number."""
    return np.isnan(x) | (x >= y)


def _area(box: np.ndarray, known: np.ndarray) -> np.ndarray:
    """:func:`geometry.area`, missing corners passed over."""
    side = lambda i: np.maximum(0.0, np.where(known[:, i] & known[:, i + 2], box[:, i + 2] - box[:, i], 0.0))
    return side(0) * side(1)


def _overlap(a: np.ndarray, b: np.ndarray, known: np.ndarray) -> np.ndarray:
    """:func:`geometry.overlap` of whole boxes with others, whose missing corners are passed over."""
    if known.all():
        return np.maximum(0.0, np.fmin(a[:, 2], b[:, 2]) - np.maximum(a[:, 0], b[:, 0])) * np.maximum(0.0, np.fmin(a[:, 3], b[:, 3]) - np.maximum(a[:, 1], b[:, 1]))
    least = lambda i: np.where(known[:, i], np.fmin(a[:, i], b[:, i]), a[:, i])
    most = lambda i: np.where(known[:, i], np.maximum(a[:, i], b[:, i]), a[:, i])
    return np.maximum(0.0, least(2) - most(0)) * np.maximum(0.0, least(3) - most(1))


def _pairs(first: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Each row's number beside those of its ``count`` partners from ``first`` on, in blocks of bounded size that end with a row."""
    ends = np.cumsum(count)
    bounds = [0, *(np.flatnonzero(np.diff(ends // PAIRS_AT_ONCE)) + 1), len(count)]
    for lo, hi in zip(bounds, bounds[1:]):
        n = count[lo:hi]
        if n.sum():
            yield np.repeat(np.arange(lo, hi), n), np.arange(n.sum()) + np.repeat(first[lo:hi] - (np.cumsum(n) - n), n)


def _owners(words: np.ndarray, boxes: np.ndarray, known: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Of each word the region with the highest :func:`geometry.word_in_region` among its page's, the first of equals; -1 for none."""
    owner = np.full(len(words), -1)
    whole = known.all(axis=1)
    size = _area(words, np.ones(words.shape, bool))
    for w, r in _pairs(first, count):
        a, b = words[w], boxes[r]
        x, y = (a[:, 0] + a[:, 2]) / 2, (a[:, 1] + a[:, 3]) / 2
        inside = whole[r] & _reaches(x, b[:, 0]) & _reaches(b[:, 2], x) & _reaches(y, b[:, 1]) & _reaches(b[:, 3], y)
        covered = np.where(size[w] <= 0, 0.0, _overlap(a, b, known[r]) / size[w])
        score = np.where(inside, covered + 2.0, covered)
        score[np.isnan(score)] = np.inf
        score[~(inside | _reaches(covered, 0.5))] = -np.inf
        starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        best = np.repeat(np.maximum.reduceat(score, starts), np.diff(np.r_[starts, len(w)]))
        hit = np.flatnonzero((score == best) & (score > -np.inf))
        hit = hit[np.flatnonzero(np.diff(w[hit], prepend=-1))]
        owner[w[hit]] = r[hit]
    return owner


#: White space that a pattern's ``\s`` doesn't mean.
_ODD_SPACE = re.compile(r"[^\S \t\n\x0b\f\r]")


def _folded(text: str) -> str:
    """Case-folded as :func:`text.agreement_tokens` has it."""
    return text.lower() if text.isascii() else unicodedata.normalize("NFC", text.casefold())


def _laid(batch: pa.RecordBatch, page: list[str], confident: float, reader: Callable[[pa.ListArray], pa.ListArray] | None) -> pa.RecordBatch:
    """The regions of some pages, each with the text and number of the confident words in it and what its page counts.

    Words stand in reading order, unnumbered last; those of tables row by row, unless one has a box of other than four numbers.
    """
    n = batch.num_rows
    of_page = lambda x: np.repeat(np.arange(n), pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False))
    numpy = lambda x: x.to_numpy(zero_copy_only=False)
    regions = batch.column("regions")
    words = reader(regions) if reader else batch.column("words")
    r, w, r_page, w_page = fields(regions), fields(words), of_page(regions), of_page(words)

    text = pc.utf8_trim(w["text"], characters=" ")
    shown = numpy(pc.fill_null(pc.not_equal(text, ""), False))
    sure = numpy(w["confidence"].is_valid()) & ~(numpy(w["confidence"]).astype(float) < confident)
    box, known = corners(w["bbox"])
    placed = known.all(axis=1)
    number = lambda mask: np.bincount(w_page[shown & mask], minlength=n)

    eligible = np.flatnonzero(numpy(r["_eligible"]))
    eligible = eligible[np.lexsort((numpy(r["region"])[eligible], r_page[eligible]))]
    e_page = r_page[eligible]
    e_box, e_known = (x[eligible] for x in corners(r["bbox"]))
    e_area, overlaps = _area(e_box, e_known), np.zeros(n, int)
    with np.errstate(all="ignore"):
        follow = np.arange(len(eligible)) + 1
        for i, j in _pairs(follow, np.searchsorted(e_page, e_page, "right") - follow):
            smaller = np.fmin(e_area[i], e_area[j])
            crossing = ~(smaller <= 0) & _reaches(_overlap(e_box[i], e_box[j], e_known[j]) / smaller, MOST_OVERLAP)
            overlaps += np.bincount(e_page[i[crossing]], minlength=n)
        good = np.flatnonzero(shown & sure & placed)
        first = np.searchsorted(e_page, w_page[good])
        owner = _owners(box[good], e_box, e_known, first, np.searchsorted(e_page, w_page[good], "right") - first)

    good, owner = good[owner >= 0], owner[owner >= 0]
    order, late = numpy(pc.fill_null(w["reading_order"], 0)), numpy(w["reading_order"].is_null())
    at = np.lexsort((numpy(w["word"])[good], order[good], late[good], owner))
    good, owner = good[at], owner[at]
    read = numpy(text.take(pa.array(good, pa.int64()))).tolist()
    count = np.bincount(owner, minlength=len(eligible))
    ends = np.cumsum(count)
    selected = [" ".join(read[end - k : end]) for end, k in zip(ends.tolist(), count.tolist())]
    four = numpy(pc.fill_null(pc.equal(pc.list_value_length(w["bbox"]), 4), False))
    for e in np.flatnonzero(numpy(r["_table"])[eligible] & (count > 0)):
        own = slice(ends[e] - count[e], ends[e])
        ws = [{"text": t.strip(), "bbox": b} for t, b in zip(read[own], box[good[own]])]
        if four[good[own]].all():
            ws = [x for row in L.rows_of_words(ws) for x in row]
        selected[e] = " ".join(x["text"] for x in ws)

    def spread(values: list | np.ndarray, other: object, kind: pa.DataType) -> pa.Array:
        """Values of the eligible regions among all."""
        out = np.full(len(r_page), other, object if kind == pa.string() else None)
        out[eligible] = values
        return pa.array(out, kind)

    own = r["text"].take(pa.array(eligible, pa.int64())).to_pylist()
    plain = [" ".join(t.split()) for t in own]
    same = [s == t for s, t in zip(selected, plain)]
    # white space of other kinds than a pattern's \s may part a sign from its number
    alike = [k and (s == t or not _ODD_SPACE.search(t)) for k, s, t in zip(same, selected, own)]
    judged = {
        "_selected": spread(selected, None, pa.string()), "_same": spread(same, False, pa.bool_()), "_alike": spread(alike, False, pa.bool_()),
        "_left": spread(["" if k else _folded(t) for k, t in zip(same, plain)], "", pa.string()), "_right": spread(["" if k else _folded(t) for k, t in zip(same, selected)], "", pa.string()),
        "_words": spread(count, 0, pa.int64()),
    }
    counts = {"_confident": number(sure), "_unsure": number(~sure), "_unplaced": number(sure & ~placed), "_overlaps": overlaps}
    out = {c: batch.column(c).take(pa.array(r_page, pa.int64())) for c in page} | r
    return pa.RecordBatch.from_pydict(out | judged | {k: pa.array(v[r_page], pa.int64()) for k, v in counts.items()})


def judged_pages(pages: DataFrame, page: list[str], confident: float = CONFIDENT, reader: Callable[[pa.ListArray], pa.ListArray] | None = None) -> DataFrame:
    """The regions of :func:`layout_pages` with ``_selected``, the text of the words in them, and ``reasons`` against it.

    ``reader`` gives pages' words from their regions where they carry none (:func:`region_pages`). Each page is looked at once, in a map; nothing is joined. Texts that are the words' but for white space have the same
    tokens, so only others are held against each other.
    """
    kind = StructType([*[pages.schema[c] for c in page], *pages.schema["regions"].dataType.elementType.fields]).add("_selected", StringType()).add("_same", BooleanType()).add("_alike", BooleanType()).add("_left", StringType()).add("_right", StringType())
    for name in ("_words", "_confident", "_unsure", "_unplaced", "_overlaps"):
        kind = kind.add(name, LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                yield _laid(batch.slice(at, PAGES_AT_ONCE), page, confident, reader)

    rows = pages.select(*page, "regions", *["words"] * (reader is None)).mapInArrow(run, kind)
    rows = rows.withColumn("_o", token_agreement(T.folded_tokens("_left"), T.folded_tokens("_right")))
    tokens = F.col("_o.left") + F.col("_o.right")
    f1 = F.when(F.col("_same"), F.when(F.col("text").rlike(f"[{T.WORD_CHARS}]"), 1.0).otherwise(0.0)).when(tokens > 0, 2 * F.col("_o.shared") / tokens).otherwise(0.0)
    critical = F.when(F.col("_alike"), True).otherwise(T.critical_values("text") == T.critical_values("_selected"))
    reasons = F.array_compact(
        F.array(
            F.when(F.col("_selected") == "", "no_high_confidence_tesseract_text"), F.when(f1 < LEAST_F1, "low_token_f1"),
            F.when(F.col("_o.sequence_ratio") < LEAST_SEQUENCE, "low_token_sequence_ratio"), F.when(~critical, "critical_value_token_mismatch"),
        )
    )
    rows = rows.withColumn("reasons", F.when(F.col("_eligible"), reasons))
    return rows.drop("_left", "_right", "_same", "_alike", "_o")


def hybrid_regions(regions: DataFrame, words: DataFrame, page: list[str], confident: float = CONFIDENT) -> DataFrame:
    """Every textual region of a layout with the confident recognised words that lie in it: page, region, text, words, reasons.

    ``regions``: region, block_type, text, bbox, skipped, failed; ``words``: word, text, bbox, confidence, reading_order.
    ``reasons`` lists why the words can't replace the region's text: none there, other tokens, another order of them,
    or other numbers. Regions that are pictures, skipped, failed or blank aren't judged.
    """
    rows = judged_pages(layout_pages(regions, words, page), page, confident).filter("_eligible")
    return rows.select(*page, "region", F.col("_selected").alias("text"), F.col("_words").alias("words"), "reasons")


def _textual() -> Column:
    return F.coalesce(F.trim("text") != "", F.lit(False))


def _eligible() -> Column:
    off = F.coalesce(F.col("skipped"), F.lit(False)) | F.coalesce(F.col("failed"), F.lit(False)) | F.coalesce(F.col("block_type").isin(*T.VISUAL), F.lit(False))
    return _textual() & ~off


#: What a page counts over its judged regions.
_COUNTS = {
    "eligible": lambda: F.count_if("_eligible"), "_other": lambda: F.count_if(_textual() & ~F.col("_eligible")), "confident_words": lambda: F.max("_confident"), "other_words": lambda: F.max("_unsure"),
    "unplaced_words": lambda: F.max("_unplaced"), "_crossing": lambda: F.max("_overlaps"), "rejected_regions": lambda: F.count_if(F.size("reasons") > 0), "_assigned": lambda: F.sum("_words"),
}


def _skip_reason() -> Column:
    return (
        F.when(F.col("_other") > 0, "non_tesseract_textual_surya_regions")
        .when(F.col("eligible") == 0, "no_textual_surya_regions")
        .when(F.col("_crossing") > 0, "overlapping_surya_text_regions")
        .when(F.col("rejected_regions") > 0, "insufficient_per_region_agreement")
        .when((F.col("confident_words") > F.col("_assigned")) | (F.col("confident_words") == 0), "too_many_unassigned_tesseract_words")
    )


def decided_pages(judged: DataFrame, page: list[str]) -> DataFrame:
    """What :func:`hybrid_decisions` says, from the regions of :func:`judged_pages`."""
    rows = judged.groupBy(*page).agg(*[count().alias(name) for name, count in _COUNTS.items()])
    rows = rows.withColumn("unassigned_words", F.col("confident_words") - F.col("_assigned")).withColumn("skip_reason", _skip_reason()).withColumn("applied", F.col("skip_reason").isNull())
    return rows.select(*page, "applied", "skip_reason", "eligible", "confident_words", "other_words", "unplaced_words", "unassigned_words", "rejected_regions")


def decided_blocks(judged: DataFrame, page: list[str]) -> DataFrame:
    """What :func:`hybrid_blocks` gives, from the regions of :func:`judged_pages`."""
    own = [c for c in judged.columns if not c.startswith("_") and c not in (*page, "region", "reasons")]
    rows = judged.withColumns({name: count().over(Window.partitionBy(*page)) for name, count in _COUNTS.items()})
    taken = _skip_reason().isNull() & F.col("_eligible")
    text = F.when(taken, F.col("_selected")).otherwise(F.col("text")).alias("text")
    return rows.select(*page, "region", *[text if c == "text" else F.col(c) for c in own], F.when(taken, "tesseract5").otherwise("surya").alias("text_engine"))


def hybrid_decisions(regions: DataFrame, words: DataFrame, page: list[str], confident: float = CONFIDENT) -> DataFrame:
    """Whether recognised words may replace the text of a page's layout, all of it or none: page, applied, skip_reason and counts.

    Declined, by priority: a textual region that isn't for words, no region that is, two that overlap, a region whose
    words don't agree with it, a confident word in no region (or no confident word at all).
    """
    return decided_pages(judged_pages(layout_pages(regions, words, page), page, confident), page)


def hybrid_blocks(regions: DataFrame, words: DataFrame, page: list[str], confident: float = CONFIDENT) -> DataFrame:
    """``regions`` with the words' text where the whole page allows it, and ``text_engine``; other pages stay as they are."""
    return decided_blocks(judged_pages(layout_pages(regions, words, page), page, confident), page)
