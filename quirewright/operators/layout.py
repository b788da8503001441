"""Reading order, visual lines, columns and block structure of pages."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Thresholds of the structure gate as shares of the page (fixed values).
GAP, CLUSTER, LEAST_LINES, START, SPAN = 0.015, 0.02, 4, 0.30, 0.04
COLUMN_LINES, COLUMN_WORDS, COLUMN_GAP, COLUMN_WIDTH, COLUMN_HEIGHT, COLUMN_OVERLAP = 5, 40, 0.08, (0.20, 0.60), 0.25, 0.40


def reading_ordered(blocks: DataFrame, page: list[str], order: str = "reading_order", at: str = "pos") -> DataFrame:
    """``blocks`` with ``rank`` 1..N in a page: by declared order, unnumbered last, then by position."""
    w = Window.partitionBy(*page).orderBy(F.col(order).isNull(), F.col(order), F.col(at))
    return blocks.withColumn("rank", F.row_number().over(w))


def vertical_backtracks(blocks: DataFrame, page: list[str], rank: str = "rank") -> DataFrame:
    """Blocks of each page that begin above the one before by more than 0.75 of the median height (4 points at least).

    Blocks without a box are passed over.
    """
    boxed = blocks.filter(F.size("bbox") == 4)
    height = boxed.groupBy(*page).agg(F.median(F.col("bbox")[3] - F.col("bbox")[1]).alias("median_height"))
    before = F.lag(F.col("bbox")[1]).over(Window.partitionBy(*page).orderBy(rank))
    rows = boxed.withColumn("previous_top", before).join(height, page)
    return rows.filter(F.col("bbox")[1] < F.col("previous_top") - F.greatest(F.lit(4.0), 0.75 * F.col("median_height")))


def repeated_edge_lines(blocks: DataFrame, document: str, share: float = 0.15) -> DataFrame:
    """Lower-cased block texts in the top ``share`` of at least two pages of a document, with their page count."""
    top = F.col("bbox")[1] <= share * F.col("page_height")
    line = F.lower(F.trim(F.regexp_replace("text", r"\s+", " ")))
    return blocks.filter(top & (F.length("text") > 0)).groupBy(document, line.alias("line")).agg(F.count_distinct("page").alias("pages")).filter("pages >= 2")


def aligned_columns(words: list[dict], width: float, height: float) -> list[dict]:
    """Starts of words behind a gap that line up down a page: start_x, line_count, top, bottom; most lines first.

    ``words``: dicts of line (any hashable) and bbox. Arrays are sorted by line and place, so that gaps are differences of
    neighbours; the gaps' starts are then swept from left to right into clusters, each joining the nearest running mean.
    """
    good = [w for w in words if w["bbox"] is not None and len(w["bbox"]) == 4 and w["bbox"][2] > w["bbox"][0] and w["bbox"][3] > w["bbox"][1]]
    if not good:
        return []
    number = {key: k for k, key in enumerate(dict.fromkeys(w["line"] for w in good))}
    line = np.array([number[w["line"]] for w in good])
    box = np.array([w["bbox"] for w in good], float)
    order = np.lexsort((box[:, 1], box[:, 0], line))
    line, box = line[order], box[order]
    first = np.flatnonzero(np.r_[True, line[1:] != line[:-1]])
    tops, bottoms = np.minimum.reduceat(box[:, 1], first), np.maximum.reduceat(box[:, 3], first)
    wide = np.flatnonzero((line[1:] == line[:-1]) & (box[1:, 0] - box[:-1, 2] >= GAP * width)) + 1
    x, owner = box[wide, 0], line[wide]
    y = tops[owner]
    sweep = np.lexsort((y, x))
    x, y, owner = x[sweep], y[sweep], owner[sweep]
    cluster, sums, sizes = np.empty(len(x), int), np.zeros(len(x)), np.zeros(len(x))
    made = 0
    for k, at in enumerate(x):
        away = np.abs(sums[:made] / sizes[:made] - at)
        c = int(away.argmin()) if made and away.min() <= CLUSTER * width else made
        made += c == made
        cluster[k] = c
        sums[c] += at
        sizes[c] += 1
    tall = float(np.median(bottoms - tops))
    out = []
    for c in range(made):
        own = cluster == c
        count, mean, top, bottom = len(set(owner[own])), sums[c] / sizes[c], float(y[own].min()), float(y[own].max())
        if count >= LEAST_LINES and mean / width >= START and bottom - top >= max(SPAN * height, 3 * tall):
            out.append({"start_x": float(mean), "line_count": count, "top": top, "bottom": bottom})
    return sorted(out, key=lambda e: (-e["line_count"], e["start_x"]))


def text_columns(words: DataFrame, page: list[str]) -> DataFrame:
    """Pairs of a page's blocks that stand side by side as columns of text. Needs block, line, bbox, page_width, page_height."""
    box = F.col("bbox")
    blocks = (
        words.filter((F.size("bbox") == 4) & (box[2] > box[0]) & (box[3] > box[1]))
        .groupBy(*page, "block")
        .agg(
            F.count_distinct("line").alias("lines"), F.count("*").alias("words"), F.min(box[0]).alias("x0"), F.min(box[1]).alias("y0"),
            F.max(box[2]).alias("x1"), F.max(box[3]).alias("y1"), F.max("page_width").alias("w"), F.max("page_height").alias("h"),
        )
        .filter((F.col("lines") >= COLUMN_LINES) & (F.col("words") >= COLUMN_WORDS))
        .filter(((F.col("x1") - F.col("x0")) / F.col("w")).between(*COLUMN_WIDTH) & ((F.col("y1") - F.col("y0")) / F.col("h") >= COLUMN_HEIGHT))
    )
    a, b = blocks.alias("a"), blocks.alias("b")
    shared = F.least("a.y1", "b.y1") - F.greatest("a.y0", "b.y0")
    shorter = F.least(F.col("a.y1") - F.col("a.y0"), F.col("b.y1") - F.col("b.y0"))
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in page]
    pair = a.join(b, [*same, F.col("b.x0") - F.col("a.x1") >= COLUMN_GAP * F.col("a.w"), shared / shorter >= COLUMN_OVERLAP])
    return pair.select(*[F.col(f"a.{c}").alias(c) for c in page], F.col("a.block").alias("left_block"), F.col("b.block").alias("right_block"))


def rows_of_words(words: list[dict]) -> list[list[dict]]:
    """Words of a table region as rows top to bottom, each left to right; a row ends where the centre leaves its running mean."""
    if not words:
        return []
    box = np.array([w["bbox"] for w in words], float)
    centre = (box[:, 1] + box[:, 3]) / 2
    reach = max(1.0, 0.75 * float(np.median(box[:, 3] - box[:, 1])))
    down = np.lexsort((box[:, 0], centre))
    row = np.zeros(len(words), int)
    start = 0
    for k in range(1, len(down)):
        if centre[down[k]] - centre[down[start:k]].mean() > reach:
            start = k
        row[down[k]] = row[down[k - 1]] + (start == k)
    across = np.lexsort((box[:, 1], box[:, 0], row))
    return [[words[i] for i in across[row[across] == r]] for r in range(row.max() + 1)]


#: Lines that a word may join, and the reach of a line as a share of its height, within bounds (fixed values).
LOOK_BACK, REACH, LEAST_REACH, MOST_REACH = 8, 0.55, 3.5, 7.0


def visual_lines(words: list[dict]) -> list[dict]:
    """Words with bbox and text as lines: text, bbox, top to bottom. A word joins the nearest of the last lines in reach, else begins one."""
    if not words:
        return []
    box = np.array([w["bbox"] for w in words], float)
    centre, tall = (box[:, 1] + box[:, 3]) / 2, np.maximum(1.0, box[:, 3] - box[:, 1])
    line, sums = np.empty(len(words), int), np.zeros((len(words), 3))  # of each line: words, centres, heights
    made = 0
    for k in np.lexsort((box[:, 0], centre)):
        near = np.arange(made - 1, max(-1, made - 1 - LOOK_BACK), -1)  # the newest first
        mean = sums[near, 1:] / sums[near, :1]
        away = np.abs(mean[:, 0] - centre[k])
        away[away > np.clip(REACH * np.maximum(mean[:, 1], tall[k]), LEAST_REACH, MOST_REACH)] = np.inf
        at = int(near[away.argmin()]) if len(near) and np.isfinite(away.min()) else made
        made += at == made
        line[k] = at
        sums[at] += 1, centre[k], tall[k]
    out = []
    for n in np.argsort(sums[:made, 1] / sums[:made, 0], kind="stable"):
        own = np.flatnonzero(line == n)
        own = own[np.argsort(box[own, 0], kind="stable")]
        out.append({"text": " ".join(words[i]["text"] for i in own), "bbox": [*box[own, :2].min(0).tolist(), *box[own, 2:].max(0).tolist()]})
    return out


def page_lines(words: DataFrame, page: list[str]) -> DataFrame:
    """Visual lines of every page: the page's keys, line_no, text, bbox. A page is one group; pages are small."""
    own = [c for c in words.columns if c in page]
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema if f.name in own)

    def lines(t: pd.DataFrame) -> pd.DataFrame:
        found = visual_lines([{"text": x, "bbox": list(b)} for x, b in zip(t["text"], t["bbox"])])
        out = pd.DataFrame([(i, x["text"], x["bbox"]) for i, x in enumerate(found)], columns=["line_no", "text", "bbox"])
        for c in reversed(own):
            out.insert(0, c, t[c].iloc[0])
        return out

    boxed = words.filter((F.size("bbox") == 4) & (F.length("text") > 0)).select(*own, "text", "bbox")
    return boxed.groupBy(*own).applyInPandas(lines, f"{keys}, line_no int, text string, bbox array<double>")


def stacked_paragraphs(lines: DataFrame, page: list[str]) -> DataFrame:
    """Lines of each page with ``paragraph``: a new one begins where the gap to the line before exceeds 1.65 of its height."""
    w = Window.partitionBy(*page).orderBy("line_no")
    box = F.col("bbox")
    previous = F.lag("bbox").over(w)
    breaks = F.when(previous.isNull() | (box[1] - previous[3] > 1.65 * (previous[3] - previous[1])), 1).otherwise(0)
    return lines.withColumn("_b", breaks).withColumn("paragraph", F.sum("_b").over(w)).drop("_b")
