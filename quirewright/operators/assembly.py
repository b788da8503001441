"""Records and exports put together: canonical layout blocks, page records, structure evidence, configuration drift."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructType

from quirewright.functions import geometry as G
from quirewright.functions import text as T
from quirewright.operators import layout as L

#: Pages of one part of an export; a part is one row, whatever the document's length.
PAGES_A_PART = 256


def layout_blocks(df: DataFrame, key: list[str], predictions: str = "predictions") -> DataFrame:
    """Canonical blocks of recognised predictions: key, prediction_no, rank, source_order, block_type, text, bbox, skipped, failed.

    Text keeps its lines. Blank blocks go unless they are pictures, skipped or failed; a block without a label is text;
    the box is the declared one, else the polygon's. Ranks are 1..N by declared order, then by place; the declared order
    is kept.
    """
    p = df.select(*key, F.posexplode(predictions).alias("p", "x")).select(*key, (F.col("p") + 1).alias("prediction_no"), F.posexplode("x.blocks").alias("pos", "b"))
    b = F.col("b")
    named = lambda c: F.when(F.trim(c) != "", c)
    kind = T.canonical_label(F.coalesce(named(b["label"]), named(b["raw_label"]), F.lit("Text")))
    flag = lambda c: F.coalesce(c, F.lit(False))
    rows = p.filter(b.isNotNull()).select(
        *key, "prediction_no", "pos", b["reading_order"].alias("source_order"), kind.alias("block_type"), T.html_text(b["html"]).alias("text"),
        F.coalesce(G.coerced(b["bbox"]), G.from_polygon(b["polygon"])).alias("bbox"), flag(b["skipped"]).alias("skipped"), flag(b["error"]).alias("failed"),
    )
    rows = rows.filter((F.col("text") != "") | F.col("skipped") | F.col("failed") | F.coalesce(F.col("block_type").isin(*T.VISUAL), F.lit(False)))
    return L.reading_ordered(rows, [*key, "prediction_no"], order="source_order").drop("pos")


def page_record(page: Column, engine: Column, outcome: Column, classifier_route: Column, executed_route: Column, text: Column, quality: Column | None = None) -> Column:
    """A log record; the classifier's route is only kept where another one was taken."""
    route = F.coalesce(executed_route, classifier_route)
    own = F.when(~route.eqNullSafe(classifier_route), classifier_route)
    return F.struct(
        page.alias("page"), F.lit("complete").alias("status"), engine.alias("engine"), outcome.alias("outcome"), route.alias("route"), own.alias("classifier_route"),
        F.coalesce(text, F.lit("")).alias("text"), *([quality.alias("quality")] if quality is not None else []),
    )


def exported_pages(records: DataFrame, document: list[str], columns: list[str], page: str = "page") -> DataFrame:
    """Nested JSON documents of page records in order: document keys, part_no, document.

    A part holds the pages of one stretch of ``PAGES_A_PART`` numbers, so that no row grows with a document.
    """
    part = F.floor((F.col(page) - 1) / PAGES_A_PART).cast("int").alias("part_no")
    pages = F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in columns]))).alias("pages")
    return records.groupBy(*document, part).agg(F.to_json(F.struct(F.count("*").alias("page_count"), pages)).alias("document"))


def configuration_drift(jobs: DataFrame, key: str, config: str, expected: dict[str, object] | None = None) -> DataFrame:
    """key, setting, value, usual: settings that differ from ``expected``, or else from the commonest value of all jobs.

    A setting that is missing has its default and isn't drift. Null configurations give no rows.
    """
    names = jobs.schema[config].dataType.names
    pairs = F.array(*[F.struct(F.lit(n).alias("setting"), F.col(f"{config}.{n}").cast("string").alias("value")) for n in names])
    settings = jobs.select(F.col(key), F.explode(pairs).alias("s")).select(key, "s.*").filter("value IS NOT NULL")
    if expected is None:
        usual = settings.groupBy("setting", "value").count().groupBy("setting").agg(F.max_by("value", F.struct("count", "value")).alias("usual"))
    else:
        usual = jobs.sparkSession.createDataFrame([(n, str(v)) for n, v in expected.items()], "setting string, usual string")
    return settings.join(F.broadcast(usual), "setting").filter("value <> usual")  # one row a setting: the struct's fields bound it


def unknown_settings(config_json: Column, known: list[str]) -> Column:
    """Names of a JSON object's members that no setting has."""
    return F.array_except(F.json_object_keys(config_json), F.array(*map(F.lit, known)))


def wants_hindi(language: Column) -> Column:
    parts = F.transform(F.split(language, r"\+"), lambda p: F.lower(F.trim(p)))
    return F.arrays_overlap(parts, F.array(*map(F.lit, ("hin", "devanagari", "script/devanagari"))))


def primary_engine(config: Column) -> Column:
    """The engine that reads a page first: the one that is forced, else surya for Hindi where it is the fallback, else tesseract."""
    forced = F.when(config["ocr_engine"] != "auto", config["ocr_engine"])
    hindi = F.coalesce(wants_hindi(config["language"]), F.lit(False)) & F.coalesce(config["fallback_engine"] == "surya", F.lit(False))
    return F.coalesce(forced, F.when(hindi, "surya").otherwise("tesseract"))


def page_layers(record: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and the layers of each record: which engines' evidence it has, and whose text is the page's."""
    q, engine = F.col("tesseract_quality").isNotNull(), F.col("engine")
    layer = lambda there, name: F.struct(F.coalesce(there, F.lit(False)).alias("available"), engine.eqNullSafe(F.lit(name)).alias("selected"))
    native = F.coalesce(F.length("native_text") > 0, F.lit(False))
    layers = F.struct(layer(native | (engine == "pymupdf"), "pymupdf").alias("native"), layer(q | (engine == "tesseract5"), "tesseract5").alias("tesseract"), layer(F.col("surya_batch").isNotNull() | (engine == "surya"), "surya").alias("surya"))
    return record.select(*keep, layers.alias("layers"))


def parsed_candidate(value: str) -> tuple[str, float, float, float]:
    """``name:mean:ratio:threshold`` as a gate candidate; ranges are checked."""
    parts = value.split(":")
    if len(parts) != 4 or not parts[0].strip():
        raise ValueError(f"not name:mean:ratio:threshold: {value!r}")
    mean, ratio, word = (float(x) for x in parts[1:])
    if not (0 <= mean <= 100 and 0 <= ratio <= 1 and 0 <= word <= 100):
        raise ValueError(f"out of range: {value!r}")
    return parts[0].strip(), mean, ratio, word


_EVIDENCE = ArrayType(StructType().add("start_x", DoubleType()).add("line_count", IntegerType()).add("top", DoubleType()).add("bottom", DoubleType()))


@pandas_udf(_EVIDENCE)
def aligned_column_evidence(words: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    """Aligned columns of a page's words (array of structs with block, paragraph, line, bbox); the clustering depends on order."""

    def one(ws, w, h):
        if ws is None or not w or not h or w != w or h != h:
            return []
        kept = [{"line": (x["block"], x["paragraph"], x["line"]), "bbox": None if x["bbox"] is None else list(x["bbox"])} for x in ws if (x["block"] or 0) > 0 and (x["line"] or 0) > 0]
        return L.aligned_columns(kept, float(w), float(h))

    return pd.Series([one(*x) for x in zip(words, width, height)])


def structure_gate(columns: Column, text_columns: Column, native_tables: Column | None = None) -> Column:
    """Struct of reasons and escalate from the three kinds of evidence (arrays)."""
    some = lambda x: F.coalesce(F.size(x) > 0, F.lit(False))
    tables = F.filter(native_tables, lambda t: (t["row_count"] >= 2) & (t["column_count"] >= 2)) if native_tables is not None else F.array()
    reasons = F.array_compact(F.array(F.when(some(columns), "repeated_aligned_columns"), F.when(some(text_columns), "multiple_text_columns"), F.when(some(tables), "strict_native_table")))
    return F.struct(reasons.alias("reasons"), (F.size(reasons) > 0).alias("escalate"))


# structure of a page from its visual lines

_KIND = {name: re.compile(pattern) for name, pattern in T.LINE_KINDS}
#: Of two lines that make a heading together: how far apart their tops and how long they may be (fixed values).
HEADING_APART, HEADING_NUMBER, HEADING_TITLE = 16, 30, 100


def _envelope(boxes: list[list[float]]) -> list[float]:
    a = np.array(boxes, float)
    return [*a[:, :2].min(0).tolist(), *a[:, 2:].max(0).tolist()]


def merged_headings(lines: list[dict]) -> list[dict]:
    """Two lines at one height that only together make a heading, as one line."""
    heading = _KIND["section_heading"].match

    def belong(a: dict, b: dict) -> bool:
        level = abs(a["bbox"][1] - b["bbox"][1]) <= HEADING_APART and len(a["text"]) <= HEADING_NUMBER and len(b["text"]) <= HEADING_TITLE
        return bool(level and not heading(a["text"]) and heading(f"{a['text']} {b['text']}"))

    # a line belongs to one pair: the pair before takes it
    first = [False] * len(lines)
    for i, (a, b) in enumerate(zip(lines, lines[1:])):
        first[i] = not (i and first[i - 1]) and belong(a, b)
    pair = lambda a, b: {"text": f"{a['text']} {b['text']}", "bbox": _envelope([a["bbox"], b["bbox"]])}
    return [pair(x, lines[i + 1]) if first[i] else x for i, x in enumerate(lines) if not (i and first[i - 1])]


def page_structure(lines: list[dict], height: float, headers: set[str]) -> list[dict]:
    """Typed blocks of a page's lines in order from 0.

    By priority: a repeated header in the top 15 %, a bare number in the bottom 10 %, a heading, a caption, a run of at
    least three table rows, else a paragraph that goes on while the gap is at most 1.65 of the line before. Paragraphs of
    up to three characters away from the edges are debris.
    """
    lines = merged_headings(lines)
    n = len(lines)
    top, bottom = (np.array([x["bbox"][k] for x in lines], float) for k in (1, 3))
    gap = np.r_[top[1:] - bottom[:-1], np.inf] if n else top  # to the next line
    is_kind = {name: np.array([bool(p.match(x["text"])) for x in lines], bool) for name, p in _KIND.items()}
    # every line's own label, later ones giving way to earlier ones
    label = np.full(n, "", object)
    for k, x in enumerate(lines):
        caption = "table_caption" if x["text"].lower().startswith("table") else "figure_caption"
        label[k] = (
            "page_header" if x["text"].lower() in headers and top[k] <= 0.15 * height
            else "page_footer" if x["text"].strip().isdigit() and bottom[k] >= 0.9 * height
            else "section_heading" if is_kind["section_heading"][k]
            else caption if is_kind["caption"][k]
            else ""
        )
    wordy = np.array([len(x["text"]) < 140 and ":" in x["text"] for x in lines], bool)

    def last_of_table(k: int) -> int:
        z = k
        while z + 1 < n and gap[z] <= 20 and (is_kind["table_like"][z + 1] or (z - k >= 2 and wordy[z + 1])):
            z += 1
        return z

    def last_of_paragraph(k: int) -> int:
        stops = np.flatnonzero((gap[k:] > 1.65 * (bottom[k:] - top[k:])) | np.r_[label[k + 1 :] != "", True])
        return k + int(stops[0])

    out: list[dict] = []
    k = 0
    while k < n:
        kind, z = label[k], k
        if not kind:
            z = last_of_table(k)
            kind = "table"
            if z - k < 2:
                kind, z = "paragraph", last_of_paragraph(k)
        text = ("\n" if kind == "table" else " ").join(x["text"] for x in lines[k : z + 1])
        if not (kind == "paragraph" and len(text) <= 3 and 0.18 * height < top[k] < 0.88 * height):
            out.append({"block_type": kind, "text": text, "bbox": _envelope([x["bbox"] for x in lines[k : z + 1]]), "reading_order": len(out)})
        k = z + 1
    return out


def structured_pages(words: DataFrame, page: list[str], document: str, height: str = "page_height") -> DataFrame:
    """Typed blocks of every page from its words (text, bbox). A page is one small group; headers are counted before, by document."""
    lines = L.page_lines(words, page)
    tops = lines.join(words.groupBy(*page).agg(F.max(height).alias("_h")), page).filter(F.col("bbox")[1] <= 0.15 * F.col("_h"))
    number = next(c for c in page if c != document)
    repeated = tops.groupBy(document, F.lower("text").alias("line")).agg(F.count_distinct(number).alias("n")).filter("n > 1")
    marked = lines.join(words.groupBy(*page).agg(F.max(height).alias("_h")), page).join(repeated.select(document, F.col("line").alias("_line"), F.lit(True).alias("_header")), (lines[document] == repeated[document]) & (F.lower("text") == F.col("_line")), "left").drop(repeated[document])
    own = [c for c in words.columns if c in page]
    keys = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema if f.name in own)

    def build(t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values("line_no")
        headers = {x.lower() for x, h in zip(t["text"], t["_header"]) if h is True}
        blocks = page_structure([{"text": x, "bbox": list(b)} for x, b in zip(t["text"], t["bbox"])], float(t["_h"].iloc[0] or 0), headers)
        out = pd.DataFrame([(b["reading_order"], b["block_type"], b["text"], b["bbox"]) for b in blocks], columns=["reading_order", "block_type", "text", "bbox"])
        for c in reversed(own):
            out.insert(0, c, t[c].iloc[0])
        return out

    return marked.groupBy(*own).applyInPandas(build, f"{keys}, reading_order int, block_type string, text string, bbox array<double>")


# untyped payloads of hosted recognisers


#: Members of a payload's node that hold its text, other nodes below it, and lists of words (fixed values).
TEXT_MEMBERS, CHILD_MEMBERS, WORD_MEMBERS = ("text", "markdown", "content", "raw_text"), ("children", "blocks", "items", "words", "text_lines", "lines"), ("words", "text_lines", "lines")
_SCALAR = ("text", "content", "raw_text", "markdown", "html")
_BOXES = ("bbox", "box", "bounding_box", "coordinates")


def _scalar(value: object) -> str:
    """A text, or that of an object which holds one."""
    if isinstance(value, dict):
        value = next((value[k] for k in _SCALAR if isinstance(value.get(k), str)), "")
    return value if isinstance(value, str) else ""


def deep_text(node: object) -> str:
    """The best text of a JSON node: its own, else that of its html, else of the first member whose nodes have any, in order, parted by spaces.

    Nodes are listed parents first and then settled from the last to the first, so that no depth is too much.
    """
    nodes: list[tuple[object, list[list[int]]]] = [(node, [])]  # with the numbers of the nodes below, a list a member
    for value, below in nodes:
        if isinstance(value, dict):
            for name in CHILD_MEMBERS:
                inner = value.get(name)
                inner = inner if isinstance(inner, list) else [inner] if isinstance(inner, dict) else []
                below.append(list(range(len(nodes), len(nodes) + len(inner))))
                nodes.extend((x, []) for x in inner)
    texts = [""] * len(nodes)
    for k in range(len(nodes) - 1, -1, -1):
        value, below = nodes[k]
        if isinstance(value, str):
            texts[k] = value
        elif isinstance(value, dict):
            own = next((t for name in TEXT_MEMBERS if (t := _scalar(value.get(name)))), "")
            own = own or (T.html_lines(value["html"], True) if isinstance(value.get("html"), str) else "")
            texts[k] = own or next((joined for inner in below if (joined := " ".join(texts[i] for i in inner if texts[i]))), "")
    return texts[0]


def deep_words(node: object) -> Iterator[tuple[str, list[float] | None, float | None]]:
    """(text, box, confidence) of every word or line below a JSON node, in document order; a score stands for a confidence."""
    number = lambda v: isinstance(v, int | float) and not isinstance(v, bool)
    stack: list[tuple[object, bool]] = [(node, False)]
    while stack:
        x, as_word = stack.pop()
        if isinstance(x, list):
            stack.extend((y, as_word) for y in reversed(x))
        elif isinstance(x, dict):
            text = _scalar(x) if as_word else ""
            if text:
                box = next((x[k] for k in _BOXES if isinstance(x.get(k), list) and len(x[k]) >= 4 and all(map(number, x[k][:4]))), None)
                score = next((float(x[k]) for k in ("confidence", "score") if number(x.get(k))), None)
                yield text, [float(v) for v in box[:4]] if box else None, score
            else:
                below = [(x[k], k in WORD_MEMBERS) for k in (*WORD_MEMBERS, "children", "blocks", "items") if isinstance(x.get(k), list) or (k not in WORD_MEMBERS and isinstance(x.get(k), dict))]
                stack.extend(reversed(below))


@pandas_udf(StringType())
def payload_text(x: pd.Series) -> pd.Series:
    """``deep_text`` of JSON texts; null for one that can't be read."""

    def one(v):
        try:
            return deep_text(json.loads(v)) if v else None
        except (ValueError, RecursionError):
            return None

    return x.map(one)
