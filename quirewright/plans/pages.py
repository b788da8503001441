"""Queries over the page tables with the operators of the package, and the same in SQL where it can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quirewright.functions import geometry as G
from quirewright.functions import measures as M
from quirewright.functions import text as T
from quirewright.operators import assembly as Y
from quirewright.operators import evidence as E
from quirewright.operators import hybrid as H
from quirewright.operators import layout as L
from quirewright.operators import matching as X
from quirewright.operators import routing as R
from quirewright.plans import dialect as D
from quirewright.plans.tables import table
from quirewright.session import spread
from quirewright.sources import artifacts as A

#: Gate candidates that the calibration replays: name, least mean confidence, least share of confident words, confident from.
CANDIDATES = [("base", 65.0, 0.70, 60.0), ("strict", 80.0, 0.85, 70.0), ("mean_only", 72.5, 0.0, 0.0), ("loose", 50.0, 0.40, 50.0), ("words_only", 0.0, 0.90, 65.0)]

QUERIES = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _signals(c: str) -> str:
    words = f"list_filter(string_split({D.collapsed(c)}, ' '), lambda w: w <> '')"
    plain = f"regexp_replace(coalesce({c}, ''), '{D._SPACE}', '', 'g')"
    unprintable = r"[^\p{L}\p{M}\p{N}\p{P}\p{S}\p{Z}]|\x{FFFD}"
    symbol = r"[^\p{L}\p{N}\p{M}_''\-.,:/()\[\]{}%+*=#।॥]"
    good = f"list_filter({words}, lambda w: regexp_matches(w, '[\\p{{L}}\\p{{N}}]') AND length(w) <= 64 AND len(regexp_extract_all(w, '{symbol}')) / length(w) <= 0.30)"
    return f"""length({D.collapsed(c)}) AS chars, len({words}) AS word_count,
        CASE WHEN length({plain}) > 0 THEN len(regexp_extract_all({plain}, '{unprintable}')) / length({plain}) ELSE 0.0 END AS garbage_ratio,
        len(regexp_extract_all(coalesce({c}, ''), '\\p{{Co}}')) AS private_use_count,
        CASE WHEN len({words}) > 0 THEN len({good}) / len({words}) ELSE 0.0 END AS plausible_word_ratio"""


@query(f"SELECT doc_id, {_signals('text')} FROM documents")
def page_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", R.text_signals("text").alias("s")).select("doc_id", "s.*")


_CLASS = """CASE WHEN u AND NOT d THEN 'DIGITAL' WHEN u THEN 'MIXED' WHEN coalesce(n > 0, false) OR d THEN 'SCANNED' ELSE 'OCR_NEEDED' END"""
_CLASSIFIED = f"""SELECT delivery_id, job_id, {_CLASS} AS classification FROM (
    SELECT *, chars >= 80 AND word_count >= 12 AND garbage_ratio <= 0.05 AS u, coalesce(a >= 0.55, false) AS d FROM (
    SELECT delivery_id, job_id, signals.image_count AS n, signals.image_area_ratio AS a, {_signals('native_text')} FROM pages))"""


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = spread(table(spark, sf_dir, "pages").select("delivery_id", "job_id", "native_text", "signals"))
    return p.select("delivery_id", "job_id", R.classify(R.text_signals("native_text"), F.col("signals.image_count"), F.col("signals.image_area_ratio")).alias("classification"))


@query(f"SELECT delivery_id, classification FROM ({_CLASSIFIED})")
def page_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).select("delivery_id", "classification")


@query(f"SELECT job_id, classification, count(*) AS pages FROM ({_CLASSIFIED}) GROUP BY ALL")
def classification_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).groupBy("job_id", "classification").agg(F.count("*").alias("pages"))


def gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spread(table(spark, sf_dir, "calibration_pages")).withColumn("signals", R.text_signals("tesseract_text"))
    return c.select("page_key", "expected_auto_accept", "signals", "confidences", "lang")


_KNOWN = "list_filter(coalesce(confidences, []), lambda c: c IS NOT NULL)"
_REASONS = f"""list_filter([CASE WHEN chars < 20 THEN 'too_few_characters' END, CASE WHEN word_count < 4 THEN 'too_few_words' END,
    CASE WHEN n = 0 THEN 'no_word_confidences' END, CASE WHEN mean < 65 THEN 'low_mean_confidence' END, CASE WHEN ratio < 0.7 THEN 'low_confident_word_ratio' END,
    CASE WHEN garbage_ratio > 0.08 THEN 'high_garbage_ratio' END, CASE WHEN plausible_word_ratio < 0.7 THEN 'low_word_plausibility' END], lambda r: r IS NOT NULL)"""
_GATE = f"""SELECT page_key, {_REASONS} AS reasons, n FROM (SELECT *, len(k) AS n, list_avg(k) AS mean, CASE WHEN len(k) > 0 THEN len(list_filter(k, lambda c: c >= 60)) / len(k) ELSE 0.0 END AS ratio
    FROM (SELECT page_key, {_KNOWN} AS k, {_signals('tesseract_text')} FROM calibration_pages))"""


@query(f"SELECT page_key, len(reasons) = 0 AS accepted, array_to_string(reasons, ',') AS reasons, n AS word_confidence_count FROM ({_GATE})")
def ocr_quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = gated(spark, sf_dir).select("page_key", R.recognition_quality(F.col("signals"), F.col("confidences")).alias("q"))
    return q.select("page_key", "q.accepted", F.array_join("q.rejection_reasons", ",").alias("reasons"), "q.word_confidence_count")


@query(f"SELECT reason, count(*) AS pages FROM (SELECT unnest(reasons) AS reason FROM ({_GATE})) GROUP BY reason")
def rejection_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = gated(spark, sf_dir).select(R.recognition_quality(F.col("signals"), F.col("confidences")).alias("q"))
    return q.select(F.explode("q.rejection_reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("pages"))


_CAND = ", ".join(f"('{n}', {m}, {r}, {w})" for n, m, r, w in CANDIDATES)
_REPLAY = f"""SELECT candidate, coalesce(expected_auto_accept, false) AS want,
    chars >= 20 AND word_count >= 4 AND garbage_ratio <= 0.08 AND plausible_word_ratio >= 0.7 AND len(k) > 0
    AND coalesce(list_avg(k) >= m AND len(list_filter(k, lambda c: c >= w)) / len(k) >= r, false) AS ok
    FROM (SELECT expected_auto_accept, {_KNOWN} AS k, {_signals('tesseract_text')} FROM calibration_pages) p, (VALUES {_CAND}) v(candidate, m, r, w)"""
_CONFUSION = f"""SELECT *, safe_accepted + false_accepts AS accepted, round_even((safe_accepted + false_accepts) / pages, 6) AS coverage,
    CASE WHEN false_accepts + unsafe_rejected > 0 THEN round_even(false_accepts / (false_accepts + unsafe_rejected), 6) END AS false_accept_rate
    FROM (SELECT candidate, count(*) AS pages, count(*) FILTER (WHERE ok AND want) AS safe_accepted, count(*) FILTER (WHERE ok AND NOT want) AS false_accepts,
    count(*) FILTER (WHERE NOT ok AND want) AS false_rejects, count(*) FILTER (WHERE NOT ok AND NOT want) AS unsafe_rejected FROM ({_REPLAY}) GROUP BY candidate)"""


def _confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.confusion(R.gate_replay(gated(spark, sf_dir), CANDIDATES), "expected_auto_accept")


@query(_CONFUSION)
def gate_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _confusion(spark, sf_dir)


@query(f"""WITH c AS ({_CONFUSION}) SELECT candidate, accepted, false_accepts, NOT EXISTS (SELECT 1 FROM c d WHERE d.false_accepts <= c.false_accepts AND d.accepted >= c.accepted
    AND (d.false_accepts < c.false_accepts OR d.accepted > c.accepted)) AS on_frontier FROM c""")
def pareto_frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.pareto_frontier(_confusion(spark, sf_dir)).select("candidate", "accepted", "false_accepts", "on_frontier")


@query(f"SELECT candidate, coverage, false_accepts FROM ({_CONFUSION}) ORDER BY coverage DESC, false_accepts, candidate LIMIT 1")
def selected_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.selected(_confusion(spark, sf_dir)).select("candidate", "coverage", "false_accepts")


_DONE = "lower(trim(status)) = 'complete'"
_LATEST = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id, page ORDER BY delivered_at DESC NULLS LAST, delivery_id DESC) AS rn FROM pages WHERE {_DONE}) WHERE rn = 1"


#: What a document's summary counts.
_SUMMED = ("classification", "outcome", "engine", "escalation_reason", "tesseract_quality")


def _latest(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return E.latest_complete(table(spark, sf_dir, "pages"), ["job_id", "page"], ["delivered_at", "delivery_id"], list(columns))


@query(f"SELECT job_id, page, delivery_id, engine, outcome FROM ({_LATEST})")
def manifest_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _latest(spark, sf_dir, "delivery_id", "engine", "outcome").select("job_id", "page", "delivery_id", "engine", "outcome")


@query(f"SELECT DISTINCT job_id, page FROM pages p WHERE NOT EXISTS (SELECT 1 FROM pages d WHERE {_DONE.replace('status', 'd.status')} AND d.job_id = p.job_id AND d.page = p.page)")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    done = p.filter(F.lower(F.trim("status")) == "complete")
    return E.pending(p.select("job_id", "page").distinct(), done, ["job_id", "page"])


@query(f"""SELECT job_id, count(*) AS pages, {", ".join(f"count(*) FILTER (WHERE classification = '{s}') AS {s.lower()}" for s in ("DIGITAL", "SCANNED", "MIXED", "OCR_NEEDED"))},
    count(*) FILTER (WHERE engine = 'surya') AS surya_pages, count(*) FILTER (WHERE escalation_reason IS NOT NULL) AS escalated,
    count(*) FILTER (WHERE tesseract_quality.accepted) AS accepted, count(*) FILTER (WHERE NOT tesseract_quality.accepted) AS rejected, round_even(avg(tesseract_quality.mean_word_confidence), 3) AS mean_confidence FROM ({_LATEST}) GROUP BY job_id""")
def document_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.document_summary(_latest(spark, sf_dir, *_SUMMED), ["job_id"])


@query(f"SELECT job_id, outcome, count(*) AS pages FROM ({_LATEST}) GROUP BY ALL")
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sparse counts of a summary, a row each."""
    return _latest(spark, sf_dir, "outcome").groupBy("job_id", "outcome").agg(F.count("*").alias("pages"))


@query(f"""SELECT w.job_id AS job_id, wanted, coalesce(done, 0) AS done, CASE WHEN coalesce(done, 0) = wanted THEN 'complete' ELSE 'incomplete' END AS state FROM (SELECT job_id, count(DISTINCT page) AS wanted FROM pages WHERE job_id IS NOT NULL AND page IS NOT NULL GROUP BY job_id) w
    LEFT JOIN (SELECT job_id, count(*) AS done FROM ({_LATEST}) WHERE page IS NOT NULL GROUP BY job_id) d ON d.job_id = w.job_id""")
def document_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages that a job's log names, those that are done, and its state."""
    wanted = table(spark, sf_dir, "pages").filter("job_id IS NOT NULL AND page IS NOT NULL").groupBy("job_id").agg(F.count_distinct("page").alias("wanted"))
    done = _latest(spark, sf_dir).filter("page IS NOT NULL").groupBy("job_id").agg(F.count("*").alias("done"))
    rows = wanted.join(done, "job_id", "left").fillna(0, "done")
    return rows.withColumn("state", F.when(F.col("done") == F.col("wanted"), "complete").otherwise("incomplete"))


@query(f"""SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS pages, CAST(sum(s) AS BIGINT) AS surya_pages, count(*) FILTER (WHERE s = 0) AS without_surya
    FROM (SELECT job_id, count(*) AS n, count(*) FILTER (WHERE engine = 'surya') AS s FROM ({_LATEST}) GROUP BY job_id)""")
def batch_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = E.document_summary(_latest(spark, sf_dir, *_SUMMED), ["job_id"])
    return d.agg(F.count("*").alias("documents"), F.sum("pages").alias("pages"), F.sum("surya_pages").alias("surya_pages"), F.count_if(F.col("surya_pages") == 0).alias("without_surya"))


@query("SELECT job_id, CAST(('0x' || substr(sha256(source.file_name), 1, 16))::UBIGINT % 7 AS INT) AS shard FROM jobs WHERE source.file_name IS NOT NULL")
def shard_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "jobs").filter("source.file_name IS NOT NULL")
    return j.select("job_id", E.shard_of(F.col("source.file_name"), 7).alias("shard"))


@query("SELECT source.content_sha256 AS content_sha256, count(*) AS jobs, count(DISTINCT source.file_name) AS names FROM jobs WHERE source.content_sha256 IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def resubmitted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = table(spark, sf_dir, "jobs").select("source.content_sha256", "source.file_name").filter("content_sha256 IS NOT NULL")
    return j.groupBy("content_sha256").agg(F.count("*").alias("jobs"), F.count_distinct("file_name").alias("names")).filter("jobs > 1")


@query("""WITH l AS (SELECT job_id, page, count(*) AS n FROM pending_surya_pages GROUP BY ALL), r AS (SELECT job_id, page, count(*) AS m FROM calibration_pages GROUP BY ALL),
    b AS (SELECT coalesce(l.job_id, r.job_id) AS job_id, coalesce(l.page, r.page) AS page, n, m FROM l FULL JOIN r ON l.job_id = r.job_id AND l.page = r.page)
    SELECT job_id, page, 'missing' AS problem FROM b WHERE m IS NULL UNION ALL SELECT job_id, page, 'unexpected' FROM b WHERE n IS NULL
    UNION ALL SELECT job_id, page, 'duplicate_left' FROM b WHERE n > 1 UNION ALL SELECT job_id, page, 'duplicate_right' FROM b WHERE m > 1""")
def page_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.page_alignment(table(spark, sf_dir, "pending_surya_pages"), table(spark, sf_dir, "calibration_pages"), ["job_id", "page"])


@query(f"SELECT doc_id, array_to_string({D.critical('text')}, '|') AS critical FROM documents")
def critical_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.array_join(T.critical_values("text"), "|").alias("critical"))


_BLOCKS = """SELECT result_id, prediction_no, CAST(block_no AS INT) AS block_no, b.label AS label, b.reading_order AS reading_order, b.html AS html FROM (
    SELECT result_id, prediction_no, unnest(blocks) AS b, generate_subscripts(blocks, 1) AS block_no FROM (
    SELECT result_id, CAST(generate_subscripts(predictions, 1) AS INT) AS prediction_no, unnest(predictions).blocks AS blocks FROM surya_results)) WHERE b IS NOT NULL"""


def _surya_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "surya_results").select("result_id", F.posexplode("predictions").alias("p", "x"))
    b = s.select("result_id", (F.col("p") + 1).alias("prediction_no"), F.posexplode("x.blocks").alias("q", "b")).filter("b IS NOT NULL")
    return b.select("result_id", "prediction_no", (F.col("q") + 1).alias("block_no"), "b.label", "b.reading_order", "b.html")


@query(f"SELECT result_id, prediction_no, block_no, {D.stripped('html')} AS text FROM ({_BLOCKS})")
def html_text_by_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _surya_blocks(spark, sf_dir).select("result_id", "prediction_no", "block_no", T.stripped_html("html").alias("text"))


@query(f"SELECT result_id, prediction_no, block_no, {D.html_lines('html')} AS text FROM ({_BLOCKS})")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _surya_blocks(spark, sf_dir).select("result_id", "prediction_no", "block_no", T.html_text("html").alias("text"))


_CELL = r"(?is)<(t[dh])((?:[\s/][^>]*)?)>(.*?)</t[dh]\s*>"
_INNER = r"regexp_replace(regexp_replace(regexp_extract(c, '" + _CELL + r"', 3), '(?i)<(?:br|p|div|li)(?:[\s/][^>]*)?>', chr(10), 'g'), '<[!?/a-zA-Z][^>]*>', '', 'g')"


@query(rf"""SELECT result_id, prediction_no, block_no, CAST(row_no AS INT) AS row_no, CAST(k - 1 AS INT) AS cell_no, trim(regexp_replace(regexp_replace({D.resolved(D.resolved(_INNER))}, '[ \t\f\v]+', ' ', 'g'), ' *\n *', chr(10), 'g'), ' ' || chr(10)) AS text,
    lower(regexp_extract(c, '{_CELL}', 1)) = 'th' AS is_header, greatest(1, coalesce(TRY_CAST(regexp_extract(c, '(?i)^<[^>]*rowspan\s*=\s*["'']?\s*(\d+)', 1) AS INT), 1)) AS rowspan, greatest(1, coalesce(TRY_CAST(regexp_extract(c, '(?i)^<[^>]*colspan\s*=\s*["'']?\s*(\d+)', 1) AS INT), 1)) AS colspan
    FROM (SELECT *, unnest(cells) AS c, generate_subscripts(cells, 1) AS k FROM (SELECT *, regexp_extract_all(r, '{_CELL}', 0) AS cells FROM (
    SELECT result_id, prediction_no, block_no, unnest(l) AS r, generate_subscripts(l, 1) - 1 AS row_no FROM (SELECT *, regexp_extract_all(regexp_extract(html, '(?is)<table\b.*?</table\s*>'), '(?is)<tr(?:[\s/][^>]*)?>(.*?)</tr\s*>', 1) AS l FROM ({_BLOCKS}) WHERE lower(html) LIKE '%<table%'))))""")
def html_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _surya_blocks(spark, sf_dir).filter(F.lower("html").contains("<table")).select("result_id", "prediction_no", "block_no", F.posexplode(T.html_table("html")).alias("row_no", "row"))
    return rows.select("result_id", "prediction_no", "block_no", "row_no", F.posexplode("row").alias("cell_no", "cell")).select("result_id", "prediction_no", "block_no", "row_no", "cell_no", "cell.*")


@query(f"SELECT {D.label('label')} AS block_type, count(*) AS blocks FROM ({_BLOCKS}) GROUP BY 1")
def block_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _surya_blocks(spark, sf_dir).groupBy(T.canonical_label("label").alias("block_type")).agg(F.count("*").alias("blocks"))


@query(f"SELECT result_id, prediction_no, block_no, CAST(row_number() OVER (PARTITION BY result_id, prediction_no ORDER BY reading_order NULLS LAST, block_no) AS INT) AS rank FROM ({_BLOCKS})")
def canonical_reading_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.reading_ordered(_surya_blocks(spark, sf_dir), ["result_id", "prediction_no"], at="block_no").select("result_id", "prediction_no", "block_no", "rank")


@query("""SELECT block_key FROM (SELECT *, lag(bbox[2]) OVER (PARTITION BY document_id, page ORDER BY block_key % 3, block_key) AS before, median(bbox[4] - bbox[2]) OVER (PARTITION BY document_id, page) AS h
    FROM structure_blocks WHERE len(bbox) = 4 AND document_id IS NOT NULL AND page IS NOT NULL) WHERE bbox[2] < before - greatest(4.0, 0.75 * h)""")
def vertical_backtracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Backtracks of pages that are read in a shuffled order, as the declared one has none."""
    b = table(spark, sf_dir, "structure_blocks").filter("document_id IS NOT NULL AND page IS NOT NULL").withColumn("rank", F.struct(F.col("block_key") % 3, "block_key"))
    return L.vertical_backtracks(b, ["document_id", "page"]).select("block_key")


@query(r"SELECT document_id, lower(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS line, count(DISTINCT page) AS pages FROM structure_blocks WHERE bbox[2] <= 0.15 * page_height AND length(text) > 0 GROUP BY ALL HAVING count(DISTINCT page) >= 2")
def repeated_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.repeated_edge_lines(table(spark, sf_dir, "structure_blocks"), "document_id")


@query(f"SELECT kind, count(*) AS lines FROM (SELECT {D.kind('line')} AS kind FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY kind")
def line_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy(T.line_kind("line").alias("kind")).agg(F.count("*").alias("lines"))


_INTER = "greatest(0.0, least(a.bbox[3], b.bbox[3]) - greatest(a.bbox[1], b.bbox[1])) * greatest(0.0, least(a.bbox[4], b.bbox[4]) - greatest(a.bbox[2], b.bbox[2]))"
_AREA = "(greatest(0.0, {0}.bbox[3] - {0}.bbox[1]) * greatest(0.0, {0}.bbox[4] - {0}.bbox[2]))"


@query(f"""SELECT left_region, right_region, share FROM (SELECT a.block_key AS left_region, b.block_key AS right_region, CASE WHEN least({_AREA.format('a')}, {_AREA.format('b')}) > 0 THEN {_INTER} / least({_AREA.format('a')}, {_AREA.format('b')}) END AS share
    FROM structure_blocks a JOIN structure_blocks b ON a.document_id = b.document_id AND a.page = b.page AND a.block_key < b.block_key) WHERE share >= 0.15""")
def overlapping_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "structure_blocks").withColumnRenamed("block_key", "region")
    return H.overlapping_regions(r, ["document_id", "page"]).select("left_region", "right_region", "share")


#: The same page's boxes moved down by so many points play the words that are laid into its regions.
SHIFT = 37.0


@query(f"""WITH w AS (SELECT document_id, page, block_key, [bbox[1], bbox[2] + {SHIFT}, bbox[3], bbox[4] + {SHIFT}] AS bbox FROM structure_blocks),
    s AS (SELECT a.block_key AS word, b.block_key AS region, (a.bbox[1] + a.bbox[3]) / 2 BETWEEN b.bbox[1] AND b.bbox[3] AND (a.bbox[2] + a.bbox[4]) / 2 BETWEEN b.bbox[2] AND b.bbox[4] AS inside,
    CASE WHEN {_AREA.format('a')} > 0 THEN {_INTER} / {_AREA.format('a')} ELSE 0.0 END AS covered FROM w a JOIN structure_blocks b ON a.document_id = b.document_id AND a.page = b.page),
    t AS (SELECT word, region, row_number() OVER (PARTITION BY word ORDER BY covered + CASE WHEN inside THEN 2.0 ELSE 0.0 END DESC, region) AS n FROM s WHERE inside OR covered >= 0.5)
    SELECT b.block_key AS word, t.region FROM structure_blocks b LEFT JOIN t ON t.word = b.block_key AND t.n = 1 WHERE b.document_id IS NOT NULL AND b.page IS NOT NULL""")
def word_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "structure_blocks").filter("document_id IS NOT NULL AND page IS NOT NULL")
    x = F.col("bbox")
    w = b.select("document_id", "page", F.col("block_key").alias("word"), F.array(x[0], x[1] + SHIFT, x[2], x[3] + SHIFT).alias("bbox"))
    return H.owned_words(w, b.withColumnRenamed("block_key", "region"), ["document_id", "page"]).select("word", "region")


_TURNED = """SELECT pending_id, reading_order, x0 + CASE r.page_rotation WHEN 90 THEN v WHEN 180 THEN w - u WHEN 270 THEN w - v ELSE u END AS x, y0 + CASE r.page_rotation WHEN 90 THEN h - u WHEN 180 THEN h - v WHEN 270 THEN u ELSE v END AS y FROM (
    SELECT *, b[i] * CASE WHEN r.page_rotation IN (90, 270) THEN h ELSE w END / r.raster_width AS u, b[j] * CASE WHEN r.page_rotation IN (90, 270) THEN w ELSE h END / r.raster_height AS v FROM (
    SELECT pending_id, r, r.pdf_bbox[1] AS x0, r.pdf_bbox[2] AS y0, r.pdf_bbox[3] - r.pdf_bbox[1] AS w, r.pdf_bbox[4] - r.pdf_bbox[2] AS h, t.reading_order AS reading_order, t.bbox AS b FROM (SELECT pending_id, raster AS r, unnest(tesseract_words) AS t FROM pending_surya_pages)), (VALUES (1, 2), (3, 2), (3, 4), (1, 4)) c(i, j)
    WHERE len(b) = 4 AND r.raster_width > 0 AND r.raster_height > 0 AND len(r.pdf_bbox) = 4)"""


@query(f"SELECT pending_id, reading_order, round(min(x), 6) AS x0, round(min(y), 6) AS y0, round(max(x), 6) AS x1, round(max(y), 6) AS y1 FROM ({_TURNED}) GROUP BY pending_id, reading_order")
def words_in_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words in the points of the page as it lies unrotated."""
    w = table(spark, sf_dir, "pending_surya_pages").select("pending_id", "raster", F.explode("tesseract_words").alias("w"))
    p = w.select("pending_id", "w.reading_order", G.box_to_points(F.col("w.bbox"), F.col("raster"), F.col("raster.page_rotation")).alias("b")).filter("b IS NOT NULL")
    return p.select("pending_id", "reading_order", *[F.round(F.col("b")[i], 6).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))])


@query(r"""SELECT pending_id, trim(w.text) AS text, w.bbox[1] AS x0, w.bbox[3] AS x1, CASE WHEN w.confidence >= 0 THEN w.confidence END AS confidence FROM (SELECT pending_id, unnest(tesseract_words) AS w FROM pending_surya_pages)
    WHERE trim(w.text) <> '' AND len(w.bbox) = 4""")
def tsv_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words written as a recogniser's TSV and parsed again."""
    p = table(spark, sf_dir, "pending_surya_pages")
    words = F.filter("tesseract_words", lambda w: w["text"].isNotNull() & (F.size(w["bbox"]) == 4))
    s = lambda x: F.coalesce(x.cast("string"), F.lit(""))
    b = lambda w, i: w["bbox"][i]
    line = lambda w: F.concat_ws("\t", F.lit("5"), F.lit("1"), F.lit("1"), F.lit("1"), F.lit("1"), s(w["reading_order"]), s(b(w, 0)), s(b(w, 1)), s(b(w, 2) - b(w, 0)), s(b(w, 3) - b(w, 1)), s(w["confidence"]), w["text"])
    tsv = F.concat(F.lit("level\tpage\n"), F.array_join(F.transform(words, line), "\n"))
    w = p.select("pending_id", F.explode(A.tsv_words(tsv)).alias("w"))
    return w.select("pending_id", "w.text", F.col("w.bbox")[0].alias("x0"), F.bround(F.col("w.bbox")[2], 9).alias("x1"), "w.confidence")


@query("""SELECT json_extract_string(structure_gate, '$.enabled') AS enabled, json_extract_string(structure_gate, '$.escalate') AS escalate, count(*) AS pages
    FROM pages WHERE structure_gate IS NOT NULL AND json_valid(structure_gate) GROUP BY ALL""")
def structure_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.try_parse_json("structure_gate")
    p = table(spark, sf_dir, "pages").filter(v.isNotNull())
    return p.groupBy(F.try_variant_get(v, "$.enabled", "string").alias("enabled"), F.try_variant_get(v, "$.escalate", "string").alias("escalate")).agg(F.count("*").alias("pages"))


@query(f"""SELECT job_id, CAST((page - 1) // 256 AS INT) AS part_no, md5(string_agg('--- Page ' || page || ' ---' || chr(10) || coalesce(text, ''), chr(10) ORDER BY page, coalesce(text, ''))) AS digest FROM ({_LATEST}) WHERE page > 0 GROUP BY job_id, 2""")
def combined_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.page_texts(_latest(spark, sf_dir, "text").filter("page > 0"), ["job_id"]).select("job_id", "part_no", F.md5("text").alias("digest"))


_ISSUES = {
    "bad_page": "page > 0", "bad_digest": "regexp_matches(source_sha256, '^[0-9a-f]{64}$')", "unknown_engine": "engine IN ('pymupdf', 'tesseract5', 'surya', 'none')",
    "native_without_text": "outcome IS DISTINCT FROM 'native_text_accepted' OR (engine = 'pymupdf' AND route = 'native_text')", "tesseract_without_quality": "outcome IS DISTINCT FROM 'tesseract_accepted' OR tesseract_quality.accepted",
    "escalated_without_reason": "outcome IS DISTINCT FROM 'surya_escalated' OR escalation_reason IN ('quality', 'structure')",
}


@query(" UNION ALL ".join(f"SELECT delivery_id, '{code}' AS code FROM pages WHERE NOT coalesce({ok}, false)" for code, ok in _ISSUES.items()))
def verification_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark_sql = {k: v.replace("regexp_matches(source_sha256, '^[0-9a-f]{64}$')", "source_sha256 RLIKE '^[0-9a-f]{64}$'") for k, v in _ISSUES.items()}
    return E.issues(table(spark, sf_dir, "pages"), ["delivery_id"], {k: F.expr(v) for k, v in spark_sql.items()})


@query(f"""WITH e AS (SELECT job_id, engine, avg(tesseract_quality.mean_word_confidence) AS m FROM ({_LATEST}) GROUP BY ALL), a AS (SELECT job_id, m FROM e WHERE engine = 'tesseract5'), b AS (SELECT job_id, m FROM e WHERE engine = 'surya')
    SELECT a.job_id, CASE WHEN a.m IS NULL OR b.m IS NULL THEN 'unavailable' WHEN a.m = b.m THEN 'tie' WHEN a.m > b.m THEN 'tesseract5' ELSE 'surya' END AS winner FROM a JOIN b ON a.job_id = b.job_id""")
def paired_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _latest(spark, sf_dir, "engine", "tesseract_quality").groupBy("job_id", "engine").agg(F.avg("tesseract_quality.mean_word_confidence").alias("m"))
    a, b = (e.filter(F.col("engine") == x).select("job_id", F.col("m").alias(x)) for x in ("tesseract5", "surya"))
    return a.join(b, "job_id").select("job_id", M.winner(F.col("tesseract5"), F.col("surya"), "tesseract5", "surya", lower_wins=False).alias("winner"))


@query("""SELECT lang, round_even(avg(c), 2) AS confidence_avg, round_even(max(c), 2) AS confidence_peak FROM (SELECT lang, unnest(confidences) AS c FROM calibration_pages) GROUP BY lang""")
def confidence_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "calibration_pages").select("lang", F.explode("confidences").alias("confidence"))
    return E.resource_summary(c, ["lang"], ["confidence"])


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Blocks of each page as reference, and as recognised: misread, moved, in the opposite order, and every seventh lost."""
    b = table(spark, sf_dir, "structure_blocks").filter("length(text) > 0 AND document_id IS NOT NULL AND page IS NOT NULL")
    b = L.reading_ordered(b, ["document_id", "page"], at="block_key").withColumnRenamed("rank", "block").withColumn("block_type", T.canonical_label("block_type"))
    x = F.col("bbox")
    moved = F.when(F.size(x) == 4, F.array(x[0] + 5, x[1] + 5, x[2] + 5, x[3] + 5))
    tokens = lambda t: T.tokens(T.reference_text(t))
    ref = b.select("document_id", "page", "block", tokens("text").alias("tokens"), "bbox", "block_type")
    opposite = F.count("*").over(Window.partitionBy("document_id", "page")) - F.col("block") + 1
    hyp = b.filter("block_key % 7 <> 0").select("document_id", "page", opposite.cast("int").alias("block"), tokens(F.translate("text", "lo", "10")).alias("tokens"), moved.alias("bbox"), "block_type")
    return ref, hyp


@query()
def block_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = ["document_id", "page"]
    return X.assigned(X.candidates(*_sides(spark, sf_dir), page), page).select(*page, "ref", "hyp", "jaccard", "iou")


@query()
def reading_order_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = ["document_id", "page"]
    ref, hyp = _sides(spark, sf_dir)
    number = lambda df, name: df.groupBy(*page).agg(F.count("*").alias(name))
    counts = number(ref, "refs").join(number(hyp, "hyps"), page, "left").fillna(0, "hyps")
    return X.order_scores(X.assigned(X.candidates(ref, hyp, page), page), page, counts)


@query()
def structure_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = ["document_id", "page"]
    ref, hyp = _sides(spark, sf_dir)
    return X.structure_scores(X.assigned(X.candidates(ref, hyp, page, same_type=True), page), ref, hyp, page)


@query()
def visual_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = table(spark, sf_dir, "pending_surya_pages").select("pending_id", F.explode("tesseract_words").alias("w")).select("pending_id", "w.text", "w.bbox")
    return L.stacked_paragraphs(L.page_lines(w, ["pending_id"]), ["pending_id"])


@query("""SELECT date_trunc('hour', delivered_at AT TIME ZONE 'UTC') AS hour, lower(status) AS status, count(*) AS deliveries FROM pages GROUP BY ALL""")
def hourly_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    return p.groupBy(F.date_trunc("hour", F.col("delivered_at").cast("timestamp_ntz")).alias("hour"), F.lower("status").alias("status")).agg(F.count("*").alias("deliveries"))


_NAMED = "coalesce(CASE WHEN trim(b.label) <> '' THEN b.label END, CASE WHEN trim(b.raw_label) <> '' THEN b.raw_label END, 'Text')"


@query(f"""SELECT result_id, prediction_no, CAST(row_number() OVER (PARTITION BY result_id, prediction_no ORDER BY o NULLS LAST, pos) AS INT) AS rank, block_type, text, skipped, failed FROM (
    SELECT result_id, prediction_no, pos, b.reading_order AS o, {D.label(_NAMED)} AS block_type, {D.html_lines('b.html')} AS text, coalesce(b.error, false) AS failed, coalesce(b.skipped, false) AS skipped FROM (SELECT result_id, prediction_no, unnest(blocks) AS b, generate_subscripts(blocks, 1) AS pos FROM (
    SELECT result_id, CAST(generate_subscripts(predictions, 1) AS INT) AS prediction_no, unnest(predictions).blocks AS blocks FROM surya_results)) WHERE b IS NOT NULL)
    WHERE text <> '' OR failed OR skipped OR coalesce(block_type IN ('chart', 'diagram', 'figure', 'image', 'picture'), false)""")
def layout_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.layout_blocks(table(spark, sf_dir, "surya_results"), ["result_id"]).select("result_id", "prediction_no", "rank", "block_type", "text", "skipped", "failed")


_SETTINGS = "(SELECT job_id, j.key AS setting, j.value ->> '$' AS value FROM jobs, json_each(to_json(config)) j WHERE (j.value ->> '$') IS NOT NULL)"


@query(f"""WITH s AS {_SETTINGS}, u AS (SELECT setting, value AS usual FROM (SELECT setting, value, row_number() OVER (PARTITION BY setting ORDER BY count(*) DESC, value DESC) AS n FROM s GROUP BY setting, value) WHERE n = 1)
    SELECT setting, job_id, value, usual FROM s JOIN u USING (setting) WHERE value <> usual""")
def configuration_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.configuration_drift(table(spark, sf_dir, "jobs"), "job_id", "config")


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recognised words of pending pages, one a row, with their page's size."""
    p = table(spark, sf_dir, "pending_surya_pages").filter("document_id IS NOT NULL AND page IS NOT NULL")
    w = p.select("document_id", "page", F.col("raster.raster_height").cast("double").alias("page_height"), F.explode("tesseract_words").alias("w"))
    return w.select("document_id", "page", "page_height", "w.text", "w.bbox")


@query()
def structured_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Y.structured_pages(_words(spark, sf_dir), ["document_id", "page"], "document_id")


@query()
def structure_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over aligned columns and columns of text of each pending page; words at one height are one line, either half of a page is a block."""
    p = table(spark, sf_dir, "pending_surya_pages")
    row = lambda w: (F.floor(F.get(w["bbox"], F.lit(1)) / 10) + 1).cast("int")
    line = lambda w: F.struct(F.lit(1).alias("block"), F.lit(1).alias("paragraph"), row(w).alias("line"), w["bbox"].alias("bbox"))
    columns = Y.aligned_column_evidence(F.transform("tesseract_words", line), F.col("raster.raster_width"), F.col("raster.raster_height"))
    w = p.select("pending_id", "raster", F.explode("tesseract_words").alias("w"))
    half = F.when(F.get("w.bbox", F.lit(0)) + F.get("w.bbox", F.lit(2)) < F.col("raster.raster_width"), 1).otherwise(2)
    words = w.select("pending_id", half.alias("block"), row(F.col("w")).alias("line"), "w.bbox", F.col("raster.raster_width").alias("page_width"), F.col("raster.raster_height").alias("page_height"))
    sides = L.text_columns(words, ["pending_id"]).groupBy("pending_id").agg(F.collect_list(F.struct("left_block", "right_block")).alias("t"))  # one pair a page at most
    gated = p.select("pending_id", columns.alias("c")).join(sides, "pending_id", "left").select("pending_id", Y.structure_gate(F.col("c"), F.col("t")).alias("g"))
    return gated.select("pending_id", F.array_join("g.reasons", ",").alias("reasons"), "g.escalate")


@query("SELECT artifact_id, sha256(artifact_json) AS digest, length(artifact_json) AS chars, json_valid(artifact_json) AS valid FROM rich_artifacts WHERE artifact_json IS NOT NULL")
def artifact_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "rich_artifacts").filter("artifact_json IS NOT NULL")
    return a.select("artifact_id", F.sha2("artifact_json", 256).alias("digest"), F.length("artifact_json").alias("chars"), F.try_parse_json("artifact_json").isNotNull().alias("valid"))


@query(f"""SELECT job_id, CAST((page - 1) // 256 AS INT) AS part_no, count(*) AS page_count, CAST(min(page) AS INT) AS first_page, arg_min(engine, page) AS first_engine, md5(string_agg(page || ':' || coalesce(engine, '') || ':' || coalesce(outcome, '') || ':' || coalesce(text, ''), '|' ORDER BY page)) AS digest FROM ({_LATEST}) WHERE page > 0 GROUP BY job_id, 2""")
def exported_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each export read back: its counts, its first page, and a digest of what its pages say."""
    d = Y.exported_pages(_latest(spark, sf_dir, "engine", "outcome", "route", "text").filter("page > 0"), ["job_id"], ["page", "engine", "outcome", "route", "text"])
    x = F.from_json("document", "struct<page_count:bigint,pages:array<struct<page:int,engine:string,outcome:string,text:string>>>")
    said = lambda p: F.concat_ws(":", p["page"].cast("string"), F.coalesce(p["engine"], F.lit("")), F.coalesce(p["outcome"], F.lit("")), F.coalesce(p["text"], F.lit("")))
    return d.select("job_id", "part_no", x.alias("x")).select("job_id", "part_no", "x.page_count", F.col("x.pages")[0]["page"].alias("first_page"), F.col("x.pages")[0]["engine"].alias("first_engine"), F.md5(F.array_join(F.transform("x.pages", said), "|")).alias("digest"))
