"""Checks of published pages as issue rows: blocks, records by their outcome, artifacts against the log, combined text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirewright.functions import geometry as G
from quirewright.operators import evidence as E

#: The engine and the route that each outcome asks for (fixed values).
OUTCOMES = {
    "native_text_accepted": ("pymupdf", "native_text"),
    "tesseract_accepted": ("tesseract5", "tesseract"),
    "tesseract_rejected_no_fallback": ("none", "tesseract"),
    "surya_primary": ("surya", "surya"),
    "surya_escalated": ("surya", "tesseract"),
}


def block_issues(blocks: DataFrame, page: list[str], key: str, page_box: Column) -> DataFrame:
    """page, key, code of each block that breaks a rule; key is null for rules of the whole page.

    A block needs an order; its box, if it has one, must be finite, ordered and within the page; the orders of a page
    must run from ``first`` on without gaps or repeats.
    """
    rows = blocks.withColumn("_box", page_box)
    checks = {"invalid_block_order": F.col("reading_order").isNotNull(), "invalid_block_bbox": F.col("bbox").isNull() | G.inside_page(F.col("bbox"), F.col("_box"))}
    own = E.issues(rows, [*page, key], checks)
    kind = blocks.schema[key].dataType.simpleString()
    orders = blocks.filter("reading_order IS NOT NULL").groupBy(*page).agg(F.count("*").alias("n"), F.count_distinct("reading_order").alias("d"), F.min("reading_order").alias("a"), F.max("reading_order").alias("z"))
    gaps = orders.filter("n <> d OR a NOT IN (0, 1) OR z - a + 1 <> n").select(*page, F.lit(None).cast(kind).alias(key), F.lit("noncontiguous_block_order").alias("code"))
    return own.unionByName(gaps)


def order_report(blocks: DataFrame, page: list[str]) -> DataFrame:
    """Per page: blocks, whether their ranks run 1..N, the tolerance of backtracks and their number."""
    boxed = F.size("bbox") == 4
    height = F.when(boxed, F.col("bbox")[3] - F.col("bbox")[1])
    w = Window.partitionBy(*page)
    before = F.last(F.when(boxed, F.col("bbox")[1]), ignorenulls=True).over(w.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1))
    rows = blocks.withColumns({"_h": height, "_before": before}).withColumn("_tolerance", F.greatest(F.lit(4.0), 0.75 * F.median("_h").over(w)))
    back = F.coalesce(boxed & (F.col("bbox")[1] < F.col("_before") - F.col("_tolerance")), F.lit(False))
    run = (F.min("rank") == 1) & (F.max("rank") == F.count("*")) & (F.count_distinct("rank") == F.count("*"))
    return rows.withColumn("_back", back).groupBy(*page).agg(F.count("*").alias("blocks"), run.alias("contiguous"), F.max("_tolerance").alias("tolerance"), F.count_if("_back").alias("backtracks"))


def outcome_issues(records: DataFrame, key: list[str], fallback: Column | None = None, primary: Column | None = None) -> DataFrame:
    """key, code of each record that lacks what its outcome asks for: engine and route, evidence, settings, batch.

    ``fallback`` and ``primary`` are the job's settings; where they are null or not given, rules about them pass.
    """
    o, q = F.col("outcome"), F.col("tesseract_quality")
    is_ = lambda name: o.eqNullSafe(F.lit(name))
    unless = lambda name, ok: ~is_(name) | F.coalesce(ok, F.lit(False))
    setting = lambda c, value: c.isNull() | (c == value) if c is not None else F.lit(True)
    checks = {f"{name}_route": unless(name, (F.col("engine") == engine) & (F.col("route") == route)) for name, (engine, route) in OUTCOMES.items()}
    checks |= {
        "unknown_outcome": F.coalesce(o.isin(*OUTCOMES), F.lit(False)),
        "tesseract_quality": unless("tesseract_accepted", q["accepted"]),
        "compact_text": unless("tesseract_rejected_no_fallback", F.col("text") == ""),
        "compact_setting": unless("tesseract_rejected_no_fallback", setting(fallback, "none")),
        "primary_provenance": unless("surya_primary", (F.col("classifier_route") == "tesseract") & (F.col("escalation_reason") == "primary")),
        "primary_evidence": unless("surya_primary", q.isNull()),
        "primary_setting": unless("surya_primary", setting(primary, "surya")),
        "escalation_evidence": unless("surya_escalated", q.isNotNull()),
        "escalation_reason": unless("surya_escalated", F.col("escalation_reason").isin("quality", "structure")),
        "escalation_setting": unless("surya_escalated", setting(fallback, "surya")),
        "surya_batch": ~o.isin("surya_primary", "surya_escalated") | F.col("surya_batch").isNotNull() | o.isNull(),
    }
    return E.issues(records, key, checks)


def published_issues(artifact: DataFrame, log: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """key, code, left, right: pages that only the artifact or only the log has, and columns in which the two differ."""
    missing = E.page_alignment(artifact, log, key).filter("problem IN ('missing', 'unexpected')")
    text = lambda: F.lit(None).cast("string")
    code = F.when(F.col("problem") == "missing", "page_not_in_log").otherwise("page_not_published")
    differing = E.differing(artifact, log, key, columns).select(*key, F.concat(F.col("column"), F.lit("_differs")).alias("code"), "left", "right")
    return missing.select(*key, code.alias("code"), text().alias("left"), text().alias("right")).unionByName(differing)


def batch_issues(records: DataFrame, batches: DataFrame, key: list[str]) -> DataFrame:
    """key, code of recognised pages whose batch holds no raw result of theirs; ``batches`` has the key of every raw result."""
    wanted = records.filter("surya_batch IS NOT NULL")
    return wanted.join(batches.select(*key).distinct(), key, "left_anti").select(*key, F.lit("raw_result_missing").alias("code"))


def verdict(issues: DataFrame, document: list[str], strict: bool = True) -> DataFrame:
    """Per document: errors, warnings, and whether it is valid. Unless ``strict``, pages that aren't done are warnings."""
    soft = F.col("code").isin("page_not_published", "raw_result_missing") & F.lit(not strict)
    return issues.groupBy(*document).agg(F.count_if(~soft).alias("errors"), F.count_if(soft).alias("warnings")).withColumn("valid", F.col("errors") == 0)
