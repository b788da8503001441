"""Append-only page logs, summaries, evaluation aggregates, calibration, comparison and verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirewright.functions import measures as M


def latest_complete(log: DataFrame, key: list[str], sequence: list[str], columns: list[str], status: str = "status") -> DataFrame:
    """Per key the last record whose status is complete, whatever its letter case: the key and ``columns``.

    Which record is last is found from the key and the sequence alone. The wanted columns are joined to it by both, so
    that neither the scan nor a shuffle holds others; the sequence must tell the records of a key apart.
    """
    done = log.filter(F.lower(F.trim(F.col(status))) == "complete").select(*dict.fromkeys([*key, *sequence, *columns]))
    if not set(columns) - {*key, *sequence}:
        return done.groupBy(*key).agg(F.max(F.struct(*sequence)).alias("_s")).select(*key, "_s.*").select(*dict.fromkeys([*key, *columns]))
    last = done.groupBy(*key).agg(F.max(F.struct(*sequence)).alias("_s")).select(F.struct(*key, F.col("_s").alias("s")).alias("_k"))
    return done.join(last, F.struct(*key, F.struct(*sequence).alias("s")) == F.col("_k"), "left_semi").select(*dict.fromkeys([*key, *columns]))


def pending(wanted: DataFrame, completed: DataFrame, key: list[str]) -> DataFrame:
    """Rows still to do: those whose key no completed record has. Null keys are always to do."""
    return wanted.join(completed.select(*key).distinct(), key, "left_anti")


def document_summary(pages: DataFrame, document: list[str]) -> DataFrame:
    """Per document: pages, a dense count of classifications, a sparse one of outcomes, escalations, accepted and rejected recognitions, mean confidence, and whether all is done."""
    states = ("DIGITAL", "SCANNED", "MIXED", "OCR_NEEDED")
    q = F.col("tesseract_quality")
    return pages.groupBy(*document).agg(
        F.count("*").alias("pages"),
        *[F.count_if(F.col("classification") == s).alias(s.lower()) for s in states],
        F.count_if(F.col("engine") == "surya").alias("surya_pages"),
        F.count_if(F.col("escalation_reason").isNotNull()).alias("escalated"),
        F.count_if(q["accepted"]).alias("accepted"),
        F.count_if(~q["accepted"]).alias("rejected"),
        F.bround(F.avg(q["mean_word_confidence"]), 3).alias("mean_confidence"),
    )


def stratified_rates(rows: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Error metrics by several groupings in one pass: counts, summed distances and lengths, weighted and mean rates.

    Needs char_distance, ref_chars, hyp_chars, word_distance, ref_words, hyp_words. A grouping's absent keys are null and
    ``grouping_no`` tells the groupings apart.
    """
    keys = list(dict.fromkeys(k for s in sets for k in s))
    total = lambda c: F.sum(c).alias(c)
    kinds = F.explode(F.array(*[F.struct(F.lit(i).alias("no"), *[(F.col(k) if k in s else F.lit(None).cast("string")).alias(k) for k in keys]) for i, s in enumerate(sets)]))
    char_rate = M.error_rate(F.col("char_distance"), F.col("ref_chars"), F.col("hyp_chars"))
    out = (
        rows.withColumn("char_rate", char_rate).withColumn("_g", kinds)
        .groupBy(F.col("_g.no").alias("grouping_no"), *[F.col(f"_g.{k}").alias(k) for k in keys])
        .agg(F.count("*").alias("pages"), *[total(c) for c in ("char_distance", "ref_chars", "hyp_chars", "word_distance", "ref_words", "hyp_words")], F.avg("char_rate").alias("mean_char_rate"))
    )
    return out.withColumn("cer", M.error_rate(F.col("char_distance"), F.col("ref_chars"), F.col("hyp_chars"))).withColumn("wer", M.error_rate(F.col("word_distance"), F.col("ref_words"), F.col("hyp_words")))


def confusion(replayed: DataFrame, expected: str) -> DataFrame:
    """Per candidate: the four outcomes of accepted against ``expected`` (a null counts as not to accept), and rates."""
    want = F.coalesce(F.col(expected), F.lit(False))
    return (
        replayed.groupBy("candidate")
        .agg(
            F.count("*").alias("pages"),
            F.count_if(F.col("accepted") & want).alias("safe_accepted"),
            F.count_if(F.col("accepted") & ~want).alias("false_accepts"),
            F.count_if(~F.col("accepted") & want).alias("false_rejects"),
            F.count_if(~F.col("accepted") & ~want).alias("unsafe_rejected"),
        )
        .withColumn("accepted", F.col("safe_accepted") + F.col("false_accepts"))
        .withColumn("coverage", M.rate(F.col("accepted"), F.col("pages")))
        .withColumn("false_accept_rate", M.rate(F.col("false_accepts"), F.col("false_accepts") + F.col("unsafe_rejected")))
    )


def accepted_accuracy(replayed: DataFrame) -> DataFrame:
    """Per candidate: character error rate over all its pages and over those it accepts. Needs char_distance, ref_chars, hyp_chars."""
    names = ("char_distance", "ref_chars", "hyp_chars")
    sums = [x for c in names for x in (F.sum(c).alias(f"_all_{c}"), F.coalesce(F.sum(F.when(F.col("accepted"), F.col(c))), F.lit(0)).alias(f"_own_{c}"))]
    rate = lambda side: M.error_rate(*[F.col(f"_{side}_{c}") for c in names])
    return replayed.groupBy("candidate").agg(F.count_if("accepted").alias("accepted"), *sums).select("candidate", "accepted", rate("all").alias("cer"), F.when(F.col("accepted") > 0, rate("own")).alias("accepted_cer"))


def evidence_issues(pages: DataFrame, key: list[str], words: str, confidences: str, reviewed: str) -> DataFrame:
    """key, code: what a page lacks to serve for calibration: words, a confidence for every word, a review."""
    c = F.col(confidences)
    checks = {
        "no_words": F.coalesce(F.length(words), F.lit(0)) > 0, "no_confidences": F.coalesce(F.size(c), F.lit(0)) > 0,
        "missing_confidence": c.isNull() | ~F.exists(c, lambda x: x.isNull()), "not_reviewed": F.col(reviewed).isNotNull(),
    }
    return issues(pages, key, checks)


def pareto_frontier(candidates: DataFrame) -> DataFrame:
    """``candidates`` that none beats: fewer or as many false accepts, as many or more accepted, one of them strictly.

    A row is beaten exactly if fewer false accepts have as many accepted, or as many false accepts more. The window has no
    partitions: candidates are the short list that a replay was given, not data.
    """
    best = F.max("accepted").over(Window.orderBy("false_accepts").rangeBetween(Window.unboundedPreceding, -1))
    same = F.max("accepted").over(Window.partitionBy("false_accepts"))
    on = (F.col("accepted") == F.col("_same")) & (F.col("_best").isNull() | (F.col("_best") < F.col("accepted")))
    return candidates.withColumn("_best", best).withColumn("_same", same).withColumn("on_frontier", on).drop("_best", "_same")


def selected(candidates: DataFrame, most_false_accepts: int | None = None) -> DataFrame:
    """The candidate of widest coverage among those with few enough false accepts; ties by fewer of them, then by name."""
    ok = candidates if most_false_accepts is None else candidates.filter(F.col("false_accepts") <= most_false_accepts)
    return ok.orderBy(F.desc("coverage"), "false_accepts", "candidate").limit(1)


def page_alignment(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Keys that only one side has, or that a side has twice: key, problem (missing, unexpected, duplicate_left, duplicate_right)."""
    a = left.groupBy(*key).agg(F.count("*").alias("_l"))
    b = right.groupBy(*key).agg(F.count("*").alias("_r"))
    both = a.join(b, key, "full")
    problem = F.explode(
        F.array_compact(
            F.array(
                F.when(F.col("_r").isNull(), "missing"), F.when(F.col("_l").isNull(), "unexpected"),
                F.when(F.col("_l") > 1, "duplicate_left"), F.when(F.col("_r") > 1, "duplicate_right"),
            )
        )
    )
    return both.select(*key, problem.alias("problem"))


def differing(left: DataFrame, right: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Column by column comparison of two tables: key, column, left, right where the two differ, nulls alike."""
    pair = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"l.{c}").cast("string").alias("left"), F.col(f"r.{c}").cast("string").alias("right")) for c in columns])
    joined = left.select(*key, *columns).alias("l").join(right.select(*key, *columns).alias("r"), key)
    return joined.select(*key, F.explode(F.filter(pair, lambda p: ~p["left"].eqNullSafe(p["right"]))).alias("d")).select(*key, "d.*")


def issues(rows: DataFrame, key: list[str], checks: dict[str, Column]) -> DataFrame:
    """One row for each check that a row breaks: key, code. A check that is null is broken."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), code) for code, ok in checks.items()]))
    return rows.select(*key, F.explode(broken).alias("code"))


def resource_summary(samples: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """Rounded mean and peak of each value per group; null where all are null."""
    return samples.groupBy(*group).agg(*[x for v in values for x in (F.bround(F.avg(v), 2).alias(f"{v}_avg"), F.bround(F.max(v), 2).alias(f"{v}_peak"))])


def shard_of(path: Column, shards: int) -> Column:
    """Shard of a path by the first 64 bits of its digest; the same on every machine."""
    return F.pmod(F.conv(F.substring(F.sha2(path, 256), 1, 16), 16, 10).cast("decimal(20,0)"), F.lit(shards).cast("decimal(20,0)")).cast("int")
