"""Page signals, classification, and the gate on recognised text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirewright.functions import text as T


@dataclass(frozen=True)
class Gates:
    """Thresholds; inclusive as named."""

    min_native_chars: int = 80
    min_native_words: int = 12
    max_native_garbage: float = 0.05
    dominant_image_ratio: float = 0.55
    min_chars: int = 20
    min_words: int = 4
    min_mean_confidence: float = 65.0
    min_confident_ratio: float = 0.70
    confident_word: float = 60.0
    max_garbage: float = 0.08
    min_plausible: float = 0.70

    def __post_init__(self) -> None:
        ratios = (self.max_native_garbage, self.dominant_image_ratio, self.min_confident_ratio, self.max_garbage, self.min_plausible)
        if any(not 0 <= x <= 1 for x in ratios) or min(self.min_native_chars, self.min_native_words, self.min_chars, self.min_words) < 0:
            raise ValueError("gates: ratios lie in 0..1, counts aren't negative")


def text_signals(text: Column | str) -> Column:
    """Struct of the statistics that both gates use."""
    normal = T.collapse(text)
    return F.struct(
        F.length(normal).alias("chars"),
        F.size(T.words(text)).alias("word_count"),
        T.garbage_ratio(text).alias("garbage_ratio"),
        T.private_use_count(text).alias("private_use_count"),
        T.plausible_word_ratio(text).alias("plausible_word_ratio"),
    )


def classify(signals: Column, image_count: Column, image_area_ratio: Column, gates: Gates = Gates()) -> Column:
    """DIGITAL, MIXED, SCANNED or OCR_NEEDED from text statistics and images."""
    usable = (signals["chars"] >= gates.min_native_chars) & (signals["word_count"] >= gates.min_native_words) & (signals["garbage_ratio"] <= gates.max_native_garbage)
    dominant = F.coalesce(image_area_ratio >= gates.dominant_image_ratio, F.lit(False))
    return (
        F.when(usable & ~dominant, "DIGITAL").when(usable, "MIXED").when(F.coalesce(image_count > 0, F.lit(False)) | dominant, "SCANNED").otherwise("OCR_NEEDED")
    )


def recognition_quality(signals: Column, confidences: Column, gates: Gates = Gates()) -> Column:
    """Struct of accepted, rejection_reasons and the statistics decided on; decided unrounded, null confidences don't count."""
    known = F.filter(F.coalesce(confidences, F.array().cast("array<double>")), lambda c: c.isNotNull())
    n = F.size(known)
    mean = F.when(n > 0, F.aggregate(known, F.lit(0.0), lambda a, c: a + c) / n)
    confident = F.when(n > 0, F.size(F.filter(known, lambda c: c >= gates.confident_word)) / n).otherwise(0.0)
    reasons = F.array_compact(
        F.array(
            F.when(signals["chars"] < gates.min_chars, "too_few_characters"),
            F.when(signals["word_count"] < gates.min_words, "too_few_words"),
            F.when(n == 0, "no_word_confidences"),
            F.when(mean < gates.min_mean_confidence, "low_mean_confidence"),
            F.when(confident < gates.min_confident_ratio, "low_confident_word_ratio"),
            F.when(signals["garbage_ratio"] > gates.max_garbage, "high_garbage_ratio"),
            F.when(signals["plausible_word_ratio"] < gates.min_plausible, "low_word_plausibility"),
        )
    )
    return F.struct((F.size(reasons) == 0).alias("accepted"), reasons.alias("rejection_reasons"), n.alias("word_confidence_count"), mean.alias("mean_word_confidence"), confident.alias("confident_word_ratio"))


def gate_replay(pages: DataFrame, candidates: list[tuple[str, float, float, float]], gates: Gates = Gates()) -> DataFrame:
    """Every page under every candidate (name, mean confidence, confident ratio, confident word): candidate, accepted.

    Needs columns signals and confidences. The candidates are a literal array, exploded in place: no join at all.
    """
    given = F.array(*[F.struct(F.lit(n).alias("candidate"), F.lit(float(m)).alias("mean"), F.lit(float(r)).alias("ratio"), F.lit(float(w)).alias("word")) for n, m, r, w in candidates])
    rows = pages.withColumn("_c", F.explode(given))
    known = F.filter(F.coalesce("confidences", F.array().cast("array<double>")), lambda c: c.isNotNull())
    n = F.size(known)
    s = F.col("signals")
    mean = F.aggregate(known, F.lit(0.0), lambda a, c: a + c) / n
    ratio = F.size(F.filter(known, lambda c: c >= F.col("_c.word"))) / n
    good = (s["chars"] >= gates.min_chars) & (s["word_count"] >= gates.min_words) & (s["garbage_ratio"] <= gates.max_garbage) & (s["plausible_word_ratio"] >= gates.min_plausible)
    accepted = good & (n > 0) & F.coalesce((mean >= F.col("_c.mean")) & (ratio >= F.col("_c.ratio")), F.lit(False))
    return rows.withColumn("accepted", accepted).withColumn("candidate", F.col("_c.candidate")).drop("_c")
