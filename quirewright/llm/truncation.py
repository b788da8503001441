"""Texts cut by a field limit or in transfer.

Two kinds of evidence are combined for every document. Its length: for every source a right-censored log-normal is
fitted by maximum likelihood to the histogram of lengths, in code points and in bytes; where lengths pile up at a value
that the fitted density can't explain, that value is a candidate limit, and a document there has a censoring posterior,
the share of the pile that the density leaves unexplained. Its ending: what the text's last line is like, and whether its
last word stands inside other texts as a whole word, counted over all documents.

How much an ending says is not set by hand: the shares of endings among cut and among whole texts are estimated by EM
together with the share of cut texts at every limit and elsewhere in every source. The censoring posteriors anchor it:
how cut texts end is learnt at the limits, how whole ones end from all texts as far as they aren't cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quirewright.session import settled

#: A pile is looked for in windows of so many lengths that end at the limit: a mark or a word's rest may shorten or lengthen a value.
WINDOWS = (1, 4, 16)
#: Log likelihood that a limit must win, and the least documents of its pile.
LEAST_GAIN, LEAST_PILE = 9.0, 4
#: Share of cut texts away from any limit, as the prior has it, and the documents that it weighs; at a limit the censoring
#: posterior weighs as much as the endings of the pile's documents.
AWAY, AWAY_WEIGHT = 0.05, 8.0
#: Kinds of endings, states of the last word, and whether a mark stands behind it, with the documents of each that the prior counts as cut and as whole.
KINDS = {
    "sentence": (0.1, 5), "inner_stop": (0.3, 0.3), "broken": (1, 0.02), "table_cut": (0.5, 0.1), "reference_cut": (0.5, 0.1), "table": (0.2, 1), "line": (0.2, 2),
    "title": (0.2, 2), "title_last": (0.2, 1), "single": (0.2, 1), "prose": (4, 0.2), "none": (0.02, 1),
}
WORDS = {"known": (3, 6), "part": (3, 0.1), "strange": (1, 0.3), "new": (1, 1), "none": (1, 1)}
MARKS = {"bare": (5, 10), "marked": (1, 0.02)}
#: Documents that the words' shares over all kinds weigh against a kind's own.
WORD_WEIGHT = 10.0
#: Steps of EM, and the change of every log likelihood ratio below which it ends.
STEPS, SETTLED = 60, 0.01
#: Groups that EM sums at the driver (a kilobyte each); more are summed by a job a step.
GROUPS_HERE = 10_000
#: Endings that stop inside no word or sentence: no case, whatever the length.
FINISHED = ("sentence", "none")
#: Occurrences inside texts that make a word a known one, and those that make its beginnings telling.
KNOWN, FREQUENT = 1, 12
#: Times that a sentence goes on behind a word's full stop, and their share of the word's occurrences, that make it an abbreviation.
ABBREVIATED, ABBREVIATED_SHARE = 3, 0.5

_MARK = r"(?<!\s)\s*+(…|\.\.\.|\[\s*(\.\.\.|…|more|truncated|cut)\s*\]|\(\s*(\.\.\.|…|more|truncated|cut|continued|cont\.)\s*\)|<truncated>|--more--)$"
_STOP = r"([.!?।॥|]|\.\.\.)[\"'”’»)\]]*$"
# an initial, an abbreviation or a currency's whole units end in a point inside a sentence
_INNER_STOP = r"((^|[\s(])\p{Lu}\.|\b(Ref|No|Nr|p|pp|S|vol|Vol|cf|Dr|Mr|Mrs|St|z\.B|i\.e|e\.g)\.|\b(EUR|GBP|CHF|USD|Rs|INR)\s\d+\.)$"
_SMALL = r"(of|the|and|for|in|to|a|an|at|on|by|der|die|das|des|von|und|zu|für|im|am|de|du|la|le|les|et|en|à|d)"
_CAPITALISED = rf"^[\p{{Lu}}\p{{N}}(\"“][\p{{L}}\p{{M}}\p{{N}}.'’/()\"”–-]*[:,]?(\s+([\p{{Lu}}\p{{N}}&(–-][\p{{L}}\p{{M}}\p{{N}}.'’/()–-]*[:,]?|{_SMALL}))*$"
_LIST = r"^\s*([-*•–]|\(?\p{N}{1,3}[.)]|\(?[a-z][.)])\s+\S"
_TABLE = r"\s\|\s"
_COMMAND = r"^([$>#]\s*)?[a-z][\w./-]*(\s+\S+)*?\s--?[a-z]"
_FIELD = r"^\p{Lu}[\p{L} ]{1,24}:\s?\S"
_PLACE_DATE = r"^\P{Ll}[^\n]{1,60},\s+([^\n]{2,24}\s)?\d{4}$"
_REFERENCE = r"^\p{Lu}[\p{L}.]{1,10}\s[\p{Lu}\p{N}]+-\p{N}+/\p{Lu}$"
_REFERENCE_CUT = r"^Ref\.?(\s[\p{Lu}\p{N}]*(-(\p{N}+/?)?)?)?$"
_WORD = r"(?<![\p{L}\p{M}])[\p{L}\p{M}]++"  # tried once at each word's beginning: linear in runs of any length
_BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u200b\u200c\u200d\u2028\u2029\u202f\u205f\u3000\ufeff"
#: What every mark ends in, so that other texts needn't be searched for one.
_MARK_ENDS = ("…", "...", "]", ")", ">", "--")


def _ending(text: Column) -> dict[str, Column]:
    """Columns of a text's end: its last two lines and its last paragraph, whole, and its last word."""
    bare = F.rtrim(text, F.lit(_BLANKS))
    # only texts with the sign are rewritten, and only those that may hold a mark are searched for one
    bare = F.when(F.instr(bare, "\r") > 0, F.replace(F.replace(bare, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))).otherwise(bare)
    ends = F.lower(F.right(bare, F.lit(3)))
    unmarked = F.when(reduce(or_, [F.endswith(ends, F.lit(e)) for e in _MARK_ENDS]), F.regexp_replace(bare, _MARK, "")).otherwise(bare)
    return {"bare": bare, "unmarked": unmarked}


def _end_parts() -> dict[str, Column]:
    """The columns that follow from ``bare`` and ``unmarked``."""
    marked = F.length("unmarked") < F.length("bare")
    return {"marked": marked, "body": F.when(marked, F.rtrim("unmarked", F.lit(_BLANKS))).otherwise(F.col("bare"))}


def _end_lines() -> dict[str, Column]:
    """The columns that follow from ``body``."""
    body = F.col("body")
    last = F.substring_index(body, "\n", -1)
    two = F.substring_index(body, "\n", -2)
    return {
        "last_lines": two,
        "line": F.trim(last),
        "previous": F.when(F.instr(body, "\n") > 0, F.trim(F.substring_index(two, "\n", 1))),
        # from the text's end backwards to the last blank line
        "paragraph": F.trim(F.when(F.instr(body, "\n") > 0, F.regexp_replace(body, r"\A(?s:.*)\n[ \t]*\n\s*+", "")).otherwise(body)),
        "last_word": F.regexp_extract(last, rf"({_WORD})$", 1),
        "stop_word": F.regexp_extract(last, rf"({_WORD})\.$", 1),
    }


def _columns(line: Column) -> Column:
    return F.regexp_count(line, F.lit(_TABLE))


def ending_signs() -> dict[str, Column]:
    """What the whole last lines and the whole last paragraph show, as a few truth values that travel in place of the text."""
    line, previous, paragraph, body, lines = (F.col(c) for c in ("line", "previous", "paragraph", "body", "last_lines"))
    title = line.rlike(_CAPITALISED) & (F.length(line) <= 90) & ~F.lower(line).rlike(rf"(^|\s){_SMALL}$")
    table = line.rlike(_TABLE) | (F.coalesce(previous.rlike(_TABLE), F.lit(False)) & paragraph.contains(" | "))
    return {
        "blank": F.coalesce(F.length("bare") == 0, F.lit(True)),
        "broken": F.right("bare", F.lit(1)).rlike(r"[�\x{D800}-\x{DFFF}]$"),
        "stopped": lines.rlike(_STOP) & ~lines.rlike(_INNER_STOP),
        "table": table,
        "table_cut": F.coalesce(previous.rlike(_TABLE) & (_columns(previous) > _columns(line)), F.lit(False)) & (paragraph != line),
        "reference_cut": line.rlike(_REFERENCE_CUT) | line.rlike(r"^\P{Ll}[^\n]{1,60},\s+[\p{L}]+\s\d{1,3}$"),
        "line_kind": line.rlike(_LIST) | line.rlike(_COMMAND) | line.rlike(_FIELD) | line.rlike(_PLACE_DATE) | line.rlike(_REFERENCE) | line.rlike(r"_{3,}$"),
        "single": (F.instr(body, "\n") == 0) & (F.length(body) <= 60) & ~body.rlike(r"[.!?।|,;]\s"),
        "title": title,
        # inside a paragraph of prose: it has a finished sentence, or a line that isn't of the kinds above
        "prose_before": title & paragraph.rlike(r"(?U)[\p{L}\p{N}%)][.!?।|]\s") & ~table,
        "title_last": title & paragraph.contains("\n") & ~paragraph.rlike(r"(?U)[\p{Ll}\p{Lo}][.!?।|]\s"),
    }


def ending_kinds(df: DataFrame) -> DataFrame:
    """``df`` with ``ending``, a kind, the state of the last word and whether a mark stands behind it; needs the columns of ``ending_signs``, ``known`` and ``begins`` of the last word, ``abbreviation`` of the one before the stop."""
    word = F.col("last_word")
    state = (
        F.when(F.coalesce(F.length(word) == 0, F.lit(True)), "none")
        .when(F.col("known"), "known")
        .when(F.col("begins"), "part")  # never seen whole, but frequent words begin with it
        .when(word.rlike(r"^\p{Ll}"), "strange")
        .otherwise("new")
    )
    kind = (
        F.when(F.col("blank"), "none")
        .when(F.col("broken"), "broken")
        .when(F.col("stopped") & F.col("abbreviation") & (F.col("stop_word") != ""), "inner_stop")
        .when(F.col("stopped"), "sentence")
        .when(F.col("table_cut"), "table_cut")
        .when(F.col("reference_cut"), "reference_cut")
        .when(F.col("table"), "table")
        .when(F.col("line_kind"), "line")
        .when(F.col("title") & ~F.col("prose_before"), "title")
        .when(F.col("title_last"), "title_last")
        .when(F.col("single"), "single")
        .otherwise("prose")
    )
    return df.withColumn("ending", F.concat_ws(":", kind, state, F.when(F.col("marked"), "marked").otherwise("bare")))


def _fit(length: np.ndarray, count: np.ndarray, limit: float) -> tuple[float, float, float]:
    """Log likelihood, mean and deviation of log lengths when those at or above ``limit`` are only known to reach it."""
    x = np.log(length)
    free = length < limit
    n_free, n_cut = count[free].sum(), count[~free].sum()
    if n_free < 2:
        return -np.inf, 0.0, 1.0
    mu = np.average(x[free], weights=count[free])
    sd = max(0.05, math.sqrt(np.average((x[free] - mu) ** 2, weights=count[free])))
    edge = math.log(limit) if np.isfinite(limit) else np.inf
    for _ in range(60 if n_cut else 0):  # EM: the censored values' expected first and second moments
        z = (edge - mu) / sd
        h = math.exp(-0.5 * z * z) / math.sqrt(2 * math.pi) / max(1e-12, 0.5 * math.erfc(z / math.sqrt(2)))
        m1, m2 = mu + sd * h, mu * mu + sd * sd + sd * h * (edge + mu)
        new = (count[free] @ x[free] + n_cut * m1) / (n_free + n_cut)
        var = (count[free] @ x[free] ** 2 + n_cut * m2) / (n_free + n_cut) - new * new
        done = abs(new - mu) < 1e-5
        mu, sd = new, max(0.05, math.sqrt(max(var, 0.0)))
        if done:
            break
    density = -0.5 * ((x[free] - mu) / sd) ** 2 - math.log(sd * math.sqrt(2 * math.pi)) - x[free]
    tail = math.log(max(1e-300, 0.5 * math.erfc((edge - mu) / sd / math.sqrt(2)))) if n_cut else 0.0
    return float(count[free] @ density + n_cut * tail), mu, sd


def censoring_limits(length: np.ndarray, count: np.ndarray) -> list[tuple[int, int, float]]:
    """(from, to, posterior) of each pile of lengths that the fitted density doesn't explain.

    Lengths are positive and ascending. The density is fitted anew with the piles so far taken as censored, so that a
    pile doesn't bend the curve it is measured against.
    """
    total = count.sum()
    found: list[tuple[int, int, float]] = []
    at_limit = np.zeros(len(length), bool)
    # share of the values that any smooth density would put near a length: counted around it, the window itself left out
    heap = np.cumsum(np.r_[0, count])
    x = np.log(length)
    hi = np.arange(1, len(length) + 1)
    windows = []
    for width in WINDOWS:
        lo = np.searchsorted(length, length - width + 1)
        # the denser of both sides, so that neither the slope nor the top of a mode of its own looks like a pile
        reach = np.maximum(0.1 * length, 2 * width + 4)
        left = heap[lo] - heap[np.searchsorted(length, length - width + 1 - reach)]
        right = heap[np.searchsorted(length, length + reach, "right")] - heap[hi]
        windows.append((width, lo, heap[hi] - heap[lo], np.maximum(left, right) * width / reach))
    while not at_limit.all():  # each pile takes lengths away, so the search ends
        spare = ~at_limit
        limit = float(length[at_limit].min()) if at_limit.any() else np.inf
        _, mu, sd = _fit(length, count, limit) if np.isfinite(limit) and count[length < limit].sum() >= 8 else _fit(length[spare], count[spare], np.inf)
        best: tuple[float, int, int, float] | None = None
        for width, lo, pile, around in windows:
            fitted = total * width * np.exp(-0.5 * ((x - mu) / sd) ** 2) / (sd * math.sqrt(2 * math.pi)) / length
            expected = np.maximum(np.maximum(fitted, around), 1e-3 * width)
            gain = np.where(pile > expected, pile * np.log(np.maximum(pile, 1e-9) / expected) - (pile - expected), 0.0) - math.log(len(length) * len(WINDOWS))
            gain[(pile < LEAST_PILE) | at_limit | (length < 4 * width)] = 0.0
            k = int(gain.argmax())
            if gain[k] > LEAST_GAIN and (best is None or gain[k] > best[0]):
                best = float(gain[k]), int(lo[k]), k, float(max(0.0, 1 - expected[k] / pile[k]))
        if best is None:
            break
        _, a, z, posterior = best
        found.append((int(length[a]), int(length[z]), posterior))
        at_limit[a : z + 1] = True
    return found


def source_limits(lengths: DataFrame) -> DataFrame:
    """Piles of each source: source, unit, from_length, to_length, posterior. Needs columns source, chars, bytes."""
    # every length has its own count: a source of b bytes has at most sqrt(2 b) different ones
    histogram = (
        lengths.filter("chars > 0")
        .select("source", F.explode(F.array(*[F.struct(F.lit(c).alias("unit"), F.col(c).cast("bigint").alias("n")) for c in ("chars", "bytes")])).alias("x"))
        .groupBy("source", "x.unit", "x.n")
        .count()
    )

    def fit(key: tuple, t: pd.DataFrame) -> pd.DataFrame:
        t = t.sort_values("n")
        piles = censoring_limits(t["n"].to_numpy(float), t["count"].to_numpy(float))
        return pd.DataFrame([(t["source"].iloc[0], key[1], *p) for p in piles], columns=["source", "unit", "from_length", "to_length", "posterior"])

    return histogram.groupBy("source", "unit").applyInPandas(fit, "source string, unit string, from_length bigint, to_length bigint, posterior double")


#: Every kind with every state of the last word, without and with a mark.
CELLS = [f"{k}:{w}:{m}" for k in KINDS for w in WORDS for m in MARKS]


def _shares(counts: np.ndarray) -> np.ndarray:
    """Share of each cell among cut (row 0) and whole (row 1) texts, from their expected numbers and the prior's."""
    n = counts.reshape(2, len(KINDS), len(WORDS), len(MARKS))
    kind, word, mark = (n.sum(axes) + np.array(list(prior.values())).T for axes, prior in (((2, 3), KINDS), ((1, 3), WORDS), ((1, 2), MARKS)))
    word /= word.sum(1, keepdims=True)
    mark /= mark.sum(1, keepdims=True)
    within = (n.sum(3) + WORD_WEIGHT * word[:, None]) / (n.sum((2, 3))[:, :, None] + WORD_WEIGHT)
    return ((kind / kind.sum(1, keepdims=True))[:, :, None, None] * within[..., None] * mark[:, None, None]).reshape(2, -1)


def _cut_shares(n: np.ndarray, expected: np.ndarray, limit: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """Share of cut texts of each group (row of ``n``, documents by cell) by EM under fixed likelihood ratios of the cells."""
    expected = np.clip(expected, 0.005, 0.995)
    weight = np.where(limit, n.sum(1), AWAY_WEIGHT)
    share = expected.copy()
    for _ in range(60):
        odds = (share / (1 - share))[:, None] * ratio
        new = ((n * (odds / (1 + odds))).sum(1) + weight * expected) / (n.sum(1) + weight)
        done = np.abs(new - share).max(initial=0) < 1e-6
        share = np.clip(new, 1e-6, 1 - 1e-6)
        if done:
            break
    # a pile may be one of whole texts that are alike: how much better its endings fit cuts tells, if even odds were before
    gain = (n * np.log1p(share[:, None] * (ratio - 1))).sum(1)
    genuine = 1 / (1 + np.exp(-np.clip(gain, -500, 500)))
    return np.where(limit, np.clip(share * genuine, 1e-6, 1 - 1e-6), share)


_GROUP = ["source", "unit", "from_length"]


def estimated_endings(judged: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Groups of documents (those at a limit, or the rest of a source) with their ``share`` of cut texts, and the log likelihood ratio of being cut of each of ``CELLS``.

    One row a group and never more than the cells' numbers reach the driver. Needs columns source, ending, posterior,
    unit, from_length.
    """
    place = {c: i for i, c in enumerate(CELLS)}
    cell = F.element_at(F.create_map(*[x for k, i in place.items() for x in (F.lit(k), F.lit(i))]), F.col("ending"))
    counted = judged.groupBy(*_GROUP, cell.alias("cell")).agg(F.count("*").alias("n"), F.max("posterior").alias("posterior"))
    groups = counted.groupBy(*_GROUP).agg(F.max("posterior").alias("posterior"), F.map_from_entries(F.collect_list(F.struct("cell", "n"))).alias("by"))
    columns = F.transform(F.sequence(F.lit(0), F.lit(len(CELLS) - 1)), lambda c: F.coalesce(F.try_element_at("by", c), F.lit(0)).cast("double"))
    groups = settled(groups.select(*_GROUP, F.coalesce("posterior", F.lit(AWAY)).alias("expected"), columns.alias("n")), "ending-counts")

    # cuts at limits teach how cuts end: those in transfer fall anywhere too, and elsewhere nothing tells that a text was cut but its ending
    def totals(n: np.ndarray, expected: np.ndarray, limit: np.ndarray, ratio: np.ndarray) -> np.ndarray:
        odds = _cut_shares(n, expected, limit, ratio)
        cut = n * (q := (odds / (1 - odds))[:, None] * ratio) / (1 + q)
        return np.array([cut[limit].sum(0), (n - cut).sum(0)])

    def summed(ratio: np.ndarray) -> np.ndarray:
        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in frames:
                if len(f):
                    t = totals(np.stack(f["n"].to_numpy()), f["expected"].to_numpy(), f["limit"].to_numpy(bool), ratio)
                    yield pd.DataFrame({"cut": [t[0]], "whole": [t[1]]})

        parts = groups.select("n", "expected", F.col("unit").isNotNull().alias("limit")).mapInPandas(run, "cut array<double>, whole array<double>")
        row = parts.agg(*[F.array(*[F.coalesce(F.sum(F.col(c)[k]), F.lit(0.0)) for k in range(len(CELLS))]).alias(c) for c in ("cut", "whole")]).first()
        return np.array([row["cut"], row["whole"]], float)

    # few groups are counted here, more where they lie; the sums are the same
    held = groups.select("n", "expected", F.col("unit").isNotNull().alias("limit")).toPandas() if groups.count() <= GROUPS_HERE else None
    if held is not None:
        numbers = np.stack(held["n"].to_numpy()) if len(held) else np.zeros((0, len(CELLS)))
        summed = lambda ratio: totals(numbers, held["expected"].to_numpy(), held["limit"].to_numpy(bool), ratio)
    open_end = np.array([c.split(":")[0] not in FINISHED for c in CELLS])

    def ratios(counts: np.ndarray) -> np.ndarray:
        shares = _shares(counts)
        return np.where(open_end, shares[0] / shares[1], 1e-9)  # by definition a finished text wasn't cut, whatever its length

    ratio = ratios(np.zeros((2, len(CELLS))))
    for _ in range(STEPS):
        before, ratio = ratio, ratios(summed(ratio))
        if np.abs(np.log(ratio) - np.log(before)).max() < SETTLED:
            break

    def final(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if len(f):
                yield f[_GROUP].assign(share=_cut_shares(np.stack(f["n"].to_numpy()), f["expected"].to_numpy(), f["unit"].notna().to_numpy(), ratio))

    return groups.mapInPandas(final, "source string, unit string, from_length bigint, share double"), np.log(ratio)


def truncated_texts(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``key``, source, ending, posterior (of the length, null where it is at no limit) and ``cut`` for every row.

    Null, empty and blank texts aren't cut. A null source is a source of its own. Repeated rows are judged each; other
    columns aren't read. An empty table gives no rows.
    """
    rows = df.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{source}`").cast("string"), F.lit("")).alias("source"), F.col(f"`{text}`").cast("string").alias("text"))
    lengths = rows.select("source", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"))
    # words inside texts, with what stands behind them seen, so whole; a map-side sum leaves one row a word and task
    inside = rows.select(F.explode(F.regexp_extract_all("text", F.lit(rf"({_WORD}(?:\.(?=[,;]|\s+\p{{Ll}}))?)(?=[^�])"), 1)).alias("word"))
    inside = inside.select(F.rtrim("word", F.lit(".")).alias("word"), F.endswith("word", F.lit(".")).alias("goes_on")).groupBy("word").agg(F.count("*").alias("count"), F.count_if("goes_on").alias("goes_on"))
    begins = (
        inside.filter(F.col("count") >= FREQUENT)
        .filter(F.length("word") > 1)
        .select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda n: F.substring("word", F.lit(1), n))).alias("word"))
        .distinct()
        .select("word", F.lit(True).alias("begins"))
    )
    abbreviation = (F.col("goes_on") >= ABBREVIATED) & (F.col("goes_on") >= ABBREVIATED_SHARE * F.col("count"))
    words = inside.filter(F.col("count") >= KNOWN).select("word", F.lit(True).alias("known"), abbreviation.alias("abbreviation")).join(begins, "word", "full_outer")
    signs = ending_signs()
    ends = rows.withColumns(_ending(F.col("text"))).withColumns(_end_parts()).withColumns(_end_lines()).withColumns(signs)
    ends = ends.select("key", "source", F.length("text").alias("chars"), F.octet_length("text").alias("bytes"), "marked", *signs, "last_word", "stop_word")
    # a text that ends in neither a word nor a word's full stop needs none looked up; its key is spread, so that no task gets all of them
    looked_up = F.when(F.length("last_word") > 0, F.col("last_word")).otherwise(F.col("stop_word"))
    spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64("key", "chars", "bytes"), F.lit(4096)).cast("string"))
    ends = ends.withColumn("word", F.when(F.coalesce(F.length(looked_up) == 0, F.lit(True)), spread).otherwise(looked_up))
    # only the last words' own rows are wanted of the vocabulary; the documents' side carries what its end shows, not the text
    judged = ending_kinds(
        ends
        .join(words, "word", "left")
        .withColumns({"known": F.coalesce("known", F.lit(False)), "begins": F.coalesce("begins", F.lit(False)), "abbreviation": F.coalesce("abbreviation", F.lit(False))})
    ).select("key", "source", "chars", "bytes", "ending")
    limits = source_limits(lengths).groupBy("source").agg(F.collect_list(F.struct("unit", "from_length", "to_length", "posterior")).alias("limits"))
    near = F.filter("limits", lambda p: F.when(p["unit"] == "chars", F.col("chars")).otherwise(F.col("bytes")).between(p["from_length"], p["to_length"]))
    pile = F.array_max(F.transform(near, lambda p: F.struct(p["posterior"].alias("posterior"), p["unit"].alias("unit"), p["from_length"].alias("from_length"))))
    judged = judged.join(limits, "source", "left").withColumn("pile", pile).select("key", "source", "ending", "pile.*")
    judged = settled(judged, "endings")  # a few bytes a document; counted, and then judged by the counts
    groups, ratios = estimated_endings(judged)
    said = F.element_at(F.create_map(*[x for c, v in zip(CELLS, ratios) for x in (F.lit(c), F.lit(float(v)))]), F.col("ending"))
    # a source has few limits: one row a source, so that the documents meet a small table
    place = lambda t: F.concat_ws("|", F.coalesce("unit", F.lit("")), F.coalesce(F.col("from_length").cast("string"), F.lit("")))
    by_source = groups.groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct(place(groups).alias("place"), "share"))).alias("shares"))
    share = F.try_element_at("shares", place(judged))
    kind = F.substring_index("ending", ":", 1)
    finished = kind.isin(*FINISHED)
    return (
        judged.join(by_source, "source", "left")
        .withColumn("log_odds", said + F.log(share / (1 - share)))
        .select(F.col("key").alias(key), F.when(F.col("source") != "", F.col("source")).alias("source"), "ending", "posterior", "log_odds", (~finished & (F.col("log_odds") > 0)).alias("cut"))
    )


def truncation_by_source(judged: DataFrame) -> DataFrame:
    """source, texts, cut texts and their share, from ``truncated_texts``."""
    return judged.groupBy("source").agg(F.count("*").alias("texts"), F.count_if("cut").alias("cut_texts"), (F.count_if("cut") / F.count("*")).alias("cut_share"))
