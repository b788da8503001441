"""One consistent form for texts that look the same.

A text's plain ASCII parts are in that form already. Its other words are taken once each, whatever the number of texts
they stand in, and exploded to positioned code points; broadcast tables give decompositions, spaces, invisible
characters and look-alikes; combining marks are ordered by class and recomposed, and the words are put back together.
Only words that change are joined back to the texts, and only texts with such words are rebuilt.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Letters of other scripts that look like Latin ones. Fixed values, by script.
LOOK_ALIKES = {
    "Cyrillic": ("авсеһіјкморԛѕтухԁԝԍАВЕЅІЈКМНОРСТУХԀԜԚ", "aвceһijkмopqsтyxdwgABESIJKMHOPCTYXDWQ"),
    "Greek": ("αβγικνορυχϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹ", "aßyikvopuxcjABEZHIKMNOPTYXC"),
    "Armenian": ("օոսհցզՕՍԼ", "onuhgqOUL"),
}
#: Latin letters that look like plain ones.
LATIN_LOOK_ALIKES = {"ɡ": "g", "ɑ": "a", "ⅼ": "l", "ꞷ": "w"}
#: Scripts whose joiners are kept between their letters.
INDIC = r"[ऀ-෿]"
#: A run of ASCII letters, digits and characters beyond ASCII; one that holds a character beyond ASCII is a word to look at.
SEGMENT = r"[A-Za-z0-9\x{80}-\x{10FFFF}]++"
_JOINERS = ("‌", "‍")
_WIDE = ("<wide>", "<narrow>", "<font>")


@lru_cache(maxsize=1)
def code_points() -> list[tuple[str, str, int]]:
    """(character, what stands for it, class) of every character that isn't simply itself; made by rule from Unicode's data.

    ``what`` is the full decomposition, the ordinary space or line end, or the empty string for an invisible character.
    The class is the first character's combining class; -1 marks a starter that composes with the one before it.
    """
    seconds = {pair[1] for pair in compositions()}
    out = []
    for n in range(0x80, sys.maxunicode + 1):
        c = chr(n)
        kind = unicodedata.category(c)
        if kind in ("Cn", "Co", "Cs") or 0xAC00 <= n <= 0xD7A3:
            continue
        if kind == "Zs":
            out.append((c, " ", 0))
        elif kind in ("Zl", "Zp") or n == 0x85:
            out.append((c, "\n", 0))
        elif kind == "Cf" and not 0x600 <= n <= 0x6DD or n in (0x34F, 0x115F, 0x1160, 0x3164, 0xFFA0) or 0xFE00 <= n <= 0xFE0F:
            out.append((c, "", 0))
        else:
            spec = unicodedata.decomposition(c)
            folded = spec.startswith(_WIDE) or spec.startswith("<compat>") and "LIGATURE" in unicodedata.name(c, "")
            plain = unicodedata.normalize("NFKD" if folded else "NFD", c)
            level = -1 if c in seconds and not unicodedata.combining(c) else unicodedata.combining(c)
            if plain != c or level:
                out.append((c, plain, level))
    return out


@lru_cache(maxsize=1)
def compositions() -> dict[str, str]:
    """Pairs of characters that compose, and what they compose to; by rule from Unicode's data."""
    out = {}
    for n in range(0xC0, 0x1FFFF):
        spec = unicodedata.decomposition(chr(n))
        if spec and spec[0] != "<" and " " in spec:
            pair = "".join(chr(int(x, 16)) for x in spec.split())
            if unicodedata.normalize("NFC", pair) == chr(n):
                out[pair] = chr(n)
    return out


def _look_alikes() -> list[tuple[str, str, str]]:
    """(letter, script of the word it stands in, letter of that script)."""
    out = [(c, "Latin", plain) for c, plain in LATIN_LOOK_ALIKES.items()]
    for script, (own, latin) in LOOK_ALIKES.items():
        for a, b in zip(own, latin, strict=True):
            if unicodedata.name(b).startswith("LATIN"):
                out += [(a, "Latin", b), (b, script, a)]
    return list({(c, s): (c, s, p) for c, s, p in reversed(out)}.values())


def _table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))  # fixed size: made from Unicode's own data


def canonical_words(words: DataFrame) -> DataFrame:
    """``word`` and ``plain`` for the distinct non-null values of column ``word``; ``plain`` is the word in canonical form."""
    spark = words.sparkSession
    decomposed = _table(spark, code_points(), "c string, what string, level int")
    alike = _table(spark, _look_alikes(), "c string, target string, same string")
    here = Window.partitionBy("word").orderBy("p")
    points = (
        words.select("word")
        .filter("word IS NOT NULL")
        .distinct()
        .select("word", F.posexplode(F.regexp_extract_all("word", F.lit(r"(?s)(.)"), 1)).alias("p", "c"))
        .withColumn("before", F.lag("c").over(here))
        .withColumn("after", F.lead("c").over(here))
        .join(decomposed, "c", "left")
    )
    kept_joiner = F.col("c").isin(*_JOINERS) & F.coalesce(F.col("before").rlike(INDIC) & F.col("after").rlike(INDIC), F.lit(False))
    parts = points.withColumn("what", F.when(kept_joiner, F.col("c")).otherwise(F.coalesce("what", "c"))).select(
        "word", "p", F.posexplode(F.regexp_extract_all("what", F.lit(r"(?s)(.)"), 1)).alias("s", "c")
    )
    parts = parts.join(decomposed.select("c", "level"), "c", "left").withColumn("level", F.coalesce("level", F.lit(0)))
    # the script a run of letters is written in: that of its letters without look-alikes elsewhere, then of most letters
    order = Window.partitionBy("word").orderBy("p", "s")
    letters = (
        parts.withColumn("letter", F.col("c").rlike(r"\p{L}"))
        .withColumn("run", F.sum(F.when(F.col("letter") | F.col("c").rlike(r"\p{M}"), 0).otherwise(1)).over(order))
        .withColumn("script", F.when(~F.col("letter"), None).otherwise(_script("c")))
    )
    convertible = alike.groupBy("c").agg(F.first("c").alias("_c")).select("c", F.lit(True).alias("ambiguous"))
    run = Window.partitionBy("word", "run")
    letters = letters.join(F.broadcast(convertible), "c", "left")
    weights = [
        F.struct(
            F.sum(F.when((F.col("script") == s) & F.col("ambiguous").isNull(), 1).otherwise(0)).over(run).alias("sure"),
            F.sum(F.when(F.col("script") == s, 1).otherwise(0)).over(run).alias("all"),
            F.lit(rank).alias("rank"),
            F.lit(s).alias("script"),
        )
        for rank, s in enumerate(["Armenian", "Greek", "Cyrillic", "Latin"])
    ]
    letters = letters.withColumn("target", F.when(F.col("script").isNotNull(), F.greatest(*weights)["script"]))
    letters = letters.join(alike, ["c", "target"], "left").withColumn("c", F.when((F.col("script") != F.col("target")) | F.col("c").isin(*LATIN_LOOK_ALIKES), F.coalesce("same", "c")).otherwise(F.col("c")))
    # marks of one base, ordered by class; then composed one after the other
    bases = letters.withColumn("base", F.sum(F.when(F.col("level") == 0, 1).otherwise(0)).over(order))
    clusters = bases.groupBy("word", "base").agg(F.array_sort(F.collect_list(F.struct(F.greatest("level", F.lit(0)).alias("level"), "p", "s", "c"))).alias("marks"))
    composed = clusters.select("word", "base", F.when(F.size("marks") == 1, F.col("marks")[0]["c"]).otherwise(_compose("marks")).alias("c"))
    out = composed.groupBy("word").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("base", "c"))), lambda x: x["c"]), "").alias("plain"))
    # a word of invisible characters alone has no row left
    return words.select("word").filter("word IS NOT NULL").distinct().join(out, "word", "left").select("word", F.coalesce("plain", F.lit("")).alias("plain"))


def _script(c: str) -> Column:
    out = F.when(F.col(c).rlike(r"\p{IsLatin}"), "Latin").when(F.col(c).rlike(r"\p{IsCyrillic}"), "Cyrillic")
    return out.when(F.col(c).rlike(r"\p{IsGreek}"), "Greek").when(F.col(c).rlike(r"\p{IsArmenian}"), "Armenian")


def _compose(marks: str) -> Column:
    """Canonical composition of a base and its ordered marks; a mark behind one of its own class can't reach the base."""
    pairs = F.from_json(F.lit(json.dumps(compositions())), "map<string,string>")
    start = F.struct(F.col(marks)[0]["c"].alias("base"), F.lit("").alias("tail"), F.lit(-1).alias("last"))

    def step(a: Column, m: Column) -> Column:
        pair = F.when(a["last"] < m["level"], F.element_at(pairs, F.concat(a["base"], m["c"])))
        return F.when(pair.isNotNull(), F.struct(pair.alias("base"), a["tail"].alias("tail"), a["last"].alias("last"))).otherwise(
            F.struct(a["base"].alias("base"), F.concat(a["tail"], m["c"]).alias("tail"), m["level"].alias("last"))
        )

    return F.aggregate(F.slice(marks, 2, F.size(marks)), start, step, lambda a: F.concat(a["base"], a["tail"]))


def canonical_texts(df: DataFrame, text: str = "text", out: str = "canonical") -> DataFrame:
    """``df`` with column ``out``: ``text`` in canonical form, and ``out``_changed: whether it differs.

    Full-width and ligature forms become plain letters, letters and marks are composed (marks without a composed letter
    stay, in canonical order), invisible characters go except joiners between Indic letters, any space is U+0020 and any
    line separator a line end, and letters that look like those of the word's own script become those. Words wholly of
    another script, quotes, dashes, superscripts, fractions and other signs stay. Conjoining Hangul letters stay as they
    are. Null stays null and unchanged, the empty text stays empty. All rows and columns are kept, repeated rows too; no
    column name of ``df`` may begin with two underscores, other names don't clash.
    """
    source = F.col(f"`{text}`").cast("string")
    # a text's edits follow from it alone, so two hashes of it name them, however often and wherever it is read
    rows = df.withColumn("__row", F.struct(F.xxhash64(source).alias("a"), F.xxhash64(F.lit(1), source).alias("b")))
    runs = F.regexp_extract_all(source, F.lit(f"({SEGMENT})"), 1)
    between = F.split(source, SEGMENT, -1)  # one more than runs; the first and the last may be empty
    odd = source.rlike(r"[^\x00-\x7F]")
    segments = (
        rows.filter(odd)
        .select("__row", F.posexplode(F.arrays_zip(runs.alias("word"), between.alias("gap"))).alias("k", "x"))
        .select("__row", "k", "x.word", "x.gap")
        .filter(F.col("word").rlike(r"[^\x00-\x7F]"))
    )
    changed = canonical_words(segments.select("word")).filter("word <> plain")
    edits = (
        segments.join(changed, "word")
        .groupBy("__row")
        .agg(F.array_sort(F.collect_set(F.struct("k", F.concat("gap", "plain").alias("new")))).alias("__edits"))
    )
    # the parts are columns from below the join, not expressions: each is made once for a row
    parts = F.when(odd, F.zip_with(between, runs, lambda g, w: F.concat(g, w)))
    tail = F.when(odd, F.element_at(between, -1))
    rows = rows.withColumn("__parts", parts).withColumn("__tail", tail).join(edits, "__row", "left")

    def with_what_precedes(e: Column, i: Column) -> Column:
        done = F.coalesce(F.get("__edits", i - 1)["k"] + 1, F.lit(0))
        return F.concat(F.array_join(F.slice("__parts", done + 1, e["k"] - done), ""), e["new"])

    rest = F.element_at("__edits", -1)["k"] + 2
    # the last of the zipped parts is the tail without a word, hence null
    after = F.array_join(F.slice("__parts", rest, F.greatest(F.size("__parts") - rest, F.lit(0))), "")
    rebuilt = F.concat(F.array_join(F.transform("__edits", with_what_precedes), ""), after, F.col("__tail"))
    return (
        rows.withColumn(out, F.when(F.col("__edits").isNull(), source).otherwise(rebuilt))
        .withColumn(f"{out}_changed", F.col("__edits").isNotNull())
        .drop("__row", "__edits", "__parts", "__tail")
    )
