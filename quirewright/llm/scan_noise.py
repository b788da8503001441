"""Noise in text from scanned pages: words broken at line ends, misread characters, running headers, page numbers.

An averaged perceptron edits characters. At every place of a word the operations keep, replace, delete and insert (on spans
of one or two characters, learnt from aligned pages) compete by their weights; what an edit wins over keeping is its score.
A second layer of the perceptron weighs what words the clean texts hold and how often: neither a word they lack must
change, nor need the correction be one of theirs, the weights decide. It runs over the distinct words, whatever the number
of pages they are on. Line ends behind a hyphen mark are joined by two more operations. Headers and page numbers are lines
at a page's edge; a perceptron over features of the place, of what other pages of the document repeat, and of how the
numbers go on from page to page tells them from text, taught by the lines that the clean text of a page lacks.
"""

from __future__ import annotations

import difflib
import re
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirewright.llm.canonical import canonical_words
from quirewright.session import settled

#: Pages read for training (by hash of their key, so any part of the table), passes over them.
TRAINING_PAGES, PASSES = 1_500, 4
#: What knowing words may win or lose an edit at most; an edit that loses more to keeping is never proposed, as it couldn't win.
WORD_SAY = 8.0
#: What an edited form must win over keeping the word: half the margin that training asks for.
LEAST_WORTH = 0.5
#: One word in so many is also trained as if no clean text held it.
HELD_OUT = 3
#: Edits to a word besides the editor's own best path, which may have any number.
MOST_EDITS = 3
#: Longest run of letters and digits that can be a word of a language; longer ones aren't edited.
LONGEST_WORD = 64
#: Lines at either edge of a page that may be furniture.
EDGE_LINES = 3
#: Hyphen marks at a line end.
HYPHENS = "-‐‑¬­"
#: Share of a page's height at either edge that is margin.
MARGIN = 0.06

_TOKEN = r"[\p{L}\p{M}\p{N}\p{Cf}|]++"
#: Numbers in Roman signs are no words of a language.
_ROMAN_WORD = r"(?i)^(?=[ivxlcdm]{2})m{0,3}(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})$"
_PY_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}\p{Cf}|]+")
_BREAK = rf"(?U)[\p{{L}}\p{{M}}][{HYPHENS}][ \t]*\r?\n[ \t]*\p{{L}}"
_PY_BREAK = regex.compile(rf"([\p{{L}}\p{{M}}]+)([{HYPHENS}])[ \t]*\r?\n[ \t]*(\p{{L}}[\p{{L}}\p{{M}}]*)")


# the editor


KEEP = ("", "\0")
_ZEROS = [0.0] * 16
#: Score by which the right operation of a place must win in training.
MARGIN_OF_KEEPING = 2.0


@dataclass
class Editor:
    """Weights of (operation, feature); an operation is (span read, span meant). ``words`` are those of the second layer."""

    operations: list[tuple[str, str]] = field(default_factory=list)
    weights: dict[tuple[str, str], dict[str, float]] = field(default_factory=dict)
    words: dict[str, float] = field(default_factory=dict)

    @staticmethod
    def features(word: str, at: int, span: int) -> list[str]:
        w = f"^^{word}$$"
        i = at + 2
        left, right = w[i - 2 : i], w[i + span : i + span + 2]
        return ["b", f"l{left[-1]}", f"r{right[:1]}", f"L{left}", f"R{right}", f"x{left[-1]}_{right[:1]}", f"d{int(any(c.isdigit() or c == '|' for c in word))}"]

    def score(self, op: tuple[str, str], features: list[str]) -> float:
        own = self.weights.get(op)
        return sum(own.get(f, 0.0) for f in features) if own else 0.0

    def fits(self, word: str, at: int) -> list[tuple[str, str]]:
        return [op for op in self.by_start.get(word[at : at + 1], ()) if word.startswith(op[0], at)] + self.by_start.get("", [])

    @property
    def by_start(self) -> dict[str, list[tuple[str, str]]]:
        if not hasattr(self, "_by_start"):
            self._by_start = defaultdict(list)
            for op in self.operations:
                self._by_start[op[0][:1]].append(op)
        return self._by_start

    def edits(self, word: str) -> list[tuple[float, int, tuple[str, str]]]:
        """(score above keeping, where, operation) of everything that fits, at every place."""
        out = []
        for at in range(len(word) + 1):
            keep = self.score(KEEP, self.features(word, at, 1))
            for op in self.fits(word, at):
                if at < len(word) or not op[0]:
                    out.append((self.score(op, self.features(word, at, len(op[0]))) - keep, at, op))
        return out

    def proposals(self, word: str) -> dict[str, tuple[float, int]]:
        """Edited forms: (score above keeping the word, number of edits). None that could win is left out.

        The editor's best path, with any number of edits; every edit that loses less than ``WORD_SAY`` to keeping; and
        every set of up to ``MOST_EDITS`` of those that lose less than half of it each.
        """
        every = sorted((e for e in self.edits(word) if e[0] > -WORD_SAY), key=lambda e: (-e[0], e[1], e[2]))
        out: dict[str, tuple[float, int]] = {}

        def add(chosen: tuple) -> None:
            form, gain, done, free = [], 0.0, 0, 0
            for d, at, (read, meant) in sorted(chosen, key=lambda e: e[1]):
                if at < free:
                    return  # they overlap
                form += [word[done:at], meant]
                gain, done, free = gain + d, at + len(read), at + max(1, len(read))
            made = "".join([*form, word[done:]])
            if gain > -WORD_SAY and made != word and (made not in out or gain > out[made][0]):
                out[made] = gain, len(chosen)

        best, end = [], -1
        for e in sorted((e for e in every if e[0] > 0), key=lambda e: (e[1], -e[0])):
            if e[1] >= end:
                best.append(e)
                end = e[1] + max(1, len(e[2][0]))
        if best:
            add(tuple(best))
        for size in range(1, MOST_EDITS + 1):
            able = every if size == 1 else [e for e in every if e[0] > -WORD_SAY / 2]
            for chosen in combinations(able, size):
                add(chosen)
        return out

    def worth(self, gain: float, known: str, meant: str) -> float:
        """What an edited form wins over keeping the word: its edits' score, and what knowing both words says."""
        return gain + min(WORD_SAY, max(-WORD_SAY, sum(self.words.get(f, 0.0) for f in word_features(known, meant))))

    def join(self, left: str, right: str) -> str | None:
        """``drop`` or ``keep`` for the hyphen between two lines' words, or none if the lines aren't to be joined."""
        s = {k: sum(self.weights.get(("\n", k), {}).get(f, 0.0) for f in _join_features(left, right)) for k in ("drop", "keep", "apart")}
        best = max(s, key=s.get)
        return None if best == "apart" else best


def _join_features(left: str, right: str) -> list[str]:
    return ["b", f"w{left.lower()}", f"e{left[-3:].lower()}", f"s{right[:3].lower()}", f"c{int(right[:1].isupper())}{int(left[:1].isupper())}", f"n{min(len(left), 6)}", f"m{min(len(right), 6)}", f"R{right.lower()}"]


def _spans(read: str, meant: str) -> list[tuple[int, str, str]]:
    """Edits that turn one word into the other: where, span read, span meant."""
    a = next((i for i, (x, y) in enumerate(zip(read, meant)) if x != y), min(len(read), len(meant)))
    z = next((i for i, (x, y) in enumerate(zip(reversed(read[a:]), reversed(meant[a:]))) if x != y), min(len(read), len(meant)) - a)
    if len(read) - z - a <= 2 and len(meant) - z - a <= 2:
        return [(a, read[a : len(read) - z], meant[a : len(meant) - z])]
    return [(i1, read[i1:i2], meant[j1:j2]) for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, read, meant, autojunk=False).get_opcodes() if tag != "equal"]


def _widened(word: str, at: int, read: str, meant: str) -> tuple[int, str, str]:
    """A bare deletion takes its neighbour along, so that a span never vanishes unseen."""
    return (at - 1, word[at - 1] + read, word[at - 1] + meant) if read and not meant and at else (at, read, meant)


def _visible(read: str, meant: str) -> bool:
    """Whether a reader sees the difference; other differences are for the canonical form to mend."""
    bare = [unicodedata.normalize("NFKC", "".join(c for c in x if unicodedata.category(c) != "Cf")) for x in (read, meant)]
    scripts = [{unicodedata.name(c, "?").split(" ")[0] for c in x if c.isalpha()} for x in bare]
    alike = scripts[0] and scripts[1] and scripts[0] != scripts[1]  # a letter of another script in a word only looks the same
    return bare[0] != bare[1] and not alike and not any(unicodedata.combining(c) == 230 for c in read + meant)


def occurrence(count: int | None) -> str:
    """How often the clean texts hold a word, in steps."""
    return "0" if not count or count < 0 else "1" if count == 1 else "2" if count == 2 else "few" if count < 8 else "many" if count < 64 else "most"


def word_features(known: str, meant: str) -> list[str]:
    """Features of a correction: ``known`` has the steps of :func:`occurrence` of the word in the clean and in all scanned texts, ``meant`` that of the form in the clean texts, its number of edits, its length, and whether the scanned texts hold it more often than the word."""
    (seen, times), (count, edits, length, read) = known.split(" "), meant.split(" ")
    return ["b", f"k{seen}", f"m{count}", f"k{seen} m{count}", f"m{count} e{edits}", f"m{count} l{length}", f"k{seen} m{count} l{length}", f"k{seen} m{count} t{times}", f"k{seen} m{count} s{read}", f"m{count} s{read} t{times}"]


def meant_as(count: int | None, edits: int, form: str, read: int, times: int) -> str:
    """A form as :func:`word_features` wants it: ``read`` and ``times`` are how often the scanned texts hold it and the word."""
    return f"{occurrence(count)} {min(edits, 4)} {min(len(form), 6)} {'more' if read > times else 'less' if read > 0 else 'none'}"


class _Averaged:
    """Weights that are averaged over the steps of their training."""

    def __init__(self) -> None:
        self.now: dict = defaultdict(float)
        self.total: dict = defaultdict(float)
        self.step = 0

    def add(self, keys: list, by: float) -> None:
        for k in keys:
            self.now[k] += by
            self.total[k] += by * self.step

    def mean(self) -> dict:
        return {k: x for k, v in self.now.items() if abs(x := v - self.total[k] / max(1, self.step)) > 1e-3}


def train_editor(pairs: list[tuple[str, str]], joins: list[tuple[str, str, str]], passes: int = PASSES) -> Editor:
    """The first layer, an averaged perceptron, from (word read, word meant) pairs, equal ones included, and (left, right, drop/keep/apart) line ends."""
    counted = Counter()
    examples: list[tuple[str, dict[int, tuple[str, str]]]] = []
    for (read, meant), n in sorted(Counter(pairs).items()):
        edits = {}
        for e in _spans(read, meant) if read != meant else []:
            at, a, b = _widened(read, *e)
            if len(a) <= 2 and len(b) <= 2 and _visible(a, b):
                edits[at] = (a, b)
                counted[a, b] += n
        if len(read) <= LONGEST_WORD:
            examples.append((read, edits))
    e = Editor(sorted(op for op, n in counted.items() if n >= 2))
    known = set(e.operations)
    places = []
    for read, edits in examples:
        for at in range(len(read) + 1):
            ops = [op for op in e.fits(read, at) if at < len(read) or not op[0]]
            if ops:
                want = edits.get(at)
                spans = {n: e.features(read, at, n) for n in {1, *(len(op[0]) for op in ops)}}
                places.append((want if want in known else KEEP, [(KEEP, spans[1])] + [(op, spans[len(op[0])]) for op in ops]))
    now: dict = defaultdict(dict)
    total: dict = defaultdict(dict)
    step = 0

    def move(op: tuple[str, str], features: list[str], by: float) -> None:
        own, sums = now[op], total[op]
        for f in features:
            own[f] = own.get(f, 0.0) + by
            sums[f] = sums.get(f, 0.0) + by * step

    for _ in range(passes):
        for want, ops in places:
            step += 1
            score = [sum(map(own.get, features, _ZEROS)) if (own := now.get(op)) else 0.0 for op, features in ops]
            right = next(k for k, (op, _) in enumerate(ops) if op == want)
            # every operation must lose to the right one by a margin, keeping to an edit as an edit to keeping
            for k, (op, features) in enumerate(ops):
                if k != right and score[k] > score[right] - MARGIN_OF_KEEPING:
                    move(op, features, -0.25)
                    move(want, ops[right][1], 0.25)
                    score[right] += 0.25 * len(features)
    e.weights = {op: {f: x for f, v in own.items() if abs(x := v - total[op][f] / max(1, step)) > 1e-3} for op, own in now.items()}
    w = _Averaged()
    for _ in range(passes):
        for left, right, label in joins:
            w.step += 1
            f = _join_features(left, right)
            s = {k: sum(w.now.get((k, x), 0.0) for x in f) for k in ("drop", "keep", "apart")}
            guess = max(s, key=s.get)
            if guess != label:
                w.add([(label, x) for x in f], 1.0)
                w.add([(guess, x) for x in f], -1.0)
    for (k, f), v in w.mean().items():
        e.weights.setdefault(("\n", k), {})[f] = v
    return e


def train_words(editor: Editor, examples: list[tuple[str, str, list[tuple[str, str, float]]]], passes: int = 3 * PASSES) -> None:
    """The second layer, from (known, form meant, [(form, meant_as, gain)]); the word itself is meant where no form equals it."""
    w = _Averaged()
    for _ in range(passes):
        for known, right, forms in examples:
            w.step += 1
            worth = {}
            for form, as_, gain in forms:
                features = word_features(known, as_)
                said = sum(w.now.get(f, 0.0) for f in features)
                worth[form] = gain + min(WORD_SAY, max(-WORD_SAY, said)), features, said
            best = max(worth, key=lambda f: worth[f][0])
            if right in worth:
                if worth[right][0] < 1 and worth[right][2] < WORD_SAY:
                    w.add(worth[right][1], 0.2)
                if best != right and worth[best][0] > worth[right][0] - 1:
                    w.add(worth[best][1], -0.2)
            elif worth[best][0] > -1 and worth[best][2] > -WORD_SAY:
                w.add(worth[best][1], -0.2)
    editor.words = w.mean()


def _joined_words(text: str) -> str:
    return _PY_BREAK.sub(lambda m: m[1] + m[3], text)


def aligned_pairs(pages: list[tuple[str, str]]) -> tuple[list[list[tuple[str, str]]], list[tuple[str, str, str]]]:
    """Word pairs, a list a page, and line ends of pages given as (clean text, scanned text)."""
    every, joins = [], []
    for clean, scanned in pages:
        pairs: list[tuple[str, str]] = []
        every.append(pairs)
        a, b = _PY_TOKEN.findall(_joined_words(scanned)), _PY_TOKEN.findall(clean)
        for tag, i1, i2, j1, j2 in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes():
            if tag == "equal":
                pairs += [(x, x) for x in a[i1:i2:4]]
            elif tag == "replace" and i2 - i1 == j2 - j1:
                pairs += [(x, y) for x, y in zip(a[i1:i2], b[j1:j2]) if x.isascii() == y.isascii() and difflib.SequenceMatcher(None, x, y).ratio() > 0.5]
        flat = re.sub(r"\s+", " ", clean)
        for left, _, right in _PY_BREAK.findall(scanned):
            label = "keep" if f"{left}-{right}" in flat else "drop" if left + right in flat else "apart" if regex.search(rf"{left}-? {right}", flat) else None
            if label:
                joins.append((left, right, label))
    return every, joins


# words


def _texts(calibration: DataFrame, pending: DataFrame, blocks: DataFrame) -> DataFrame:
    """One row a text: table_name, row_key, document_id, page, text, and what a block's place says."""
    none = F.lit(None)
    page = lambda t, key, name: t.select(
        F.lit(name).alias("table_name"), F.col(key).cast("bigint").alias("row_key"), "document_id", F.col("page").cast("int").alias("page"), F.col("tesseract_text").alias("text"),
        none.cast("int").alias("reading_order"), none.cast("double").alias("top"), none.cast("string").alias("block_type"),
    )
    block = blocks.select(
        F.lit("structure_blocks").alias("table_name"), F.col("block_key").cast("bigint").alias("row_key"), "document_id", F.col("page").cast("int").alias("page"), "text",
        F.col("reading_order").cast("int").alias("reading_order"), (F.get("bbox", F.lit(1)) / F.col("page_height")).alias("top"), "block_type",
    )
    return page(calibration, "page_key", "calibration_pages").unionByName(page(pending, "pending_id", "pending_surya_pages")).unionByName(block)


def _tokens(text: Column) -> Column:
    joined = F.when(text.rlike(rf"[{HYPHENS}][ \t]*\r?\n"), F.regexp_replace(text, rf"(?<=[\p{{L}}\p{{M}}])[{HYPHENS}][ \t]*\r?\n[ \t]*(?=\p{{L}})", "")).otherwise(text)
    # of texts in ASCII the same tokens by a class that is quicker to tell
    return F.when(joined.rlike(r"[^\x00-\x7F]"), F.regexp_extract_all(joined, F.lit(f"({_TOKEN})"), 1)).otherwise(F.regexp_extract_all(joined, F.lit("([A-Za-z0-9|]++)"), 1))


def _bare(word: Column) -> Column:
    """A token without strokes that belong to no word: a danda or a table's rule."""
    return F.when(word.rlike(r"[\p{IsDevanagari}]"), F.regexp_replace(word, r"^\|+|\|+$", "")).otherwise(F.regexp_replace(word, r"^\|\|+|\|\|+$", ""))


def _step(count: Column) -> Column:
    """:func:`occurrence` as a column."""
    count = F.coalesce(count, F.lit(0))
    return F.when(count == 0, "0").when(count == 1, "1").when(count == 2, "2").when(count < 8, "few").when(count < 64, "many").otherwise("most")


def _weighed(features: Column, weights: dict[str, float]) -> Column:
    """Sum of the weights of an array of features."""
    table = F.create_map(*[x for f, v in sorted(weights.items()) for x in (F.lit(f), F.lit(float(v)))]) if weights else F.create_map(F.lit(""), F.lit(0.0))
    return F.aggregate(features, F.lit(0.0), lambda a, f: a + F.coalesce(F.try_element_at(table, f), F.lit(0.0)))


def proposed_words(texts: DataFrame, clean: DataFrame, editor: Editor) -> DataFrame:
    """raw, times, seen, form, count, read, edits, gain: every form that the editor proposes for each distinct word of ``texts.text``, and what ``clean.text`` says of both."""
    lexicon = clean.select(F.explode(_tokens(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("count")).filter(~F.col("word").rlike(r"[\p{Cf}|]"))
    lexicon = settled(lexicon, "lexicon")
    words = texts.select(F.explode(_tokens(F.col("text"))).alias("raw")).groupBy("raw").agg(F.count("*").alias("times")).withColumn("word", _bare(F.col("raw")))
    words = words.filter(F.col("word").rlike(r"\p{L}") & (F.length("word") <= LONGEST_WORD) & ~F.col("word").rlike(_ROMAN_WORD))
    words = settled(words, "words")  # the distinct words are asked for several times, the texts' tokens only once
    odd = F.col("word").rlike(r"[^\x00-\x7F]")
    plain = settled(canonical_words(words.filter(odd).select("word")), "plain")
    words = words.filter(~odd).select("raw", "word", "times").unionByName(words.filter(odd).join(plain, "word").select("raw", F.col("plain").alias("word"), "times"))
    # a word that only its capitals hide is as well known as in small letters
    lower = lexicon.groupBy(F.lower("word").alias("low")).agg(F.sum("count").alias("seen"))
    words = words.withColumn("low", F.lower("word")).join(lower, "low", "left").select("raw", "word", "times", F.coalesce("seen", F.lit(0)).alias("seen"))

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                rows = [(k, form, edits, gain) for k, word in enumerate(part.column("word").to_pylist()) for form, (gain, edits) in editor.proposals(word).items()]
                from_row, form, edits, gain = zip(*rows) if rows else ((), (), (), ())
                taken = part.select(["raw", "times", "seen"]).take(pa.array(from_row, pa.int32()))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(form, pa.string()), pa.array(edits, pa.int32()), pa.array(gain, pa.float64())], names=["raw", "times", "seen", "form", "edits", "gain"])

    tasks = max(2, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    tried = words.repartition(tasks, "raw").mapInArrow(propose, "raw string, times bigint, seen bigint, form string, edits int, gain double")
    scanned = words.groupBy(F.col("word").alias("form")).agg(F.sum("times").alias("read"))
    both = lexicon.select(F.col("word").alias("form"), "count").join(scanned, "form", "full_outer")
    counted = tried.join(both, "form", "left")
    return settled(counted.select("raw", "times", "seen", "form", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("read", F.lit(0)).alias("read"), "edits", "gain"), "proposals")


def learn_words(editor: Editor, proposals: DataFrame, pages: list[str], pairs: list[list[tuple[str, str]]]) -> None:
    """Trains the editor's second layer on the proposals for the words of the aligned pages, given with their clean texts.

    What a page's own clean text adds to the counts is taken off, as no page is helped by its own clean text otherwise.
    """
    flat = lambda w: "".join(c for c in unicodedata.normalize("NFKC", w) if unicodedata.category(c) != "Cf")
    words = sorted({read for own in pairs for read, _ in own})
    if not words:
        return
    read = proposals.sparkSession.createDataFrame([(w,) for w in words], "raw string")  # words of at most TRAINING_PAGES pages
    forms = F.array_sort(F.collect_list(F.struct("form", "count", "read", "edits", "gain"))).alias("forms")
    proposed = {r.raw: r for r in proposals.join(F.broadcast(read), "raw").groupBy("raw").agg(F.max("times").alias("times"), F.max("seen").alias("seen"), forms).collect()}
    examples: dict[tuple, None] = {}
    for clean, own in zip(pages, pairs):
        here = Counter(_PY_TOKEN.findall(clean))
        low = Counter()
        for w, n in here.items():
            low[w.lower()] += n
        for raw, meant in own:
            if (r := proposed.get(raw)) is not None:
                right = meant if raw == meant or not _visible(raw, meant) else flat(meant)
                known = f"{occurrence(r.seen - low[raw.lower()])} {occurrence(r.times)}"
                examples[known, right, tuple((f, meant_as(n - here[f], edits, f, read, r.times), gain) for f, n, read, edits, gain in r.forms)] = None
                # as if the clean texts held neither this word nor some others: most words of a text to come may be new
                unseen = lambda w: zlib.crc32(w.encode("utf-8", "surrogatepass")) % HELD_OUT == 0
                if unseen(raw.lower()) or unseen(right):
                    examples[f"0 {occurrence(r.times)}", right, tuple((f, meant_as(0 if unseen(f) else n, edits, f, read, r.times), gain) for f, n, read, edits, gain in r.forms)] = None
    train_words(editor, list(examples))


def word_corrections(proposals: DataFrame, editor: Editor) -> DataFrame:
    """word, meant: the words for which some form is worth more than keeping them, with the form worth most."""
    k, m = F.concat(F.lit("k"), _step(F.col("seen"))), F.concat(F.lit("m"), _step(F.col("count")))
    e, n = F.concat(F.lit("e"), F.least("edits", F.lit(4))), F.concat(F.lit("l"), F.least(F.length("form"), F.lit(6)))
    t = F.concat(F.lit("t"), _step(F.col("times")))
    r = F.when(F.col("read") > F.col("times"), "smore").when(F.col("read") > 0, "sless").otherwise("snone")
    features = F.array(F.lit("b"), k, m, F.concat_ws(" ", k, m), F.concat_ws(" ", m, e), F.concat_ws(" ", m, n), F.concat_ws(" ", k, m, n), F.concat_ws(" ", k, m, t), F.concat_ws(" ", k, m, r), F.concat_ws(" ", m, r, t))
    said = F.least(F.lit(WORD_SAY), F.greatest(F.lit(-WORD_SAY), _weighed(features, editor.words)))
    sure = proposals.withColumn("worth", F.col("gain") + said).filter(F.col("worth") > LEAST_WORTH)
    return sure.groupBy("raw").agg(F.max_by("form", F.struct("worth", "count", "form")).alias("meant")).withColumnRenamed("raw", "word")


# furniture


_ROMAN = r"(?i)^[\[(~–—-]*\s*(?:(?:p|page)\b\.?\s*)?(m{0,3})(cm|cd|d?c{0,3})(xc|xl|l?x{0,3})(ix|iv|v?i{0,3})\s*[\])~–—.-]*$"
_ALONE = r"(?i)^[\[(~–—-]*\s*(?:(?:p|page|pg|s|seite|f|folio|पृष्ठ)\b\.?\s*)?(\d{1,9})(?:\s*(?:of|von|de|sur|/|में से)\s*\d{1,9})?\s*[\])~–—.-]*$"
_BEFORE = r"^[\[(~–—-]*\s*(\d{1,9})\s*[\])~–—-]*(?:\s*[|·•]\s*|\s{2,}|\t)(\D.*)$"
_BEHIND = r"^(.*\D)(?:\s*[|·•]\s*|\s{2,}|\t)[\[(~–—-]*\s*(\d{1,9})\s*[\])~–—-]*$"


def _roman(line: Column) -> Column:
    """Value of a Roman number alone in a line, up to 3999; null where there is none."""
    tens = lambda i, v, x: ["", i, i * 2, i * 3, i + v, v, v + i, v + i * 2, v + i * 3, i + x]
    value = F.lit(0)
    for group, (i, v, x, unit) in enumerate((("m", "", "", 1000), ("c", "d", "m", 100), ("x", "l", "c", 10), ("i", "v", "x", 1)), 1):
        forms = ["", "m", "mm", "mmm"] if unit == 1000 else tens(i, v, x)
        value = value + unit * (F.array_position(F.array(*map(F.lit, forms)), F.lower(F.regexp_extract(line, _ROMAN, group))).cast("int") - 1)
    return F.when(line.rlike(_ROMAN) & (value > 0), value)


def edge_lines(texts: DataFrame) -> DataFrame:
    """Lines at a page's edges: table_name, row_key, document_id, page, n, width, line, edge (top, bottom), depth, next, number, alone, header, key.

    Of a page the ``EDGE_LINES`` outer lines at both edges; of a block the same, if it is the page's first or last or in the
    margin. ``key`` is the header without letter case, spacing and signs that scanning confuses. Only the edges' lines are
    shuffled, and of the pages' own texts not even these.
    """
    blanks = F.lit(" \t\r\x0b\x0c\u00a0\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000")
    bare = lambda x: F.trim(x, blanks)
    lines = F.filter(F.split("text", "\n"), lambda x: bare(x) != "")
    slim = texts.withColumn("lines", lines).withColumn("n", F.size("lines")).filter("n > 0")
    slim = slim.select(
        "table_name", "row_key", "document_id", "page", "reading_order", "top", "n", F.array_max(F.transform("lines", F.length)).alias("width"),
        F.transform(F.slice("lines", 1, EDGE_LINES + 1), bare).alias("head"), F.transform(F.slice("lines", F.greatest(F.lit(1), F.col("n") - EDGE_LINES + 1), EDGE_LINES), bare).alias("tail"),
    )
    blocks = slim.filter("table_name = 'structure_blocks'")
    extents = texts.filter("table_name = 'structure_blocks'").groupBy("document_id", "page").agg(F.min("reading_order").alias("first"), F.max("reading_order").alias("last"))
    blocks = blocks.join(extents, ["document_id", "page"], "left").withColumns(
        {"is_top": F.coalesce(F.col("reading_order") == F.col("first"), F.lit(False)) | F.coalesce(F.col("top") < MARGIN, F.lit(False)), "is_bottom": F.coalesce(F.col("reading_order") == F.col("last"), F.lit(False)) | F.coalesce(F.col("top") > 1 - MARGIN, F.lit(False))}
    )
    pages = slim.filter("table_name <> 'structure_blocks'").withColumns({"is_top": F.lit(True), "is_bottom": F.lit(True)})
    placed = pages.unionByName(blocks.select(pages.columns))

    def entry(line: Column, edge: str, depth: int, following: Column) -> Column:
        return F.struct(line.alias("line"), F.lit(edge).alias("edge"), F.lit(depth).alias("depth"), following.alias("next"))

    size, none = F.size("tail"), F.lit(None).cast("string")
    spots = F.array_compact(
        F.array(
            *[F.when(F.col("is_top") & (F.col("n") > d), entry(F.get("head", F.lit(d)), "top", d, F.get("head", F.lit(d + 1)))) for d in range(EDGE_LINES)],
            # a line isn't taken for both edges unless the block is at the bottom alone
            *[F.when(F.col("is_bottom") & ((F.col("n") > 2 * d + 1) | ~F.col("is_top") & (F.col("n") > d)), entry(F.get("tail", size - 1 - d), "bottom", d, none)) for d in range(EDGE_LINES)],
        )
    )
    out = placed.select("table_name", "row_key", "document_id", "page", "n", "width", F.explode(spots).alias("x")).select("table_name", "row_key", "document_id", "page", "n", "width", "x.*")
    latin = F.translate(F.col("line"), "०१२३४५६७८९", "0123456789")
    out = out.withColumns({"latin": latin, "roman": F.when(F.col("line").rlike(_ROMAN), _roman(F.col("line")))})
    out = out.withColumn("shape", F.when(~F.col("latin").rlike("[0-9]"), "none").when(F.col("latin").rlike(_ALONE), "alone").when(F.col("latin").rlike(_BEFORE), "before").when(F.col("latin").rlike(_BEHIND), "behind").otherwise("none"))
    shape = F.col("shape")
    number = F.when(shape == "alone", F.regexp_extract("latin", _ALONE, 1)).when(shape == "before", F.regexp_extract("latin", _BEFORE, 1)).when(shape == "behind", F.regexp_extract("latin", _BEHIND, 2))
    alone = (shape == "alone") | F.col("roman").isNotNull()
    any_digit = lambda p: p.replace(r"\d", r"[\d०-९]").replace(r"\D", r"[^\d०-९]")
    header = F.when(alone, None).when(shape == "before", F.regexp_extract("line", any_digit(_BEFORE), 2)).when(shape == "behind", F.regexp_extract("line", any_digit(_BEHIND), 1)).otherwise(F.col("line"))
    key = F.regexp_replace(F.lower("header"), r"(?U)[^\p{L}\p{M}\p{N}|]+", "")
    key = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace(key, "rn", "m"), "ii", "u"), "cl", "d"), "0115|lcq", "oiisiieg")
    return out.withColumns({"number": F.coalesce(number.cast("int"), F.col("roman")), "alone": alone}).withColumn("header", header).withColumn("key", F.when(F.length(key) > 2, key)).drop("roman", "latin", "shape")


_flag = lambda c: F.when(F.coalesce(c, F.lit(False)), "1").otherwise("0")
_steps = lambda c, *bounds: F.concat(*[_flag(c > b) for b in bounds])


#: Order in which the signs of a line are packed, those of its own and those that are counted.
SIGNS = ("len", "stop", "inner", "on", "clause", "low", "item", "width", "caps", "place", "lines", "block", "number")
COUNTED = ("rep", "forms", "titled", "shared", "own")


def _packed(signs: dict[str, Column]) -> Column:
    """Signs as one short string, so that a line stays a small row while it is shuffled."""
    return F.concat_ws(",", *[F.coalesce(v, F.lit("")) for v in signs.values()])


def edge_signs(edges: DataFrame) -> DataFrame:
    """The lines of :func:`edge_lines` with the signs that follow from a line and its place; the texts that only they need are dropped."""
    h = F.col("header")
    signs = {
        "len": _steps(F.coalesce(F.length("header"), F.lit(0)), 3, 20, 45, 70, 90), "stop": _flag(F.col("line").rlike(r"[.!?।;,]$")), "inner": _flag(h.rlike(r"[.!?।]\s+\p{Lu}")),
        "on": _flag(F.col("next").rlike(r"^\p{Ll}") & ~h.rlike(r"^\p{Ll}")), "clause": _flag(h.rlike(r",\s.*\s\p{Ll}+$")), "low": _flag(h.rlike(r"^\p{Ll}")), "item": _flag(h.rlike(r"^(?:\p{N}+[.)]|[-*•])\s")),
        "width": _steps(F.length("line") / F.col("width"), 0.5, 0.7, 0.85), "caps": _steps(F.regexp_count(h, F.lit(r"(?<!\S)[\p{Lu}\p{N}]")) / F.greatest(F.regexp_count(h, F.lit(r"\S+")), F.lit(1)), 0.45, 0.7),
        "place": F.concat(F.substring("edge", 1, 1), F.col("depth")), "lines": _steps(F.col("n"), 1, 2, 4), "block": _flag(F.col("table_name") == "structure_blocks"), "number": F.when(F.col("number").isNull(), "none").when(F.col("alone"), "alone").otherwise("beside"),
    }
    return edges.select("table_name", "row_key", "document_id", "page", "edge", "depth", "line", "number", "key", F.xxhash64("header").alias("form"), _packed(signs).alias("signs"))


def edge_features(edges: DataFrame) -> DataFrame:
    """The lines of :func:`edge_signs` with ``repeats`` (pages of the document that have the key at an edge), ``keyed``, ``numbered``, and the signs that are counted."""
    at = ["table_name", "document_id"]
    keyed = edges.filter("key IS NOT NULL AND document_id IS NOT NULL")
    repeats = keyed.groupBy(*at, "key").agg(F.count_distinct("page").alias("repeats"), F.count_distinct("form").alias("forms"), F.max(F.get(F.split("signs", ","), F.lit(SIGNS.index("low"))) == "0").alias("titled"))
    numbered = edges.filter("number IS NOT NULL AND page IS NOT NULL AND document_id IS NOT NULL")
    shifts = numbered.groupBy(*at, (F.col("number") - F.col("page")).alias("shift")).agg(F.count_distinct("page").alias("pages"))
    usual = shifts.groupBy(*at).agg(F.max_by("shift", F.struct("pages", -F.abs("shift"))).alias("usual"), F.max("pages").alias("usual_pages"))
    # a document has one row here and few there: its lines are many, so their rows may be spread
    rows = edges.join(repeats, [*at, "key"], "left").join(usual, at, "left")
    counted = {
        "rep": _steps(F.coalesce("repeats", F.lit(0)), 0, 1, 2, 4), "forms": _steps(F.coalesce("forms", F.lit(0)), 1, 2), "titled": _flag(F.col("titled")), "shared": _steps(F.coalesce("usual_pages", F.lit(0)), 0, 1, 2),
        "own": F.when(F.col("number").isNull() | F.col("usual").isNull(), "none").otherwise(_flag(F.col("number") - F.col("page") == F.col("usual"))),
    }
    keyed, numbered = F.col("key").isNotNull().alias("keyed"), F.col("number").isNotNull().alias("numbered")
    return rows.select("table_name", "row_key", "edge", "depth", "line", "repeats", keyed, numbered, "signs", _packed(counted).alias("counted"))


#: Page-position features, each of the signs named: of a line as a running header and as the place of the page's number.
HEADER_FEATURES = ("rep", "len", "place", "number", "rep stop", "rep inner", "rep on", "rep clause", "rep low", "item", "rep len", "rep titled", "rep place", "rep number own", "stop inner on clause low", "rep lines", "rep len stop", "stop place", "number own shared", "rep width", "rep caps", "rep forms", "width caps on", "rep width caps", "rep forms stop", "rep width stop on")
NUMBER_FEATURES = ("number", "place", "number own", "number own shared", "number place", "number lines", "number rep", "number own lines", "number own stop")


def _position(names: tuple[str, ...]) -> list[Column]:
    """The features of an edge's line, in the order of ``names``; needs the columns ``s`` and ``c``, the signs unpacked."""
    sign = {k: F.get("s", F.lit(i)) for i, k in enumerate(SIGNS)} | {k: F.get("c", F.lit(i)) for i, k in enumerate(COUNTED)}
    return [F.concat_ws(" ", *[F.concat(F.lit(k + "="), sign[k]) for k in x.split()]) for x in names]


def _unpacked(edges: DataFrame) -> DataFrame:
    return edges.withColumns({"s": F.split("signs", ","), "c": F.split("counted", ",")})


def _position_score(names: tuple[str, ...], weights: dict[str, float]) -> Column:
    """Sum of the weights of a line's features: each kind of feature has a short table of its own."""
    tables: dict[str, dict[str, float]] = defaultdict(dict)
    for f, v in weights.items():
        tables[" ".join(part.split("=")[0] for part in f.split(" "))][f] = v
    total = F.lit(float(weights.get("b", 0.0)))
    for name, feature in zip(names, _position(names)):
        if own := tables.get(name):
            table = F.create_map(*[x for f, v in sorted(own.items()) for x in (F.lit(f), F.lit(float(v)))])
            total = total + F.coalesce(F.try_element_at(table, feature), F.lit(0.0))
    return total


def _folded(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKC", text).lower() if unicodedata.category(c)[0] in "LMN")


def missing_from(clean: str, lines: list[tuple[str, str, int]]) -> list[bool]:
    """Whether each (line, edge, depth) of a scanned page is missing from its clean text where it should stand; misread characters are no matter."""
    whole = _folded(clean)
    out = []
    for line, edge, depth in lines:
        own = _folded(line)
        reach = len(own) + 100 * depth + 12  # the lines further out may be text
        place = whole[:reach] if edge == "top" else whole[-reach:]
        if len(own) < 6:  # too short to be looked for anywhere: the clean text itself must begin or end so
            out.append(not (place.startswith(own) if edge == "top" else place.endswith(own)))
        else:
            out.append(difflib.SequenceMatcher(None, own, place, autojunk=False).find_longest_match().size < 0.5 * len(own))
    return out


def train_linear(examples: list[tuple[list[str], bool]], passes: int = 3 * PASSES) -> dict[str, float]:
    """An averaged perceptron's weights of features that tell true examples from others."""
    w = _Averaged()
    for _ in range(passes):
        for features, true in examples:
            w.step += 1
            s = sum(w.now.get(f, 0.0) for f in features)
            if (s if true else -s) < 1:
                w.add(features, 0.25 if true else -0.25)
    return w.mean()


@dataclass
class Furniture:
    """Weights of page-position features: of a line that is a running header, and of one that holds the page's number."""

    header: dict[str, float] = field(default_factory=dict)
    number: dict[str, float] = field(default_factory=dict)


def learn_furniture(edges: DataFrame, sample: list[tuple[int, str, str]]) -> Furniture:
    """Learnt from the edges of sampled pages (key, clean text, scanned text): what the clean text lacks is furniture."""
    if not sample:
        return Furniture()
    keys = edges.sparkSession.createDataFrame([(k,) for k, _, _ in sample], "row_key bigint").distinct()  # at most TRAINING_PAGES
    own = edges.filter("table_name = 'calibration_pages'").join(F.broadcast(keys), "row_key")
    features = lambda names: F.array(F.lit("b"), *_position(names))
    rows = _unpacked(own).select("row_key", "edge", "depth", "line", "repeats", "keyed", "numbered", features(HEADER_FEATURES).alias("as_header"), features(NUMBER_FEATURES).alias("as_number")).orderBy("row_key", "edge", "depth", "line").collect()
    by_page: dict[int, list] = defaultdict(list)
    for r in rows:
        by_page[r.row_key].append(r)
    headers, numbers = [], []
    for key, clean, _ in sample:
        own = by_page.pop(key, [])
        for r, missing in zip(own, missing_from(clean, [(r.line, r.edge, r.depth) for r in own])):
            if r.keyed:  # a header is one by other pages that have it
                headers.append((r.as_header, missing and (r.repeats or 0) > 1))
            if r.numbered:
                numbers.append((r.as_number, missing))
    return Furniture(train_linear(headers), train_linear(numbers))


def furniture(edges: DataFrame, learnt: Furniture) -> DataFrame:
    """table_name, row_key, noise (running_header, page_number), line: the lines at page edges that are furniture; needs the columns of :func:`edge_features`."""
    header = F.col("keyed") & (_position_score(HEADER_FEATURES, learnt.header) > 0)
    number = F.col("numbered") & (_position_score(NUMBER_FEATURES, learnt.number) > 0)
    judged = _unpacked(edges).select("table_name", "row_key", "edge", "depth", "line", header.alias("is_header"), number.alias("is_number"))
    # an inner line counts only behind outer ones that are furniture themselves
    outward = Window.partitionBy("table_name", "row_key", "edge").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    reached = judged.withColumn("reached", F.min(F.col("is_header") | F.col("is_number")).over(outward)).filter("reached")
    kinds = F.array_compact(F.array(F.when(F.col("is_header"), F.lit("running_header")), F.when(F.col("is_number"), F.lit("page_number"))))
    return reached.select("table_name", "row_key", F.explode(kinds).alias("noise"), "line")


# the operator


def training_sample(calibration: DataFrame, pages: int = TRAINING_PAGES) -> list[tuple[int, str, str]]:
    """(key, clean text, scanned text) of at most ``pages`` pages, any part of the table: those whose keys' hashes are smallest."""
    rows = (
        calibration.filter("length(reference_text) > 0 AND length(tesseract_text) > 0")
        .select(F.xxhash64("page_key", "document_id").alias("h"), F.col("page_key").cast("bigint").alias("page_key"), "reference_text", "tesseract_text")
        .orderBy("h", "reference_text", "tesseract_text")
        .limit(pages)
        .collect()
    )
    return [(r.page_key, r.reference_text, r.tesseract_text) for r in rows]


def scan_noise(calibration: DataFrame, pending: DataFrame, blocks: DataFrame, pages: int = TRAINING_PAGES, editor: Editor | None = None, learnt: Furniture | None = None) -> DataFrame:
    """table_name, row_key, noise, detail: what was found in each row, several details a kind.

    detail is the word as read (misread), the letters around the break (hyphenation) or the line. Null, empty and blank
    texts have no noise; a null document or page has no header; rows entered twice count as one page. Empty tables are
    fine. What isn't given is learnt from at most ``pages`` pages of ``calibration``; counts are over all rows.
    """
    sample = training_sample(calibration, pages)
    texts = _texts(calibration, pending, blocks).filter("length(text) > 0")
    clean = calibration.select(F.col("reference_text").alias("text")).filter("length(text) > 0")
    pairs, breaks = aligned_pairs([(c, s) for _, c, s in sample]) if editor is None else ([], [])
    editor = editor or train_editor([p for own in pairs for p in own], breaks)
    proposals = proposed_words(texts, clean, editor)
    if pairs:
        learn_words(editor, proposals, [c for _, c, _ in sample], pairs)
    meant = settled(word_corrections(proposals, editor), "corrections")
    words = texts.select("table_name", "row_key", F.explode(F.array_distinct(_tokens(F.col("text")))).alias("word"))
    misread = words.join(meant, "word").select("table_name", "row_key", F.lit("misread").alias("noise"), F.concat_ws("\t", "word", "meant").alias("detail"))

    def joins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(t.as_py(), k.as_py(), f"{left}\t{right}\t{way}") for t, k, x in zip(*b.columns) for left, _, right in _PY_BREAK.findall(x.as_py()) if (way := editor.join(left, right))]
            columns = list(zip(*rows)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(["hyphenation"] * len(rows), pa.string()), pa.array(columns[2], pa.string())], names=["table_name", "row_key", "noise", "detail"])

    broken = texts.filter(F.col("text").rlike(_BREAK)).select("table_name", "row_key", "text").mapInArrow(joins, "table_name string, row_key bigint, noise string, detail string")
    edges = settled(edge_features(settled(edge_signs(edge_lines(texts)), "edges")), "edge-signs")  # a few lines a page, counted three times
    lines = furniture(edges, learnt or learn_furniture(edges, sample)).select("table_name", "row_key", "noise", F.col("line").alias("detail"))
    return misread.unionByName(broken).unionByName(lines)


def repaired_texts(calibration: DataFrame, pending: DataFrame, blocks: DataFrame, pages: int = TRAINING_PAGES) -> DataFrame:
    """table_name, row_key, text: continuous paragraphs without headers and page numbers, words joined and corrected.

    Null texts stay null. Lines of a paragraph are joined by a space; blank lines part paragraphs.
    """
    found = scan_noise(calibration, pending, blocks, pages).groupBy("table_name", "row_key").agg(F.collect_set(F.struct("noise", "detail")).alias("found"))
    rows = _texts(calibration, pending, blocks).select("table_name", "row_key", "text").join(found, ["table_name", "row_key"], "left")

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [repaired(t, [(x["noise"], x["detail"]) for x in f or []]) for t, f in zip(b.column("text").to_pylist(), b.column("found").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("table_name"), b.column("row_key"), pa.array(out, pa.string())], names=["table_name", "row_key", "text"])

    return rows.mapInArrow(repair, "table_name string, row_key bigint, text string")


def repaired(text: str | None, found: list[tuple[str, str]]) -> str | None:
    """One text repaired by what was found in it."""
    if not text:
        return text
    lines = text.replace("\r\n", "\n").split("\n")
    filled = [i for i, x in enumerate(lines) if x.strip()]
    furniture_lines = {d for n, d in found if n in ("running_header", "page_number")}
    for i in [*filled[:EDGE_LINES], *filled[-EDGE_LINES:]]:
        if lines[i].strip() in furniture_lines:
            lines[i] = ""
    way = {(a, b): w for n, d in found if n == "hyphenation" for a, b, w in [d.split("\t")]}
    joined = _PY_BREAK.sub(lambda m: m[1] + ("-" if way.get((m[1], m[3])) == "keep" else "") + m[3] if (m[1], m[3]) in way else m[0], "\n".join(lines))
    joined = re.sub(r"(?<=\d)([-–])[ \t]*\r?\n[ \t]*(?=\d)", r"\1", joined)  # a range of figures goes on, though it is no case
    meant = dict(d.split("\t") for n, d in found if n == "misread")
    joined = _PY_TOKEN.sub(lambda m: meant.get(m[0], m[0]), joined) if meant else joined
    paragraphs = (re.sub(r"[ \t]*\n[ \t]*", " ", p).strip() for p in re.split(r"\n[ \t]*\n\s*", joined))
    return "\n\n".join(p for p in paragraphs if p)
