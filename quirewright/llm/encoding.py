"""Encoding of texts with a public byte-level BPE, exact for texts of any length.

Short texts are encoded where they lie: a map without a shuffle. A long text is cut into pieces that tasks encode in
parallel; the pieces' ids are joined up a binary tree, a level at a time, so that every pair of neighbours is a task's
group of its own and no task gets more of a text than its two halves. At each join a window around the seam is encoded
anew and grown until both sides agree:

* between words, it is grown until it begins and ends where a blank follows a sign: there the splitting pattern parts
  words whatever stands around, so the ids outside of the window are the same with and without the other half;
* inside one unsplit run, the tokens at both ends of the window must stand beside their outer neighbours as the merges
  of the two together leave them; a sequence is the encoding of a run exactly if all its adjacent pairs do.

A piece carries its ids and the texts of its two edges only, up to the first such place.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirewright.session import settled

#: Folder of the public tokenizers' files, and the tokenizer used.
TOKENIZER_FOLDER, TOKENIZER = "/opt/tokenizers", "byte_bpe_50k"
#: The splitting pattern of this vocabulary (a fixed value of the public tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Code points of a piece of a long text; a text of up to twice that stays whole.
PIECE_CHARS = 4_096
#: Bytes of an unsplit run that are encoded at once; a longer run is encoded as a tree.
RUN_BYTES = 2_048
#: Code points first taken at either side of a seam, and tokens at either side of a seam in a run.
WINDOW_CHARS, WINDOW_TOKENS = 64, 4
_LONG_RUN = re.compile(rf"\S{{{RUN_BYTES // 4},}}|\s{{{RUN_BYTES // 4},}}")
#: Where words are parted whatever stands around: only blanks can begin a word, and none stands inside one.
_PARTED = re.compile(r"(?<=\S)[ \n]")


@dataclass(slots=True)
class Piece:
    """Ids of a part of a text; its edges' texts, up to a place where words are parted, with the numbers of their ids. Without such a place both are the whole text."""

    ids: np.ndarray
    head: str
    head_ids: int
    tail: str
    tail_ids: int
    whole: bool


class Encoder:
    """Ids of a text, equal to the tokenizer's own whatever the text's length."""

    def __init__(self, folder: str = TOKENIZER_FOLDER, name: str = TOKENIZER, vocabulary: bytes | None = None):
        vocabulary = vocabulary or Path(folder, f"{name}.tiktoken").read_bytes()
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.bpe = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.split = regex.compile(PATTERN)
        self.once = self.bpe._core_bpe.encode_single_piece
        self.beside: dict[tuple[int, int], bool] = {}

    def ids(self, text: str | None) -> np.ndarray:
        """Ids of a text; none for an empty or null one."""
        if not text:
            return np.zeros(0, np.int32)
        if len(text) > RUN_BYTES // 4 and _LONG_RUN.search(text):
            return np.array(self.words(text), np.int32)
        return np.frombuffer(self.bpe._core_bpe.encode_to_tiktoken_buffer(text, set()), np.int32)

    def words(self, text: str) -> list[int]:
        """Ids of a text word by word, so that long runs are encoded as trees."""
        return [i for m in self.split.finditer(text) for i in self.run(m[0].encode())]

    def piece(self, text: str) -> Piece:
        ids = self.ids(text)
        first = _PARTED.search(text, WINDOW_CHARS)
        if first is None:
            return Piece(ids, text, len(ids), text, len(ids), True)
        size, last = WINDOW_CHARS, None
        while last is None:  # there is one: the first
            last = _PARTED.search(text, max(0, len(text) - size))
            size *= 4
        head, tail = text[: first.start()], text[last.start() :]
        return Piece(ids, head, len(self.ids(head)), tail, len(self.ids(tail)), False)

    def run(self, data: bytes) -> list[int]:
        """Ids of one unsplit run: of its halves, then of the seam."""
        if len(data) <= RUN_BYTES:
            return self.once(data)
        middle = len(data) // 2
        return self.join_run(self.run(data[:middle]), self.run(data[middle:]))

    def fits(self, a: int, b: int) -> bool:
        ok = self.beside.get((a, b))
        if ok is None:
            if len(self.beside) > 300_000:  # a cache, forgotten when full
                self.beside.clear()
            ok = self.beside[a, b] = self.once(self.bpe.decode_bytes([a, b])) == [a, b]
        return ok

    def join_run(self, left: list[int], right: list[int]) -> list[int]:
        size = WINDOW_TOKENS
        while True:
            a, b = max(0, len(left) - size), min(len(right), size)
            window = self.once(self.bpe.decode_bytes(left[a:] + right[:b]))
            if (a == 0 or self.fits(left[a - 1], window[0])) and (b == len(right) or self.fits(window[-1], right[b])):
                return left[:a] + window + right[b:]
            size *= 2

    def join(self, left: Piece, right: Piece) -> Piece:
        """The piece of both texts, as if encoded at once."""
        seam = left.tail + right.head
        if left.whole and right.whole and self.split.fullmatch(seam) and left.head and right.head:
            window = np.array(self.join_run(left.ids.tolist(), right.ids.tolist()), np.int32)
        else:
            window = self.ids(seam)
        ids = np.concatenate([left.ids[: len(left.ids) - left.tail_ids], window, right.ids[right.head_ids :]])
        head = (seam, len(window)) if left.whole else (left.head, left.head_ids)
        tail = (seam, len(window)) if right.whole else (right.tail, right.tail_ids)
        return Piece(ids, *head, *tail, left.whole and right.whole)

    def join_all(self, pieces: list[Piece]) -> list[int]:
        """Ids of the text whose pieces these are, in order; joined up a binary tree."""
        while len(pieces) > 1:
            pieces = [self.join(*pieces[k : k + 2]) if k + 1 < len(pieces) else pieces[k] for k in range(0, len(pieces), 2)]
        return pieces[0].ids.tolist()


@dataclass(frozen=True)
class Shipped:
    """A vocabulary that travels with the job, so that only the driver needs the tokenizer's file; of the file's size."""

    name: str
    file: Broadcast

    def encoder(self) -> Encoder:
        """One encoder for each worker process."""
        vocabulary = self.file.value
        known = self.name, len(vocabulary), zlib.crc32(vocabulary)
        if known not in _encoders:
            _encoders.clear()
            _encoders[known] = Encoder(name=self.name, vocabulary=vocabulary)
        return _encoders[known]


_encoders: dict = {}


def _id_lists(found: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(found) + 1, np.int32)
    np.cumsum([len(x) for x in found], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*found, np.zeros(0, np.int32)])))


def encode_texts(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    folder: str = TOKENIZER_FOLDER,
    name: str = TOKENIZER,
    piece_chars: int = PIECE_CHARS,
    counts_only: bool = False,
) -> DataFrame:
    """``key`` and ``ids`` (or ``tokens``, their number) of every row, without special tokens.

    Null and empty texts have the empty list of ids. Every row of ``df`` gives one row, repeated keys and rows included,
    null keys too; other columns aren't read. An empty ``df`` gives no rows.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    shipped = Shipped(name, df.sparkSession.sparkContext.broadcast(Path(folder, f"{name}.tiktoken").read_bytes()))
    long = F.coalesce(F.length("text") > 2 * piece_chars, F.lit(False))
    out = f"key {kind}, tokens bigint" if counts_only else f"key {kind}, ids array<int>"

    def finished(keys: pa.Array, found: list[np.ndarray]) -> pa.RecordBatch:
        column = pa.array([len(x) for x in found], pa.int64()) if counts_only else _id_lists(found)
        return pa.RecordBatch.from_arrays([keys, column], names=["key", "tokens" if counts_only else "ids"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = shipped.encoder()
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                yield finished(part.column(0), [e.ids(x) for x in part.column(1).to_pylist()])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = shipped.encoder()
        for b in batches:
            for at in range(0, b.num_rows, 100):
                part = b.slice(at, 100)
                yield _piece_columns(part.select(["row", "key", "parts", "copies"]), part.column("no"), [e.piece(t) for t in part.column("text").to_pylist()])

    def joined(t: pa.Table) -> pa.Table:
        t = t.sort_by("no").combine_chunks()
        parts = t.to_batches()[0]
        found = [Piece(ids.values.to_numpy(), *(parts.column(c)[k].as_py() for c in _EDGES)) for k, ids in enumerate(parts.column("ids"))]
        one = shipped.encoder().join(*found) if len(found) > 1 else found[0]
        return pa.Table.from_batches([_piece_columns(parts.slice(0, 1).select(["row", "key", "parts", "copies"]), pa.array([parts.column("no")[0].as_py() // 2], pa.int32()), [one])])

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                done = finished(b.column("key").slice(k, 1), [b.column("ids")[k].values.to_numpy()])
                for _ in range(b.column("copies")[k].as_py()):
                    yield done

    short = rows.filter(~long).mapInArrow(whole, out)
    # equal rows are encoded once and counted: one text may be a third of all
    row = F.struct(F.xxhash64("key", "text").alias("a"), F.xxhash64(F.lit(1), "text", "key").alias("b"))
    parts = F.ceil(F.length("text") / F.lit(piece_chars)).cast("int")
    cut = (
        rows.filter(long)
        .select(row.alias("row"), "key", "text", parts.alias("parts"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("no"))
        .select("row", "key", "parts", "no", F.substring("text", F.col("no") * piece_chars + 1, F.lit(piece_chars)).alias("text"))
        .groupBy("row", "key", "parts", "no", "text")
        .agg(F.count("*").alias("copies"))
    )
    fields = f"row struct<a:bigint,b:bigint>, key {kind}, parts int, copies bigint, no int, ids array<int>, head string, head_ids int, tail string, tail_ids int, whole boolean"
    made = settled(cut.mapInArrow(pieces, fields), "pieces")
    most = made.agg(F.max("parts")).first()[0] or 1
    level = made
    while most > 1:
        level = level.groupBy("row", F.floor(F.col("no") / 2)).applyInArrow(joined, fields)
        most = -(-most // 2)
    return short.unionByName(level.mapInArrow(flat, out)).withColumnRenamed("key", key)


_EDGES = ("head", "head_ids", "tail", "tail_ids", "whole")


def _piece_columns(of_row: pa.RecordBatch, no: pa.Array, found: list[Piece]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.string(), pa.int32(), pa.bool_())
    edges = [pa.array([getattr(p, c) for p in found], kind) for c, kind in zip(_EDGES, kinds)]
    return pa.RecordBatch.from_arrays([*of_row.columns, no, _id_lists([p.ids for p in found]), *edges], names=["row", "key", "parts", "copies", "no", "ids", *_EDGES])
