"""Messages delivered more than once: keep exactly one delivery of each message.

Plan: a row is reduced to (identifier, time, delivery); a map-side pass drops what repeats inside a partition, so an
identifier that is a third of all rows leaves each partition once; the survivors are laid out in bucketed storage,
``slice`` of the identifier's hash by time bucket. In a slice, every time bucket has a Bloom filter. Filters of earlier
buckets are held as a binary counter of merged ranges, so an identifier is screened against O(log buckets) filters: no
hit means definitely new; a hit is followed down to the single buckets whose filter answers, and only those buckets'
stored identifiers are compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one slice; a slice is one task's unit of memory (about 60 bytes a row).
SLICE_ROWS = 50_000
#: Seconds of a time bucket.
BUCKET_SECONDS = 86_400
#: Bits of a filter for each identifier, and probes: about 0.2 % false positives.
BITS_PER_ID, PROBES = 13, 6
#: Rows a partition holds at once in the map-side pass.
CHUNK_ROWS = 1_000_000

_REDUCED = "message string, at_us bigint, delivery_id bigint, dropped boolean"


def message_key(column: Column | str) -> Column:
    """Identifier without surrounding white space and letter case; null for null or blank ones."""
    bare = F.lower(F.regexp_replace(column, r"(?U)^\s+|\s+$", ""))
    return F.when(bare != "", bare)


class BloomFilter:
    """Bit array over 64-bit hashes; ``PROBES`` positions by double hashing."""

    __slots__ = ("bits", "mask")

    def __init__(self, size: int):
        n = 1 << max(6, int(np.ceil(np.log2(max(1, size) * BITS_PER_ID))))
        self.bits, self.mask = np.zeros(n >> 3, np.uint8), np.uint64(n - 1)

    def _at(self, hashes: np.ndarray) -> np.ndarray:
        a, b = hashes >> np.uint64(32), (hashes & np.uint64(0xFFFFFFFF)) | np.uint64(1)
        i = np.arange(PROBES, dtype=np.uint64)[:, None]
        return (a + i * b + i * i) & self.mask

    def add(self, hashes: np.ndarray) -> BloomFilter:
        at = self._at(hashes).ravel()
        np.bitwise_or.at(self.bits, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))
        return self

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        at = self._at(hashes)
        return ((self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=0)


def _outcome(code: np.ndarray, at: np.ndarray, delivery: np.ndarray) -> np.ndarray:
    """0 for the earliest delivery of each identifier among these rows, 1 for one to drop, 2 for a row equal to the earliest."""
    order = np.lexsort((delivery, at))
    _, first, back = np.unique(code[order], return_index=True, return_inverse=True)
    out = np.empty(len(code), np.int8)
    out[order] = np.where(delivery[order] == delivery[order][first][back], 2, 1)
    out[order[first]] = 0
    return out


def _codes(message: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Dense integer codes: equal strings, equal code; compared as whole strings, not by hash."""
    encoded = pc.dictionary_encode(message)
    encoded = encoded.combine_chunks() if isinstance(encoded, pa.ChunkedArray) else encoded
    if isinstance(encoded, pa.ChunkedArray):
        encoded = encoded.chunk(0)
    return encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _map_side(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        outcome = _outcome(_codes(t["message"]), t["at_us"].to_numpy(), t["delivery_id"].to_numpy())
        t = t.append_column("dropped", pa.array(outcome == 1)).filter(pa.array(outcome < 2))
        return t.combine_chunks().to_batches()[0]

    rows = 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            rows += b.num_rows
        if rows >= CHUNK_ROWS:
            yield flush()
            held.clear()
            rows = 0
    if held:
        yield flush()


def _screen_slice(table: pa.Table) -> pa.Table:
    """Deliveries of one slice to drop; see the module's text."""
    early = table.filter(table["dropped"])["delivery_id"].to_numpy()
    table = table.filter(pc.invert(table["dropped"]))
    if not table.num_rows:
        return pa.table({"delivery_id": pa.array(early, pa.int64())})
    code, at, delivery = _codes(table["message"]), table["at_us"].to_numpy(), table["delivery_id"].to_numpy()
    hashes = table["hash"].to_numpy().astype(np.int64).view(np.uint64)
    bucket = table["bucket"].to_numpy()
    order = np.lexsort((delivery, at, bucket))
    code, hashes, bucket, delivery = code[order], hashes[order], bucket[order], delivery[order]
    edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    drop = np.zeros(len(code), bool)
    _, start, back = np.unique(code, return_index=True, return_inverse=True)
    equal = delivery == delivery[start][back]  # rows equal to the kept one aren't dropped
    stored: list[tuple[BloomFilter, np.ndarray]] = []  # of single buckets: filter, sorted codes
    ranges: list[tuple[int, int, BloomFilter]] = []  # binary counter: first bucket, past the last, filter of all
    kept_hashes: list[np.ndarray] = []
    for a, z in zip(edges[:-1], edges[1:]):
        c, h = code[a:z], hashes[a:z]
        # rows are in order of time, so the first of a code is the earliest of this bucket
        _, first = np.unique(c, return_index=True)
        seen = np.ones(z - a, bool)
        seen[first] = False
        suspects = np.flatnonzero(~seen)
        for lo, hi, whole in ranges:
            maybe = suspects[whole.may_hold(h[suspects])]
            for k in range(lo, hi) if len(maybe) else ():
                own, ids = stored[k]
                ask = maybe[own.may_hold(h[maybe])]
                if len(ask):
                    seen[ask] |= np.isin(c[ask], ids)
            suspects = suspects[~seen[suspects]]
        drop[a:z] = seen
        new = np.flatnonzero(~seen)
        stored.append((BloomFilter(len(new)).add(h[new]), np.sort(c[new])))
        kept_hashes.append(h[new])
        lo = len(stored) - 1
        ranges.append((lo, lo + 1, stored[-1][0]))
        while len(ranges) > 1 and ranges[-1][1] - ranges[-1][0] == ranges[-2][1] - ranges[-2][0]:
            lo, hi = ranges[-2][0], ranges[-1][1]
            del ranges[-2:]
            merged = np.concatenate(kept_hashes[lo:hi])
            ranges.append((lo, hi, BloomFilter(len(merged)).add(merged)))
    return pa.table({"delivery_id": pa.array(np.r_[early, delivery[drop & ~equal]], pa.int64())})


def repeated_deliveries(
    df: DataFrame,
    message: str = "message_id",
    at: str = "delivered_at",
    delivery: str = "delivery_id",
    bucket_seconds: int = BUCKET_SECONDS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Column ``delivery_id``: one row for each delivery to drop.

    Deliveries are of one message if their identifiers are equal apart from letter case and surrounding white space.
    The earliest time is kept, then the smallest delivery number; a missing time counts as the latest. Null and blank
    identifiers are never repeats. Wholly equal rows count as one delivery, dropped only if another delivery of the
    message is kept. A row without a delivery number can't be named and is ignored.
    Empty input gives no rows; other columns, whatever their names, aren't read.
    """
    last = F.lit(2**62)
    rows = df.select(
        message_key(F.col(f"`{message}`")).alias("message"),
        F.coalesce(F.unix_micros(F.col(f"`{at}`").cast("timestamp")), last).alias("at_us"),
        F.col(f"`{delivery}`").cast("bigint").alias("delivery_id"),
    ).filter("message IS NOT NULL AND delivery_id IS NOT NULL")
    slices = max(1, -(-df.count() // slice_rows))
    local = rows.mapInArrow(_map_side, _REDUCED)
    bucket = F.floor(F.col("at_us") / F.lit(bucket_seconds * 1_000_000)).cast("bigint")
    width = min(slices, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4)
    # rows that the map-side pass dropped travel as bare numbers, spread evenly; survivors go to their slice
    sliced = (
        local.select(
            F.expr("IF(dropped, NULL, message)").alias("message"), "at_us", "delivery_id", bucket.alias("bucket"), F.xxhash64("message").alias("hash"), "dropped"
        )
        .withColumn("slice", F.pmod(F.expr("IF(dropped, xxhash64(delivery_id), hash)"), F.lit(slices)))
        .repartition(max(1, width), "slice")
    )
    return sliced.groupBy("slice").applyInArrow(_screen_slice, "delivery_id bigint").distinct()


def exactly_once(df: DataFrame, message: str = "message_id", at: str = "delivered_at", delivery: str = "delivery_id", **sizes: int) -> DataFrame:
    """``df`` without its repeated deliveries; all columns, rows without an identifier included."""
    drop = repeated_deliveries(df, message, at, delivery, **sizes).withColumnRenamed("delivery_id", "__drop")
    return df.join(drop, F.col(f"`{delivery}`").cast("bigint") == F.col("__drop"), "left_anti")
