"""Filling containers of fixed capacity with items that aren't split, by the sum-of-squares rule.

Items are dealt evenly to shards, whatever their keys, so that no group is larger than ``SHARD_ITEMS`` and a shard is one
task. In a shard each item goes where the sum over all residual gaps of the squared number of open containers with that
gap becomes smallest, which keeps gaps of every size on offer. The unspent rest is the shard's few open containers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirewright.session import settled

#: Items of one shard: large enough that its open containers waste little, small enough for a task's memory.
SHARD_ITEMS = 10_000
#: Capacities packed in one pass over the sizes; more take further passes.
CAPACITIES_A_PASS = 1_000


def sum_of_squares(sizes: Sequence[int] | np.ndarray, capacity: int) -> np.ndarray:
    """Container number of each item, from 0. Sizes lie in 1..capacity; an item of size 0 isn't allowed here."""
    open_by_gap = np.zeros(capacity + 1, np.int64)
    stacks: dict[int, list[int]] = {}
    out = np.empty(len(sizes), np.int64)
    made = 0
    never = np.int64(1) << 60
    for i, s in enumerate(np.asarray(sizes).tolist()):
        if s == capacity:
            out[i] = made
            made += 1
            continue
        # change of the sum of squares when a container of gap g takes the item: gap g loses one, gap g - s gains one
        have = open_by_gap[s:capacity]
        change = 2 * (open_by_gap[: capacity - s] - have) + 2
        change[0] -= 1  # a full container has no gap
        change[have == 0] = never
        k = int(change.argmin())
        if change[k] <= 2 * open_by_gap[capacity - s] + 1:
            gap = s + k
            out[i] = box = stacks[gap].pop()
            open_by_gap[gap] -= 1
            left = k
        else:
            out[i] = box = made
            made += 1
            left = capacity - s
        if left:
            open_by_gap[left] += 1
            stacks.setdefault(left, []).append(box)
    return out


def pack(
    sizes: DataFrame, capacities: DataFrame, key: str = "doc_id", size: str = "tokens", shard_items: int = SHARD_ITEMS
) -> DataFrame:
    """Every item's container for each capacity: capacity_id, container_id, ``key``, piece_no, piece_count, start, tokens.

    An item larger than the capacity is cut into full pieces and a rest, numbered from 1, each a row; ``start`` is the
    offset of the piece in the item. Any other item is one row. Items of size 0 or null take no room: they lie in the
    shard's first container. ``capacities``: columns capacity_id and capacity_tokens; null or non-positive ones are left
    out. Repeated keys and rows are items of their own. No items, no rows.
    """
    kind = sizes.schema[key].dataType.simpleString()
    items = sizes.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{size}`").cast("bigint"), F.lit(0)).alias("size"))

    def shard(wanted: list[tuple[int, int]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), schema=None) if (batches := [b for b in batches if b.num_rows]) else None
        number = TaskContext.get().partitionId()
        # a shard is bounded by the dealing below; should one be larger, it is packed in runs of twice the bound
        for run, at in enumerate(range(0, table.num_rows if table else 0, 2 * shard_items)):
            part = table.slice(at, 2 * shard_items)
            n = part["size"].to_numpy()
            base = (number << 40) + (run << 32)
            for capacity_id, capacity in wanted:
                pieces = np.maximum(1, -(-n // capacity))
                row = np.repeat(np.arange(len(n)), pieces)
                no = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = no * capacity
                tokens = np.minimum(n[row] - start, capacity)
                box = np.zeros(len(row), np.int64)
                some = tokens > 0
                box[some] = sum_of_squares(tokens[some], capacity)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(row), capacity_id), pa.int32()),
                        pa.array(box + base),
                        part["key"].combine_chunks().take(pa.array(row)),
                        pa.array(no + 1, pa.int32()),
                        pa.array(pieces[row], pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(tokens, pa.int64()),
                    ],
                    names=["capacity_id", "container_id", "key", "piece_no", "piece_count", "start", "tokens"],
                )

    items = settled(items, "sizes")  # counted and dealt: the sizes are worth computing once
    shards = max(1, -(-items.count() // shard_items))
    dealt = items.repartition(shards)
    out = f"capacity_id int, container_id bigint, key {kind}, piece_no int, piece_count int, start bigint, tokens bigint"
    rest = capacities.select("capacity_id", "capacity_tokens").filter("capacity_tokens > 0").toLocalIterator()
    packed = None
    while (wanted := [tuple(r) for r in islice(rest, CAPACITIES_A_PASS)]) or packed is None:
        part = dealt.mapInArrow(partial(shard, wanted), out)
        packed = part if packed is None else packed.unionByName(part)
    return packed.withColumnRenamed("key", key)
