import random

import numpy as np
import pytest

from quirewright.llm import packing
from quirewright.llm.packing import pack, sum_of_squares


def brute(sizes, capacity):
    """Tries every open container and a new one; counts the squares anew each time."""
    gaps, out = [], []
    for s in sizes:
        def squares(gs):
            n = {}
            for g in gs:
                if 0 < g < capacity:
                    n[g] = n.get(g, 0) + 1
            return sum(v * v for v in n.values())
        options = [(squares(gaps[:i] + [g - s] + gaps[i + 1 :]), g - s) for i, g in enumerate(gaps) if g >= s] + [(squares([*gaps, capacity - s]), capacity)]
        best = min(options)
        if best[1] == capacity:
            gaps.append(capacity - s)
        else:
            gaps[gaps.index(best[1] + s)] = best[1]
        out.append(best[0])
    return len(gaps), out[-1] if out else 0


def test_each_choice_is_the_smallest_sum():
    r = random.Random(2)
    for _ in range(25):
        capacity = r.randrange(3, 30)
        sizes = [r.randrange(1, capacity + 1) for _ in range(60)]
        box = sum_of_squares(sizes, capacity)
        load = np.bincount(box, sizes)
        assert load.max() <= capacity
        n = np.bincount([int(capacity - x) for x in load if 0 < capacity - x])
        assert (len(load), int((n**2).sum())) == brute(sizes, capacity)


@pytest.mark.parametrize("a_pass", [1_000, 1])
def test_whole_table(spark, monkeypatch, a_pass):
    monkeypatch.setattr(packing, "CAPACITIES_A_PASS", a_pass)
    r = random.Random(3)
    rows = [(r.randrange(50), r.choice([0, None, 5, 17, 64, 65, 200, r.randrange(1, 64)]), "x") for _ in range(900)]
    df = spark.createDataFrame(rows, "doc_id bigint, tokens bigint, size string")
    caps = spark.createDataFrame([(1, 64), (2, 7), (3, None)], "capacity_id int, capacity_tokens int")
    got = pack(df, caps, shard_items=200).toPandas()
    assert set(got.capacity_id) == {1, 2}
    for cid, cap in ((1, 64), (2, 7)):
        g = got[got.capacity_id == cid]
        assert g.tokens.sum() == sum(t or 0 for _, t, _ in rows)
        assert len(g[g.piece_no == 1]) == len(rows)
        assert g.groupby("container_id").tokens.sum().max() <= cap
        # nothing is split unless it alone exceeds the capacity
        assert (g[g.piece_count > 1].groupby(["doc_id"]).tokens.max() == cap).all()
        assert len(g) == sum(max(1, -(-(t or 0) // cap)) for _, t, _ in rows)
        assert g[g.tokens > 0].container_id.nunique() <= 1.1 * g.tokens.sum() / cap + 8
    assert pack(df.limit(0), caps).count() == 0
