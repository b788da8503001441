"""Matching of reference blocks with recognised ones: candidates, one-to-one assignment, order and structure scores."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quirewright.functions import geometry as G
from quirewright.functions import measures as M

#: Least overlap of tokens or boxes for a candidate; least matches and coverage for an order to be measured.
LEAST_JACCARD, LEAST_IOU, LEAST_MATCHES, LEAST_COVERAGE = 0.25, 0.25, 2, 0.5


def candidates(reference: DataFrame, found: DataFrame, page: list[str], same_type: bool = False, boxes: bool = True) -> DataFrame:
    """Pairs of a page's blocks whose tokens or boxes overlap enough: page, ref, hyp, jaccard, iou.

    Both sides need block (number), tokens, bbox, block_type. An equi-join on the page; the overlap is a residual condition.
    """
    a = reference.select(*page, F.col("block").alias("ref"), M.numbered(F.col("tokens")).alias("rt"), F.col("bbox").alias("rb"), F.col("block_type").alias("rk"))
    b = found.select(*page, F.col("block").alias("hyp"), M.numbered(F.col("tokens")).alias("ht"), F.col("bbox").alias("hb"), F.col("block_type").alias("hk"))
    # the pairs cost far more than their bytes say: a fixed number of tasks, which the assignment's grouping then reuses
    tasks = max(2, int(reference.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pairs = a.repartition(tasks, *page).join(b.repartition(tasks, *page), page)
    if same_type:
        pairs = pairs.filter("rk <=> hk")
    pairs = pairs.withColumn("jaccard", M.numbered_jaccard(F.col("rt"), F.col("ht")))
    pairs = pairs.withColumn("iou", G.iou(F.col("rb"), F.col("hb")) if boxes else F.lit(None).cast("double"))
    return pairs.filter((F.col("jaccard") >= LEAST_JACCARD) | (F.coalesce("iou", F.lit(0.0)) >= LEAST_IOU)).select(*page, "ref", "hyp", "rk", "hk", "jaccard", "iou")


def best_assignment(edges: list[tuple[int, int, float]]) -> list[int]:
    """Indices of edges (left, right, weight) of a matching with most edges, and of those the heaviest.

    Shortest augmenting paths: each round adds one pair at the least loss of weight, so no number of pairs is lighter than
    need be. Edges are tried in the order given.
    """
    lefts, rights = sorted({e[0] for e in edges}), sorted({e[1] for e in edges})
    li, ri = {v: i for i, v in enumerate(lefts)}, {v: i for i, v in enumerate(rights)}
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for k, (a, b, w) in enumerate(edges):
        key = li[a], ri[b]
        if key not in best or w > best[key][0]:
            best[key] = w, k
    out_of = [[] for _ in lefts]
    for (a, b), (w, _) in best.items():
        out_of[a].append((b, w))
    left_of: list[int | None] = [None] * len(rights)
    right_of: list[int | None] = [None] * len(lefts)
    while True:
        # cost of reaching each left vertex from a free one; taking an edge costs -w, giving one back costs +w
        cost = np.array([0.0 if right_of[a] is None else np.inf for a in range(len(lefts))])
        came: list[tuple[int, int] | None] = [None] * len(lefts)
        for _ in range(len(lefts)):
            changed = False
            for a in range(len(lefts)):
                if cost[a] < np.inf:
                    for b, w in out_of[a]:
                        c = left_of[b]
                        if c is not None and c != a and cost[a] - w + best[c, b][0] < cost[c] - 1e-12:
                            cost[c], came[c], changed = cost[a] - w + best[c, b][0], (a, b), True
            if not changed:
                break
        ends = [(cost[a] - w, a, b) for a in range(len(lefts)) if cost[a] < np.inf for b, w in out_of[a] if left_of[b] is None]
        if not ends:
            break
        _, a, b = min(ends)
        while True:
            left_of[b], right_of[a] = a, b
            if came[a] is None:
                break
            a, b = came[a]
        right_of = [None] * len(lefts)
        for b, a in enumerate(left_of):
            if a is not None:
                right_of[a] = b
    return sorted(best[a, b][1] for b, a in enumerate(left_of) if a is not None)


def assigned(pairs: DataFrame, page: list[str]) -> DataFrame:
    """The candidates that the best one-to-one assignment of each page takes; a page's blocks are one small group."""

    def solve(t: pa.Table) -> pa.Table:
        ref, hyp, jaccard, iou = (t[c].to_pylist() for c in ("ref", "hyp", "jaccard", "iou"))
        if len(set(ref)) == len(ref) and len(set(hyp)) == len(hyp):
            return t  # one to one already
        rows = sorted(range(len(ref)), key=lambda k: (ref[k], hyp[k]))
        edges = [(ref[k], hyp[k], max(jaccard[k], iou[k] or 0.0) + 1e-6 * jaccard[k] + 1e-9 * (iou[k] or 0.0)) for k in rows]
        return t.take([rows[k] for k in best_assignment(edges)])

    return pairs.groupBy(*page).applyInArrow(solve, pairs.schema)


def order_scores(matches: DataFrame, page: list[str], counts: DataFrame) -> DataFrame:
    """Per page: pairs of matches, those in the wrong order, their share, and whether that is measured.

    ``matches`` needs ref and hyp as ranks; ``counts`` the page's numbers of blocks, refs and hyps.
    """
    a, b = matches.alias("a"), matches.alias("b")
    on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in page]
    pairs = a.join(b, [*on, F.col("a.ref") < F.col("b.ref")]).groupBy(*[F.col(f"a.{c}").alias(c) for c in page]).agg(F.count("*").alias("pairs"), F.count_if(F.col("a.hyp") > F.col("b.hyp")).alias("inversions"))
    matched = matches.groupBy(*page).agg(F.count("*").alias("matched"))
    rows = counts.join(matched, page, "left").join(pairs, page, "left").fillna(0, ["matched", "pairs", "inversions"])
    covered = (F.col("matched") >= LEAST_COVERAGE * F.col("refs")) & (F.col("matched") >= LEAST_COVERAGE * F.col("hyps"))
    measured = (F.col("matched") >= LEAST_MATCHES) & covered
    return rows.withColumn("status", F.when(measured, "measured").otherwise("inconclusive")).withColumn("inversion_rate", F.when(measured, F.col("inversions") / F.col("pairs")))


def structure_scores(matches: DataFrame, reference: DataFrame, found: DataFrame, page: list[str]) -> DataFrame:
    """Per page and block type: counts of both sides and of same-type matches, precision, recall and F1."""
    count = lambda df, name: df.groupBy(*page, "block_type").agg(F.count("*").alias(name))
    hits = matches.groupBy(*page, F.col("rk").alias("block_type")).agg(F.count("*").alias("matched"))
    rows = count(reference, "refs").join(count(found, "hyps"), [*page, "block_type"], "full").join(hits, [*page, "block_type"], "left").fillna(0, ["refs", "hyps", "matched"])
    return rows.withColumns(
        {
            "precision": F.when(F.col("hyps") > 0, F.col("matched") / F.col("hyps")).otherwise(0.0),
            "recall": F.when(F.col("refs") > 0, F.col("matched") / F.col("refs")).otherwise(0.0),
            "f1": 2 * F.col("matched") / (F.col("refs") + F.col("hyps")),
        }
    )
