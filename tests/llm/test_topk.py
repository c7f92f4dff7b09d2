from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakestrata.llm import topk
from lakestrata.llm.cover_tree import CoverTree, build, search
from lakestrata.llm.topk import search_rounds, top_k

NAN, INF = float("nan"), float("inf")


def brute(rows, k=10):
    vectors = sorted(
        {
            (i, tuple(int(np.floor(1024 * float(np.float32(x)))) for x in v))
            for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
        }
    )
    out = set()
    for q, v in vectors:
        if q % 50:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors if i != q]
        out |= {(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)}
    return out


def table(spark, rows):
    return spark.createDataFrame(
        [(*r, 1, "clash") for r in rows], "vec_id long, embedding array<float>, label int, score string"
    )


@pytest.mark.parametrize("shard", [1 << 14, 40])
def test_equals_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "LEAF", 6)
    monkeypatch.setattr(topk, "QUERY_LEAF", 2)
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(300)]
    rows += [(1000 + i, [0.5, 0.5, 0.5]) for i in range(150)]
    rows += [(1500, [1.0, None, 0.0]), (1550, [NAN, 1.0, 1.0]), (1600, [INF, 1.0, 1.0]), (1650, None)]
    rows += [(None, [9.0, 9.0, 9.0]), (1700, []), (1750, [0.0, 0.0, 0.0]), (1800, [1.0, 2.0])]
    rows += [(1801, [-0.25, 0.5, 1.0])] * 3 + [(50, rows[50][1])]
    found = top_k(table(spark, rows), F.col("vec_id") % 50 == 0)
    assert {tuple(r) for r in found.collect()} == brute(rows)


def test_far_shards_are_not_searched(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    monkeypatch.setattr(topk, "ROOTS", 7)
    monkeypatch.setattr(topk, "LEAF", 16)
    monkeypatch.setattr(topk, "QUERY_LEAF", 1)
    rng = random.Random(3)
    centres = [[rng.gauss(0, 5) for _ in range(6)] for _ in range(12)]
    rows = [(i, [rng.gauss(c, 0.05) for c in centres[i % 12]]) for i in range(1200)]
    rows += [(5000 + i, [2.0] * 6) for i in range(300)]
    rule = F.col("vec_id") % 50 == 0
    first, second, near, left = search_rounds(table(spark, rows), rule, 10)
    found = top_k(table(spark, rows), rule)
    assert {tuple(r) for r in found.collect()} == brute(rows)
    near, left = ({(r.block, r.shard) for r in d.collect()} for d in (near, left))
    blocks = {b for b, _ in near | left}
    n, query_cells = topk._cells(len(rows), 60), topk._cells(30, 8)
    pairs = len(blocks) * sum(-(-c // 60) for c in cell_sizes(spark, rows, n).values())
    assert query_cells <= len(blocks) < 30 and not near & left
    # Of all pairs, most cannot hold a better row.
    assert len(near) + len(left) < pairs / 2
    assert {r.block for r in first.collect()} == blocks
    assert second.count() <= len(left) * 8 * 10


def cell_sizes(spark, rows, n):
    vectors = topk.whole_vectors(table(spark, rows))
    pivots = topk._pivots(vectors, len(rows), n)
    placed = topk._in_cells(vectors, pivots, n, 1)
    return {r.cell: r["count"] for r in placed.groupBy("cell").count().collect()}


def test_few_or_no_candidates(spark):
    rule = F.col("vec_id") % 50 == 0
    assert top_k(table(spark, []), rule).count() == 0
    assert top_k(table(spark, [(50, [1.0])]), rule).count() == 0
    assert top_k(table(spark, [(1, [1.0])]), rule).count() == 0
    found = top_k(table(spark, [(50, [1.0]), (100, [2.0])]), rule).collect()
    assert {tuple(r) for r in found} == {(50, 1, 100, 2 * 1024**2), (100, 1, 50, 2 * 1024**2)}


def test_tree_covers_its_points_and_prunes():
    rng = np.random.default_rng(9)
    centres = rng.integers(-9000, 9000, (20, 3))
    points = (centres[rng.integers(0, 20, 4000)] + rng.integers(-50, 50, (4000, 3))).astype(float)
    tree = CoverTree.from_bytes(build(points, np.arange(4000), 16).to_bytes())
    for i in range(len(tree.begin)):
        inside = tree.points[tree.begin[i] : tree.end[i]] - tree.points[tree.centre[i]]
        assert np.linalg.norm(inside, axis=1).max() <= tree.radius[i] * (1 + 1e-9) + 1e-9
        assert tree.begin[i] <= tree.centre[i] < tree.end[i]
    queries = build(points[:40], np.arange(40), 8)
    best = search(queries, tree, 5)
    exact = points[:40].astype(np.int64) @ points.T.astype(np.int64)
    np.fill_diagonal(exact, -(2**62))
    wanted = np.sort(exact, axis=1)[:, ::-1][:, :5]
    assert (best.scores == wanted[queries.ids]).all()
