"""Hard negatives against every pair of rows."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import gnat


def brute_force(rows, n_positives=5, n_negatives=3, low=50, high=95):
    """``rows``: (id, label, vector); anchors are ids divisible by 50."""
    kept = []
    for i, label, v in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            row = (i, label, [math.floor(256.0 * x) for x in v])
            if row not in kept:
                kept.append(row)
    out = []
    for a, label, v in kept:
        if a % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, other == label) for i, other, w in kept if i != a and len(w) == len(v)]
        for s, p, _ in sorted(x for x in scored if x[2])[:n_positives]:
            near = sorted((t, i) for t, i, same in scored if not same and low * -s <= 100 * -t <= high * -s)
            out += [(a, p, rank, i, -s, -t) for rank, (t, i) in enumerate(near[:n_negatives], 1)]
    return sorted(out)


def found(spark, rows, **kw):
    vectors = spark.createDataFrame(rows, "vec_id long, label long, embedding array<double>")
    return sorted(tuple(r) for r in gnat.hard_negatives(vectors, F.col("vec_id") % 50 == 0, **kw).collect())


def clustered(n: int, dim: int, seed: int, spread: float = 0.25):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(12, dim))
    rows = []
    for i in range(n):
        v = centers[i % 12] + spread * rng.normal(size=dim)
        rows.append((i, int((i % 12) // 4), [float(x) for x in v / np.linalg.norm(v)]))
    return rows


def test_equals_brute_force_in_trees_of_several_levels(spark, monkeypatch):
    monkeypatch.setattr(gnat, "LEAF_ROWS", 16)
    monkeypatch.setattr(gnat, "FANOUT", 4)
    monkeypatch.setattr(gnat, "BLOCK_ANCHORS", 3)
    rows = clustered(600, 8, 1)
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, rows, n_positives=2, n_negatives=5, low=10, high=100) == brute_force(rows, 2, 5, 10, 100)


def test_the_embeddings(spark):
    from tidemark.llm.queries import op13_hard_negatives

    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], [float(x) for x in r["embedding"]])
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in op13_hard_negatives(spark, sf).collect())
    assert got == brute_force(rows)
    assert got


def test_nulls_ties_repeated_rows_other_lengths_and_wide_numbers(spark, monkeypatch):
    monkeypatch.setattr(gnat, "LEAF_ROWS", 8)
    rng = np.random.default_rng(4)
    rows: list = [(i, i % 3, [1.0, 0.5, 0.25]) for i in range(0, 120)]  # one frequent vector: ties by id
    rows += [(200 + i, i % 3, rng.normal(size=3).tolist()) for i in range(60)]
    rows += [(300 + i, i % 2, [0.7 + i / 100, 0.1]) for i in range(60)]  # another length
    rows += [(50, 2, [1.0, 0.5, 0.25]), (50, 0, [0.9, 0.5, 0.2]), (None, 1, [1.0, 1.0, 1.0]), (401, None, [1.0, 1.0, 1.0]),
             (402, 1, None), (403, 1, []), (404, 1, [1.0, None, 1.0]), (405, 1, [math.inf, 1.0, 1.0]), (406, 1, [math.nan, 1.0, 1.0]),
             (407, 0, [0.0, 0.0, 0.0]), (450, 0, [0.0, 0.0, 0.0]), (500, 1, [-1.0, -0.5, -0.25])]
    rows += [(1000 + i, i % 2, [1e7 + i, 3e6 - i, 0.5, 1.0, 2.0]) for i in range(0, 60, 5)]  # sums beyond 2^53
    assert found(spark, rows) == brute_force(rows)
    assert found(spark, []) == []
    assert found(spark, [(50, 1, [1.0])]) == []


def test_ranges_rule_out_most_leaves_of_clustered_vectors():
    rng = np.random.default_rng(6)
    centers = 40 * rng.normal(size=(30, 6))
    vectors = np.floor(centers[rng.integers(0, 30, 6000)] + rng.normal(size=(6000, 6)))
    tree = gnat.plant(vectors[:1000], 20, iter(range(10**6)), iter(range(1, 10**6)))
    leaf, seen = np.zeros(len(vectors), "int64"), []
    gnat._down(tree, vectors, np.arange(len(vectors)), leaf, seen)
    ranges: dict = {}
    for node, point, sibling, low, high, least, most in seen:
        old = ranges.get((node, point, sibling), (math.inf, -math.inf, math.inf, -math.inf))
        ranges[node, point, sibling] = (min(old[0], low), max(old[1], high), min(old[2], least), max(old[3], most))
    gnat.measure(tree, [dict(zip(("node", "point", "sibling", "low", "high", "least", "most"), (*k, *v))) for k, v in ranges.items()])
    anchors = vectors[:50]
    scores = gnat.products(anchors, vectors)
    own = (anchors * anchors).sum(axis=1)
    low, high = (own - 20)[:, None], (own + 20)[:, None]
    met = {(int(a), leaf) for rows, leaf in gnat.reached(tree, anchors, low, high) for a in rows}
    for a in range(50):
        holding = set(leaf[(scores[a] >= low[a]) & (scores[a] <= high[a])].tolist())
        assert holding <= {k for b, k in met if b == a}
    assert len(met) < 0.5 * 50 * len(set(leaf.tolist()))


def test_products_are_exact():
    a = np.array([[2.0**40, 3.0, -1.0]])
    b = np.array([[2.0**20 + 1, 5.0, 7.0]])
    assert gnat.products(a, b)[0, 0] == 2**60 + 2**40 + 15 - 7
    with pytest.raises(OverflowError):
        gnat.products(np.array([[2.0**40]]), np.array([[2.0**40]]))
