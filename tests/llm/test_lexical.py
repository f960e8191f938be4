"""Block-Max MaxScore against scores of all documents by the formula."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from tidemark.llm import lexical

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute_force(docs, items, k):
    counts = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted: dict = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(TERM.findall((t or "").translate(LOWER)))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in terms if c[t])
            if score > 0:
                scored.append((-score, i is not None, i or 0))
        out += [(item, rank, i if known else None, -score) for rank, (score, known, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def found(spark, docs, items, k, **kw):
    index = lexical.build(spark.createDataFrame(docs, "doc_id long, text string"), **kw)
    got = lexical.search(index, spark.createDataFrame(items, "item_id long, text string"), k).collect()
    return sorted((tuple(r) for r in got), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_equals_brute_force_over_many_blocks_and_shards(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)] + ["Straße", "ÉCOLE", "x-y", "42"]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (j + 1) for j in range(64)], k=rng.randint(0, 60)))) for i in range(1500)]
    docs += [(7000 + i, "w0 w1 w50") for i in range(300)]  # many equal scores
    items = [(i, " ".join(rng.sample(words, rng.randint(1, 12)))) for i in range(12)] + [(3, "w2 w2 W3"), (None, "w5 w9"), (90, None), (91, "unknown")]
    want = brute_force(docs, items, 10)
    monkeypatch.setattr(lexical, "SLICE", 500)
    for block, size, parts in ((8, 1 << 13, 256), (128, 1 << 25, 5)):
        monkeypatch.setattr(lexical, "BLOCK", block)
        monkeypatch.setattr(lexical, "RANGE", 64)
        monkeypatch.setattr(lexical, "BLOCK_ITEMS", parts)
        assert found(spark, docs, items, 10, shard_bytes=size) == want


def test_the_benchmark(spark):
    from tidemark.llm.queries import op11_lexical_search

    sf = "/root/testdata/sf0.01"
    rows = {t: [tuple(r) for r in spark.read.parquet(f"{sf}/{t}.parquet").select(key, "text").collect()]
            for t, key in (("documents", "doc_id"), ("benchmark", "item_id"))}
    got = sorted(tuple(r) for r in op11_lexical_search(spark, sf).select("item_id", "rank", "doc_id", "score").collect())
    assert got == brute_force(rows["documents"], rows["benchmark"], 50)


def test_nulls_empty_tables_repeated_rows_and_long_texts(spark):
    docs = [(None, "alpha beta"), (1, None), (2, ""), (3, "..."), (4, "alpha"), (4, "alpha"), (5, "beta " * 50_000), (6, "gamma\x00alpha")]
    items = [(1, "Alpha beta"), (1, "Alpha beta"), (2, "ALPHA")]
    assert found(spark, docs, items, 5) == brute_force(docs, items, 5)
    assert found(spark, [], items, 5) == []
    assert found(spark, docs, [], 5) == []


def test_blocks_round_trip_and_bounds_reject_blocks():
    rng = np.random.default_rng(2)
    docs = np.unique(rng.integers(0, 200_000, 1000)).astype("int64")
    tfs, lengths = rng.integers(1, 400, len(docs)), rng.integers(400, 900, 200_001).astype("u4")
    parts = [(docs, tfs), (docs[:1], tfs[:1] + 70_000), (docs[5:700], tfs[5:700]), (docs[-3:], tfs[-3:])]
    starts = np.cumsum([0, *(len(d) for d, _ in parts)])[:-1]
    lists = lexical.compress(*(np.concatenate(x) for x in zip(*parts)), lengths, starts)
    for (own, tf), (heads, data) in zip(parts, lists, strict=True):
        heads = np.frombuffer(heads, lexical.HEAD)
        back = [np.concatenate(x) for x in zip(*(lexical.decompress(heads, data, len(own), i) for i in range(len(heads))))]
        assert (back[0] == own).all() and (back[1] == tf).all()
        assert heads["tf"].max() == tf.max() and heads["n"].min() == lengths[own].min()

    import pyarrow as pa

    n = 20_000  # one rare term decides; the blocks of the frequent one away from it stay compressed
    lengths = np.full(n, 100, "u4")
    every = np.arange(n)
    rare = np.arange(0, 4000, 40)
    rows = [(0, None, n, lengths.tobytes(), np.arange(n, dtype="i8").tobytes()),
            (0, b"often", n, *next(lexical.compress(every, np.ones(n, "int64"), lengths, np.array([0])))),
            (0, b"rare", len(rare), *next(lexical.compress(rare, np.full(len(rare), 3), lengths, np.array([0]))))]
    table = pa.table({c: pa.array(v) for c, v in zip(("shard", "term", "df", "heads", "data"), zip(*rows))})
    shard = lexical._Lists(table, n, 100 * n)
    at, scores = shard.best({b"often": 1, b"rare": 5000}, 20)
    assert at.tolist() == rare[:20].tolist() and len(set(scores.tolist())) == 1
    assert shard.read < 60 < len(shard.lists[b"often"][1])
