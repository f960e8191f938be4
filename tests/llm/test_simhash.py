"""Classes equal brute force over all pairs of fingerprints."""

import random
import re

import pytest
import xxhash

from tidemark.llm import simhash


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(prints):
    """prints: id -> fingerprint; the smallest id that each reaches."""
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_every_pair_within_the_radius_collides():
    masks = simhash.covering_masks(2)
    for a in range(64):
        for b in range(a + 1, 64):
            assert any(m >> a & 1 and m >> b & 1 for m in masks)


def test_classes_of_the_documents(spark):
    from tidemark.llm.queries import op9_simhash

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    prints = {r["doc_id"]: brute_fingerprint(r["text"]) for r in docs}
    want = brute_classes(prints)
    got = op9_simhash(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for row in got:
        assert row["fingerprint"] == f"{prints[row['doc_id']]:016x}"
        assert row["component_id"] == want[row["doc_id"]]


def test_chains_and_hot_buckets_of_fingerprints(spark):
    """Random fingerprints with chains one and two bits apart and a large ball around one value."""
    random.seed(2)
    base = random.getrandbits(64)
    prints = {random.getrandbits(64) for _ in range(200)} | {base}
    for _ in range(300):
        prints.add(base ^ (1 << random.randrange(64)) ^ (1 << random.randrange(64)))
    x = random.getrandbits(64)
    for _ in range(60):
        x ^= (1 << random.randrange(64)) | (1 << random.randrange(64))
        prints.add(x)
    signed = [(simhash._signed(p),) for p in prints]
    roots = simhash.components(simhash.links(spark.createDataFrame(signed, "fp long"))).collect()
    want = brute_classes({s: s % 2**64 for (s,) in signed})
    got = {s: s for (s,) in signed} | {r["node"]: r["root"] for r in roots}
    assert got == want


def test_edge_cases_and_one_of_each_class(spark):
    rows = [(5, "A b c d e"), (3, "a B c d e"), (None, "a b c d e"), (7, None), (8, ""), (9, " \n"), (10, "x"),
            (10, "x"), (11, "other words entirely here"), (None, None)]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, fingerprint string")
    found = simhash.classes(docs.select("doc_id", "text")).collect()
    assert len(found) == len(rows)
    by_text = {(r["doc_id"], r["fingerprint"]): r["component_id"] for r in found}
    assert {c for (i, f), c in by_text.items() if f == 0} == {7}
    assert {c for (i, f), c in by_text.items() if i in (3, 5)} == {3}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 7, 10, 11]
    assert kept.where("fingerprint <> 'k'").count() == 0
    empty = spark.createDataFrame([], docs.schema)
    assert simhash.keep_one(empty).collect() == []
    assert simhash.classes(empty).collect() == []
    nulls = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert [r["component_id"] for r in simhash.classes(nulls).collect()] == [None, None]
    assert simhash.keep_one(nulls).count() == 1


def test_radius_one_and_others(spark):
    fps = spark.createDataFrame([(0,), (1,), (3,), (1 << 40,)], "fp long")
    pairs = {tuple(sorted(r)) for r in simhash.links(fps, radius=1).collect()}
    assert pairs == {(0, 1), (1, 3), (0, 1 << 40)}
    with pytest.raises(ValueError):
        simhash.links(fps, radius=3)
