"""Suffix-array dedup against every window of every text."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np

from tidemark.llm import suffix_dedup


def brute_force(texts: list[bytes], length: int) -> list[tuple[int, int, int, bytes]]:
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, bytes(c for c, g in zip(t, gone) if not g)))
    return out


def run(spark, rows, length, batches=4, schema="doc_id long, text string", **kw):
    docs = spark.createDataFrame(rows, schema)
    got = suffix_dedup.remove_repeats(docs, length=length, batches=batches, **kw)
    return sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
                  for r in got.collect())


def expected(rows, length):
    found = brute_force([(t or "").encode() for _, t in rows], length)
    return sorted((i is not None, i or 0, *f) for (i, _), f in zip(rows, found))


def made_rows(seed: int, n: int, length: int, letters: str) -> list[tuple[int | None, str | None]]:
    """Texts put together from a few passages, cut anywhere, with single letters changed."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    passages = [word(rng.randint(length // 2, 4 * length)) for _ in range(6)]
    rows: list[tuple[int | None, str | None]] = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p) // 2)
            text += word(rng.randint(0, length)) + p[a : rng.randint(a, len(p))]
        if text and rng.random() < 0.3:
            at = rng.randrange(len(text))
            text = text[:at] + "é" + text[at + 1 :]
        rows.append((i, text))
    return rows


def test_equals_brute_force_on_passages(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 1 << 12)
    for seed, letters, length, batches in ((1, "abcdefgh ñ", 40, 4), (2, "ab", 40, 3), (3, "abcdefghij", 64, 5), (4, "a", 24, 2)):
        rows = made_rows(seed, 40, length, letters)
        assert run(spark, rows, length, batches) == expected(rows, length)


def test_nulls_short_long_repeated_rows_and_ids(spark):
    passage = "the quick brown fox jumps over the lazy dog and runs on "
    rows = [(None, passage * 3), (1, None), (2, ""), (3, "short"), (4, passage + "x"), (4, passage + "x"), (4, "y" + passage),
            (5, "z" * 500), (6, "".join(chr(97 + i * i % 23) for i in range(3000))), (7, "ab" * 100)]
    assert run(spark, rows, 50) == expected(rows, 50)
    assert run(spark, [], 50) == []


def test_default_length_over_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = suffix_dedup.remove_repeats(docs)
    found = sorted((True, r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got.collect())
    assert found == expected(rows, 400)
    assert sum(r[3] for r in found) > 0


def test_clashing_columns_are_replaced_and_others_kept(spark):
    rows = [(1, "a" * 100, "old", 5.0), (2, "b", "new", 6.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string, score double")
    got = suffix_dedup.remove_repeats(docs, length=32)
    assert got.columns == ["doc_id", "text", "score", "kept", "n_bytes", "n_removed", "n_spans"]
    assert [(r["doc_id"], r["score"], bytes(r["kept"]), r["n_spans"]) for r in got.orderBy("doc_id").collect()] == [
        (1, 5.0, b"", 1), (2, 6.0, b"b", 0)]


def test_samples_are_the_windows_own_choice(monkeypatch):
    rng = random.Random(5)
    text = bytes(rng.choice(b"abcd") for _ in range(3000))
    shape = suffix_dedup.Shape.of(64)
    at, first, last = suffix_dedup.sampled(text, shape)
    assert first[0] == 0 and last[-1] == len(text) - 64 and (first[1:] == last[:-1] + 1).all()
    for window in (0, 700, 2000):
        alone, _, _ = suffix_dedup.sampled(text[window : window + 64], shape)
        of = np.searchsorted(last, window)
        assert alone[0] + window == at[of]
    monkeypatch.setattr(suffix_dedup, "PIECE", 100)  # pieces give the same samples
    assert all((a == b).all() for a, b in zip(suffix_dedup.sampled(text, shape), (at, first, last)))


def test_levels_are_a_binary_counter(spark):
    docs = spark.createDataFrame([(i, f"{i} " * 40) for i in range(30)], "doc_id long, text string")
    keyed = suffix_dedup._keyed(docs, "text", "doc_id")
    family = suffix_dedup.Family(spark, 2, suffix_dedup.Shape.of(32))
    sizes = []
    for i in range(5):
        family.add(keyed.where(f"doc_id % 5 = {i}")).count()
        sizes.append(sorted(family.levels))
    assert sizes == [[0], [1], [0, 1], [2], [0, 2]]
