"""Removed words equal brute force over all windows."""

import hashlib
import random
import re

from tidemark.llm import substring_dedup as sd


def brute(rows, window=20):
    """rows: (order key, text) in any order -> removed flags by (key, text)."""
    words = {(k, t): re.findall(r"[^\x20\x09-\x0D]+", t or "") for k, t in rows}
    first = {}
    for (k, t), w in words.items():
        for p in range(len(w) - window + 1):
            key = tuple(w[p:p + window])
            first[key] = min(first.get(key, (k, p)), (k, p))
    out = {}
    for (k, t), w in words.items():
        gone = [False] * len(w)
        for p in range(len(w) - window + 1):
            if first[tuple(w[p:p + window])] < (k, p):
                gone[p:p + window] = [True] * window
        out[k, t] = [x for x, g in zip(w, gone) if not g], sum(gone)
    return out


def test_difference_cover():
    for period in (1, 2, 7, 13, 20):
        cover = sd.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert len(sd.difference_cover(13)) == 4


def test_documents(spark):
    from tidemark.llm.queries import op7_substring_dedup

    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = {k: (kept, n) for (k, _), (kept, n) in brute(rows).items()}
    got = op7_substring_dedup(spark, sf).collect()
    assert len(got) == len(rows)
    assert sum(n for _, n in want.values()) > 0
    for r in got:
        kept, n = want[r["doc_id"]]
        assert (r["n_words"], r["n_removed"]) == (len(kept) + n, n)
        assert r["kept_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()


def test_overlaps_ties_and_edge_cases(spark):
    random.seed(4)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(60):
        w = [random.choice("abcdefgh") for _ in range(random.randint(0, 120))]
        if i % 2:
            a = random.randrange(40)
            w[len(w) // 2:len(w) // 2] = passage[a:a + random.randint(18, 30)]
        rows.append((random.randrange(40), " ".join(w)))  # some ids twice, with other texts
    rows += [(100, "z " * 70), (101, None), (102, ""), (103, " \t\n"), (104, "only\x0bthree\x0cwords"), (None, " ".join(passage))]
    rows += [rows[3], rows[3]]  # repeated rows
    low = -(2**63)
    want = brute([(low if k is None else k, t) for k, t in rows])
    docs = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, n_words string").repartition(7)
    keyed = docs.withColumn("whole", docs["text"])
    got = sd.remove_repeats(keyed).collect()
    assert len(got) == len(rows)
    for r in got:
        kept, n = want[low if r["doc_id"] is None else r["doc_id"], r["whole"]]
        assert (r["text"], r["n_removed"]) == (" ".join(kept), n)
    assert sd.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_small_buckets_and_other_windows(spark, monkeypatch):
    monkeypatch.setattr(sd, "BUCKET_BYTES", 200)
    random.seed(8)
    rows = [(i, " ".join(random.choice("ab") for _ in range(random.randint(0, 40)))) for i in range(50)]
    docs = spark.createDataFrame([(k, t, t) for k, t in rows], "doc_id long, text string, whole string")
    for window, period in ((20, 13), (6, 4), (5, 1)):
        want = brute(rows, window)
        for r in sd.remove_repeats(docs, window=window, period=period).collect():
            assert r["text"].split() == want[r["doc_id"], r["whole"]][0]
