"""Counts equal plain definitions; the bounds, the guarantee on fresh documents, and edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality_rules as qr


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), len(lines))


def test_counts_of_random_texts():
    random.seed(9)
    for _ in range(500):
        text = "".join(random.choice("ab é\x1c #|\n\t日\U0001f600") for _ in range(random.randint(0, 80)))
        assert qr.counts(text.encode()) == brute(text)
    for text in ("", " \n ", "#", "a b c a b c", "x " * 100_000):
        assert qr.counts(text.encode()) == brute(text)


def test_exact_binomial_tails():
    for n, p in ((10, 0.1), (200, 0.02), (3000, 0.005)):
        pmf = [math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(min(n, 120) + 1)]
        for k in (0, 1, 3, 8):
            low, up = sum(pmf[:k + 1]), 1 - sum(pmf[:k])
            assert math.isclose(qr.tail(k, n, p), low, rel_tol=1e-9) or qr.tail(k, n, p) > 0.5 and low > 0.5
            assert math.isclose(qr.upper_tail(k, n, p), up, rel_tol=1e-6, abs_tol=1e-12)
    assert qr.tail(5, 5, 0.1) == 1.0 and qr.tail(0, 0, 0.1) == 1.0 and qr.upper_tail(0, 0, 0.1) == 1.0


def test_documents(spark):
    from tidemark.llm.queries import op8_quality_rules

    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = op8_quality_rules(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want[:5]
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r["base_failed"] and r["kept"])
    good = [r["kept"] for r in got if labels.get(r["doc_id"]) == 1 and not r["base_failed"]]
    assert np.mean(good) > 0.97


def _documents(spark, n, seed):
    """Good documents with few symbols and bad ones with many, in two languages, some unlabelled."""
    random.seed(seed)
    rows, labels = [], []
    for i in range(n):
        bad = random.random() < 0.3
        words = [f"w{random.randrange(5000)}" for _ in range(60)]
        for _ in range(random.randrange(15, 40) if bad else random.randrange(3) * (random.random() < 0.1)):
            words[random.randrange(60)] += "#"
        rows.append((i, " ".join(words), ("en", "de")[i % 2], int(bad)))
        labels.append((i, int(not bad), 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, bad int")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, kept int")


def test_certified_cutoffs_hold_on_fresh_documents(spark):
    docs, labels = _documents(spark, 6000, 1)
    half = labels.where("doc_id < 4000")
    judged = qr.judge(docs, half, risk=0.04).join(labels.drop("kept"), "doc_id").where("NOT base_failed AND doc_id >= 4000")
    by = {r["quality"]: r["share"] for r in judged.groupBy("quality").agg(F.avg((~F.col("kept")).cast("int")).alias("share")).collect()}
    assert by[1] <= 0.04 and by[0] > 0.5


def test_edge_cases(spark):
    docs, labels = _documents(spark, 300, 2)
    odd = spark.createDataFrame([(900, None, "en", 0), (901, "", None, 0), (None, "a b c " * 40, "xx", 0), (901, "", None, 0),
                                 (902, " ".join(f"u{i}#####" for i in range(80)), "unlabelled", 0)], docs.schema)
    more = spark.createDataFrame([(1, 5, 0), (None, 1, 0), (77777, 0, 0), (2, None, 0), (3, 1, 0), (3, 0, 0)], labels.schema)
    judged = qr.judge(docs.unionAll(odd), labels.unionAll(more)).collect()
    assert len(judged) == 305
    assert [r["kept"] for r in judged if r["doc_id"] in (900, 901)] == [False] * 3
    assert [r["kept"] for r in judged if r["doc_id"] == 902] == [True]  # no labels there: only base rules
    none = qr.judge(docs, spark.createDataFrame([], labels.schema))
    assert none.where("kept = base_failed").count() == 0
    assert qr.judge(spark.createDataFrame([], docs.schema), labels).collect() == []


def plain_selection(rows, names, risk, confidence):
    """The cutoffs by hand from (stratum, rule -> ratio, label) of each labelled document."""
    strata = {s for s, _, _ in rows}
    sequences = {}
    for s in strata:
        good, bad = ([ratios for t, ratios, label in rows if t == s and label == of] for of in (1, 0))
        level, left, limits, tried = confidence / (len(names) * len(strata)), list(names), {}, []

        def hit(docs, limits):
            return sum(any(d[n] > c for n, c in limits.items()) for d in docs)

        while left:
            before = hit(bad, limits)
            rule = max(left, key=lambda n: hit(bad, {**limits, n: qr.GRID[-1]}) - before)
            left.remove(rule)
            last = before
            for c in qr.GRID:
                now = hit(bad, {**limits, rule: c})
                if now > last and qr.upper_tail(now - before, len(bad), risk) <= level:
                    last, limits = now, {**limits, rule: c}
                    tried.append((limits, qr.tail(hit(good, limits), len(good), risk)))
        if tried:
            sequences[s] = tried
    open_ones = sorted(sequences, key=lambda s: (max(p for _, p in sequences[s]), s or ""))
    done = []
    while open_ones and max(p for _, p in sequences[open_ones[0]]) <= confidence / len(open_ones):
        done.append(open_ones.pop(0))
    chosen = {}
    for s, tried in sequences.items():
        for limits, p in tried:
            if s not in done and p > confidence / len(open_ones):
                break
            chosen[s] = limits
    return {(s, n): c for s, limits in chosen.items() for n, c in limits.items()}


def test_kept_equals_a_plain_selection(spark):
    """At a tenth, the symbols are certified in all four languages, and no stratum loses too many good ones."""
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = qr.judge(docs, labels).collect()
    names = list(qr.rules())

    def ratios(r):
        words = max(r["n_words"], 1)
        return dict(zip(names, (r["n_symbols"] / words, r["n_dup_lines"] / max(r["n_lines"], 1), r["n_repeat_words"] / words,
                                max(r["word_chars"] / words - 10, 0) / 20)))

    quality = {r["doc_id"]: r["quality"] for r in labels.collect()}
    rows = [(r["stratum"], ratios(r), quality[r["doc_id"]]) for r in judged if quality.get(r["doc_id"]) in (0, 1) and not r["base_failed"]]
    limits = plain_selection(rows, names, qr.RISK, qr.CONFIDENCE)
    assert {s for s, rule in limits if rule == "symbols"} == {"en", "de", "fr", "es"}
    for r in judged:
        failed = [n for n, x in ratios(r).items() if x > limits.get((r["stratum"], n), np.inf)]
        assert r["failed"] == failed and r["kept"] == (not r["base_failed"] and not failed)
    for stratum in ("en", "de", "fr", "es"):
        good = [r["kept"] for r in judged if r["stratum"] == stratum and quality.get(r["doc_id"]) == 1 and not r["base_failed"]]
        assert np.mean(good) >= 0.98


def test_cutoffs_from_half_of_the_labels_spare_the_good_ones_of_the_other_half(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = qr.judge(docs, labels.where("doc_id % 2 = 0")).join(labels, "doc_id").where("doc_id % 2 = 1 AND NOT base_failed")
    lost = judged.where("quality = 1").groupBy("stratum").agg(F.avg((~F.col("kept")).cast("int")).alias("lost")).collect()
    assert all(r["lost"] <= 0.02 for r in lost)
    assert judged.where("quality = 0").agg(F.avg((~F.col("kept")).cast("int"))).first()[0] > 0.3
