"""Held-out accuracy, the probabilities' sums, and edge cases."""

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import toxicity


def test_held_out_accuracy(spark):
    from tidemark.llm.queries import op2_toxicity

    sf = "/root/testdata/sf0.1"  # a hundredth has 14 toxic documents held out
    got = op2_toxicity(spark, sf).persist()
    assert got.count() == 10_000
    assert got.where("score < 0 OR score > 1 OR score IS NULL").count() == 0
    rows = got.where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    toxic = [r["score"] for r in rows if r["toxic"] == 1]
    clean = [r["score"] for r in rows if r["toxic"] == 0]
    auc = np.mean(np.array(toxic)[:, None] > np.array(clean)[None, :])
    assert auc > 0.93
    assert np.mean([s >= 0.3 for s in clean]) < 0.05
    assert np.mean([s >= 0.3 for s in toxic]) > 0.65


def plain_ratios(texts):
    """Kneser-Ney by hand: (n-gram -> log-ratio, context -> log-ratio of what was never seen after it)."""
    order, discount = toxicity.ORDER, toxicity.DISCOUNT
    pad = " " * (order - 1)
    counts = [{}, {}]
    for text, of in texts:
        line = pad + text.lower().replace(" ", pad)
        for i in range(order, len(line) + 1):
            gram = line[i - order : i]
            counts[of][gram] = counts[of].get(gram, 0) + 1
    kinds, below = {*counts[0], *counts[1]}, None
    orders = {order: kinds}
    ways = {}
    for n in range(order - 1, 0, -1):
        ways[n] = {}
        for gram in orders[n + 1]:
            ways[n][gram[1:]] = ways[n].get(gram[1:], 0) + 1
        orders[n] = set(ways[n])
    below = {g: c / sum(ways[1].values()) for g, c in ways[1].items()}
    for n in range(2, order):
        now = {}
        for gram, c in ways[n].items():
            after = [v for g, v in ways[n].items() if g[:-1] == gram[:-1]]
            now[gram] = (max(c - discount, 0) + discount * len(after) * below[gram[1:]]) / sum(after)
        below = now
    totals = [{}, {}]
    for of in (0, 1):
        for gram, c in counts[of].items():
            total, n = totals[of].get(gram[:-1], (0, 0))
            totals[of][gram[:-1]] = (total + c, n + 1)

    def p(of, gram, shared):
        total, n = totals[of].get(gram[:-1], (0, 0))
        return (max(counts[of].get(gram, 0) - discount, 0) + discount * n * shared) / total if total else shared

    seen = {g: np.log(p(1, g, below[g[1:]])) - np.log(p(0, g, below[g[1:]])) for g in kinds}
    weight = lambda of, c: discount * totals[of][c][1] / totals[of][c][0] if c in totals[of] else 1.0
    unseen = {c: np.log(weight(1, c)) - np.log(weight(0, c)) for c in {g[:-1] for g in kinds}}
    return seen, unseen, below


def test_ratios_equal_kneser_ney_by_hand(spark):
    """Each n-gram's and each context's ratio; and over all bytes seen anywhere, the shared
    probabilities after a context make 1 with what is left for the others."""
    texts = ["abracadabra", "abracabra", "cadabra abra", "dabra", "abra cad", "bra bra brac"]
    rows = [(t, i % 2) for i, t in enumerate(texts)]
    grams = toxicity.count_grams(spark.createDataFrame(rows, "text string, toxic int")).persist()
    total = sum(len(t) + (toxicity.ORDER - 2) * t.count(" ") for t in texts)  # each space is a margin
    assert grams.agg(F.sum(F.col("toxic") + F.col("ordinary"))).first()[0] == total
    seen, unseen, shared = plain_ratios(rows)
    text = lambda key, n: key.to_bytes(n, "big").decode()
    got = {text(r["gram"], toxicity.ORDER - 1): r["p"] for r in toxicity._shared(grams).collect()}
    assert got.keys() == shared.keys() and all(np.isclose(got[g], shared[g]) for g in got)
    of_gram, of_context = toxicity.log_ratios(grams)
    got = {text(r["gram"], toxicity.ORDER): r["ratio"] for r in of_gram.collect()}
    assert got.keys() == seen.keys() and all(np.isclose(got[g], seen[g]) for g in got)
    got = {text(r["context"], toxicity.ORDER - 1): r["ratio"] for r in of_context.collect()}
    assert got.keys() == unseen.keys() and all(np.isclose(got[c], unseen[c]) for c in got)


def test_edge_cases(spark):
    texts = ["you are an idiot and worthless", "a calm walk by the river", None, "", " \n", "x" * 200_000]
    docs = spark.createDataFrame(
        [(i % 200, texts[i % 2] + f" {i}", "s") for i in range(400)] + [(1000 + i, t, "s") for i, t in enumerate(texts)]
        + [(None, "idiot worthless", "s"), (None, None, "s")], "doc_id long, text string, score string")
    labels = spark.createDataFrame(
        [(i, i % 2 ^ 1, 1) for i in range(200)] + [(5, 3, 1), (None, 1, 1), (99999, 1, 1), (7, None, 1)],
        "doc_id long, toxic int, extra int")
    scored = toxicity.score(docs, labels).persist()
    assert scored.count() == docs.count()
    assert scored.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    high = scored.where("doc_id < 200 AND doc_id % 2 = 0").agg(F.avg("score")).first()[0]
    low = scored.where("doc_id < 200 AND doc_id % 2 = 1").agg(F.avg("score")).first()[0]
    assert high > 0.8 > 0.2 > low
    kept = toxicity.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert [r["text"] for r in kept.where("doc_id IS NULL").collect()] == [None]  # judged by their text
    none = spark.createDataFrame([], labels.schema)
    assert toxicity.score(docs, none).where("score <> 0").count() == 0
    assert toxicity.score(spark.createDataFrame([], docs.schema), labels).collect() == []
    one = labels.where("toxic = 1")
    assert toxicity.score(docs, one).where("score <> 0").count() == 0


def test_rows_of_one_doc_id_are_judged_by_their_own_text(spark):
    texts = ["you are an idiot and worthless", "a calm walk by the river"]
    docs = spark.createDataFrame([(i, texts[i % 2] + f" {i}") for i in range(200)] + [
        (7, texts[0]), (7, texts[1]), (7, texts[1]), (None, texts[0]), (None, texts[1]), (9, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(0, 200) if i != 7], "doc_id long, toxic int")
    kept = toxicity.without_toxic(docs, labels)
    assert sorted(r["text"] for r in kept.where("doc_id = 7").collect()) == [texts[1], texts[1], texts[1] + " 7"]
    assert [r["text"] for r in kept.where("doc_id IS NULL").collect()] == [texts[1]]
    assert kept.where("doc_id = 9").count() == 2


def test_features_equal_brute_force():
    rng = np.random.default_rng(0)
    texts = [toxicity.PAD + t for t in (b"short", b"", b"y" * 31, b"some longer text " * 9)]
    data, ends = b"".join(texts), np.cumsum([len(t) for t in texts])
    every = rng.normal(size=len(data) - len(toxicity.PAD))
    mean, high, evidence = toxicity._summed(data, every, ends)
    for t, end, m, h, e in zip(texts, ends, mean, high, evidence):
        size = len(t) - len(toxicity.PAD)
        r = every[end - len(toxicity.PAD) - size : end - len(toxicity.PAD)]
        if not size:
            assert (m, h, e) == (0, 0, 0)
            continue
        sums, at = [], 0
        for word in t[len(toxicity.PAD):].split(b" "):
            size = min(len(word) + 1, len(r) - at)
            if size:
                sums.append(min(r[at:at + size].sum(), 30))
            at += size
        want = sum(np.log1p(toxicity.MIXED * np.expm1(x)) for x in sums) / np.sqrt(len(sums) + 5)
        assert np.isclose(e, want)
        w = min(toxicity.STRETCH, len(r))
        assert np.isclose(m, r.mean())
        assert np.isclose(h, max(r[i:i + w].mean() for i in range(len(r) - w + 1)))


def test_each_gram_keeps_its_own_ratio(spark):
    """Rare toxic words and frequent ordinary ones of few letters; unseen n-grams get the backoff."""
    rng = np.random.default_rng(1)
    words = np.unique(rng.integers(97, 103, (40, 5)).astype("uint8").view("S5").ravel()).tolist()
    pairs = [(words[2 * i].decode(), words[2 * i + 1].decode()) for i in range(4)]
    texts = [(a + " calm") if i % 2 else f"{b} {b}\u2003{b.upper()}  calm\n{b} " for i in range(200) for a, b in [pairs[i // 2 % 3]]]
    texts += [pairs[3][0], pairs[0][0] + " " + pairs[0][1], "", None, " \n ", "zq\u00e9 " * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    train = docs.join(labels, "doc_id").where(toxicity.fold().isin(0, 1))
    seen, unseen = toxicity.log_ratios(toxicity.count_grams(train).persist())
    by_gram = {r["gram"]: r["ratio"] for r in seen.collect()}
    by_context = {r["context"]: r["ratio"] for r in unseen.collect()}
    got = {r["doc_id"]: r["mean_ratio"] for r in toxicity.score(docs, labels).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        data = toxicity.PAD + (t or "").lower().encode().translate(toxicity.SPACES, toxicity.LEADS).replace(b" ", toxicity.PAD)
        ratios = [by_gram.get(g, by_context.get(g >> 8, 0.0)) for g in toxicity._grams(data).tolist()]
        assert np.isclose(got[i], np.mean(ratios or [0.0]), atol=1e-5), (i, t)


def test_a_task_scores_a_block_in_portions():
    import tracemalloc

    import pyarrow as pa

    rng = np.random.default_rng(3)
    words = ["".join(map(chr, rng.integers(97, 123, 7))) for _ in range(2000)]
    texts = [" ".join(rng.choice(words, 2000)) for _ in range(260)]  # 4 MB in all
    piece = pa.table({"doc_id": range(260), "text": texts, toxicity.TEXT_HASH: range(260)})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, piece.schema) as out:
        out.write_table(piece)
    block = pa.table({"block": pa.array([0], pa.int32()), "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})
    grams = toxicity._wanted(block)["gram"]
    model = pa.table({"gram": grams, "ratio": pa.array(rng.normal(size=len(grams)).astype("float32"))})
    tracemalloc.start()
    got = toxicity._block_features(block, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got["doc_id"].to_pylist() == list(range(260))
    assert peak < 80 << 20, f"{peak >> 20} MB for 4 MB of text"
