"""Counts follow the inverse Poisson distribution; shares meet the weights; edge cases."""

import hashlib
import math

from pyspark.sql import functions as F

from tidemark.llm import mixing


def brute_count(rate, seed, doc_id, part=1):
    text = f"{seed}|{'' if doc_id is None else doc_id}|{part}"
    u = int(hashlib.md5(text.encode()).hexdigest()[:13], 16) / 2**52
    k, p = 0, math.exp(-rate)
    total = p
    while total <= u and k < 2000:
        k += 1
        p *= rate / k
        total += p
    return k


def _docs(spark, n=2000):
    rows = [(i, "x" * (10 + i % 7), "hot" if i % 3 else f"s{i % 5}", "c") for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, cumulative string")


def test_counts_and_shares(spark):
    docs = _docs(spark)
    weights = spark.createDataFrame([("hot", 1.0), ("s0", 2.0), ("s3", 1.0), ("s1", 0.0), ("other", 5.0)], "source string, weight double")
    out = mixing.mix(docs, weights, budget=60_000.0, seed=11).persist()
    assert out.columns == [*docs.columns, "copy"]
    got = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    size = {r["source"]: r["n"] for r in docs.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    weight = {"hot": 1.0, "s0": 2.0, "s3": 1.0}
    for r in docs.collect():
        rate = weight.get(r["source"], 0.0) / 4.0 * 60_000 / size[r["source"]]
        assert got.get(r["doc_id"], 0) == (brute_count(rate, 11, r["doc_id"]) if rate else 0)
    share = {r["source"]: r["n"] for r in out.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert set(share) == set(weight)
    for source, w in weight.items():
        assert abs(share[source] / 60_000 - w / 4.0) < 0.05
    copies = out.groupBy("doc_id").agg(F.sort_array(F.collect_list("copy")).alias("c"))
    assert all(r["c"] == list(range(len(r["c"]))) for r in copies.collect())
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()


def test_the_order_is_shuffled_and_repeats(spark):
    docs = _docs(spark, 600)
    one, two = ([r["doc_id"] for r in mixing.mix(docs).collect()] for _ in range(2))
    assert sorted(one) == sorted(two)
    assert one != sorted(one)
    assert mixing.mix(docs, seed=8).count() != 0


def test_large_rates_are_sums_of_parts(spark):
    docs = spark.createDataFrame([(i, "abcd", "s") for i in range(40)], "doc_id long, text string, source string")
    out = mixing.mix(docs, budget=4 * 40 * 1300.0)
    counts = [r["count"] for r in out.groupBy("doc_id").count().collect()]
    assert abs(sum(counts) / 40 - 1300) < 5 * math.sqrt(1300 / 40)
    want = {i: sum(brute_count(1300 / 3, 7, i, part) for part in (1, 2, 3)) for i in range(40)}
    assert {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()} == want


def test_edge_cases(spark):
    rows = [(1, None, "empty"), (2, "", "empty"), (3, "text", None), (None, "other text", "a"), (None, None, None),
            (4, "same", "b"), (4, "same", "b")]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, source string, copy int")
    out = mixing.mix(docs)
    assert out.columns == ["doc_id", "text", "source", "copy"]
    found = out.collect()
    assert sorted(r["doc_id"] for r in found if r["source"] == "empty") == [1, 2]  # no size: once each
    n = sum(r["doc_id"] == 4 for r in found)
    assert n % 2 == 0  # equal rows, equal counts
    assert mixing.mix(spark.createDataFrame([], docs.schema)).collect() == []
    odd = spark.createDataFrame([("b", None), ("a", -1.0), (None, 1.0)], "source string, weight double")
    assert {r["source"] for r in mixing.mix(docs, odd).collect()} <= {None}
    none = spark.createDataFrame([], "source string, weight double")
    assert mixing.mix(docs, none).collect() == []


def test_sql_at_rates_of_several_parts(spark, tmp_path):
    import duckdb

    from tidemark.llm import queries

    rows = [(1, "a", "en", "small", 1), (2, "b" * 4000, "en", "large", 4000), (3, None, "en", "empty", 0), (4, "c" * 9, "en", None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
        want = sorted(db.execute(f"SELECT doc_id, copy FROM ({queries.OP10_SQL})").fetchall())
    got = sorted(tuple(r) for r in queries.op10_mixing(spark, str(tmp_path)).select("doc_id", "copy").collect())
    assert got == want and len(want) > 900 and (3, 0) in want
