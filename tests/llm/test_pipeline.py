"""The pipeline's stages: columns, what each keeps, and the run against brute force."""

import base64
import math

import corpus_pipeline
import public_tokenizers
import tiktoken

from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_mixing import brute_count
from tests.llm.test_simhash import brute_classes, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force_after_the_first_stage(spark):
    """Toxicity is judged by its own test; the rest of the run is repeated in plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, SF).persist()
    assert kept.columns == docs.columns
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = {r["doc_id"]: r for r in kept.collect()}
    clean = [d for d, t in labels.items() if t == 0]
    assert sum(d in rows for d in clean) >= 0.9 * len(clean)

    ids = sorted(rows)
    texts = dict(zip(ids, brute_lines([(i, rows[i]["text"], rows[i]["source"]) for i in ids], 8)))
    root = brute_classes({i: brute_fingerprint(texts[i]) for i in ids})
    left = [i for i in ids if root[i] == i]
    sizes = {}
    for i in left:
        sizes[rows[i]["source"]] = sizes.get(rows[i]["source"], 0) + len(texts[i])
    share = sum(sizes.values()) / len(sizes)
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i in left:
        size = sizes[rows[i]["source"]]
        n = brute_count(share / size, 7, i) if size else 1
        want += [(i, reference.encode_ordinary(texts[i]))] * n
    got = [(r["doc_id"], r["ids"]) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want)
    assert math.isclose(len(got), len(left), rel_tol=0.3)


def test_stages(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "near_duplicates", "mixing", "byte_bpe"]
    empty = spark.createDataFrame([], spark.read.parquet(f"{SF}/documents.parquet").schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).collect() == []
