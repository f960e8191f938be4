"""Toxicity: class-conditional Kneser-Ney models over byte n-grams.

Of all labelled training documents the n-grams of each class are counted (``ORDER`` bytes of the
lower-cased text, a Latin letter with an accent being one byte; every n-gram counts). At the top
order each class has its own discounted counts; below, both back off to one interpolated Kneser-Ney model of shared continuation counts, so that an
expression which neither class has seen often is judged by what both have in common. A document's
log-likelihoods under the two models are compared per byte over the whole text, in its most toxic
stretch, and word by word as evidence for a mixture (ordinary text with a share ``MIXED`` of toxic
words), divided by the root of the number of words. A logistic curve of the three, fitted on a
further fold of labelled documents, makes the score.

Counts and log-ratios are rows that Spark aggregates and joins: they grow with the corpus, every
n-gram has its own, and one that neither class has seen gets its context's backoff. Documents are
dealt to blocks of about ``BLOCK_BYTES`` by a hash; the n-grams of a block's distinct words are joined
with the model once, and a task holds one block and its ratios, never the model. Only the three
weights and the bias of the curve come from a sample: the ``CURVE_ROWS`` labelled rows with the
smallest hash.

Defined cases: NULL and empty texts have log-ratios 0 and get the curve's value there; without
labelled documents of both classes every score is 0; labels other than 0 and 1 and labels of
unknown documents are not used; a doc_id with two labels counts under each; repeated rows get
equal scores; rows with a NULL doc_id are scored and never learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks, key_of, staged

ORDER, DISCOUNT = 6, 0.75
#: Text of a block of documents, which share one look-up of their n-grams.
BLOCK_BYTES = 1 << 25
#: Text that a task scores at a time: arrays of eight bytes for each of its n-grams exist only for so much.
SCORED_BYTES = 1 << 20
#: Blocks in one list of those that want an n-gram; a frequent one has as many lists as it needs.
LIST_BLOCKS = 1 << 12
#: Bytes in the stretch whose mean log-ratio is the second feature; share of toxic words in the third.
STRETCH, MIXED = 12, 0.01
FEATURES = ("mean_ratio", "high_ratio", "evidence")
#: The hash of a scored row's text, which tells apart rows of one doc_id.
TEXT_HASH = "text_hash"
CURVE_ROWS = 20_000
SPACES = bytes.maketrans(b"\t\n\r\x0b\x0c", b"     ")
#: The first bytes of U+0080 to U+00FF: without them each of these characters is its second byte.
LEADS = b"\xc2\xc3"
PAD = b" " * (ORDER - 1)


def fold(doc_id: str = "doc_id") -> Column:
    """0 to 3, by the CRC-32 of the id's decimal text; 2 is held out."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def _plain(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """Each whole text in lower case, with spaces for white space and without ``LEADS``; NULL is empty."""
    return [(x or b"").translate(SPACES, LEADS) for x in pc.utf8_lower(column).cast(pa.binary()).to_pylist()]


def _normal(batch: pa.RecordBatch, text: str) -> list[bytes]:
    """Each plain text behind a margin of spaces, each white space made such a margin: a word is
    judged from its own start on, whatever stands before it."""
    plain = _plain(batch.column(batch.schema.get_field_index(text)))
    return [PAD + x.replace(b" ", PAD) for x in plain]


def _grams(data: bytes) -> np.ndarray:
    """The n-gram that ends at each byte from the margin's end on, as an integer."""
    raw = np.frombuffer(data, dtype="uint8").astype("int64")
    n = len(raw) - ORDER + 1
    out = np.zeros(max(n, 0), dtype="int64")
    for j in range(ORDER):
        out = (out << 8) | raw[j : n + j]
    return out


def count_grams(labelled: DataFrame, text: str = "text", label: str = "toxic") -> DataFrame:
    """(gram, toxic, ordinary): how often each n-gram ends in a text of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = _normal(batch, text)
            labels = batch.column(batch.schema.get_field_index(label)).to_pylist()
            for of in (0, 1):
                own = [x for x, y in zip(texts, labels) if y == of]
                for a, b in chunks(own, 1 << 22):
                    # a text's margin lets no n-gram reach over from the text before
                    every = _grams(b"".join(own[a:b]))
                    ends = np.cumsum([len(x) for x in own[a:b]])[:-1]
                    over = (ends[:, None] - np.arange(1, ORDER)[None, :]).ravel()
                    gram, n = np.unique(np.delete(every, over), return_counts=True)
                    zero = np.zeros(len(n), dtype="int64")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(gram), pa.array(n if of else zero), pa.array(zero if of else n)],
                        names=["gram", "toxic", "ordinary"])

    counted = labelled.select(text, label).mapInArrow(run, "gram long, toxic long, ordinary long")
    return counted.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def _shared(grams: DataFrame) -> DataFrame:
    """(gram, p) for the n-grams of order ``ORDER - 1``: interpolated Kneser-Ney over both classes.

    The count of an n-gram below the top order is in how many ways it is preceded."""
    orders = {ORDER: grams.select("gram")}
    for n in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit((1 << (8 * n)) - 1))
        orders[n] = orders[n + 1].groupBy(suffix.alias("gram")).agg(F.count("*").alias("c"))
    one = orders[1]
    p = one.select("gram", (F.col("c") / F.sum("c").over(Window.partitionBy(F.lit(0)))).alias("p"))  # 256 rows at most
    for n in range(2, ORDER):
        context = Window.partitionBy(F.shiftright("gram", 8))  # at most 256 rows
        stats = orders[n].select(
            "gram", "c", F.sum("c").over(context).alias("s"), F.count("*").over(context).alias("n"),
            F.col("gram").bitwiseAND(F.lit((1 << (8 * (n - 1))) - 1)).alias("suffix"))
        lower = p.select(F.col("gram").alias("suffix"), F.col("p").alias("below"))
        p = stats.join(lower, "suffix").select("gram", (
            (F.greatest(F.col("c") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("n") * F.col("below")) / F.col("s")).alias("p"))
    return p


def log_ratios(grams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, ratio, weight) of each counted n-gram, log toxic over ordinary probability, and
    (context, ratio, weight): the same for any n-gram that neither class has after that context."""
    context = Window.partitionBy(F.shiftright("gram", 8))  # at most 256 rows
    stats = grams.select("*", *[x.over(context).alias(n) for n, x in (
        ("ct", F.sum("toxic")), ("co", F.sum("ordinary")),
        ("nt", F.count_if(F.col("toxic") > 0)), ("no", F.count_if(F.col("ordinary") > 0)))])

    def backoff(total: str, kinds: str) -> Column:
        return F.when(F.col(total) > 0, DISCOUNT * F.col(kinds) / F.col(total)).otherwise(F.lit(1.0))

    def kept(count: str, total: str) -> Column:
        share = F.greatest(F.col(count) - DISCOUNT, F.lit(0.0)) / F.col(total)
        return F.when(F.col(total) > 0, share).otherwise(F.lit(0.0))

    shared = _shared(grams).select(F.col("gram").alias("suffix"), F.col("p").alias("shared"))
    suffix = F.col("gram").bitwiseAND(F.lit((1 << (8 * (ORDER - 1))) - 1))
    seen = stats.withColumn("suffix", suffix).join(shared, "suffix").select(
        "gram",
        (F.log(kept("toxic", "ct") + backoff("ct", "nt") * F.col("shared"))
         - F.log(kept("ordinary", "co") + backoff("co", "no") * F.col("shared"))).alias("ratio"),
        (F.col("toxic") + F.col("ordinary")).alias("weight"))
    unseen = stats.groupBy(F.shiftright("gram", 8).alias("context")).agg(
        F.first(F.log(backoff("ct", "nt")) - F.log(backoff("co", "no"))).alias("ratio"),
        F.first(F.col("ct") + F.col("co")).alias("weight"))
    return seen, unseen


def _summed(data: bytes, ratio: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each padded text in ``data``, with a ratio for each n-gram: mean log-ratio, that of its
    highest stretch, and the evidence of its words (a word ends with its space)."""
    total = np.concatenate([np.zeros(ORDER - 1), [0.0], np.cumsum(ratio, dtype="float64")])  # total[i]: up to byte i
    starts = np.concatenate([[0], ends[:-1]]) + len(PAD)
    n = np.maximum(ends - starts, 1)
    mean = (total[ends] - total[starts]) / n
    high = np.zeros(len(ends))
    for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
        if b > a:
            w = min(STRETCH, b - a)
            high[i] = (total[a + w : b + 1] - total[a : b + 1 - w]).max() / w
    space = np.frombuffer(data, dtype="uint8") == 32
    first = np.flatnonzero(space[:-1] & ~space[1:]) + 1  # a word: every text begins with spaces
    last = np.append(np.flatnonzero(~space[:-1] & space[1:]) + 2, len(data))[: len(first)]
    of = np.searchsorted(ends, first, "right")
    word = total[np.minimum(last, ends[of])] - total[first]
    one = np.log1p(MIXED * np.expm1(np.minimum(word, 30.0)))
    words = np.bincount(of, minlength=len(ends))
    evidence = np.bincount(of, weights=one, minlength=len(ends)) / np.sqrt(words + 5.0)
    return mean, high, evidence


def _blocks(texts: DataFrame, n: int) -> DataFrame:
    """(block, rows): ``texts`` dealt to blocks by a hash; a task's rows of a block are packed as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(0).to_numpy()
            order = np.argsort(block, kind="stable")
            kinds, first = np.unique(block[order], return_index=True)
            for k, rows in zip(kinds, np.split(order, first[1:])):
                piece, sink = batch.take(pa.array(rows)).select(["doc_id", "text", TEXT_HASH]), pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, piece.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "rows"])

    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")
    return texts.select(block.alias("block"), "doc_id", "text", F.xxhash64("text").alias(TEXT_HASH)).mapInArrow(run, "block int, rows binary")


def _unpacked(block: pa.Table) -> Iterator[pa.Table]:
    for rows in block["rows"]:
        yield pa.ipc.open_stream(rows.as_buffer()).read_all()


def _words(plain: list[bytes]) -> pa.DictionaryArray:
    """The words of the texts in order; white space beside white space has an empty word between."""
    return pa.array(b" ".join(plain).split(b" "), pa.binary()).dictionary_encode()


def _wanted(block: pa.Table) -> pa.Table:
    """(block, gram): the distinct n-grams of a block's documents."""
    words: set[bytes] = set()
    for rows in _unpacked(block):
        plain = _plain(rows["text"])
        for a, b in chunks(plain, SCORED_BYTES):
            words.update(_words(plain[a:b]).dictionary.to_pylist())
    every, found = list(words), [np.zeros(0, dtype="int64")]
    for a, b in chunks(every, 1 << 20):
        found.append(np.unique(_grams(PAD + PAD.join(every[a:b]) + PAD)))
    grams = np.unique(np.concatenate(found))
    return pa.table({"block": pa.array(np.full(len(grams), block["block"][0].as_py(), dtype="int32")), "gram": pa.array(grams)})


def _ratios(words: pa.DictionaryArray, grams: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """The ratio of each n-gram of the words in order, each with the margin behind it."""
    kinds = words.dictionary.to_pylist()
    gram = _grams(PAD + PAD.join(kinds) + PAD)
    place = np.minimum(np.searchsorted(grams, gram), max(len(grams) - 1, 0))
    if not np.array_equal(grams[place], gram):
        raise ValueError("an n-gram of the block was not looked up")
    length = np.array([len(x) + len(PAD) for x in kinds])
    start = np.cumsum(length) - length
    of = words.indices.to_numpy()
    n = length[of]
    shift = start[of] - (np.cumsum(n) - n)
    where = np.repeat(shift, n)
    where += np.arange(len(where))
    return ratios[place][where]


def _block_features(block: pa.Table, model: pa.Table) -> pa.Table:
    """(doc_id, ``TEXT_HASH``, the ``FEATURES``) of a block's documents, by the ratios of its n-grams."""
    order = np.argsort(model["gram"].to_numpy())
    grams, ratios = model["gram"].to_numpy()[order], model["ratio"].to_numpy()[order]
    ids, hashes, parts = [], [], []
    for rows in _unpacked(block):
        ids += rows["doc_id"].chunks
        hashes += rows[TEXT_HASH].chunks
        plain = _plain(rows["text"])
        for a, b in chunks(plain, SCORED_BYTES):
            some = plain[a:b]
            data = PAD + b" ".join(some).replace(b" ", PAD)
            ends = np.cumsum([len(PAD) + len(x) + (len(PAD) - 1) * x.count(b" ") for x in some])
            ratio = _ratios(_words(some), grams, ratios)[: len(data) - len(PAD)]
            parts.append(_summed(data, ratio, ends))
    every = [np.concatenate(x) for x in zip(*parts)]
    return pa.table({"doc_id": pa.chunked_array(ids), TEXT_HASH: pa.chunked_array(hashes), **dict(zip(FEATURES, every))})


def with_features(texts: DataFrame, seen: DataFrame, unseen: DataFrame) -> DataFrame:
    """(doc_id, ``TEXT_HASH``, the ``FEATURES``) of each whole text, by the exact ratios of ``log_ratios``."""
    size = texts.agg(F.sum(F.octet_length("text").cast("double"))).first()[0] or 0
    n = max(1, -int(-size // BLOCK_BYTES))
    blocks = _blocks(texts, n)
    wanted = blocks.groupBy("block").applyInArrow(_wanted, "block int, gram long")
    # few rows an n-gram: both joins are of lists of at most about LIST_BLOCKS blocks, whatever their number
    part = F.pmod("block", F.lit(-(-n // LIST_BLOCKS)))
    kinds = wanted.groupBy("gram", part.alias("part")).agg(F.collect_list("block").alias("blocks"))
    backoff = unseen.select("context", F.col("ratio").alias("backoff"))
    known = kinds.join(seen.select("gram", "ratio"), "gram", "left").join(
        backoff, F.shiftright("gram", 8) == F.col("context"), "left")
    ratio = F.coalesce("ratio", "backoff", F.lit(0.0)).cast("float")
    model = known.select(F.explode("blocks").alias("block"), "gram", ratio.alias("ratio"))

    schema = T.StructType([texts.schema["doc_id"], T.StructField(TEXT_HASH, T.LongType()), *(T.StructField(n, T.DoubleType()) for n in FEATURES)])
    return blocks.groupBy("block").cogroup(model.groupBy("block")).applyInArrow(_block_features, schema)


def _curve(rows: list[tuple]) -> list[float] | None:
    """Weights of the features and a bias: logistic regression by Newton's method; None with one class."""
    k = len(FEATURES)
    x = np.array([r[:k] for r in rows], dtype="float64").reshape(-1, k)
    y = np.array([r[k] for r in rows], dtype="float64")
    if not len(y) or y.min() == y.max():
        return None
    middle, spread = x.mean(axis=0), x.std(axis=0) + 1e-12
    x = np.column_stack([(x - middle) / spread, np.ones(len(y))])
    weights, ridge = np.zeros(k + 1), np.diag([0.1] * k + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -35, 35)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (y - p) - ridge @ weights)
        weights += step
        if np.abs(step).max() < 1e-9:
            break
    slopes = weights[:k] / spread
    return [*map(float, slopes), float(weights[k] - slopes @ middle)]


def score(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic"
) -> DataFrame:
    """(doc_id, ``TEXT_HASH``, the ``FEATURES``, score), a row for each row of ``docs``.

    ``labels`` has the doc_id and the label; folds 0 and 1 train the models, fold 3 the curve,
    fold 2 is held out from both."""
    known = labels.select(F.col(doc_id).alias("_of"), F.col(label).cast("int").alias("_label")).where("_label IN (0, 1)")
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    # labels grow with the corpus, so they are never sent to every task: one plan for every size
    learnt = known.where(fold("_of").isin(0, 1)).hint("merge")
    train = texts.where(fold("doc_id").isin(0, 1)).join(learnt, F.col("doc_id") == F.col("_of"))
    grams = staged(count_grams(train, "text", "_label"), "toxicity-grams")
    seen, unseen = log_ratios(grams)
    features = staged(with_features(texts, seen, unseen), "toxicity-features")
    sample = features.join(known.where(fold("_of") == 3), F.col("doc_id") == F.col("_of")).orderBy(
        F.xxhash64("doc_id", "_label"), "doc_id", *FEATURES).limit(CURVE_ROWS)
    curve = _curve([tuple(r[n] for n in (*FEATURES, "_label")) for r in sample.collect()])
    if curve is None:
        return features.withColumn("score", F.lit(0.0))
    *slopes, bias = curve
    line = F.lit(bias)
    for name, slope in zip(FEATURES, slopes):
        line = line + F.lit(slope) * F.col(name)
    return features.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(line, F.lit(500.0)), F.lit(-500.0)))))


def without_toxic(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic", limit: float = 0.3
) -> DataFrame:
    """The rows of ``docs`` whose score is below ``limit``, each judged by its own text: rows that share a
    doc_id, or have none, are told apart by the hash of their text."""
    scored = score(docs, labels, text, doc_id, label)
    bad = scored.where(F.col("score") >= limit).select(key_of("doc_id").alias("_of"), F.col(TEXT_HASH).alias("_hash"))
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), key_of(doc_id).alias("_key"), F.xxhash64(F.col(text).cast("string")).alias("_text"))
    same = (F.col("_key") == F.col("_of")) & (F.col("_text") == F.col("_hash"))
    return rows.join(bad.distinct().hint("merge"), same, "left_anti").select("row.*")
