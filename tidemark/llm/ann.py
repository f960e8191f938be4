"""Approximate nearest neighbours by largest inner product, from randomly rotated one-bit codes.

A few centres are fitted on a bounded sample. Each vector x, less its nearest centre c, is rotated by
a seeded random rotation and kept, once, as the signs of its coordinates (packed bits) with two
scalars: its length, and the inner product of the code's unit vector with the rotated direction. A
query's coordinates become ``PLANES`` bit planes; counting the bits that a plane shares with a code
gives, with <q, c> and the scalars, an unbiased estimate of <q, x>. Its error lies within ``bound``
standard deviations plus what rounding to planes can add.

Only codes meet all queries, in two passes over the same staged codes. The first takes each query's
``guesses`` * (``k`` + 1) best estimates; the (``k`` + 1)-th best of their exact products is a floor:
no result lies below it. The second
keeps the vectors whose upper bound reaches the floor. Original vectors are fetched for those alone,
by an equi-join, and reranked by the exact product.

Equal vectors are searched once, with the smallest k + 1 ids of each, so that a third of all rows
may be one vector. The distinct vectors and the distinct queries are dealt into blocks of bounded
size, and each task has one block of either: a stated query set against all rows. It returns at
most k + 1 rows for each of its queries, or places in its block.

Defined cases: vectors that are NULL, empty, zero, or hold NULL or non-finite components take no
part, as query or candidate; so do rows with a NULL id. Vectors of other lengths than the query's
are no candidates. Repeated (id, vector) rows count once; a vector's own id is never its result. An
empty table gives no rows. Columns of the input other than the two named, of whatever name, are not
read, and tied products go by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

SEED = 20240601
#: Distinct vectors and distinct queries to a block.
BLOCK_ROWS, BLOCK_QUERIES = 1 << 14, 1 << 11
#: The centres are fitted on at most so many distinct vectors; every vector is coded and searched.
SAMPLE, CENTERS = 4096, 64
#: Bits to a coordinate of a query, and pairs estimated at once.
PLANES, PAIRS = 8, 1 << 20
CODE = "dim int, kind long, near int, bits binary, length double, aligned double"


@lru_cache(maxsize=4)
def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random rotation: the Q of a Gaussian matrix, signs fixed by the diagonal of R."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _nearest(vectors: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(axis=1)[None, :] - 2 * vectors @ centers.T, axis=1)


def fit(sample: np.ndarray, n: int = CENTERS, rounds: int = 8, seed: int = SEED) -> np.ndarray:
    """Up to ``n`` centres of a bounded sample, by Lloyd's steps from spread-out vectors of it."""
    rng = np.random.default_rng(seed)
    centers, away = [sample.mean(axis=0)], None
    while len(centers) < min(n, len(sample) // 16):
        gap = ((sample - centers[-1]) ** 2).sum(axis=1)
        away = gap if away is None else np.minimum(away, gap)
        if not 0 < away.sum() < np.inf:
            break
        centers.append(sample[rng.choice(len(sample), p=away / away.sum())])
    found = np.array(centers)
    for _ in range(rounds if len(found) > 1 else 0):
        near = _nearest(sample, found)
        found = np.array([sample[near == i].mean(axis=0) if (near == i).any() else c for i, c in enumerate(found)])
    return found


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans as packed 64-bit words."""
    packed = np.packbits(bits, axis=-1)
    pad = [(0, 0)] * (packed.ndim - 1) + [(0, -packed.shape[-1] % 8)]
    return np.ascontiguousarray(np.pad(packed, pad)).view("uint64")


def encode(vectors: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each vector's centre, and the packed signs, length and <code, direction> of the rest."""
    near = _nearest(vectors, centers)
    rest = vectors - centers[near]
    length = np.linalg.norm(rest, axis=1)
    turned = (rest / np.where(length > 0, length, 1)[:, None]) @ rotation(vectors.shape[1]).T
    aligned = np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])
    return near, _words(turned > 0), length, aligned


def estimate(
    near: np.ndarray, bits: np.ndarray, length: np.ndarray, aligned: np.ndarray, queries: np.ndarray,
    centers: np.ndarray, bound: float,
) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products [query, vector] and their error bounds, from the packed bits."""
    dim = queries.shape[1]
    turned = queries @ rotation(dim).T
    low = turned.min(axis=1)
    step = (turned.max(axis=1) - low) / (2**PLANES - 1)
    level = np.rint((turned - low[:, None]) / np.where(step > 0, step, 1)[:, None]).astype("uint8")
    shared = np.zeros((len(queries), len(bits)), dtype="int32")
    for plane in range(PLANES):
        asked = _words((level >> plane) & 1)
        for word in range(bits.shape[1]):
            shared += np.bitwise_count(asked[:, word, None] & bits[None, :, word]).astype("int32") << plane
    ones = np.bitwise_count(bits).sum(axis=1, dtype="int64")
    # <signs, low + step * level>: twice the part under set bits, less the whole
    signed = (2 * shared - level.sum(axis=1, dtype="int64")[:, None]) * step[:, None]
    signed += low[:, None] * (2 * ones - dim)[None, :]
    safe = np.where(aligned > 0, aligned, 1)
    scale = np.where(aligned > 0, length / safe, 0) / np.sqrt(dim)
    about = signed * scale + (queries @ centers.T)[:, near]
    spread = np.sqrt(np.maximum(1 - safe**2, 0)) / safe / np.sqrt(max(dim - 1, 1)) * length
    slack = bound * np.linalg.norm(queries, axis=1)[:, None] * spread[None, :]
    slack += (dim / 2 * step)[:, None] * scale[None, :]  # rounding, at its worst
    slack += 1e-9 * np.abs(about) + 1e-12 * np.linalg.norm(queries, axis=1)[:, None] * length[None, :]
    return about, slack


def _matrix(values: pa.ChunkedArray | pa.Array) -> np.ndarray:
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    flat = values.flatten().to_numpy(zero_copy_only=False).astype("float64")
    return flat.reshape(len(values), -1)


def _coded(batch: pa.RecordBatch, centers: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    sizes = pc.list_value_length(batch["v"]).to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes).tolist():
        of = batch.filter(pa.array(sizes == dim))
        held = centers.get(dim, np.zeros((1, dim)))
        near, bits, length, aligned = encode(_matrix(of["v"]), held)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(near), dim, "int32")), of["kind"], pa.array(near.astype("int32")),
            pa.array([x.tobytes() for x in bits], pa.binary()), pa.array(length), pa.array(aligned)],
            ["dim", "kind", "near", "bits", "length", "aligned"])


def _estimates(asks: pa.Table, held: pa.Table, centers: dict[int, np.ndarray], bound: float
               ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first query's place, estimates, error bounds) for some of a block's queries after another."""
    dim = held["dim"][0].as_py()
    bits = np.frombuffer(b"".join(held["bits"].to_pylist()), "uint64").reshape(held.num_rows, -1)
    codes = (held["near"].to_numpy(), bits, held["length"].to_numpy(), held["aligned"].to_numpy())
    wanted, near = _matrix(asks["wanted"]), centers.get(dim, np.zeros((1, dim)))
    step = max(1, PAIRS // held.num_rows)
    for a in range(0, len(wanted), step):
        yield a, *estimate(*codes, wanted[a : a + step], near, bound)


def _best(asks: pa.Table, held: pa.Table, centers: dict, k: int) -> tuple[list, list, list]:
    """(query, kind, estimate) of the ``k`` best estimates of a block for each query."""
    query, kind, out = asks["query"].to_numpy(), held["kind"].to_numpy(), ([], [], [])
    for a, about, _ in _estimates(asks, held, centers, 0.0):
        at = np.argpartition(-about, k - 1, axis=1)[:, :k] if len(kind) > k else np.tile(np.arange(len(kind)), (len(about), 1))
        out[0].append(np.repeat(query[a : a + len(about)], at.shape[1]))
        out[1].append(kind[at].ravel())
        out[2].append(np.take_along_axis(about, at, axis=1).ravel())
    return tuple(np.concatenate(x) for x in out)


def _survivors(asks: pa.Table, held: pa.Table, centers: dict, bound: float) -> tuple[list, list, list]:
    """A row for each query with the places of the vectors whose upper bound reaches its floor, and one
    of no query with the vectors that have those places, in order."""
    query, floor, kind = asks["query"].to_numpy(), asks["floor"].to_numpy(), held["kind"].to_numpy()
    hits, used = [], np.zeros(len(kind), dtype=bool)
    for a, about, slack in _estimates(asks, held, centers, bound):
        reached = about + slack >= floor[a : a + len(about), None]
        used |= reached.any(axis=0)
        hits += [(int(query[a + i]), np.flatnonzero(row).astype("int32")) for i, row in enumerate(reached) if row.any()]
    if not hits:
        return [], [], []
    order = np.flatnonzero(used)
    order = order[np.argsort(kind[order])]
    place = np.zeros(len(kind), dtype="int32")
    place[order] = np.arange(len(order), dtype="int32")
    return [None, *(q for q, _ in hits)], [None, *(place[at] for _, at in hits)], [kind[order], *[None] * len(hits)]


def _rerank(asks: pa.Table, held: pa.Table, k: int) -> tuple[list, list, list]:
    """(query, kind, exact product) of the best ``k`` of each query's survivors in a block."""
    order = np.argsort(held["kind"].to_numpy())
    kind, first = held["kind"].to_numpy()[order], held["first"].to_numpy()[order]
    vectors = _matrix(held["v"])[order]
    wanted, out = _matrix(asks["wanted"]), ([], [], [])
    for query, row, at in zip(asks["query"].to_pylist(), wanted, asks["at"]):
        at = at.values.to_numpy()
        exact = vectors[at] @ row
        best = np.lexsort((first[at], -exact))[:k]
        out[0].extend([query] * len(best))
        out[1].extend(kind[at[best]].tolist())
        out[2].extend(exact[best].tolist())
    return out


def search(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding",
           bound: float = 2.0, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
           sample: int = SAMPLE, guesses: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query``, the ``k`` other rows with the
    largest inner product, nearest first, ties to the smaller id."""
    part = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0)
    ).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # -0.0 and 0.0 are one
    part = staged(part, "ann-vectors")
    # each distinct vector under its smallest id, with its smallest k + 1 ids; Spark applies the
    # limit before the shuffle too, so a frequent vector sends few rows from each task
    by_vector = Window.partitionBy("v").orderBy("id")
    members = part.select("id", "v").distinct().select(
        "id", "v", F.row_number().over(by_vector).alias("n")).where(F.col("n") <= k + 1)
    # an id with several vectors gives each of them a kind of its own
    kinds = members.groupBy("v").agg(F.min("id").alias("first"), F.array_sort(F.collect_list("id")).alias("ids"))
    kinds = staged(kinds.select("v", "ids", "first").withColumn("kind", F.monotonically_increasing_id()), "ann-kinds")
    asked = part.where("asks").select("v", F.col("id").alias("query_id")).distinct()
    asked = staged(asked.join(kinds, "v").select("query_id", "kind"), "ann-asked")
    asking = asked.select(F.col("kind").alias("query")).distinct().join(
        kinds, F.col("query") == F.col("kind")).select("query", F.col("v").alias("wanted"))

    rows, queries = kinds.count(), asked.select("kind").distinct().count()
    spread = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_rows = max(1, -(-rows // block_rows), min(spread, rows // 1024))
    n_queries = max(1, -(-queries // block_queries))
    drawn: dict[int, list] = {}
    for row in kinds.orderBy(F.xxhash64("v"), "kind").limit(sample).select("v").collect():  # at most ``sample``
        drawn.setdefault(len(row["v"]), []).append(row["v"])
    centers = {dim: fit(np.array(of)) for dim, of in drawn.items()}

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _coded(batch, centers)

    codes = staged(kinds.select("kind", "v").mapInArrow(coded, CODE), "ann-codes")

    def block(of: str, n: int) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def paired(asks: DataFrame, run, schema: str) -> DataFrame:
        """``run`` over each pair of a block of queries and a block of codes of one length."""
        left = asks.select("*", F.size("wanted").alias("dim"), block("query", n_queries).alias("bq"), every(n_rows).alias("br"))
        right = codes.select("*", block("kind", n_rows).alias("br"), every(n_queries).alias("bq"))
        keys = ("dim", "bq", "br")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)

    def first(asks: pa.Table, held: pa.Table) -> pa.Table:
        found = _best(asks, held, centers, guesses * (k + 1)) if asks.num_rows and held.num_rows else ((), (), ())
        return pa.table(dict(zip(("query", "kind", "about"), map(pa.array, found, (pa.int64(), pa.int64(), pa.float64())))))

    near = Window.partitionBy("query").orderBy(F.desc("about"), "kind")
    guessed = paired(asking, first, "query long, kind long, about double").select(
        "query", "kind", F.row_number().over(near).alias("n")).where(F.col("n") <= guesses * (k + 1))
    product = F.aggregate(F.zip_with("v", "wanted", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    floors = guessed.join(kinds.select("kind", "v"), "kind").join(asking, "query").groupBy("query").agg(
        F.coalesce(F.get(F.sort_array(F.collect_list(product), asc=False), F.lit(k)), F.lit(float("-inf"))).alias("floor"))
    asking = staged(asking.join(floors, "query"), "ann-asking")

    place = "dim int, bq int, br int"

    def second(asks: pa.Table, held: pa.Table) -> pa.Table:
        some = asks.num_rows and held.num_rows
        found = _survivors(asks, held, centers, bound) if some else ([], [], [])
        at = [[asks[c][0].as_py()] * len(found[0]) if some else [] for c in ("dim", "bq", "br")]
        types = [pa.int32()] * 3 + [pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64())]
        return pa.table(dict(zip(("dim", "bq", "br", "query", "at", "kinds"), map(pa.array, (*at, *found), types))))

    kept = staged(paired(asking, second, f"{place}, query long, at array<int>, kinds array<long>"), "ann-survivors")
    keys = ("dim", "bq", "br")
    own = [f"of_{c}" for c in keys]
    fetched = kept.where("query IS NULL").select(
        *(F.col(c).alias(o) for c, o in zip(keys, own)), F.explode("kinds").alias("kind")).join(
        kinds.select("kind", "first", "v"), "kind")
    waiting = kept.where("query IS NOT NULL").select(*keys, "query", "at").join(asking.select("query", "wanted"), "query")

    def third(asks: pa.Table, held: pa.Table) -> pa.Table:
        found = _rerank(asks, held, k + 1) if asks.num_rows else ([], [], [])
        return pa.table(dict(zip(("query", "kind", "score"), map(pa.array, found, (pa.int64(), pa.int64(), pa.float64())))))

    found = waiting.groupBy(*keys).cogroup(fetched.groupBy(*own)).applyInArrow(
        third, "query long, kind long, score double")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "first")
    best = found.join(kinds.select("kind", "first", "ids"), "kind").select(
        "query", "score", "ids", F.row_number().over(by_score).alias("n")).where(F.col("n") <= k + 1)
    ids = best.select("query", "score", F.explode("ids").alias("vec_id"))
    in_order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    ids = ids.select("*", F.row_number().over(in_order).alias("n")).where(F.col("n") <= k + 1)
    lists = ids.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("near"))
    others = asked.join(lists, asked["kind"] == lists["query"]).select("query_id", F.slice(
        F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return others.select("query_id", F.posexplode("near").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")
