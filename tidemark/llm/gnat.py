"""Hard-negative mining in a GNAT-style multiway hyperplane tree.

Every node of the tree has up to ``FANOUT`` split points; a vector goes to the nearest one, so that
the hyperplanes between split points part it from the siblings. Each split point stores the range of
its distances to the vectors below each sibling. The points are chosen on a bounded sample (far
apart from each other); the ranges, and the ranges of the vectors' norms, are aggregated from all rows.

A row's score is its inner product s with the anchor a. As |a - x|^2 = |a|^2 + |x|^2 - 2 s, a window
of scores is an annulus of distances around the anchor. A subtree is out if, for any split point of
its node, no distance in its stored range and the anchor's distance to the point meet the annulus by
the triangle inequality. What is left goes down to the leaves, where scores are exact integers.

Positives and negatives each take two rounds. The first visits the leaf that the anchor itself falls
into and gives a lower bound of the scores that can still matter (the n-th best positive, the n-th
best of each window); the second visits all leaves that the annulus above that bound meets. A leaf is
split into chunks of ``LEAF_ROWS`` rows by a hash, so a leaf of any size is many tasks, and anchors
come in blocks: a task has one chunk, one block of anchors, and returns at most n rows a window.

Defined cases: rows with a NULL id, label or vector, an empty vector, or a NULL or non-finite
component (as given or scaled) take no part; vectors of another length than the anchor's are no
partners (each length has a tree of its own); rows equal in all three count once, and a row with the anchor's id is never its
partner; scores are exact while sums of products stay below 2^63, and the job fails beyond; equal
scores come by smaller id; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Split points of a node; rows to a chunk of a leaf; anchors to a block; vectors that the split points
#: are chosen from, at most (a leaf then holds a share of all rows, in as many chunks as it needs).
FANOUT, LEAF_ROWS, BLOCK_ANCHORS, SAMPLE = 12, 4096, 2048, 20_000
#: Nodes on a way down, at most; and the share of the norms that a distance may be off by.
DEPTH, SLACK = 60, 1e-6


@dataclass
class Node:
    """Split points, and what is below each: a node or a leaf's number."""

    number: int
    points: np.ndarray
    below: list[Node | int]
    low: np.ndarray = field(default_factory=lambda: np.zeros(0))  # [point, sibling]
    high: np.ndarray = field(default_factory=lambda: np.zeros(0))
    norms: np.ndarray = field(default_factory=lambda: np.zeros(0))  # [sibling, (least, most)]


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(square, 0))


def _far_apart(sample: np.ndarray, k: int) -> np.ndarray:
    """Up to ``k`` distinct vectors, each the farthest from those before it."""
    chosen = [0]
    near = distances(sample, sample[:1])[:, 0]
    while len(chosen) < k and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(sample, sample[chosen[-1:]])[:, 0])
        near[chosen] = 0
    return sample[chosen]


def plant(sample: np.ndarray, share: int, numbers: Iterator[int], leaves: Iterator[int], depth: int = 0) -> Node | int:
    """A tree over ``sample`` whose leaves have at most ``share`` of its vectors, or no two distinct ones."""
    points = _far_apart(sample, FANOUT) if len(sample) > max(share, 1) and depth < DEPTH else sample[:1]
    if len(points) < 2:
        return next(leaves)
    node = Node(next(numbers), points, [])
    nearest = distances(sample, points).argmin(axis=1)
    node.below = [plant(sample[nearest == i], share, numbers, leaves, depth + 1) for i in range(len(points))]
    return node


def _down(node: Node | int, vectors: np.ndarray, rows: np.ndarray, leaf: np.ndarray, seen: list[tuple]) -> None:
    """Leaves of the rows, and (node, point, sibling, distances, norms) of all siblings on the way."""
    if isinstance(node, int):
        leaf[rows] = node
        return
    far = distances(vectors[rows], node.points)
    nearest = far.argmin(axis=1)
    for j, below in enumerate(node.below):
        own = nearest == j
        if own.any():
            norms = np.sqrt((vectors[rows[own]] ** 2).sum(axis=1))
            seen += [(node.number, i, j, float(far[own, i].min()), float(far[own, i].max()), float(norms.min()), float(norms.max()))
                     for i in range(len(node.points))]
            _down(below, vectors, rows[own], leaf, seen)


def _nodes(node: Node | int) -> Iterator[Node]:
    if isinstance(node, Node):
        yield node
        for below in node.below:
            yield from _nodes(below)


def measure(tree: Node | int, ranges: list) -> None:
    """Write the aggregated ranges to the nodes; what no row is below stays empty (low above high)."""
    by_number = {n.number: n for n in _nodes(tree)}
    for n in by_number.values():
        m = len(n.points)
        n.low, n.high, n.norms = np.full((m, m), np.inf), np.full((m, m), -np.inf), np.full((m, 2), np.nan)
    for r in ranges:
        n = by_number[r["node"]]
        n.low[r["point"], r["sibling"]], n.high[r["point"], r["sibling"]] = r["low"], r["high"]
        n.norms[r["sibling"]] = (r["least"] * (1 - SLACK), r["most"] * (1 + SLACK))


def reached(tree: Node | int, anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[np.ndarray, int]]:
    """(rows of ``anchors``, leaf) for the leaves that may hold a score between ``low`` and ``high``:
    [anchor, window], a window with low above high is none."""
    out: list[tuple[np.ndarray, int]] = []
    square = (anchors * anchors).sum(axis=1)
    norm = np.sqrt(square)

    def visit(node: Node | int, rows: np.ndarray) -> None:
        if isinstance(node, int):
            out.append((rows, node))
            return
        far, reach = distances(anchors[rows], node.points), float(np.sqrt((node.points**2).sum(axis=1).max()))
        for j, below in enumerate(node.below):
            if not node.low[0, j] <= node.high[0, j]:
                continue
            least, most = node.norms[j] ** 2
            # the annulus of each window, and the distances that each split point leaves possible
            slack = SLACK * (1 + norm[rows, None] + np.sqrt(most) + reach)
            inner = np.sqrt(np.maximum(square[rows, None] + least - 2 * high[rows], 0)) - slack
            outer = np.sqrt(np.maximum(square[rows, None] + most - 2 * low[rows], 0)) + slack
            nearest = np.maximum(node.low[:, j] - far, far - node.high[:, j]).max(axis=1)
            farthest = (far + node.high[:, j]).min(axis=1)
            meets = (low[rows] <= high[rows]) & (nearest[:, None] <= outer) & (farthest[:, None] >= inner)
            own = rows[meets.any(axis=1)]
            if len(own):
                visit(below, own)

    visit(tree, np.arange(len(anchors)))
    return out


def products(anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles while they hold every sum, else in Python's integers."""
    most = max((np.abs(x).max() if x.size else 0.0) for x in (anchors, vectors))
    if most * most * max(anchors.shape[1], 1) < 2**53:
        return (anchors @ vectors.T).astype("int64")
    whole = [np.array([[int(x) for x in row] for row in side], dtype=object).reshape(side.shape) for side in (anchors, vectors)]
    return (whole[0] @ whole[1].T).astype("int64")  # raises beyond a long


def _matrix(column: pa.ChunkedArray, kind: str = "float64") -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(values), -1)


def _visit(route: DataFrame, rows: DataFrame, blocks: int, n: int, same: bool) -> DataFrame:
    """(ask, window, score, id) of the ``n`` best rows of each chunk in each window: ``route`` has
    (leaf, ask, id, label, v, low, high) with arrays of windows."""
    block = F.pmod(F.xxhash64("ask"), F.lit(blocks)).cast("int").alias("of_block")
    chunks = rows.select(F.col("leaf").alias("of_leaf"), F.col("chunk").alias("of_chunk")).distinct()
    asked = route.join(chunks, F.col("leaf") == F.col("of_leaf")).select(
        "of_leaf", "of_chunk", block, "ask", "id", "label", "v", "low", "high")
    held = rows.select("leaf", "chunk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "label", "v")

    def run(asks: pa.Table, found: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if asks.num_rows and found.num_rows:
            ids, labels = found["id"].to_numpy(), found["label"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, labels, vectors = ids[order], labels[order], _matrix(found["v"])[order]
            lows, highs, names = _matrix(asks["low"], "int64"), _matrix(asks["high"], "int64"), asks["ask"].to_numpy()
            own, kinds, anchors = asks["id"].to_numpy(), asks["label"].to_numpy(), _matrix(asks["v"])
            step = max(1, (1 << 22) // len(ids))
            for a in range(0, len(names), step):
                scores = products(anchors[a : a + step], vectors)
                for row, score in enumerate(scores, a):
                    able = (ids != own[row]) & ((labels == kinds[row]) == same)
                    for w in range(lows.shape[1]):
                        at = np.flatnonzero(able & (score >= lows[row, w]) & (score <= highs[row, w]))
                        if len(at) > n:  # ids rise: the first of equal scores have the smaller ids
                            least = np.partition(score[at], len(at) - n)[len(at) - n]
                            at = np.concatenate([at[score[at] > least], at[score[at] == least]])[:n]
                        out.append((np.full(len(at), names[row]), np.full(len(at), w), score[at], ids[at]))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, "int64")] * 4
        return pa.table({c: pa.array(x, t) for c, x, t in zip(
            ("ask", "window", "score", "id"), columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64()))})

    found = asked.groupBy("of_leaf", "of_chunk", "of_block").cogroup(held.groupBy("leaf", "chunk", "block")).applyInArrow(run, "ask long, window int, score long, id long")
    best = Window.partitionBy("ask", "window").orderBy(F.desc("score"), "id")
    return found.select("*", F.row_number().over(best).alias("nth")).where(F.col("nth") <= n)


class Forest:
    """The trees of a table's vectors, one for each length, and its rows by leaf and chunk."""

    def __init__(self, part: DataFrame):
        """``part``: (id, label, v) with whole numbers in ``v``."""
        spark = part.sparkSession
        total = part.count()
        sample = part.select("v").orderBy(F.xxhash64("id", "v")).limit(SAMPLE).collect()  # bounded: SAMPLE vectors
        by_size: dict[int, list] = {}
        for r in sample:
            by_size.setdefault(len(r["v"]), []).append(r["v"])
        numbers, leaves = iter(range(1 << 30)), iter(range(1, 1 << 30))
        share = max(1, LEAF_ROWS * len(sample) // max(total, 1))
        self.trees = {size: plant(np.array(v, "float64"), share, numbers, leaves) for size, v in sorted(by_size.items())}
        trees = self.trees

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf, seen = _placed(trees, batch.column("v"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf, pa.int32()), *[batch.column(c) for c in ("id", "label", "v")],
                     pa.array([seen if i == 0 else [] for i in range(len(leaf))], RANGES)],
                    names=["leaf", "id", "label", "v", "seen"])

        rows = staged(part.mapInArrow(place, f"leaf int, id long, label long, v array<double>, seen {RANGE_SQL}"), "gnat-rows")
        ranges = rows.where(F.size("seen") > 0).select(F.explode("seen").alias("s")).groupBy("s.node", "s.point", "s.sibling").agg(
            F.min("s.low").alias("low"), F.max("s.high").alias("high"), F.min("s.least").alias("least"), F.max("s.most").alias("most"))
        found = ranges.collect()  # bounded by the tree: FANOUT rows for each split point
        for tree in self.trees.values():
            own = {n.number for n in _nodes(tree)}
            measure(tree, [r for r in found if r["node"] in own])
        per_leaf = rows.groupBy("leaf").agg(F.ceil(F.count("*") / LEAF_ROWS).cast("int").alias("chunks"))
        self.rows = rows.drop("seen").join(per_leaf, "leaf").withColumn(
            "chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")).drop("chunks")
        self.spark = spark

    def home(self, asks: DataFrame) -> DataFrame:
        """Each row of ``asks`` with the leaf that its own vector falls into."""
        trees = self.trees

        def leaf(batch: pa.RecordBatch) -> list[tuple[np.ndarray, int]]:
            own, _ = _placed(trees, batch.column("v"))
            return [(np.flatnonzero(own == k), int(k)) for k in np.unique(own)]

        return _routed(asks, leaf)

    def route(self, asks: DataFrame) -> DataFrame:
        """Each row of ``asks`` for each leaf that may hold a score within its windows."""
        trees = self.trees

        def leaves(batch: pa.RecordBatch) -> list[tuple[np.ndarray, int]]:
            sizes = pc.list_value_length(batch.column("v")).to_numpy()
            out: list[tuple[np.ndarray, int]] = []
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                if int(size) not in trees:
                    out.append((rows, -int(size)))
                    continue
                v, low, high = (_matrix(pa.chunked_array([batch.column(c).take(pa.array(rows))])) for c in ("v", "low", "high"))
                out += [(rows[at], leaf) for at, leaf in reached(trees[int(size)], v, low, high)]
            return out

        return _routed(asks, leaves)


RANGES = pa.list_(pa.struct([("node", pa.int32()), ("point", pa.int32()), ("sibling", pa.int32()),
                             *[(n, pa.float64()) for n in ("low", "high", "least", "most")]]))
RANGE_SQL = "array<struct<node: int, point: int, sibling: int, low: double, high: double, least: double, most: double>>"


def _placed(trees: dict, column: pa.Array) -> tuple[np.ndarray, list[dict]]:
    """Leaves of a batch of vectors, and the ranges that it adds; a length that the sample does not
    have is one leaf, numbered by the length below 0."""
    sizes = pc.list_value_length(column).to_numpy()
    leaf, seen = -sizes.astype("int64"), []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        if int(size) in trees:
            own = np.zeros(len(rows), "int64")
            _down(trees[int(size)], _matrix(pa.chunked_array([column.take(pa.array(rows))])), np.arange(len(rows)), own, seen)
            leaf[rows] = own
    names = ("node", "point", "sibling", "low", "high", "least", "most")
    return leaf, [dict(zip(names, x)) for x in seen]


def _routed(asks: DataFrame, leaves) -> DataFrame:
    names = ["ask", "id", "label", "v", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, leaf in leaves(batch) if batch.num_rows else []:
                own = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([leaf] * len(rows), pa.int32()), *[own.column(c) for c in names]], names=["leaf", *names])

    return asks.select(*names).mapInArrow(run, "leaf int, ask long, id long, label long, v array<double>, low array<long>, high array<long>")


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    scale: float = 256.0, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the components are
    floor(``scale`` * x); a negative has another label and ``low`` to ``high`` percent of the positive's score."""
    part = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
        F.col(embedding).cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    ).withColumn("v", F.transform("v", lambda x: x * scale)).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("v") > 0)
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ).withColumn("v", F.transform("v", lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))).distinct()
    part = staged(part, "gnat-vectors")
    forest = Forest(part.select("id", "label", "v"))
    anchors = part.where("asks").select(F.xxhash64("id", "label", "v").alias("ask"), "id", "label", "v")
    blocks = max(1, -(-anchors.count() // BLOCK_ANCHORS))

    def windows(asks: DataFrame, *pairs: tuple[Column, Column]) -> DataFrame:
        return asks.withColumns({"low": F.array(*[a for a, _ in pairs]), "high": F.array(*[b for _, b in pairs])})

    def nth(found: DataFrame, n: int) -> Column:
        """The n-th best score, if there are as many: what is below it cannot matter."""
        return F.max(F.when(F.col("nth") == n, F.col("score")))

    lowest, highest = F.lit(-(2**63)), F.lit(2**63 - 1)
    near = _visit(forest.home(windows(anchors, (lowest, highest))), forest.rows, blocks, n_positives, same=True)
    least = near.groupBy("ask").agg(nth(near, n_positives).alias("least"))
    wide = windows(anchors.join(least, "ask", "left"), (F.coalesce("least", lowest), highest))
    positives = staged(_visit(forest.route(wide), forest.rows, blocks, n_positives, same=True).select(
        "ask", "nth", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "gnat-positives")

    def hundredth(x: Column) -> Column:
        """floor(x / 100) in whole numbers."""
        return F.floor(x / 100).cast("long")

    # one window for each positive: low * p <= 100 * s <= high * p
    score = F.col("positive_score").cast("decimal(24,0)")
    bounds = positives.select("ask", (F.col("nth") - 1).alias("window"),
                              (-hundredth(score * -low)).alias("low"), hundredth(score * high).alias("high"))
    none = (highest, lowest)

    def with_windows(bounds: DataFrame) -> DataFrame:
        each = bounds.groupBy("ask").agg(*[
            F.max(F.when(F.col("window") == w, F.struct("low", "high"))).alias(f"w{w}") for w in range(n_positives)])
        return windows(anchors.join(each, "ask"), *[
            (F.coalesce(f"w{w}.low", none[0]), F.coalesce(f"w{w}.high", none[1])) for w in range(n_positives)])

    near = _visit(forest.home(with_windows(bounds)), forest.rows, blocks, n_negatives, same=False)
    least = near.groupBy("ask", "window").agg(nth(near, n_negatives).alias("least"))
    tight = bounds.join(least, ["ask", "window"], "left").select(
        "ask", "window", F.greatest("low", F.coalesce("least", "low")).alias("low"), "high")
    found = _visit(forest.route(with_windows(tight)), forest.rows, blocks, n_negatives, same=False)
    ids = anchors.select("ask", F.col("id").alias("anchor_id"))
    return found.withColumnsRenamed({"id": "negative_id", "score": "negative_score", "nth": "rank"}).join(
        positives.withColumn("window", F.col("nth") - 1), ["ask", "window"]).join(ids, "ask").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
