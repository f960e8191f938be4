"""Ranked lexical search: Block-Max MaxScore over a sharded inverted index.

``build`` reads the documents once and writes one index row per (shard, term): the postings in blocks
of ``BLOCK``, compressed each to its own byte width, with the last document, the largest count and
the shortest document length of every block beside them. A shard is ``SHARD_BYTES`` of text; one more
row of it (term NULL) has its documents' ids and lengths.

``search`` joins the items' terms with the index, groups the wanted lists by shard, and runs every
item against every shard, a block of items at a time. Within a shard a list's bound is the largest of
its block bounds. Lists are sorted by bound; those whose bounds together stay below the k-th best
score so far are non-essential: a document that only they hold cannot enter the heap. Documents of
the essential lists are candidates, in ranges of ids; a non-essential list is asked for a candidate
only while its score so far, the maximum of the list's block and the bounds of the rest reach the
heap. Otherwise it goes before the block is decompressed. The shards' heaps of k rows merge by a
ranking that Spark limits to k rows an item in every task before the shuffle.

Scores are 64-bit integers: term weight floor(1000 ln((2N + 2) / (2 df + 1))) times
(10^9 tf) div (1000 tf + 20 m), where m = 50 + (50 n N) div L. N, L and df are counted from the index
over all documents. A block's bound takes its largest tf and its shortest n, so it is never too low.

Defined cases: NULL or empty texts have no terms and count in neither N nor L; equal rows are
documents of their own; equal scores come by ascending doc_id, a NULL doc_id first; an item's terms
are those of all its rows, once each, and an item without terms, or whose terms no document holds,
has no rows; empty tables give an empty result; columns other than id and text are not read.
"""

from __future__ import annotations

from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import NULL_ID, key_of, staged, utf8

#: Bytes of text to a shard, postings to a block, items to a block of items, documents to a range.
SHARD_BYTES, BLOCK, BLOCK_ITEMS, RANGE = 1 << 25, 128, 256, 4096
#: Bytes of decompressed blocks that a task keeps for its next items, and postings compressed at once.
CACHE_BYTES, SLICE = 1 << 26, 1 << 18
#: ASCII but for letters and digits separates terms; only A-Z are lower-cased.
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
INDEX = "shard long, term binary, df long, heads binary, data binary"
#: Of a block: its last document, largest count, shortest document, where its bytes begin and their widths.
HEAD = np.dtype([("last", "<u4"), ("tf", "<u4"), ("n", "<u4"), ("begin", "<u4"), ("gap", "u1"), ("wide", "u1")])


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERMS).split()


def weight(df: int, n_docs: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def compress(docs: np.ndarray, tfs: np.ndarray, lengths: np.ndarray, starts: np.ndarray) -> Iterator[tuple[bytes, bytes]]:
    """Heads and bytes of the blocks of each list: the lists lie one behind another (ascending
    documents of a shard in each) and begin at ``starts``."""
    sizes = np.diff(np.append(starts, len(docs)))
    n_blocks = -(-sizes // BLOCK)
    first = np.cumsum(n_blocks) - n_blocks  # of each list's blocks
    nth = np.arange(n_blocks.sum()) - np.repeat(first, n_blocks)
    begin = np.repeat(starts, n_blocks) + nth * BLOCK
    count = np.minimum(BLOCK, np.repeat(sizes, n_blocks) - nth * BLOCK)
    gaps = np.diff(docs, prepend=0)
    gaps[starts] = docs[starts]
    heads = np.zeros(len(begin), HEAD)
    heads["last"], heads["tf"] = docs[begin + count - 1], np.maximum.reduceat(tfs, begin)
    heads["n"] = np.minimum.reduceat(lengths[docs], begin)
    for name, values in (("gap", np.maximum.reduceat(gaps, begin)), ("wide", heads["tf"])):
        heads[name] = np.where(values < 1 << 8, 1, np.where(values < 1 << 16, 2, 4))
    size = count * (heads["gap"].astype("int64") + heads["wide"])
    ends = np.cumsum(size)
    heads["begin"] = ends - size - np.repeat((ends - size)[first], n_blocks)
    out = np.zeros(int(ends[-1]), "u1")
    place = np.arange(len(docs)) - np.repeat(begin, count)  # within the block
    before = np.repeat(ends - size, count)
    for values, name in ((gaps, "gap"), (tfs, "wide")):
        width = np.repeat(heads[name], count).astype("int64")
        at = before + place * width
        for byte in range(4):
            own = width > byte
            out[at[own] + byte] = (values[own] >> (8 * byte)) & 255
        before = before + np.repeat(count * heads["gap"].astype("int64"), count)
    cuts, ends = np.append(first, len(begin)).tolist(), np.append(0, ends)[np.append(first, len(begin))].tolist()
    raw_heads, raw, wide = heads.tobytes(), out.tobytes(), HEAD.itemsize
    for i in range(len(starts)):
        yield raw_heads[cuts[i] * wide : cuts[i + 1] * wide], raw[ends[i] : ends[i + 1]]


def decompress(heads: np.ndarray, data: bytes, df: int, i: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and counts of one block."""
    head, n = heads[i], min(BLOCK, df - i * BLOCK)
    gap, wide, begin = int(head["gap"]), int(head["wide"]), int(head["begin"])
    docs = np.cumsum(np.frombuffer(data, f"<u{gap}", n, begin), dtype="int64")
    if i:
        docs += int(heads[i - 1]["last"])
    return docs, np.frombuffer(data, f"<u{wide}", n, begin + n * gap).astype("int64")


class _Shard:
    """Postings of a shard while its documents are read."""

    def __init__(self) -> None:
        self.vocabulary: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.terms, self.tfs, self.docs, self.lengths = array("I"), array("I"), array("I"), array("I")
        self.ids = array("q")
        self.size = 0

    def add(self, doc_id: int, text: bytes) -> None:
        words = terms(text)
        self.size += len(text)
        if not words:
            return
        counts = Counter(words)
        self.terms.extend(map(self.vocabulary.__getitem__, counts))
        self.tfs.extend(counts.values())
        self.docs.extend([len(self.ids)] * len(counts))
        self.ids.append(doc_id)
        self.lengths.append(len(words))

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        kinds, lengths = np.frombuffer(self.terms, "u4").astype("int64"), np.frombuffer(self.lengths, "u4")
        order = np.argsort(kinds, kind="stable")
        docs, tfs = np.frombuffer(self.docs, "u4")[order].astype("int64"), np.frombuffer(self.tfs, "u4")[order].astype("int64")
        cuts = np.append(np.flatnonzero(np.diff(kinds[order], prepend=-1)), len(order))
        yield self._batch([(shard, None, len(self.ids), lengths.tobytes(), self.ids.tobytes())])
        words, a = iter(self.vocabulary), 0
        while a < len(cuts) - 1:  # the lists of some SLICE postings, one at least
            b = max(a + 1, int(np.searchsorted(cuts, cuts[a] + SLICE, "right")) - 1)
            own = slice(cuts[a], cuts[b])
            packed = compress(docs[own], tfs[own], lengths, cuts[a:b] - cuts[a])
            yield self._batch([(shard, word, df, *lists) for df, lists, word in zip(np.diff(cuts[a : b + 1]).tolist(), packed, words)])
            a = b

    @staticmethod
    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["shard", "term", "df", "heads", "data"])


def build(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shard_bytes: int = 0) -> DataFrame:
    """The index of all documents, written to the shared staging folder."""
    limit = shard_bytes or SHARD_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, shard = TaskContext.get().partitionId() << 32, _Shard()
        done = 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, raw in zip(ids, utf8(batch, "text")):
                shard.add(i, raw)
                if shard.size >= limit:
                    if shard.ids:
                        yield from shard.rows(first + done)
                    done, shard = done + 1, _Shard()
        if shard.ids:
            yield from shard.rows(first + done)

    texts = docs.select(key_of(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    return staged(texts.mapInArrow(run, INDEX), "lexical-index")


def statistics(index: DataFrame) -> tuple[int, int]:
    """N and L: the documents with terms, and all their terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(np.frombuffer(x, "u4").sum(dtype="int64")) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sums, pa.int64())], names=["n", "l"])

    shards = index.where("term IS NULL").select(F.col("df").alias("n"), "heads").mapInArrow(run, "n long, l long")
    found = shards.agg(F.sum("n"), F.sum("l")).first()
    return found[0] or 0, found[1] or 0


def _item_terms(items: DataFrame, text: str, item_id: str) -> DataFrame:
    """(item, term), each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [(i, t) for i, raw in zip(batch.column(0).to_pylist(), utf8(batch, "text")) for t in set(terms(raw))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in own], pa.int64()), pa.array([x[1] for x in own], pa.binary())], names=["item", "term"])

    texts = items.select(F.col(item_id).cast("long").alias("item"), F.col(text).cast("string").alias("text"))
    return texts.mapInArrow(run, "item long, term binary").distinct()


class _Lists:
    """The wanted lists of a shard."""

    def __init__(self, table: pa.Table, n_docs: int, n_terms: int):
        known = table["term"].is_valid()
        about = table.filter(pc.invert(known))
        self.lengths = np.frombuffer(about["heads"][0].as_py(), "u4").astype("int64")
        self.ids = np.frombuffer(about["data"][0].as_py(), "i8")
        self.m = 50 + (50 * self.lengths * n_docs) // n_terms
        self.cache: dict[tuple[bytes, int], tuple[np.ndarray, np.ndarray]] = {}
        self.cached = 0
        self.read = 0  # blocks decompressed
        self.lists: dict[bytes, tuple[int, np.ndarray, bytes, np.ndarray]] = {}
        for row in table.filter(known).select(["term", "df", "heads", "data"]).to_pylist():
            heads = np.frombuffer(row["heads"], HEAD)
            tf, shortest = heads["tf"].astype("int64"), heads["n"].astype("int64")
            bounds = (1_000_000_000 * tf) // (1000 * tf + 20 * (50 + (50 * shortest * n_docs) // n_terms))
            self.lists[row["term"]] = (row["df"], heads, row["data"], bounds)

    def block(self, term: bytes, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and contributions (without the term's weight) of a block."""
        if (term, i) not in self.cache:
            if self.cached >= CACHE_BYTES:
                self.cache.clear()
                self.cached = 0
            df, heads, data, _ = self.lists[term]
            docs, tf = decompress(heads, data, df, i)
            self.cache[term, i] = docs, (1_000_000_000 * tf) // (1000 * tf + 20 * self.m[docs])
            self.cached += 16 * len(docs)
            self.read += 1
        return self.cache[term, i]

    def between(self, term: bytes, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``low`` and below ``high``, and their contributions."""
        last = self.lists[term][1]["last"]
        a, b = np.searchsorted(last, low), min(len(last), np.searchsorted(last, high) + 1)
        if a >= b:
            return np.zeros(0, "int64"), np.zeros(0, "int64")
        docs, scores = (np.concatenate(x) for x in zip(*(self.block(term, i) for i in range(a, b))))
        a, b = np.searchsorted(docs, low), np.searchsorted(docs, high)
        return docs[a:b], scores[a:b]

    def best(self, weights: dict[bytes, int], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the best ``k`` (score above 0; ties to the smaller id)."""
        own = [(w * int(self.lists[t][3].max()), t, w) for t, w in weights.items() if t in self.lists and w > 0]
        own.sort(key=lambda x: x[:2])  # rising bounds
        below = np.cumsum([0, *(x[0] for x in own)])  # the bounds of all lists before each
        found, scores, least = np.zeros(0, "int64"), np.zeros(0, "int64"), 1
        for low in range(0, len(self.ids) if own else 0, RANGE):
            # lists before `cut` together stay below the heap: they are not essential
            cut = int(np.searchsorted(below[1:], least))
            parts = [(*self.between(t, low, low + RANGE), w) for _, t, w in own[cut:]]
            sums = np.zeros(RANGE, "int64")
            for docs, part, w in parts:
                sums[docs - low] += w * part
            at = np.flatnonzero(sums)
            score = sums[at]
            at += low
            for j in range(cut - 1, -1, -1):
                at, score = self._asked(own[j], at, score, int(below[j]), least)
            found, scores = np.concatenate([found, at[score >= least]]), np.concatenate([scores, score[score >= least]])
            order = np.lexsort((self.ids[found], -scores))[:k]
            found, scores = found[order], scores[order]
            if len(found) == k:
                least = int(scores[-1])  # an equal score may still win by its id
        return found, scores

    def _asked(self, of: tuple[int, bytes, int], at: np.ndarray, score: np.ndarray, rest: int, least: int):
        """Candidates with the contribution of a non-essential list; without those whose score, the
        maximum of the list's block and the bounds of the ``rest`` stay below ``least``."""
        _, term, w = of
        _, heads, _, bounds = self.lists[term]
        block = np.searchsorted(heads["last"], at)
        inside = block < len(heads)
        most = np.where(inside, w * bounds[np.minimum(block, len(heads) - 1)], 0)
        able = score + most + rest >= least
        at, score, block, inside = at[able], score[able].copy(), block[able], inside[able]
        for i in np.unique(block[inside]).tolist():
            own = np.flatnonzero(block == i)
            docs, part = self.block(term, i)
            place = np.minimum(np.searchsorted(docs, at[own]), len(docs) - 1)
            hit = docs[place] == at[own]
            score[own[hit]] += w * part[place[hit]]
        return at, score


def search(index: DataFrame, items: DataFrame, k: int = 50, text: str = "text", item_id: str = "item_id") -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's ``k`` best documents."""
    n_docs, n_terms = statistics(index)
    parts = max(1, -(-items.count() // BLOCK_ITEMS))
    wanted = _item_terms(items, text, item_id).withColumn("part", F.pmod(F.xxhash64("item"), F.lit(parts)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    lists = index.join(wanted.select("part", "term").distinct(), "term").select("shard", "part", "term", "df", "heads", "data")
    lists = staged(lists, "lexical-lists")
    about = index.where("term IS NULL").select("shard", every, "term", "df", "heads", "data")
    frequency = lists.groupBy("part", "term").agg(F.sum("df").alias("df"))
    packed = wanted.join(frequency, ["part", "term"]).groupBy("part", "item").agg(
        F.collect_list(F.struct("term", "df")).alias("terms"))
    blocks = packed.groupBy("part").agg(F.collect_list(F.struct("item", "terms")).alias("items"))
    # a stated query set against all shards, a block of items at a time
    asked = about.select(F.col("shard").alias("of"), "part").join(blocks, "part")

    def run(held: pa.Table, asks: pa.Table) -> pa.Table:
        rows: list[tuple[np.ndarray, ...]] = []
        nulls: list[bool] = []
        if held.num_rows and asks.num_rows:
            shard = _Lists(held, n_docs, n_terms)
            for part in asks["items"].to_pylist():
                for item in part:
                    weights = {x["term"]: weight(x["df"], n_docs) for x in item["terms"]}
                    docs, scores = shard.best(weights, k)
                    rows.append((np.full(len(docs), item["item"] or 0), shard.ids[docs], scores))
                    nulls += [item["item"] is None] * len(docs)
        columns = [np.concatenate(x) for x in zip(*rows)] if rows else [np.zeros(0, "int64")] * 3
        return pa.table({"item": pa.array(columns[0], pa.int64(), mask=np.array(nulls, bool)), "id": columns[1], "score": columns[2]})

    heaps = lists.unionAll(about).groupBy("shard", "part").cogroup(asked.groupBy("of", "part")).applyInArrow(run, "item long, id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    return heaps.select("*", F.row_number().over(best).alias("rank")).where(F.col("rank") <= k).select(
        F.col("item").alias("item_id"), "rank", F.when(F.col("id") != NULL_ID, F.col("id")).alias("doc_id"), "score")
