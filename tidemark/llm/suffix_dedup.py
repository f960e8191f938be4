"""Suffix-array dedup: a logarithmic family of suffix arrays finds long repeated byte strings.

The arrays are sparse. Of every window of ``length`` bytes the suffix at the smallest of its first
``reach`` positions (by a hash of the eight bytes there, leftmost first) is sampled: a choice that
only the window's own bytes make, so equal windows sample the same suffix. An array is sorted by its
suffixes, each kept as its first two bytes and a digest of the bytes that all its windows share (the
core), beside a digest of the bytes that any of its windows reach (the span). Equal cores are a
possible long match, equal spans a certain one.

``Family`` holds arrays in levels, level ``i`` of 2^i batches. A new batch gets its suffix array and
is merge-scanned, bucket by bucket, against all levels; levels of equal size merge into the next, as
a binary counter carries. The scan reports whole spans that occur twice, in the batch or in a
level, and *edges*: one suffix of each span whose core occurs with another span. Edges alone are
looked at closer: their windows are split into ``step`` blocks, each with a core and a span of its
own, and the edges among these into single windows. So matches end at exact bytes, and no two
documents are ever compared as a pair.

An array keeps one suffix of equal spans and a batch of texts sends a span once, so a passage that
a third of all documents share stays one entry. The number of buckets follows the size of the texts.

Defined cases: NULL text is empty; a text shorter than ``length`` loses nothing; rows that are equal
in doc_id and text are each other's repeats, like any two documents; a NULL doc_id is an id like any
other; strings are judged on the input, not on what is left; an empty table gives an empty one;
columns named like the added ones are replaced. Very long texts are sampled piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staging_path
from .common import chunks, key_of, utf8

#: Bytes of text to a bucket of suffixes, and windows of a text that are sampled at once.
BUCKET_BYTES, PIECE = 1 << 24, 1 << 20
MIX, HIGH = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xFFFFFFFF00000000)
#: Columns that the operator adds on the way, named so that they meet no column of the input.
KEYS, DONE, EDGES = ["__doc_key", "__text_hash"], "__removed_runs", "__edge_starts"
#: What a row of packed data holds.
ARRAY, FOUND, EDGE = 0, 1, 2
PACKED = "kind int, level int, key int, data binary"
MARKS = f"{KEYS[0]} long, {KEYS[1]} long, {DONE} binary, {EDGES} binary"
#: A suffix (``flags``: 1 its span is known to repeat, 2 it is known as an edge) and a report.
SUFFIX = np.dtype([("core", "<u8"), ("span", "<u8"), ("id", "<i8"), ("text", "<i8"), ("at", "<u4"), ("flags", "u1")])
REPORT = np.dtype([("id", "<i8"), ("text", "<i8"), ("low", "<u4"), ("high", "<u4")])


class Shape(NamedTuple):
    """Windows of ``length`` bytes; a suffix stands for ``reach`` of them, a block for ``step``."""

    length: int
    reach: int
    step: int

    @staticmethod
    def of(length: int) -> Shape:
        step = isqrt(length * 3 // 4)
        if length - step * step + 1 < 8:
            raise ValueError("length must leave eight bytes behind the sampled positions (16 or more)")
        return Shape(length, step * step, step)


def sampled(text: bytes, shape: Shape) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of the sampled suffixes, and the first and last window that samples each."""
    parts: list[tuple[np.ndarray, ...]] = []
    for base in range(0, max(0, len(text) - shape.length + 1), PIECE):
        n = min(PIECE, len(text) - shape.length + 1 - base)
        ranks = np.ndarray((n + shape.reach - 1,), "<u8", text, base, (1,)) * MIX
        ranks ^= ranks >> np.uint64(29)
        ranks *= MIX
        least = (ranks & HIGH) | np.arange(len(ranks), dtype="uint64")
        width = 1
        while 2 * width <= shape.reach:  # minima of twice as many positions
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < shape.reach:
            least = np.minimum(least[: width - shape.reach], least[shape.reach - width :])
        at = (least & ~HIGH).astype("int64") + base
        cuts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        parts.append((at[cuts], cuts + base, np.append(cuts[1:], n) - 1 + base))
    if not parts:
        return (np.zeros(0, "int64"),) * 3
    at, first, last = (np.concatenate(x) for x in zip(*parts))
    new = np.concatenate([[True], at[1:] != at[:-1]])  # two pieces may meet within one suffix
    return at[new], first[new], last[np.append(np.flatnonzero(new)[1:], len(at)) - 1]


def digests(text: bytes, at: np.ndarray, width: int, length: int) -> tuple[list[int], list[int]]:
    """Core and span of the ``width`` windows that start at each position or up to ``width`` - 1 before it."""
    cores, spans, end, hashed = [], [], len(text), xxhash.xxh3_64_intdigest
    for p in at.tolist():
        first = p - width + 1
        low, high = max(first, 0), min(p + length, end)
        cores.append((text[p] << 56) | (text[p + 1] << 48) | (hashed(text[p : first + length]) >> 16))
        spans.append(hashed(text[low:high], 1 + (p - low) * 2 * length + high - p))
    return cores, spans


def _ids(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(n)).to_numpy() for n in KEYS]


def _entries(ids: list[np.ndarray], doc: int, text: bytes, at: np.ndarray, width: int, length: int) -> np.ndarray:
    out = np.zeros(len(at), SUFFIX)
    out["core"], out["span"] = digests(text, at, width, length)
    out["id"], out["text"], out["at"] = ids[0][doc], ids[1][doc], at
    return out


def _row(kind: int, level: int, key: int, data: np.ndarray) -> tuple[int, int, int, bytes]:
    return kind, level, key, data.tobytes()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (*[pa.int32()] * 3, pa.binary()))], names=["kind", "level", "key", "data"])


def _dealt(kind: int, level: int, keys: np.ndarray, data: np.ndarray) -> list[tuple]:
    """One row for each key."""
    order = np.argsort(keys, kind="stable")
    keys, data = keys[order], data[order]
    cuts = [*np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])).tolist(), len(keys)] if len(keys) else []
    return [_row(kind, level, int(keys[a]), data[a:b]) for a, b in zip(cuts, cuts[1:])]


def _owners(data: np.ndarray, n: int) -> np.ndarray:
    """The group of documents that each entry's document belongs to."""
    mixed = (data["id"].astype("uint64") * MIX) ^ (data["text"].astype("uint64") * np.uint64(0x9E3779B97F4A7C15))
    return ((mixed >> np.uint64(33)) % np.uint64(n)).astype("int64")


def _reports(kind: int, found: np.ndarray, width: int, length: int, n: int) -> list[tuple]:
    """Rows for the documents of suffixes: the bytes from their first window's start to their last
    window's end, or the positions of edges."""
    out = np.zeros(len(found), REPORT)
    out["id"], out["text"] = found["id"], found["text"]
    at = found["at"].astype("int64")
    out["low"], out["high"] = (np.maximum(at - width + 1, 0), at + length) if kind == FOUND else (at, 0)
    return _dealt(kind, -1, _owners(out, n), out)


def _scan(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The entries in the order of their suffixes; the first of each span; those of repeated spans;
    the first of each span whose core has another span, too."""
    entries = entries[np.lexsort((entries["at"], entries["text"], entries["id"], entries["span"], entries["core"]))]
    if not len(entries):
        return entries, np.zeros(0, "int64"), np.zeros(0, bool), np.zeros(0, bool)
    new_core = np.concatenate([[True], entries["core"][1:] != entries["core"][:-1]])
    first = np.flatnonzero(new_core | np.concatenate([[True], entries["span"][1:] != entries["span"][:-1]]))
    sizes = np.diff(np.append(first, len(entries)))
    many = (sizes > 1) | (np.bitwise_or.reduceat(entries["flags"], first) & 1 > 0)
    spans_of_core = np.bincount(np.cumsum(new_core)[first] - 1)
    edges = (spans_of_core > 1)[np.cumsum(new_core)[first] - 1]
    return entries, first, np.repeat(many, sizes), edges


def _send(entries: list[np.ndarray], width: int, length: int, n: int) -> list[tuple]:
    """What a batch of texts sends: each span once, by bucket; those it has twice are known to repeat."""
    sorted_entries, first, many, _ = _scan(np.concatenate(entries) if entries else np.zeros(0, SUFFIX))
    sorted_entries["flags"] |= many
    buckets = ((sorted_entries["core"][first] & np.uint64(0xFFFFFFFFFFFF)) % np.uint64(n)).astype("int64")
    return [*_dealt(ARRAY, -1, buckets, sorted_entries[first]),
            *_reports(FOUND, sorted_entries[many], width, length, n)]


def _suffixes(n: int, text: str, shape: Shape):
    """Documents to their sampled suffixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = utf8(batch, text), _ids(batch)
            for a, b in chunks(texts):
                entries = []
                for doc in range(a, b):
                    at, _, _ = sampled(texts[doc], shape)
                    entries.append(_entries(ids, doc, texts[doc], at, shape.reach, shape.length))
                yield _batch(_send(entries, shape.reach, shape.length, n))

    return run


def _closer(n: int, text: str, shape: Shape, width: int):
    """Documents with edges: these split into units of ``width`` windows. What is found is passed on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = utf8(batch, text), _ids(batch)
            done, marked = utf8(batch, DONE), utf8(batch, EDGES)
            for a, b in chunks(texts):
                entries, known = [], []
                for doc in range(a, b):
                    runs = np.frombuffer(done[doc], "<u4").reshape(-1, 2)
                    passed = np.zeros(len(runs), REPORT)
                    passed["id"], passed["text"] = ids[0][doc], ids[1][doc]
                    passed["low"], passed["high"] = runs[:, 0], runs[:, 1]
                    known.append(passed)
                    edges = np.frombuffer(marked[doc], "<u4").astype("int64")
                    if len(edges):
                        at = _units(texts[doc], edges, shape, width)
                        entries.append(_entries(ids, doc, texts[doc], at, width, shape.length))
                passed = np.concatenate(known)
                yield _batch([*_send(entries, width, shape.length, n), *_dealt(FOUND, -1, _owners(passed, n), passed)])

    return run


def _units(text: bytes, edges: np.ndarray, shape: Shape, width: int) -> np.ndarray:
    """Positions of the blocks (of their last windows) of sampled suffixes, or the windows of blocks."""
    if width > 1:
        at, first, last = sampled(text, shape)
        of = np.isin(at, edges)
        at, low, high = at[of], (at[of] - last[of]) // width, (at[of] - first[of]) // width
        count = high - low + 1
        nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        found = np.repeat(at, count) - width * (np.repeat(low, count) + nth)
    else:
        found = (edges[:, None] - np.arange(shape.step)).ravel()
        found = found[(found >= 0) & (found + shape.length <= len(text))]
    return np.unique(found)


def _meet(n: int, width: int, length: int, into: int | None):
    """A bucket's suffixes, of a batch and of levels: what repeats, the edges, and (unless ``into`` is
    None) the array of level ``into``, merged from the batch and the levels below."""

    def run(table: pa.Table) -> pa.Table:
        arrays = table.filter(pc.equal(table["kind"], ARRAY))
        levels = arrays["level"].to_pylist()
        parts = [np.frombuffer(x, SUFFIX) for x in arrays["data"].to_pylist()]
        rows: list[tuple] = []
        if parts:
            level = np.repeat(levels, [len(p) for p in parts])
            entries = np.concatenate(parts)
            merged = entries[level < into] if into is not None else None
            entries, first, many, edges = _scan(entries)
            rows += _reports(FOUND, entries[many & (entries["flags"] & 1 == 0)], width, length, n)
            of = entries[first][edges]
            rows += _reports(EDGE, of[of["flags"] & 2 == 0], width, length, n)
            if merged is not None and len(merged):
                # flags of the whole scan, by suffix, on the first of each span in the merged array
                flags = np.zeros(len(entries), "u1")
                flags[many] |= 1
                sizes = np.diff(np.append(first, len(entries)))
                flags |= np.repeat(edges.astype("u1") * 2, sizes)
                known = {(c, s): f for c, s, f in zip(
                    entries["core"][first].tolist(), entries["span"][first].tolist(), flags[first].tolist())}
                merged, first, _, _ = _scan(merged)
                merged = merged[first]
                merged["flags"] = [known[k] for k in zip(merged["core"].tolist(), merged["span"].tolist())]
                rows.append(_row(ARRAY, into, int(arrays["key"][0].as_py()), merged))
        passed = table.filter(pc.not_equal(table["kind"], ARRAY)).select(["kind", "level", "key", "data"])
        return pa.concat_tables([pa.Table.from_batches([_batch(rows)]), passed.cast(_batch([]).schema)])

    return run


def _by_document(table: pa.Table) -> pa.Table:
    """The reports of a group of documents: each one's found bytes as maximal runs, and its edges."""
    runs, edges = ({}, {})
    for kind, of in ((FOUND, runs), (EDGE, edges)):
        own = table.filter(pc.equal(table["kind"], kind))["data"].to_pylist()
        rows = np.frombuffer(b"".join(own), REPORT)
        rows = rows[np.lexsort((rows["low"], rows["text"], rows["id"]))]
        new = (rows["id"][1:] != rows["id"][:-1]) | (rows["text"][1:] != rows["text"][:-1])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), len(rows)] if len(rows) else []
        for a, b in zip(cuts, cuts[1:]):
            doc = (int(rows["id"][a]), int(rows["text"][a]))
            found = joined(rows["low"][a:b], rows["high"][a:b]) if kind == FOUND else np.unique(rows["low"][a:b])
            of[doc] = found.astype("<u4").tobytes()
    docs = [(*doc, runs.get(doc), edges.get(doc)) for doc in {**runs, **edges}]
    columns = list(zip(*docs)) if docs else [()] * 4
    return pa.table({name: pa.array(c, t) for name, c, t in zip(
        (*KEYS, DONE, EDGES), columns, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))})


def joined(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Intervals, sorted by ``low``, as maximal runs: rows (low, high)."""
    if not len(low):
        return np.zeros((0, 2), "int64")
    low, reach = low.astype("int64"), np.maximum.accumulate(high.astype("int64"))
    new = np.flatnonzero(np.concatenate([[True], low[1:] > reach[:-1]]))
    return np.stack([low[new], reach[np.append(new[1:], len(low)) - 1]], axis=1)


def _removed(text: str, names: list[str]):
    """Each text without its found runs, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, done = utf8(batch, text), utf8(batch, DONE)
            kept, sizes, gone, spans = [], [], [], []
            for raw, mark in zip(texts, done):
                runs = np.minimum(np.frombuffer(mark, "<u4").reshape(-1, 2), len(raw)).tolist()
                ends = [0, *(high for _, high in runs)]
                kept.append(b"".join(raw[a:b] for a, b in zip(ends, [*(low for low, _ in runs), len(raw)])) if runs else raw)
                sizes.append(len(raw))
                gone.append(len(raw) - len(kept[-1]))
                spans.append(len(runs))
            new = {"kept": pa.array(kept, pa.binary()), "n_bytes": pa.array(sizes, pa.int64()),
                   "n_removed": pa.array(gone, pa.int64()), "n_spans": pa.array(spans, pa.int64())}
            yield pa.RecordBatch.from_arrays(
                [new[n] if n in new else batch.column(batch.schema.get_field_index(n)) for n in names], names=names)

    return run


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    texts = docs.withColumn(text, F.col(text).cast("string"))
    return texts.withColumn(KEYS[0], key_of(doc_id)).withColumn(KEYS[1], F.xxhash64(text))


class Family:
    """A logarithmic family of suffix arrays on shared storage.

    ``add`` takes a batch of keyed documents and returns the reports of its scan: what repeats
    in the batch or against all batches before, of either side. Levels are Parquet folders; those
    that merge into the next are deleted once that is written.
    """

    def __init__(self, spark: SparkSession, buckets: int, shape: Shape, text: str = "text"):
        self.spark, self.buckets, self.shape, self.text = spark, buckets, shape, text
        self.levels: dict[int, str] = {}
        self.batches = 0

    def _read(self, path: str) -> DataFrame:
        return self.spark.read.schema(PACKED).parquet(path).select("kind", "level", "key", "data")

    def add(self, batch: DataFrame, more: bool = True) -> DataFrame:
        """``more``: batches will follow; otherwise the merged array is not written."""
        into = next(i for i in range(64) if not self.batches >> i & 1)
        rows = batch.select(*KEYS, self.text).mapInArrow(_suffixes(self.buckets, self.text, self.shape), PACKED)
        for path in self.levels.values():
            rows = rows.unionAll(self._read(path).where(F.col("kind") == ARRAY))
        meet = _meet(self.buckets, self.shape.reach, self.shape.length, into if more else None)
        path = staging_path(self.spark, f"suffix-level{into}")
        rows.groupBy("key").applyInArrow(meet, PACKED).write.partitionBy("kind").parquet(path)
        merged = [self.levels.pop(i) for i in range(into)]
        self.levels[into] = path
        self.batches += 1
        for old in merged:
            self._drop(f"{old}/kind={ARRAY}")
        return self._read(path).where(F.col("kind") != ARRAY)

    def _drop(self, path: str) -> None:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def repeated_runs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 400, batches: int = 4) -> DataFrame:
    """One row for each document with repeated bytes: its key, its text's hash and the runs of bytes
    covered by strings of ``length`` that start elsewhere, too (packed 32-bit pairs, the last one may
    reach beyond the text). The documents go into the family in ``batches`` parts of their hash."""
    shape = Shape.of(length)
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")).cast("double"))).first()[0] or 0
    n = max(1, -int(-size // BUCKET_BYTES))
    keyed = _keyed(docs, text, doc_id)
    family, reports = Family(docs.sparkSession, n, shape, text), None
    part = F.pmod(F.xxhash64(*KEYS), F.lit(batches))
    for i in range(batches):
        found = family.add(keyed.where(part == i), more=i < batches - 1)
        reports = found if reports is None else reports.unionAll(found)
    marks = reports.groupBy("key").applyInArrow(_by_document, MARKS)
    for width in (shape.step, 1):  # all columns stay in, so that all joins read one shuffle of the texts
        near = keyed.join(marks.hint("merge"), KEYS)
        found = near.mapInArrow(_closer(n, text, shape, width), PACKED)
        found = found.groupBy("key").applyInArrow(_meet(n, width, length, None), PACKED)
        marks = found.groupBy("key").applyInArrow(_by_document, MARKS)
    return marks


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = 400, batches: int = 4) -> DataFrame:
    """``docs`` with ``kept`` (the remaining bytes; they may cut a character), ``n_bytes`` of the whole
    text, ``n_removed`` and ``n_spans`` (maximal removed runs)."""
    marks = repeated_runs(docs, text, doc_id, length, batches)
    added = ("kept", "n_bytes", "n_removed", "n_spans")
    old = [f for f in docs.schema.fields if f.name not in added]
    rest = _keyed(docs, text, doc_id).join(marks.hint("merge"), KEYS, "left")
    schema = ", ".join([*(f"`{n}` {t}" for n, t in docs.select(*[f.name for f in old]).dtypes),
                        "kept binary, n_bytes long, n_removed long, n_spans long"])
    names = [*(f.name for f in old), *added]
    return rest.mapInArrow(_removed(text, names), schema.replace(f"`{text}` void", f"`{text}` string"))
