"""Substring dedup: difference-cover anchors find repeated passages, which then extend to windows.

Let D be a difference cover modulo ``period``: every difference of two residues is a difference
of two members. Of any two equal windows of ``window`` words, at some offset below ``period``
both positions are in D; so they share the hash of ``window - period + 1`` words there. Only these
anchors (4 of 13 positions for windows of 20) are hashed and shuffled. An anchor that occurs twice
extends to all windows around it; those are hashed whole, and each but the first occurrence
(smaller doc_id, then smaller start) is repeated.

Both steps send packed arrays, one per batch of documents and bucket of hashes. A hash goes from a
batch once, however often the batch has it: its other occurrences there are known to be repeated.
So a passage that a third of all documents share sends a bucket no more than one entry a batch.
The number of buckets follows the size of the texts, and no bucket is expanded into pairs.

Defined cases: NULL text has no words; a NULL doc_id comes before all others; documents that share
a doc_id are compared by their starts alone, and rows equal in doc_id and text are one document,
each marked alike; windows are judged on the input, not on what is left.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, key_of, utf8

#: Bytes of text to a bucket of hashes.
BUCKET_BYTES = 1 << 24
BASE, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
#: Columns that the operator adds on the way, named so that they meet no column of the input.
KEYS, STARTS = ["__doc_key", "__text_hash"], "__repeat_starts"
DOCUMENT = f"{KEYS[0]} long, {KEYS[1]} long, {STARTS} binary"
PACKED = "key int, docs binary, counts binary, starts binary, hashes binary"


def difference_cover(period: int) -> list[int]:
    """The first smallest set whose differences reach all residues."""
    for size in range(1, period + 1):
        for rest in combinations(range(1, period), size - 1):
            cover = (0, *rest)
            if len({(a - b) % period for a in cover for b in cover}) == period:
                return list(cover)
    return [0]


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words one after another, and each text's number of words."""
    words = [x.split() for x in texts]  # bytes: the six ASCII white-space characters
    flat = np.empty(sum(map(len, words)), dtype=object)
    flat[:] = list(chain.from_iterable(words))
    return pd.util.hash_array(flat, categorize=False), np.array([len(w) for w in words], dtype="int64")


def _span_hashes(words: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position."""
    out = np.zeros(len(at), dtype="uint64")
    for j in range(n):
        out = out * BASE + words[at + j]
    out ^= out >> np.uint64(32)
    out *= MIX
    return out ^ (out >> np.uint64(32))


class _Entries:
    """Word positions of documents: ``doc`` indexes ``ids`` (doc_id key, text hash)."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, start: np.ndarray, hashes: np.ndarray | None = None):
        self.ids, self.doc, self.start, self.hashes = ids, doc, start, hashes

    def pick(self, which: np.ndarray) -> _Entries:
        return _Entries(self.ids, self.doc[which], self.start[which], None if self.hashes is None else self.hashes[which])

    def packed(self, key: np.ndarray, hashed: bool = True) -> pa.RecordBatch:
        """One row for each key: the documents, how many entries each has, starts and hashes."""
        order = np.lexsort((self.start, self.doc, key))
        key, doc, start = key[order], self.doc[order], self.start[order].astype("uint32")
        hashes = self.hashes[order] if hashed and self.hashes is not None else None
        cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        rows: list[tuple] = []
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            first = np.flatnonzero(np.concatenate([[True], doc[a + 1 : b] != doc[a : b - 1]]))
            counts = np.diff(np.append(first, b - a)).astype("uint32")
            rows.append((int(key[a]), self.ids[doc[a:b][first]].tobytes(), counts.tobytes(), start[a:b].tobytes(),
                         None if hashes is None else hashes[a:b].tobytes()))
        columns = list(zip(*rows)) if rows else [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.binary()] * 4))],
            names=["key", "docs", "counts", "starts", "hashes"])

    @staticmethod
    def unpacked(table: pa.Table, dtype: str | None) -> _Entries:
        """The entries of packed rows; ``dtype``: of the hashes."""
        parts = {n: b"".join(x or b"" for x in table[n].to_pylist()) for n in ("docs", "counts", "starts", "hashes")}
        counts = np.frombuffer(parts["counts"], dtype="uint32")
        return _Entries(
            np.frombuffer(parts["docs"], dtype="int64").reshape(-1, 2),
            np.repeat(np.arange(len(counts)), counts),
            np.frombuffer(parts["starts"], dtype="uint32").astype("int64"),
            np.frombuffer(parts["hashes"], dtype=dtype) if dtype else None)

    def owner(self, n: int) -> np.ndarray:
        """Of each entry, the group of documents that its document belongs to."""
        mixed = (self.ids[:, 0].astype("uint64") * BASE) ^ (self.ids[:, 1].astype("uint64") * MIX)
        return ((mixed >> np.uint64(33)) % np.uint64(n)).astype("int64")[self.doc]


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """For each element of a sorted array the index of the first that equals it."""
    first = np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.zeros(0, bool)
    return np.maximum.accumulate(np.where(first, np.arange(len(first)), 0)) if len(first) else np.zeros(0, "int64")


def _sizes(runs: np.ndarray) -> np.ndarray:
    return np.bincount(runs, minlength=len(runs))[runs] if len(runs) else runs


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([batch.column(batch.schema.get_field_index(n)).to_numpy() for n in KEYS], axis=1)


def _anchors(n_buckets: int, text: str, window: int, period: int):
    """Documents to packed anchors; repeated ones of a batch go to their documents' groups."""
    length = window - period + 1
    in_cover = np.zeros(period, dtype=bool)
    in_cover[difference_cover(period)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = utf8(batch, text), _ids(batch)
            for a, b in chunks(texts):
                words, counts = _word_hashes(texts[a:b])
                doc = np.repeat(np.arange(a, b), counts)
                ends = np.cumsum(counts)
                start = np.arange(len(words)) - np.repeat(ends - counts, counts)
                at = np.flatnonzero(in_cover[start % period] & (start + length <= np.repeat(counts, counts)))
                found = _Entries(ids, doc[at], start[at], _span_hashes(words, at, length))
                order = np.argsort(found.hashes, kind="stable")
                runs = _runs(found.hashes[order])
                twice = order[_sizes(runs) > 1]
                once = found.pick(order[runs == np.arange(len(runs))])
                bucket = (once.hashes >> np.uint64(32)) % np.uint64(n_buckets)
                once.hashes = once.hashes.astype("uint32")  # the bucket stands for the other half
                yield once.packed(bucket.astype("int64"))
                known = found.pick(twice)
                yield known.packed(known.owner(n_buckets), hashed=False)

    return run


def _repeated_anchors(n_buckets: int):
    """A bucket's anchors to those that occur in two batches, by their documents' groups."""

    def run(table: pa.Table) -> pa.Table:
        hashed = pa.compute.is_valid(table["hashes"])
        sent = _Entries.unpacked(table.filter(hashed), "uint32")
        order = np.argsort(sent.hashes, kind="stable")
        twice = sent.pick(order[_sizes(_runs(sent.hashes[order])) > 1])
        out = pa.Table.from_batches([twice.packed(twice.owner(n_buckets), hashed=False)])
        return pa.concat_tables([out, table.filter(pa.compute.invert(hashed))])

    return run


def _windows(n_buckets: int, text: str, window: int, period: int):
    """Documents with repeated anchors to the packed windows around these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = utf8(batch, text), _ids(batch)
            marks = utf8(batch, STARTS)
            for a, b in chunks(texts):
                words, counts = _word_hashes(texts[a:b])
                total = len(words)
                begins = np.cumsum(counts) - counts
                found = [np.frombuffer(x, dtype="uint32") for x in marks[a:b]]
                at = np.concatenate(found) + np.repeat(begins, [len(x) for x in found])
                low = np.maximum(at - period + 1, np.repeat(begins, [len(x) for x in found]))
                cover = np.bincount(low, minlength=total + 1) - np.bincount(at + 1, minlength=total + 1)[: total + 1]
                near = np.cumsum(cover)[:total] > 0
                start = np.arange(total) - np.repeat(begins, counts)
                at = np.flatnonzero(near & (start + window <= np.repeat(counts, counts)))
                doc = np.repeat(np.arange(a, b), counts)[at]
                found = _Entries(ids, doc, start[at], _span_hashes(words, at, window))
                repeated, first = _later(found)
                bucket = (first.hashes >> np.uint64(32)) % np.uint64(n_buckets)
                yield first.packed(bucket.astype("int64"))
                yield repeated.packed(repeated.owner(n_buckets), hashed=False)

    return run


def _later(found: _Entries) -> tuple[_Entries, _Entries]:
    """Entries whose hash also starts earlier, and the others; equal ones of the others once."""
    key = found.ids[found.doc, 0]
    order = np.lexsort((found.start, key, found.hashes))
    runs = _runs(found.hashes[order])
    key, start = key[order], found.start[order]
    later = (key != key[runs]) | (start != start[runs]) if len(order) else np.zeros(0, bool)
    return found.pick(order[later]), found.pick(order[~later])


def _repeated_windows(n_buckets: int):
    """A bucket's windows to those that also start earlier, by their documents' groups."""

    def run(table: pa.Table) -> pa.Table:
        hashed = pa.compute.is_valid(table["hashes"])
        later, _ = _later(_Entries.unpacked(table.filter(hashed), "uint64"))
        out = pa.Table.from_batches([later.packed(later.owner(n_buckets), hashed=False)])
        return pa.concat_tables([out, table.filter(pa.compute.invert(hashed))])

    return run


def _by_document(table: pa.Table) -> pa.Table:
    """The packed entries of a group of documents, one row for each document."""
    found = _Entries.unpacked(table, None)
    order = np.lexsort((found.start, found.ids[found.doc, 1], found.ids[found.doc, 0]))
    ids, start = found.ids[found.doc[order]], found.start[order]
    if not len(order):
        return pa.table({**{n: pa.array([], pa.int64()) for n in KEYS}, STARTS: pa.array([], pa.binary())})
    other = np.concatenate([[True], (ids[1:] != ids[:-1]).any(axis=1)])
    fresh = other | np.concatenate([[True], start[1:] != start[:-1]])
    ids, start, first = ids[fresh], start[fresh].astype("uint32"), np.flatnonzero(other[fresh])
    starts = [x.tobytes() for x in np.split(start, first[1:])]
    return pa.table({KEYS[0]: ids[first, 0], KEYS[1]: ids[first, 1], STARTS: pa.array(starts, pa.binary())})


def _removed(window: int, text: str, names: list[str]):
    """Each text without the words of its repeated windows, and how many it had and lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, marks = utf8(batch, text), utf8(batch, STARTS)
            out, n_words, n_removed = [], [], []
            for raw, mark in zip(texts, marks):
                words = raw.split()
                n_words.append(len(words))
                start = np.frombuffer(mark, dtype="uint32").astype("int64")
                cover = np.cumsum(np.bincount(start, minlength=len(words) + 1) - np.bincount(start + window, minlength=len(words) + 1))
                kept = np.flatnonzero(cover[: len(words)] == 0) if len(start) else range(len(words))
                n_removed.append(len(words) - len(kept))
                out.append(b" ".join([words[i] for i in kept] if len(start) else words))
            new = {text: pa.array(out, pa.binary()).cast(pa.string()), "n_words": pa.array(n_words, pa.int64()),
                   "n_removed": pa.array(n_removed, pa.int64())}
            yield pa.RecordBatch.from_arrays(
                [new[n] if n in new else batch.column(batch.schema.get_field_index(n)) for n in names], names=names)

    return run


def _keyed(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    texts = docs.withColumn(text, F.col(text).cast("string"))
    return texts.withColumn(KEYS[0], key_of(doc_id)).withColumn(KEYS[1], F.xxhash64(text))


def repeated_windows(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = 20, period: int = 13) -> DataFrame:
    """One row for each document with repeated windows: its key (the doc_id, NULL as the smallest
    long), its text's hash, and the repeated windows' first positions (packed 32-bit integers)."""
    size = docs.agg(F.sum(F.length(text).cast("double"))).first()[0] or 0
    n = max(1, -int(-size // BUCKET_BYTES))
    keyed = _keyed(docs, text, doc_id)
    found = keyed.select(*KEYS, text).mapInArrow(_anchors(n, text, window, period), PACKED)
    found = found.groupBy("key").applyInArrow(_repeated_anchors(n), PACKED)
    marked = found.groupBy("key").applyInArrow(_by_document, DOCUMENT)
    # all columns stay in, so that a caller who joins the documents again reads this shuffle again
    near = keyed.join(marked, KEYS)
    sent = near.mapInArrow(_windows(n, text, window, period), PACKED).groupBy("key").applyInArrow(_repeated_windows(n), PACKED)
    return sent.groupBy("key").applyInArrow(_by_document, DOCUMENT)


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", window: int = 20, period: int = 13) -> DataFrame:
    """``docs`` with ``text`` rebuilt from the kept words (joined by one space), ``n_words`` of the
    whole text and ``n_removed``. Both joins read one shuffle of the texts."""
    starts = repeated_windows(docs, text, doc_id, window, period)
    kept = [c for c in docs.columns if c not in (text, "n_words", "n_removed")]
    names = [*kept, text, "n_words", "n_removed"]
    joined = _keyed(docs, text, doc_id).join(starts, KEYS, "left")
    schema = ", ".join(f"`{n}` {t}" for n, t in docs.select(*kept).dtypes)
    schema = ", ".join(x for x in (schema, f"`{text}` string", "n_words long", "n_removed long") if x)
    return joined.mapInArrow(_removed(window, text, names), schema)
