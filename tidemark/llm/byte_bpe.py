"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

The pre-tokens of a batch stand in one linked list of byte spans; pairs across two pre-tokens
have no rank. A bucket per merge rank holds the list positions whose pair has that rank; a bitmap
of two levels (``FAN`` bits a word, one word of words) marks the buckets in use, so that
find-first-set at each level gives the lowest rank in constant time. All positions of the bucket
merge at once (of overlapping ones the leftmost, then every second). An entry whose pair has
changed since it was queued is stale and skipped. The work is linear in the queued entries,
whatever a pre-token's length.

Defined cases: NULL text encodes as the empty text (no ids); ids decode to exactly the UTF-8
bytes of the text; special tokens are never produced; repeated rows are encoded alike; a column
with an output's name is replaced; a vocabulary without all 256 single bytes is refused.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import add_columns, chunks, strings

#: Bits in a word of the lower bitmap, as a shift; the upper bitmap has a bit for each such word.
FAN = 8
LOW = (1 << FAN) - 1
BITS = [1 << i for i in range(1 << FAN)]

#: Pre-tokens above which a worker starts anew; characters whose new pre-tokens are taken together;
#: characters of pre-tokens merged at once. They bound a worker's memory.
CACHE_SIZE, BATCH_CHARS, STEP_BYTES = 1 << 17, 6 << 20, 1 << 20


class RankQueue:
    """Positions by merge rank; ``pop`` gives the lowest rank in use with all its positions."""

    def __init__(self, n_ranks: int):
        self.words = [0] * ((n_ranks >> FAN) + 1)
        self.top = 0
        self.buckets: dict[int, list[np.ndarray]] = {}

    def push(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        """Queue each position under its rank."""
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        edges = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *edges.tolist()]
        for rank, a, b in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)]):
            bucket = self.buckets.get(rank)
            if bucket is not None:
                bucket.append(positions[a:b])
                continue
            self.buckets[rank] = [positions[a:b]]
            high = rank >> FAN
            if not self.words[high]:
                self.top |= 1 << high
            self.words[high] |= BITS[rank & LOW]

    def pop(self) -> tuple[int, np.ndarray] | None:
        top = self.top
        if not top:
            return None
        high = (top & -top).bit_length() - 1  # find first set, level by level
        word = self.words[high]
        rank = (high << FAN) + (word & -word).bit_length() - 1
        self.words[high] = word = word & (word - 1)
        if not word:
            self.top = top & (top - 1)
        found = self.buckets.pop(rank)
        return rank, found[0] if len(found) == 1 else np.sort(np.concatenate(found))


class Codec:
    """Encoder and decoder for one table of ranks (token bytes -> id)."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.size = max(ranks.values(), default=-1) + 1
        self.table: list[bytes] = [b""] * self.size
        for token, rank in ranks.items():
            self.table[rank] = token
        if any(bytes([x]) not in ranks for x in range(256)):
            raise ValueError("a byte-level vocabulary has all 256 single bytes")
        self.bytes = np.array([ranks[bytes([x])] for x in range(256)], dtype="int32")
        pairs = sorted(
            (ranks[token[:k]] * self.size + ranks[token[k:]], rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        )
        self.pairs = np.array([key for key, _ in pairs] + [2**62], dtype="int64")
        self.merged = np.array([rank for _, rank in pairs] + [-1], dtype="int64")
        self.index, self.packed = _Index(), []

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the token that two neighbours make; -1: none, as for a neighbour -1."""
        keys = left.astype("int64") * self.size + right
        at = np.searchsorted(self.pairs, keys)
        return np.where((self.pairs[at] == keys) & (left >= 0) & (right >= 0), self.merged[at], -1)

    def merge(self, pieces: list[bytes], together: bool = True) -> list[bytes]:
        """Packed ids of each pre-token. ``together``: merge all positions of a rank in one step,
        which equals one by one as long as no merge opens a lower rank; pre-tokens where one does
        are done again, one position at a time."""
        sizes = np.array([len(x) for x in pieces])
        start = np.concatenate([[0], np.cumsum(sizes + 1)])  # a wall behind each pre-token
        total = int(start[-1])
        token = np.full(total + 1, -1, dtype="int32")
        text = np.frombuffer(b"\0".join(pieces) + b"\0", dtype="uint8")
        token[:total] = self.bytes[text]
        token[start[1:] - 1] = -1
        after = np.arange(1, total + 2, dtype="int32")
        before = np.arange(-1, total, dtype="int32")
        pair = np.full(total + 1, -1, dtype="int32")
        pair[:total] = self.rank_of(token[:-1], token[1:])
        for at, piece in enumerate(pieces):  # a pre-token that is a token is no work
            if piece in self.ranks:
                a = start[at]
                pair[a : a + len(piece)] = -1
                token[a], after[a] = self.ranks[piece], a + len(piece)
        queue, again = RankQueue(self.size), set()
        first = np.flatnonzero(pair >= 0)
        if len(first):
            queue.push(first, pair[first])
        while (found := queue.pop()) is not None:
            rank, at = found
            at = at[pair[at] == rank]  # the others are stale
            if not len(at):
                continue
            if len(at) > 1:
                at = at[np.concatenate([[True], at[1:] != at[:-1]])]
                if together:
                    k = np.arange(len(at))
                    fresh = np.concatenate([[True], after[at[:-1]] != at[1:]])
                    at = at[(k - np.maximum.accumulate(np.where(fresh, k, 0))) % 2 == 0]
                else:
                    queue.push(at[1:], pair[at[1:]])
                    at = at[:1]
            gone = after[at]
            end = after[gone]
            token[at] = rank
            after[at] = end
            before[end] = at
            pair[gone] = -1
            left = before[at]
            near = np.unique(np.concatenate([at, left[left >= 0]]))
            ranks = self.rank_of(token[near], token[after[near]])
            pair[near] = ranks
            held = ranks >= 0
            if held.any():
                near, ranks = near[held], ranks[held]
                if together and (lower := ranks < rank).any():
                    again.update((np.searchsorted(start, near[lower], "right") - 1).tolist())
                queue.push(near, ranks)
        alive = np.zeros(total + 1, dtype=bool)
        alive[self._nodes(start, after, token)] = True
        ids = token[alive].astype("<i4")
        ends = np.cumsum(alive)[start[1:] - 1] if len(pieces) else []
        raw, out, a = ids.tobytes(), [], 0
        for b in ends:
            out.append(raw[4 * a : 4 * b])
            a = int(b)
        if again:
            again = sorted(again)
            for at, packed in zip(again, self.merge([pieces[x] for x in again], together=False)):
                out[at] = packed
        return out

    @staticmethod
    def _nodes(start: np.ndarray, after: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Positions that are still spans: all that are reached by ``after`` from a first one."""
        at, found = start[:-1], []
        while len(at := at[token[at] >= 0]):
            found.append(at)
            at = after[at]
        return np.concatenate(found) if found else np.zeros(0, dtype="int64")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if len(self.packed) > CACHE_SIZE:
            self.index, self.packed = _Index(), []
        index, packed = self.index, self.packed
        known = len(packed)
        coded = []  # of each text's pre-tokens the numbers: the strings themselves would fill the memory
        for text in texts:
            pieces = self.split(text)
            coded.append(np.fromiter(map(index.__getitem__, pieces), dtype="int32", count=len(pieces)))
        new = list(islice(index, known, None))
        done = 0
        while done < len(new):
            size, a = 0, done
            while done < len(new) and (size < STEP_BYTES or done == a):
                size, done = size + len(new[done]), done + 1
            packed += self.merge([x.encode() for x in new[a:done]])
        return [b"".join(map(packed.__getitem__, x.tolist())) for x in coded]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.table.__getitem__, ids))


class _Index(dict):
    """Pre-tokens numbered in the order in which they come."""

    def __missing__(self, piece: str) -> int:
        self[piece] = number = len(self)
        return number


_codecs: dict[tuple[bytes, str], Codec] = {}


def codec_of(lines: bytes, pattern: str) -> Codec:
    """The codec of a file of "base64-token rank" lines, built once in each process."""
    key = hashlib.sha256(lines).digest(), pattern
    if key not in _codecs:
        pairs = (line.split() for line in lines.splitlines() if line.strip())
        _codecs[key] = Codec({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)
    return _codecs[key]


def _vocabulary(spark: SparkSession, path: str):
    """The file of ranks for the workers: its size is fixed by the tokenizer, not by the input."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` (array<int>): the tokens of the whole text, as ``path`` ranks merges."""
    lines = _vocabulary(docs.sparkSession, path)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = codec_of(lines.value, pattern)
        texts = strings(batch, text)
        packed = [x for a, b in chunks(texts, BATCH_CHARS) for x in codec.encode(texts[a:b])]
        offsets = np.zeros(len(packed) + 1, dtype="int64")
        np.cumsum([len(x) // 4 for x in packed], out=offsets[1:])
        values = pa.array(np.frombuffer(b"".join(packed), dtype="<i4"), type=pa.int32())
        return [pa.ListArray.from_arrays(pa.array(offsets.astype("int32")), values)]

    return add_columns(docs, [T.StructField(ids, T.ArrayType(T.IntegerType(), False))], run)


def decode(docs: DataFrame, path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with ``decoded`` (binary): the bytes that ``ids`` stand for; NULL ids give none."""
    lines = _vocabulary(docs.sparkSession, path)

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        codec = codec_of(lines.value, pattern)
        lists = batch.column(batch.schema.get_field_index(ids))
        lists = lists.fill_null(pa.scalar([], lists.type)) if lists.null_count else lists
        values, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_pylist()
        return [pa.array([codec.decode(values[a:b].tolist()) for a, b in zip(at, at[1:])], pa.binary())]

    return add_columns(docs, [T.StructField(decoded, T.BinaryType())], run)
