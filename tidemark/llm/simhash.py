"""SimHash near-duplicates by covering locality-sensitive hashing.

The 64 bits fall into 2^(r+1)-1 blocks, one per non-zero label of r+1 bits; each non-zero v gives
a table that keeps the bits whose label has an odd product with v. Any r differing bits span at
most r of the r+1 dimensions, so some v leaves all of them out: every pair within r bits collides
in that table. Colliding fingerprints are linked through midpoints: a fingerprint is filed under
itself and under each value one left-out bit away. Two within distance 2 meet at a midpoint, and
all that meet there are within 2 of each other, so a star per midpoint loses no link and no
bucket is expanded into its pairs, however large.

Copies are folded into distinct fingerprints first. Defined cases: NULL or wordless text has
fingerprint zero, linked like any other; a NULL doc_id counts as the smallest only where one must
be chosen, and ``component_id`` is NULL only if every doc_id of the component is; repeated rows
share a class.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, key_of, staged, utf8
from .graph import components

BITS = 64
#: Shingle hashes whose bits are counted at once.
STEP = 1 << 15


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned SimHash: a bit is 1 if it is set in over half of the shingles' XXH64 values."""
    words = text.lower().split()  # bytes: A-Z only, and the six ASCII white-space characters
    if not words:
        return 0
    n = min(shingle, len(words))
    line = b" ".join(words)
    at = list(accumulate((len(w) + 1 for w in words), initial=0))
    hashed = xxhash.xxh64_intdigest
    h = np.fromiter((hashed(line[a : b - 1], seed) for a, b in zip(at, at[n:])), dtype="<u8", count=len(words) - n + 1)
    counts = np.zeros(BITS, dtype="int64")
    for a in range(0, len(h), STEP):
        bits = np.unpackbits(h[a : a + STEP].view("uint8").reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype="int32")
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 3, out: str = "fingerprint") -> DataFrame:
    """``docs`` with the signed 64-bit fingerprint of each whole text."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        values = np.array([fingerprint(x, shingle) for x in utf8(batch, text)], dtype="uint64")
        return [pa.array(values.view("int64"))]

    return add_columns(docs, [T.StructField(out, T.LongType(), False)], run)


def covering_masks(radius: int) -> list[int]:
    """For each table the bits that it leaves out."""
    labels = [i % (2 ** (radius + 1) - 1) + 1 for i in range(BITS)]
    return [
        sum(1 << i for i, label in enumerate(labels) if (label & v).bit_count() % 2 == 0)
        for v in range(1, 2 ** (radius + 1))
    ]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Edges (src, dst) that connect all distinct ``fp`` within ``radius`` (1 or 2) bits."""
    if radius not in (1, 2):
        raise ValueError("midpoints stand for distances of 1 and 2")
    masks = covering_masks(radius)
    tables = prints.select("fp", F.posexplode(F.array(*[
        F.col("fp").bitwiseAND(F.lit(_signed(~m & (2**64 - 1)))) for m in masks])).alias("table", "key"))
    full = tables.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    left_out = F.element_at(F.array(*[F.lit(_signed(m)) for m in masks]), F.col("table") + 1)
    near = tables.join(full, ["table", "key"]).groupBy("fp").agg(F.bit_or(left_out).alias("free"))
    flips = F.transform(
        F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.getbit("free", i) == 1),
        lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)),
    )
    filed = near.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("midpoint"))
    if radius == 1:  # pairs one bit apart: one of them is the other's midpoint
        met = filed.alias("a").join(prints.alias("b"), F.col("a.midpoint") == F.col("b.fp"))
        return met.select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst")).where("src <> dst").distinct()
    # at most 65 fingerprints lie within one bit of a midpoint: the list is bounded
    met = filed.groupBy("midpoint").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return met.select(F.explode("fps").alias("src"), F.array_min("fps").alias("dst")).where("src <> dst").distinct()


def classes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per input row: (doc_id, text_hash, fingerprint, root, component_id), where ``root``
    is the smallest fingerprint of the component and ``component_id`` its smallest doc_id."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    hashed = narrow.withColumn("text_hash", F.xxhash64("text"))
    members = staged(with_fingerprint(hashed, "text", shingle).drop("text"), "simhash-members")
    prints = members.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("first"))
    prints = staged(prints, "simhash-prints")
    roots = components(links(prints, radius))
    named = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "root").select(F.col("fp").alias("fingerprint"), "root", "component_id")
    return members.join(named, "fingerprint")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shingle: int = 3, radius: int = 2) -> DataFrame:
    """One document of each class: the one of the smallest doc_id (NULL last; ties: the smaller
    text hash; equal rows: one of them). Columns as in ``docs``."""
    found = classes(docs, text, doc_id, shingle, radius)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    chosen = found.groupBy("root").agg(F.min(order).alias("m")).select(
        key_of("m.doc_id").alias("_id"), F.col("m.text_hash").alias("_hash")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"), key_of(doc_id).alias("_id"), F.xxhash64(F.col(text).cast("string")).alias("_hash"))
    return rows.join(chosen, ["_id", "_hash"]).dropDuplicates(["_id", "_hash"]).select("row.*")
