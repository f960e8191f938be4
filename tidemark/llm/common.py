"""Helpers shared by the operators: Arrow batches, staged tables, column names."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staging_path

#: Stands for a NULL document id in keys and orders: it comes before every other id.
NULL_ID = -(2**63)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers (once an application), wherever the driver found it."""
    context = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if context.applicationId in _shipped or not os.path.isdir(root):
        return
    folder = os.path.realpath(tempfile.mkdtemp(prefix="tidemark-"))  # Spark copies it from the driver
    context.addPyFile(shutil.make_archive(os.path.join(folder, "tidemark"), "zip", root, "tidemark"))
    _shipped.add(context.applicationId)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the cluster's shared checkpoint folder and read it back.

    Cuts the lineage, so that work in Python is done once and a lost executor costs a read.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_of(column: str):
    """A document id as a key that is never NULL."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def add_columns(
    df: DataFrame, fields: list[T.StructField], fn: Callable[[pa.RecordBatch], list[pa.Array]]
) -> DataFrame:
    """``df`` with columns that ``fn`` computes for each Arrow batch; equal names are replaced."""
    names = {f.name for f in fields}
    keep = [f for f in df.schema.fields if f.name not in names]
    kept = [f.name for f in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)) for n in kept]
            yield pa.RecordBatch.from_arrays([*columns, *fn(batch)], names=[*kept, *(f.name for f in fields)])

    return df.mapInArrow(run, T.StructType([*keep, *fields]))


def utf8(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """The UTF-8 bytes of a string column; NULL is empty."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [x or b"" for x in values.to_pylist()]


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    """A string column; NULL is empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def chunks(texts: list, limit: int = 1 << 23) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes each; a longer text is alone."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and size + len(text) > limit:
            yield start, i
            start, size = i, 0
        size += len(text)
    if start < len(texts):
        yield start, len(texts)
