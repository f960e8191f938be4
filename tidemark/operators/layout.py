"""Physical layout experiments: sort orders, partitioning, and a storage-size report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import staging_path


#: Bytes that a task writes to one file: few enough that one task's sort is short and all cores write.
FILE_BYTES = 32 << 20


def storage_size(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """Bytes and file count of a written table, from a listing of its files (their rows are not read)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    return files.select("path", "length").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("total_bytes")
    ).select(F.lit(layout).alias("layout"), "n_files", "total_bytes")


def rank_orders(df: DataFrame, columns: Sequence[str], every: int = 1, key: str | None = None) -> DataFrame:
    """Which order of ``columns`` would make the smallest files, before anything is written.

    Rows sorted by an order have, in its i-th column, one run of equal values for each distinct
    combination of its first i columns; Parquet stores about one value a run. So an order costs the
    sum of runs x bytes of a value, over its columns. The number of combinations does not depend on
    their order: one aggregate over the sets of columns (with one scan and one Expand) gives them all,
    and the orders are ranked from these few rows. Returns (sort_order, runs, cost, place), place 1
    being the smallest, ties by name.

    ``every`` > 1 reads a sample: all rows of one in ``every`` values of ``key`` (whole runs, not single
    rows). The runs of orders that start with ``key`` scale exactly; those of few combinations come
    out too low, so the sample serves tables whose sets of columns are far larger than the sample.
    """
    if every > 1:
        df = df.where(F.pmod(F.xxhash64(key or columns[0]), F.lit(every)) == 0)
    sets = [list(s) for n in range(1, len(columns) + 1) for s in combinations(columns, n)]
    widths = df.agg(*[
        F.ceil(F.sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))) / F.count(F.lit(1))).cast("long").alias(c)
        for c in columns])
    held = [F.when(F.grouping(c) == 0, F.lit(c)) for c in columns]
    groups = df.groupingSets(sets, *columns).agg(F.concat_ws(",", *held).alias("columns"))
    runs = groups.groupBy("columns").agg(F.count(F.lit(1)).alias("n"))
    by_set = runs.agg(F.map_from_entries(F.collect_list(F.struct("columns", "n"))).alias("n"))  # 2^columns - 1 entries
    ranked = by_set.join(widths).select(F.explode(F.array(*[
        F.struct(
            F.lit(",".join(order)).alias("sort_order"),
            F.array(*[F.col("n")[_set_name(columns, order[: i + 1])] for i in range(len(order))]).alias("runs"),
            reduce(lambda a, b: a + b, [
                F.col("n")[_set_name(columns, order[: i + 1])] * F.col(c) for i, c in enumerate(order)]).alias("cost"))
        for order in permutations(columns)])).alias("x")).select("x.*")
    return ranked.withColumn("place", F.row_number().over(Window.orderBy("cost", "sort_order")))


def _set_name(columns: Sequence[str], chosen: Sequence[str]) -> str:
    return ",".join(c for c in columns if c in chosen)


def write_smallest(
    spark: SparkSession, df: DataFrame, columns: Sequence[str], path: str, every: int = 1, tasks: int = 1
) -> list[str]:
    """Write ``df`` in the order that ``rank_orders`` puts first, and return that order."""
    order = rank_orders(df, columns, every).where("place = 1").first()["sort_order"].split(",")
    df.repartitionByRange(tasks, *order).sortWithinPartitions(*order).write.parquet(path)
    return order


def write_layouts(
    spark: SparkSession,
    df: DataFrame,
    sort_orders: Mapping[str, Sequence[str]],
    partition_by: Mapping[str, Column] | None = None,
    checksum: Column | None = None,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Write ``df`` once per candidate layout and report their sizes (smallest first wins).

    Each candidate is ``repartition(n).sortWithinPartitions(*order)``: a local sort, no range
    shuffle; low-cardinality columns first give Parquet long runs for dictionary and run-length
    encoding. ``n`` follows from the bytes of the input. ``partition_by`` adds candidates
    partitioned by a folder per value (e.g. the year of a date); the rows of one value are dealt
    over ``n`` salts, so that a large year is written by many tasks. ``n_rows`` and ``checksum`` are
    read back from what was written.
    """
    # The input is written once in the shared staging folder (which cuts its lineage), so each
    # candidate reads a table instead of recomputing the plan before it.
    path = staging_path(spark, "layout-input")
    df.write.parquet(path)
    df = spark.read.parquet(path)
    size = storage_size(spark, path, "input").first()["total_bytes"] or 0
    n = max(1, -(-size // file_bytes))
    base = df.repartition(n)
    written: dict[str, str] = {}
    for name, order in sort_orders.items():
        written[name] = staging_path(spark, f"layout-{name}")
        (base.sortWithinPartitions(*order) if order else base).write.parquet(written[name])
    for name, col in (partition_by or {}).items():
        written[name] = staging_path(spark, f"layout-{name}")
        salted = df.withColumn("_part", col).withColumn("_salt", F.floor(F.rand(11) * n))
        salted.repartition("_part", "_salt").drop("_salt").write.partitionBy("_part").parquet(written[name])
    total = F.lit(None).cast("long") if checksum is None else checksum
    reports = []
    for name, path in written.items():
        held = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), total.alias("checksum"))
        size = storage_size(spark, path, name).first()  # two scalars of a listing
        reports.append(held.select(
            F.lit(name).alias("layout"), F.lit(size["n_files"]).alias("n_files"),
            F.lit(size["total_bytes"]).alias("total_bytes"), "n_rows", "checksum"))
    return reduce(DataFrame.unionByName, reports)
