"""One reading of a stream for several sinks, each with a ledger of the batches it has."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .runner import DEFAULT_TRIGGER, start_batch_sink

Writer = Callable[[DataFrame, int], None]


class Ledger:
    """The last batch that a sink has stored: an empty file named by its number in the sink's folder."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self.path = path
        self.files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def last(self) -> int:
        folder = self._path(self.path)
        if not self.files.exists(folder):
            return -1
        return max((int(f.getPath().getName()) for f in self.files.listStatus(folder)), default=-1)

    def add(self, batch_id: int) -> None:
        """The new mark is there before older ones go, so that a stop in between loses none."""
        self.files.create(self._path(f"{self.path}/{batch_id}"), True).close()
        for f in self.files.listStatus(self._path(self.path)):
            if int(f.getPath().getName()) < batch_id:
                self.files.delete(f.getPath(), False)


def shared_writer(spark: SparkSession, sinks: dict[str, Writer], ledger: str) -> Writer:
    """A batch writer that stores each micro-batch in all ``sinks`` from one persisted copy.

    A sink that fails does not keep the others from their rows; the batch then fails, and its replay
    goes to the sinks that lack it. A stop between a write and its mark repeats that write, so a
    sink's writer must replace what it stored for the same batch. ``ledger`` belongs to one checkpoint."""
    marks = {name: Ledger(spark, f"{ledger.rstrip('/')}/{name}") for name in sinks}

    def write(batch: DataFrame, batch_id: int) -> None:
        open_sinks = [name for name in sinks if marks[name].last() < batch_id]
        if not open_sinks:
            return
        failed: list[tuple[str, Exception]] = []
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name in open_sinks:
                try:
                    sinks[name](batch, batch_id)
                    marks[name].add(batch_id)
                except Exception as error:  # reported below, after the other sinks
                    failed.append((name, error))
        finally:
            batch.unpersist()
        if failed:
            raise RuntimeError(f"batch {batch_id} failed in {', '.join(n for n, _ in failed)}") from failed[0][1]

    return write


def start_shared(
    df: DataFrame, sinks: dict[str, Writer], ledger: str, checkpoint: str, available_now: bool = False,
    processing_time: str = DEFAULT_TRIGGER,
) -> StreamingQuery:
    """One query over ``df`` that feeds all ``sinks``: the source is read, and state is kept, once.

    ``runner.fan_out`` is the other choice: a query per sink, which reads the source as often as
    there are sinks, but lets one lag behind the others."""
    return start_batch_sink(df, shared_writer(df.sparkSession, sinks, ledger), checkpoint, available_now=available_now,
                            processing_time=processing_time)
