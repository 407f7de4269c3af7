"""Writing through a connection of one's own, one connection per partition."""

from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F


class Writer(Protocol):
    """What a partition is written through: batches, and then either commit or abort."""

    def write(self, batch: pa.RecordBatch) -> None: ...

    def commit(self) -> None: ...

    def abort(self) -> None: ...


def write_partitions(df: DataFrame, open_writer: Callable[[int, int], Writer]) -> int:
    """Hand each partition to a writer of its own in Arrow batches; returns the rows written.

    `open_writer` gets the number of the partition and of the task's attempt. A lost or
    failed task writes its partition again, so what a writer commits has to replace what
    another attempt of that partition has committed. One more writer, of partition -1, is
    opened and aborted on the driver first: a sink that can't be opened fails there, and
    what all writers share, such as a folder, exists before the first task. Partitions
    are committed one by one; `footfall.sinks.committed` commits a job as a whole.
    """
    open_writer(-1, 0).abort()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows = TaskContext.get(), 0
        writer = open_writer(task.partitionId(), task.attemptNumber())
        try:
            for batch in batches:
                writer.write(batch)
                rows += batch.num_rows
        except BaseException:
            writer.abort()
            raise
        writer.commit()
        yield pa.RecordBatch.from_pydict({"rows": pa.array([rows], pa.int64())})

    return df.mapInArrow(run, "rows bigint").agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


class ParquetWriter:
    """A file for each partition in a folder that all executors share, renamed into place when complete."""

    def __init__(self, folder: str, partition: int, attempt: int):
        uri = folder.replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else folder
        self.files, path = pyarrow.fs.FileSystem.from_uri(uri)
        self.files.create_dir(path)
        self.path, self.part = f"{path}/part-{partition:05}.parquet", f"{path}/_part-{partition:05}-{attempt}"
        self.writer = None

    def write(self, batch: pa.RecordBatch) -> None:
        if self.writer is None:
            self.writer = pyarrow.parquet.ParquetWriter(self.part, batch.schema, filesystem=self.files)
        self.writer.write_batch(batch)

    def commit(self) -> None:
        if self.writer is not None:
            self.writer.close()
            self.files.move(self.part, self.path)

    def abort(self) -> None:
        if self.writer is not None:
            self.writer.close()
            self.files.delete_file(self.part)
