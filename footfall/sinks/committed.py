"""A sink whose partitions appear together or not at all.

Each task writes one file of the run and reports it in a commit message. When all tasks
are done, the driver's step checks that the reported files are there, removes those of
attempts that lost, and publishes the run. If a task fails for good, the driver's step
discards the run. Readers go by the published run, so a failed job shows nothing, and a
job of fewer partitions leaves no old part behind.
"""

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from footfall.sinks.runs import current_folder, discard, file_system, new_run, publish, run_folder

FORMAT = "footfall-committed"


@dataclass
class Written(WriterCommitMessage):
    """What a task has written: the name of its file (none without rows) and the rows."""

    file: str | None
    rows: int


class CommittedSink(DataSource):
    """`df.write.format(FORMAT).option("folder", ...)`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> "CommittedWriter":
        folder = self.options.get("folder")
        if not folder:
            raise ValueError("the option folder is missing")
        if not overwrite:
            raise ValueError("a run replaces the former one: write with mode overwrite")
        return CommittedWriter(folder, new_run(folder))


class CommittedWriter(DataSourceArrowWriter):
    def __init__(self, folder: str, run: str):
        self.folder, self.run = folder, run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """The rows of a partition in one file; its name tells attempts apart."""
        files, path = file_system(run_folder(self.folder, self.run))
        part = f"part-{TaskContext.get().partitionId():05}-{uuid.uuid4().hex}.parquet"
        writer, rows = None, 0
        try:
            for batch in iterator:
                writer = writer or pyarrow.parquet.ParquetWriter(f"{path}/{part}", batch.schema, filesystem=files)
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Written(part if writer is not None else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        files, path = file_system(run_folder(self.folder, self.run))
        wanted = {m.file for m in messages if m is not None and m.file}
        there = {f.base_name for f in files.get_file_info(pyarrow.fs.FileSelector(path))}
        if wanted - there:
            discard(self.folder, self.run)
            raise FileNotFoundError(f"{len(wanted - there)} of {len(wanted)} parts are missing in {path}")
        for lost in there - wanted:
            files.delete_file(f"{path}/{lost}")
        publish(self.folder, self.run)

    def abort(self, messages: list[Written | None]) -> None:
        discard(self.folder, self.run)


def write_committed(df: DataFrame, folder: str) -> None:
    """Make the rows of `df` the content of the sink at `folder`."""
    df.sparkSession.dataSource.register(CommittedSink)
    df.write.format(FORMAT).mode("overwrite").option("folder", folder).save()


def read_committed(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """The rows of the last job that was committed."""
    return spark.read.schema(schema).parquet(current_folder(folder))
