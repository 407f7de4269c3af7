"""Lines of growing log files as a stream with offsets of its own.

An offset says for each file how many bytes of it are done; it always lies behind the end
of a line, so a line that is still being written waits for its end. Spark keeps the
offsets in the checkpoint: a query that is stopped and started again reads on where it was.
Files may grow and be added, at any depth; one that has become shorter is an error. Offsets
have one entry for each file, so the files are meant to be large, as logs are.
"""

import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from footfall.sinks.runs import file_system

FORMAT = "footfall-line-log"
#: Bytes that a task reads, unless a line that begins there is longer.
BYTES_PER_TASK = 128 << 20
#: Bytes that are looked through at a time for the last end of a line.
TAIL = 1 << 16
LINES_PER_BATCH = 10_000


@dataclass
class Piece(InputPartition):
    """The lines that begin at the bytes `start` to `end` of a file."""

    file: str
    start: int
    end: int


class LineLog(DataSource):
    """`spark.readStream.format(FORMAT).option("folder", ...).option("bytes_per_task", ...)`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "value string"

    def streamReader(self, schema: StructType) -> "LineLogReader":
        if not self.options.get("folder"):
            raise ValueError("the option folder is missing")
        return LineLogReader(self.options["folder"], int(self.options.get("bytes_per_task", BYTES_PER_TASK)))


class LineLogReader(DataSourceStreamReader):
    def __init__(self, folder: str, bytes_per_task: int):
        self.folder, self.bytes_per_task = folder, bytes_per_task
        self.ends: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {"files": {}}

    def latestOffset(self) -> dict:
        """Ends of the last whole lines. Of a file that has not grown, nothing is read."""
        files, root = file_system(self.folder)
        for info in files.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True, recursive=True)):
            name = info.path[len(root.rstrip("/")) + 1 :]
            if info.type != pyarrow.fs.FileType.File or any(part[0] in "._" for part in name.split("/")):
                continue
            size, end = self.ends.get(name, (0, 0))
            if info.size < size:
                raise ValueError(f"{info.path} has become shorter: {size} bytes before, {info.size} now")
            if info.size > size:
                with files.open_input_file(info.path) as file:
                    self.ends[name] = info.size, last_end(file, end, info.size)
        return {"files": {name: end for name, (_, end) in sorted(self.ends.items()) if end}}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        pieces = []
        for name, upto in end["files"].items():
            done = start["files"].get(name, 0)
            if upto < done:
                raise ValueError(f"{name} has become shorter: {done} bytes were read, {upto} are there")
            pieces += [
                Piece(name, at, min(at + self.bytes_per_task, upto)) for at in range(done, upto, self.bytes_per_task)
            ]
        return pieces

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        files, root = file_system(self.folder)
        with files.open_input_file(f"{root}/{partition.file}") as file:
            lines = []
            for line in lines_between(file, partition.start, partition.end):
                lines.append(line.decode("utf-8", "replace"))
                if len(lines) == LINES_PER_BATCH:
                    yield pa.record_batch({"value": pa.array(lines, pa.string())})
                    lines = []
            if lines:
                yield pa.record_batch({"value": pa.array(lines, pa.string())})

    def commit(self, end: dict) -> None:
        """Nothing to do: files stay, and what is read is in the checkpoint."""


def last_end(file: pa.NativeFile, start: int, size: int) -> int:
    """The position behind the last line end between `start` and `size`; `start` if there is none."""
    while size > start:
        at = max(start, size - TAIL)
        file.seek(at)
        if (found := file.read(size - at).rfind(b"\n")) >= 0:
            return at + found + 1
        size = at
    return start


def lines_between(file: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    """The lines that begin at the bytes from `start` on, before `end`, without their ends (\\n or \\r\\n)."""
    file.seek(max(0, start - 1))
    lines = io.BufferedReader(file)
    at = start
    if start:  # the byte before is the end of a line, or the line that goes on belongs to the piece before
        at += len(lines.readline()) - 1
    while at < end and (line := lines.readline()):
        at += len(line)
        yield line.removesuffix(b"\n").removesuffix(b"\r")


def read_line_log(spark: SparkSession, folder: str, bytes_per_task: int = BYTES_PER_TASK) -> DataFrame:
    """The stream of whole lines of the files under `folder`, column `value`."""
    spark.dataSource.register(LineLog)
    return spark.readStream.format(FORMAT).option("folder", folder).option("bytes_per_task", bytes_per_task).load()
