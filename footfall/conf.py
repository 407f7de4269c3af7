"""Session settings the jobs are written for, and the shared scratch folder."""

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# For a cluster, `spark.sql.shuffle.partitions` is the initial partition number
# that adaptive execution coalesces from: about (bytes shuffled / 128 MB), so
# several 10,000s at 100 TB. It is not set here because it depends on the input.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new, empty folder under the shared folder named by `spark.checkpoint.dir`.

    Where that is not set, the session's warehouse takes its place: every executor
    writes its tables there, so it is shared as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/footfall/{name}-{uuid.uuid4().hex}"


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder whose content is not needed any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


#: Whether the shuffle files of a statement go when it is done, not when the driver next collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Tables stored within leave no shuffle files: what they hold is in the stored table."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared scratch folder and return the table read back.

    Used for a table that several results are derived from: it is computed once,
    survives the loss of executors, and each reader prunes its own columns.
    """
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
