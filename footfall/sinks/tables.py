"""Result tables, partitioned by task."""

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T


def replace_task(df: DataFrame, path: str, task_id: int) -> int:
    """Make `df` the rows of `task_id` in the table at `path`; returns their number.

    The old rows stay until the new ones are complete, and other tasks are not
    touched, so a run may be repeated. A run without rows clears the task, which a
    dynamic overwrite alone would leave as it was.
    """
    written = Observation()
    (
        df.withColumn("task_id", F.lit(task_id).cast("bigint"))
        .observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("task_id")
        .parquet(path)
    )
    rows = written.get["rows"]
    if rows == 0:
        delete_task(df.sparkSession, path, df.schema, task_id)
    return rows


def delete_task(spark: SparkSession, path: str, schema: T.StructType, task_id: int) -> None:
    """Remove the rows of one task."""
    columns = T.StructType([f for f in schema.fields if f.name != "task_id"])
    spark.createDataFrame([], columns).write.mode("overwrite").parquet(f"{path}/task_id={task_id}")


def read_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A result table; reading one task scans only that task's partition."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
