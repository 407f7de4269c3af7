"""Action and user tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.conf import scratch_folder, shuffles_dropped
from footfall.schemas import ACTION_SCHEMA, USER_SCHEMA
from footfall.sources.tasks import TaskParams


def read_actions(spark: SparkSession, path: str) -> DataFrame:
    """Action table at rest. It is best partitioned by `date`, see `save_actions`."""
    names = [f.split()[0] for f in ACTION_SCHEMA.split(", ")]
    return spark.read.schema(ACTION_SCHEMA).parquet(path).select(*names)


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(USER_SCHEMA).parquet(path)


def save_actions(actions: DataFrame, path: str) -> None:
    """Store actions partitioned by date, so a date range reads only its days.

    `rebalance` sizes the files and splits a day that is bigger than the others.
    """
    with shuffles_dropped(actions.sparkSession):
        actions.hint("rebalance", "date").write.mode("overwrite").partitionBy("date").parquet(path)


def stored_actions(actions: DataFrame) -> tuple[DataFrame, str]:
    """Actions that are the result of a computation, stored once in the shared folder; and where."""
    path = scratch_folder(actions.sparkSession, "actions")
    save_actions(actions, path)
    return read_actions(actions.sparkSession, path), path


def actions_in_date_range(actions: DataFrame, params: TaskParams) -> DataFrame:
    """Actions with start_date <= date <= end_date; a missing bound is open."""
    if params.start_date:
        actions = actions.where(F.col("date") >= params.start_date)
    if params.end_date:
        actions = actions.where(F.col("date") <= params.end_date)
    return actions
