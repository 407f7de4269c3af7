"""Running token counts in the state store of a stream.

The count of a token is a state with a timer. A token that does not come for a while is
closed: its count is written to a table and its state goes, so the state store holds the
tokens of that time only. Totals are the open counts, read from the checkpoint, and the
closed ones; there is no table partition for a batch in which nothing closes.
"""

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from footfall.conf import folder_exists
from footfall.streaming.tokens import tokens

COUNT = "token string, cnt bigint"
CLOSED = f"{COUNT}, batch_id bigint"


def start_running_count(
    lines: DataFrame, checkpoint: str, idle_seconds: int, trigger: dict | None = None
) -> StreamingQuery:
    """Count tokens; those that do not come for `idle_seconds` are closed.

    Tokens are counted in Arrow batches before they are shuffled, so a hot token arrives as few
    rows. Closed counts lie beside the checkpoint's own folders, one partition for each
    batch that closed any; a batch that runs again replaces its partition.
    """

    def write_closed(batch: DataFrame, batch_id: int) -> None:
        closed = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        (
            closed.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(closed_folder(checkpoint))
        )

    def count(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            (total,) = state.get
            state.remove()
            yield pd.DataFrame({"token": [key[0]], "cnt": [total]})
            return
        total = state.get[0] if state.exists else 0
        state.update((total + sum(int(f["cnt"].sum()) for f in frames),))
        state.setTimeoutDuration(idle_seconds * 1000)

    counted = tokens(lines).mapInArrow(_counts, COUNT)
    closed = counted.groupBy("token").applyInPandasWithState(
        count, COUNT, "cnt bigint", "append", GroupStateTimeout.ProcessingTimeTimeout
    )
    return (
        closed.writeStream.foreachBatch(write_closed)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counted = pa.Table.from_batches([batch]).group_by("token").aggregate([([], "count_all")])
        yield from counted.rename_columns(["token", "cnt"]).to_batches()


def closed_folder(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-closed"


def open_counts(spark: SparkSession, checkpoint: str, batch_id: int) -> DataFrame:
    """token, cnt of the states at the end of a batch."""
    states = spark.read.format("statestore").option("batchId", batch_id).load(checkpoint)
    return states.selectExpr("key.token", "value.groupState.cnt")


def read_running_counts(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Totals after the last batch that was committed; no rows before the first one.

    Counts that a later, unfinished batch has closed are still open in the state read here.
    """
    if not folder_exists(spark, f"{checkpoint}/commits/0"):
        return spark.createDataFrame([], COUNT)
    last = spark.read.format("state-metadata").load(checkpoint).agg(F.max("maxBatchId")).first()[0]
    counts = open_counts(spark, checkpoint, last)
    if folder_exists(spark, closed_folder(checkpoint)):
        closed = spark.read.schema(CLOSED).parquet(closed_folder(checkpoint))
        counts = counts.union(closed.where(F.col("batch_id") <= last).select("token", "cnt"))
    return counts.groupBy("token").agg(F.sum("cnt").alias("cnt"))
