"""Token counts over a stream of text lines.

The count table holds one partition for each micro-batch (`run`, `batch_id`) with the
columns token, cnt and from_batch. A run is a checkpoint: its number comes from there, so
a new checkpoint adds to the counts of an old one. A compacted partition has the totals
of the batches from_batch to batch_id.
"""

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from footfall.conf import folder_exists, remove_folder

COUNT_SCHEMA = "token string, cnt bigint, from_batch bigint, run string, batch_id bigint"


def read_line_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the text files that appear under `path`."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def tokens(lines: DataFrame) -> DataFrame:
    """The comma-separated tokens of each line, empty ones dropped."""
    return lines.select(F.explode(F.split("value", ",")).alias("token")).where("token != ''")


def _write(counts: DataFrame, table: str) -> None:
    """Replace the partitions that `counts` has rows of; old rows stay until the new ones are complete."""
    (
        counts.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("run", "batch_id")
        .parquet(table)
    )


def start_token_count(
    lines: DataFrame, table: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Write each micro-batch's token counts as one partition of `table`.

    A batch that runs again after a failure replaces its own partition, so nothing
    is counted twice, and no state grows with the number of tokens. The default
    trigger takes what is there and stops; pass {"processingTime": "5 seconds"}
    for a continuous run.
    """

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        run = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        counts = batch.groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))
        number = F.lit(batch_id).cast("bigint")
        _write(counts.withColumns({"from_batch": number, "run": F.lit(run), "batch_id": number}), table)

    return (
        tokens(lines)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _stored(spark: SparkSession, table: str) -> DataFrame:
    """Rows of the table, without partitions that a compacted one holds the totals of."""
    if not folder_exists(spark, table):
        return spark.createDataFrame([], COUNT_SCHEMA)
    rows = spark.read.schema(COUNT_SCHEMA).parquet(table)
    parts = rows.select("run", "batch_id", "from_batch").distinct()
    covered = parts.alias("p").join(
        parts.alias("q"),
        F.expr("p.run = q.run and p.batch_id between q.from_batch and q.batch_id - 1"),
        "left_semi",
    )
    return rows.join(covered, ["run", "batch_id"], "left_anti")


def read_token_counts(spark: SparkSession, table: str) -> DataFrame:
    """Totals over all batches written so far; no rows before the first one."""
    return _stored(spark, table).groupBy("token").agg(F.sum("cnt").alias("cnt"))


def compact_token_counts(spark: SparkSession, table: str) -> None:
    """Put the closed batches of each run together, that is all but its last one.

    The last one may be written again, the ones before it are committed. Totals replace the
    last closed batch first and cover the others from then on; those go afterwards, so
    a reader gets right counts at any time, and so does a repetition.
    """
    rows = _stored(spark, table)
    last = rows.groupBy("run").agg(F.max("batch_id").alias("last"))
    closed = rows.join(last, "run").where("batch_id < last")
    upto = closed.groupBy("run").agg(F.min("from_batch").alias("a"), F.max("batch_id").alias("b"))
    spans = upto.where("a < b").collect()  # one row for each run
    if not spans:
        return
    totals = closed.groupBy("run", "token").agg(F.sum("cnt").alias("cnt")).join(upto.where("a < b"), "run")
    _write(totals.selectExpr("token", "cnt", "a as from_batch", "run", "b as batch_id"), table)
    for span in spans:
        for batch in range(span["a"], span["b"]):
            remove_folder(spark, f"{table}/run={span['run']}/batch_id={batch}")
