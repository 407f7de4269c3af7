"""JDBC tables. The driver jar and the database are the deployment's business."""

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, table: str, driver: str, **options: str) -> DataFrame:
    """A database table. `partitionColumn`, `lowerBound`, `upperBound` and
    `numPartitions` split a large one over tasks."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, driver=driver, **options)
        .load()
    )


def append_jdbc(
    df: DataFrame, url: str, table: str, driver: str, connections: int = 10, batch_size: int = 10_000
) -> None:
    """Append in batches over at most `connections` connections."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, driver=driver, batchsize=batch_size, numPartitions=connections)
        .mode("append")
        .save()
    )
