"""Tables in the session catalog, partitioned by day, with statistics of their columns.

A catalog table is read by name. Its statistics (rows, and for each column distinct values,
nulls, smallest and largest value) let Spark estimate filters and choose joins; its
partitions let a join with a list of days read these days only.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.conf import materialize


def save_table(rows: DataFrame, name: str, path: str, day: str = "date") -> None:
    """Make `rows` the table `name` at `path`, a folder for each day, and count its statistics.

    `rebalance` sizes the files and splits a day that is bigger than the others.
    """
    rows.hint("rebalance", day).write.mode("overwrite").partitionBy(day).option("path", path).saveAsTable(name)
    analyze(rows.sparkSession, name)


def replace_days(rows: DataFrame, name: str, day: str = "date") -> None:
    """Put the days that `rows` has in the place of the table's own; other days stay as they are."""
    spark, mode = rows.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    ordered = rows.select(*spark.table(name).columns).hint("rebalance", day)  # the partition column is the last one
    former = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # an insert by name takes it from the session only
    try:
        ordered.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(mode, former)
    analyze(spark, name)


def analyze(spark: SparkSession, name: str) -> None:
    """Count the statistics anew: one aggregation over the table, with partial results in each task."""
    spark.sql(f"analyze table {name} compute statistics for all columns")


def column_statistics(spark: SparkSession, name: str) -> dict[str, dict[str, str]]:
    """What the catalog knows of each column: distinct_count, num_nulls, min, max and so on."""
    return {
        column: {
            r.info_name: r.info_value
            for r in spark.sql(f"describe extended {name} `{column}`").collect()  # some ten lines
            if r.info_value != "NULL"
        }
        for column in spark.table(name).columns
    }


def on_days(spark: SparkSession, name: str, days: DataFrame, day: str = "date") -> DataFrame:
    """Rows of the days that are listed in the column `day` of `days`, which may be any query.

    The list is computed once and stored without repeats, so Spark plans with its measured size:
    where that is small, it sends the list first and reads only the listed partitions. Spark does
    so for a list with a selective filter only; the one on the length is there for that.
    """
    listed = materialize(days.select(day).distinct(), "days").where(F.length(day) > 0)
    return spark.table(name).join(listed, day, "left_semi")
