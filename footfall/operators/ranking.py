"""Positions of all rows in one order, without a task that sees all of them."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from footfall.conf import materialize

#: Rows that a task sorts, on average.
ROWS_PER_TASK = 100_000


def rank_all(rows: DataFrame, order: list[Column], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Every row with its position in `order`, from 1, in the column `rank`.

    Rows are dealt to ranges of the order and stored with the number of their range, so
    that all later steps see the same ranges. Ranges are counted, and a position is the
    rows of the ranges before plus the position within the range. `order` has to end in
    columns that tell all rows apart: it makes ranks certain, and it lets a range end
    among rows that are equal in the first columns, however many there are.
    """
    tasks = 1 + rows.count() // rows_per_task
    ranges = rows.repartitionByRange(tasks, *order).withColumn("rank_range", F.spark_partition_id())
    ranges = materialize(ranges, "ranges")
    sizes = ranges.groupBy("rank_range").agg(F.count(F.lit(1)).alias("rank_size"))  # one row for each task
    before = Window.orderBy("rank_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("rank_range", F.coalesce(F.sum("rank_size").over(before), F.lit(0)).alias("rank_before"))
    within = F.row_number().over(Window.partitionBy("rank_range").orderBy(*order))
    ranked = ranges.withColumn("rank_within", within).join(sizes, "rank_range")
    return ranked.withColumn("rank", F.expr("rank_before + rank_within")).drop("rank_range", "rank_before", "rank_within")
