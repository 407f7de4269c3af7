"""Building blocks that keep one hot key from landing in one task."""

from pyspark.sql import Column, DataFrame, Window, functions as F

# Spark prunes to k rows per group ahead of the shuffle up to this setting's k.
GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
# Sub-groups per group in the two-step form used above it.
SUB_GROUPS = 512


def with_group_values(rows: DataFrame, key: str, values: list[Column]) -> DataFrame:
    """Attach aggregates over each group of `key` to every row of the group.

    A window over `key` would sort a whole group in one task. Here the groups are
    pre-aggregated and joined back. While the groups are few they are broadcast and
    the rows stay where they are. Beyond that both sides are shuffled, and adaptive
    execution cuts the rows of a hot key into several tasks; it can do so because
    the null-safe key gives the groups a shuffle of their own for this join.
    """
    groups = rows.groupBy(F.col(key).alias("_key")).agg(*values)
    return rows.join(groups, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group, with their position in `rank`.

    Up to the session's GROUP_LIMIT Spark keeps k rows per group in each map task
    already. For a larger k the groups are first cut into sub-groups, so that no task
    sorts a whole group. The rows are the same.
    """
    if k > int(rows.sparkSession.conf.get(GROUP_LIMIT)):
        sub = [*group, F.pmod(F.xxhash64(*rows.columns), F.lit(SUB_GROUPS))]
        rows = (
            rows.withColumn("rank", F.row_number().over(Window.partitionBy(*sub).orderBy(*order)))
            .where(F.col("rank") <= k)
            .drop("rank")
        )
    position = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn("rank", position).where(F.col("rank") <= k)
