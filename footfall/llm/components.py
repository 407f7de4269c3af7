"""Connected components of a graph by alternating stars."""

from pyspark.sql import DataFrame, functions as F

from footfall.conf import materialize
from footfall.llm.session import tasks_for


def connected_components(edges: DataFrame) -> DataFrame:
    """id, label for every end of `edges` (a, b): label is the least id of its component.

    Each round hangs the greater neighbours of a node below its least neighbour, then its
    lesser ones; the rounds needed grow with the logarithm of the nodes. A round is
    written to the shared folder. Edges of a node with many are aggregated by partial
    minima, and the join on them may be split.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = materialize(now, "edges"), None
    while (seen := now.agg(F.count(F.lit(1)), F.expr("sum(xxhash64(a, b) % 1000000007)")).first()) != before:
        before, tasks = seen, tasks_for(2 * seen[0])
        both = now.union(now.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).coalesce(tasks)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").coalesce(tasks)
        small = hung.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(hung.select("a", "m"))
        now = materialize(small.distinct().coalesce(tasks), "edges")
    return now.select(F.col("a").alias("id"), F.col("b").alias("label")).union(now.select("b", "b").distinct())
