"""Histograms of sessions."""

from pyspark.sql import DataFrame, functions as F

from footfall.functions.columns import ratio
from footfall.schemas import STEP_BUCKETS, VISIT_BUCKETS


def session_agg_stat(sessions: DataFrame, task_id: int) -> DataFrame:
    """One row: the number of sessions and the share of each duration and step bucket.

    A single global aggregation; each task sends one partial row. Without sessions
    the count is 0 and the ratios are null.
    """
    buckets = {
        f"{column}_{suffix}": _within(column, low, high)
        for column, table in (("visit_length", VISIT_BUCKETS), ("step_length", STEP_BUCKETS))
        for suffix, low, high in table
    }
    counts = ", ".join(f"count_if({test}) as {name}" for name, test in buckets.items())
    ratios = ", ".join(f"{ratio(name, 'session_count')} as {name}_ratio" for name in buckets)
    return sessions.sparkSession.sql(
        f"""
        select {task_id}L as task_id, session_count, {ratios}
        from (select count(*) as session_count, {counts} from {{sessions}})""",
        sessions=sessions,
    )


def _within(column: str, low: int, high: int | None) -> str:
    return f"{column} >= {low}" if high is None else f"{column} between {low} and {high}"


def session_hour_count(sessions: DataFrame) -> DataFrame:
    """Number of sessions per day and hour of their start."""
    hour = F.translate(F.substring("start_time", 1, 13), " ", "_")
    return sessions.groupBy(hour.alias("date_hour")).agg(F.count(F.lit(1)).alias("session_count"))
