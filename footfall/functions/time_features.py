"""Time columns of an action table."""

import datetime

from pyspark.sql import DataFrame, functions as F

from footfall.functions.columns import (
    format_date, format_time, is_after, is_before, parse_date_key, parse_time, seconds_between,
)
from footfall.operators.skew import with_group_values


def time_feature_job(actions: DataFrame, run_date: datetime.date) -> DataFrame:
    """Calendar keys of each action, its distance from the session start, and the run date.

    Keys are cut from the text of the time, which no time zone can shift.
    """
    rows = actions.select("session_id", "action_time", parse_time("action_time").alias("at"))
    started = with_group_values(rows, "session_id", [F.min("at").alias("started_at")])
    noon = F.concat(F.left("time", F.lit(10)), F.lit(" 12:00:00")).cast("timestamp_ntz")
    started = started.withColumn("time", format_time("at")).withColumn("noon", noon)
    date_key = F.replace(F.left("time", F.lit(10)), F.lit("-"), F.lit(""))
    day = F.lit(run_date)
    return started.select(
        "session_id",
        "action_time",
        F.translate(F.left("time", F.lit(13)), " ", "_").alias("date_hour"),
        date_key.alias("date_key"),
        F.translate(F.left("time", F.lit(16)), "- :", "").alias("minute_key"),
        F.col("time").alias("full_time"),
        parse_date_key(date_key).alias("day"),
        is_after(F.col("at"), F.col("started_at")).alias("is_after_start"),
        seconds_between(F.col("at"), F.col("started_at")).alias("secs_since_session_start"),
        is_before(F.col("at"), F.col("noon")).alias("is_before_noon"),
        format_date(day).alias("run_date"),
        format_date(F.date_sub(day, 1)).alias("prev_date"),
    )
