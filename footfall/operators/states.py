"""Mergeable daily states of sessions, in place of counting each range of dates anew.

A state holds what the actions of one session on one day contribute to the session:
sets, extremes and sums, all of which can be merged in any grouping. States are stored
by day, so one more day reads that day's actions only, and the sessions of any range of
dates come from the states of its days. A session across midnight has a state for each of
its days. Actions without a date belong to no day and are left out.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.conf import shuffles_dropped
from footfall.functions.columns import parse_time_sql
from footfall.schemas import NOT_FOUND
from footfall.sources.tasks import TaskParams

STATE_SCHEMA = (
    "session_id string, user_id bigint, keywords array<string>, categories array<bigint>, "
    "first_at timestamp_ntz, last_at timestamp_ntz, steps bigint, unreadable bigint, date string"
)


def daily_states(actions: DataFrame) -> DataFrame:
    """A state for each session and day; map-side combine makes a hot session small before the shuffle."""
    return actions.sparkSession.sql(
        f"""
        select session_id, min(nullif(user_id, {NOT_FOUND})) as user_id,
          sort_array(collect_set(nullif(search_keyword, ''))) as keywords,
          sort_array(collect_set(nullif(click_category_id, {NOT_FOUND}))) as categories,
          min(acted) as first_at, max(acted) as last_at, count(*) as steps, count_if(acted is null) as unreadable, date
        from (select *, {parse_time_sql("action_time")} as acted from {{actions}})
        where date is not null group by session_id, date""",
        actions=actions,
    )


def store_states(states: DataFrame, path: str) -> None:
    """Put the days of `states` into the table at `path`; other days stay as they are."""
    with shuffles_dropped(states.sparkSession):
        (
            states.hint("rebalance", "date")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("date")
            .parquet(path)
        )


def read_states(spark: SparkSession, path: str, params: TaskParams = TaskParams()) -> DataFrame:
    """Stored states of a range of dates; only the folders of its days are read."""
    names = [f.split()[0] for f in STATE_SCHEMA.split(", ")]
    states = spark.read.schema(STATE_SCHEMA).parquet(path).select(*names)
    if params.start_date:
        states = states.where(F.col("date") >= params.start_date)
    if params.end_date:
        states = states.where(F.col("date") <= params.end_date)
    return states


def merge_states(states: DataFrame, by: tuple[str, ...] = ("session_id",)) -> DataFrame:
    """States merged over all days of each session, or of other groups; the date is the first one."""
    key = ", ".join(by)
    return states.sparkSession.sql(
        f"""
        select {key}, min(user_id) as user_id,
          array_sort(array_distinct(flatten(collect_set(keywords)))) as keywords,
          array_sort(array_distinct(flatten(collect_set(categories)))) as categories,
          min(first_at) as first_at, max(last_at) as last_at, cast(sum(steps) as bigint) as steps,
          cast(sum(unreadable) as bigint) as unreadable, min(date) as date
        from {{states}} group by {key}""",
        states=states,
    )


def sessions_of(states: DataFrame) -> DataFrame:
    """The sessions that merged states stand for, as `aggregate_sessions` gives them; other columns stay."""
    rest = [c for c in states.columns if c not in {f.split()[0] for f in STATE_SCHEMA.split(", ")}]
    return states.where("unreadable = 0").selectExpr(
        "session_id", "user_id",
        "nullif(array_join(keywords, ','), '') as search_keywords",
        "nullif(array_join(cast(categories as array<string>), ','), '') as click_category_ids",
        "cast(last_at - first_at as bigint) as visit_length", "steps as step_length",
        "cast(first_at as string) as start_time", "cast(last_at as string) as end_time", *rest,
    )


def session_spans(states: DataFrame) -> DataFrame:
    """Every session over every stretch of its days, merged, with the ranges of dates it stands for.

    A range of dates that begins after `after` (null: any time before) and not later than
    `since`, and ends not before `until` and before `before` (null: any time after) has
    exactly those days of the session. A session has few days (mostly one), so few stretches:
    its days are put together once, and what `merge_states` does is done within the row.
    """
    rest = [c for c in states.columns if c not in ("session_id", "date")]
    parts = F.sort_array(F.collect_list(F.struct("date", *rest))).alias("parts")
    days = states.where("date is not null").groupBy("session_id").agg(parts)
    spans = days.selectExpr("*", "array_distinct(parts.date) as days").selectExpr("*", "explode(sequence(1, size(days))) as i")
    spans = spans.selectExpr("*", "explode(sequence(i, size(days))) as j").selectExpr(
        "session_id", "get(days, i - 2) as after", "days[i - 1] as since", "days[j - 1] as until", "get(days, j) as before",
        "filter(parts, s -> s.date between days[i - 1] and days[j - 1]) as parts",
    )
    return spans.selectExpr(
        "session_id", "after", "since", "until", "before",
        "array_min(parts.user_id) as user_id",
        "array_sort(array_distinct(flatten(array_compact(parts.keywords)))) as keywords",
        "array_sort(array_distinct(flatten(array_compact(parts.categories)))) as categories",
        "array_min(parts.first_at) as first_at", "array_max(parts.last_at) as last_at",
        "aggregate(parts.steps, 0L, (a, n) -> a + n) as steps",
        "aggregate(parts.unreadable, 0L, (a, n) -> a + n) as unreadable", "since as date",
    )
