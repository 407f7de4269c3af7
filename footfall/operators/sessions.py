"""Actions to sessions: roll-up, user attributes, filters."""

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions.columns import parse_time_sql
from footfall.schemas import NOT_FOUND
from footfall.sources.tasks import TaskParams


def aggregate_sessions(actions: DataFrame) -> DataFrame:
    """One row per session.

    A single aggregation with map-side combine: a session with any number of rows
    reaches the reduce side as one partial row per map task. Keyword and category
    lists are exact distinct sets, sorted, null when empty. A session with an
    unreadable action time is left out.
    """
    return actions.sparkSession.sql(
        f"""
        select session_id, user_id, search_keywords, click_category_ids,
          cast(last_at - first_at as bigint) as visit_length, step_length,
          cast(first_at as string) as start_time, cast(last_at as string) as end_time
        from (
          select session_id,
            min(nullif(user_id, {NOT_FOUND})) as user_id,
            {_joined("sort_array(collect_set(nullif(search_keyword, '')))")} as search_keywords,
            {_joined(f"sort_array(collect_set(nullif(click_category_id, {NOT_FOUND})))")} as click_category_ids,
            min(acted) as first_at,
            max(acted) as last_at,
            count(*) as step_length,
            count_if(acted is null) as unreadable
          from (select *, {parse_time_sql("action_time")} as acted from {{actions}})
          group by session_id)
        where unreadable = 0""",
        actions=actions,
    )


def _joined(parts: str) -> str:
    return f"nullif(array_join(cast({parts} as array<string>), ','), '')"


def join_users(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Sessions of known users with age, profession, city and sex.

    No broadcast hint: the user table grows with the data. Spark broadcasts it
    while it is below the size threshold and sort-merge joins it beyond, where
    adaptive execution splits a user with very many sessions.
    """
    return sessions.sparkSession.sql(
        "select s.*, age, professional, city, sex from {sessions} s join {users} using (user_id)",
        sessions=sessions,
        users=users,
    )


def filter_sessions(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions that satisfy every parameter the task gives.

    Parameters the task does not give add nothing to the plan. Those on user
    attributes are pushed below the join into the user scan.
    """
    for condition in _conditions(params):
        sessions = sessions.where(condition)
    return sessions


def _conditions(params: TaskParams) -> list[Column]:
    conditions = []
    if params.start_age and params.end_age:
        conditions.append(F.col("age").between(int(params.start_age), int(params.end_age)))
    if params.professionals:
        conditions.append(_overlaps("professional", params.professionals))
    if params.cities:
        conditions.append(_overlaps("city", params.cities))
    if params.sex:
        conditions.append(F.col("sex") == params.sex)
    if params.keywords:
        conditions.append(_overlaps("search_keywords", params.keywords))
    if params.category_ids:
        conditions.append(_overlaps("click_category_ids", params.category_ids))
    return conditions


def _overlaps(column: str, wanted: str) -> Column:
    """Whether two comma-separated lists share an entry."""
    values = F.array(*[F.lit(w) for w in wanted.split(",")])
    return F.coalesce(F.arrays_overlap(F.split(column, ","), values), F.lit(False))
