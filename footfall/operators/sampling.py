"""Time-proportional random sample of sessions and their detail rows."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from footfall.conf import materialize
from footfall.operators.skew import top_per_group
from footfall.operators.stats import session_hour_count
from footfall.schemas import DETAIL_COLUMNS

SAMPLE_SIZE = 100

#: A drawn session; the first two fields are the order of drawing.
DRAWN = ["draw", "session_id", "start_time", "end_time", "search_keywords", "click_category_ids"]
HEAP_SCHEMA = f"date string, hour string, task int, seen bigint, kept array<struct<{', '.join(f'{c}: string' for c in DRAWN)}>>"
#: Heaps that are put together at once, so an array has at most this times `n` sessions.
FAN_IN = 64
#: Rows that a task takes in before it drops those that no heap keeps.
ROWS_BETWEEN_CUTS = 50_000


def extract_quota(sessions: DataFrame, n: int = SAMPLE_SIZE) -> DataFrame:
    """Sessions to draw per day and hour.

    `n` is divided evenly over the days (whole number), then over the hours of a
    day in proportion to their sessions (rounded down).

    The window runs on the counts of a day, which are at most 24.
    """
    hours = session_hour_count(sessions).selectExpr(
        "substring_index(date_hour, '_', 1) as date", "substring_index(date_hour, '_', -1) as hour", "session_count"
    )
    return _quota(hours, n)


def _quota(hours: DataFrame, n: int) -> DataFrame:
    return hours.sparkSession.sql(
        f"""
        select date, hour, session_count,
          least(floor(cast(session_count as double) / cast(day_count as double)
            * ({n} div (select count(distinct date) from {{hours}}))), session_count) as quota
        from (select *, sum(session_count) over (partition by date) as day_count from {{hours}})""",
        hours=hours,
    )


def random_extract_session(
    sessions: DataFrame, task_id: int, n: int = SAMPLE_SIZE, seed: int = 42
) -> DataFrame:
    """Draw each day-hour's quota of sessions, uniformly and reproducibly.

    Sessions are ranked by a seeded hash. No quota is above `n`, so at most `n`
    sessions per day-hour are kept before the quota is joined. `sessions` is read
    twice, so it had better be a table than a computation.
    """
    drawn = _drawn(sessions, seed)
    ranked = top_per_group(drawn, ["date", "hour"], [F.col("draw"), F.col("session_id")], n)
    return sessions.sparkSession.sql(
        f"""
        select {task_id}L as task_id, session_id, start_time, end_time, search_keywords, click_category_ids
        from {{ranked}} join {{quota}} using (date, hour) where rank <= quota""",
        ranked=ranked,
        quota=extract_quota(sessions, n),
    )


def _drawn(sessions: DataFrame, seed: int) -> DataFrame:
    return sessions.selectExpr(
        "session_id", "start_time", "end_time", "search_keywords", "click_category_ids",
        "left(start_time, 10) as date", "substr(start_time, 12, 2) as hour",
        f"md5(concat('{seed}_', session_id)) as draw",
    )


def sample_heaps(sessions: DataFrame, n: int = SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """One state for each day and hour: `seen`, its sessions, and `kept`, the `n` of smallest draw.

    Each task makes one pass over its sessions and keeps `n` of them for each day-hour it
    meets. Heaps are then put together FAN_IN at a time, so neither a task nor an
    array grows with the sessions of an hour or with the number of tasks. States of the
    same `n` and seed merge again by `merge_heaps`.
    """
    rows = _drawn(sessions, seed).withColumn("task", F.spark_partition_id())
    return merge_heaps(rows.mapInPandas(lambda frames: _heaps(frames, n), HEAP_SCHEMA), n)


def merge_heaps(states: DataFrame, n: int) -> DataFrame:
    """States of the same day-hour as one: counts added, the `n` smallest of all draws kept."""
    smallest = F.expr(f"slice(array_sort(flatten(collect_list(kept))), 1, {n})").alias("kept")
    for last in (False, False, True):
        near = F.lit(0) if last else F.expr(f"task div {FAN_IN}")
        states = states.groupBy("date", "hour", near.cast("int").alias("task")).agg(F.sum("seen").alias("seen"), smallest)
    return states


def _heaps(frames: Iterator[pd.DataFrame], n: int) -> Iterator[pd.DataFrame]:
    """The heaps of one task; its memory is `n` sessions for each day-hour it meets."""
    kept, waiting, seen, task = None, [], {}, 0
    for frame in frames:
        if frame.empty:
            continue
        task = int(frame["task"].iloc[0])
        for group, size in frame.groupby(["date", "hour"], dropna=False).size().items():
            seen[group] = seen.get(group, 0) + size
        waiting.append(frame)
        if sum(map(len, waiting)) > max(ROWS_BETWEEN_CUTS, 0 if kept is None else len(kept)):
            kept, waiting = _smallest(kept, waiting, n), []
    if not seen:
        return
    kept = _smallest(kept, waiting, n)
    for group, rows in kept.groupby(["date", "hour"], dropna=False):
        state = {"date": group[0], "hour": group[1], "task": task, "seen": seen[group], "kept": [rows[DRAWN].to_dict("records")]}
        yield pd.DataFrame(state)


def _smallest(kept: pd.DataFrame | None, waiting: list[pd.DataFrame], n: int) -> pd.DataFrame:
    rows = pd.concat(([] if kept is None else [kept]) + waiting)
    return rows.sort_values(["draw", "session_id"]).groupby(["date", "hour"], dropna=False).head(n)


def extract_in_one_pass(sessions: DataFrame, task_id: int, n: int = SAMPLE_SIZE, seed: int = 42) -> DataFrame:
    """The rows of `random_extract_session`, with `sessions` computed once and not stored.

    What is stored are the heaps, at most `n` sessions for each day-hour, as the quotas
    need all counts before the first session is taken. Sessions without a start time
    are not drawn.
    """
    heaps = materialize(sample_heaps(sessions.where("start_time is not null"), n, seed), "sample-heaps")
    quota = _quota(heaps.selectExpr("date", "hour", "seen as session_count"), n).select("date", "hour", "quota")
    taken = heaps.join(quota, ["date", "hour"]).selectExpr("explode(slice(kept, 1, int(quota))) as s")
    return taken.selectExpr(f"{task_id}L as task_id", *[f"s.{c}" for c in DRAWN[1:]])


def session_detail(actions: DataFrame, ids: DataFrame, task_id: int) -> DataFrame:
    """All action rows of the sessions in `ids`. Spark broadcasts the list if it measures small."""
    return actions.join(ids.select("session_id"), "session_id", "left_semi").selectExpr(
        f"{task_id}L as task_id", *DETAIL_COLUMNS
    )
