"""Category counts and rankings."""

from pyspark.sql import DataFrame, functions as F

from footfall.functions.columns import id_list
from footfall.operators.sampling import session_detail
from footfall.operators.ranking import rank_all
from footfall.operators.skew import top_per_group

TOP = 10

KINDS = ("click", "order", "pay")


def category_touches(actions: DataFrame, kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """One row (session_id, category_id, kind) per category an action names.

    An action may name several categories, each as often as it lists them. Parts
    of a list that are no numbers are ignored.
    """
    lists = {
        "click": "array(click_category_id)",
        "order": id_list("order_category_ids"),
        "pay": id_list("pay_category_ids"),
    }
    given = {
        "click": "click_category_id is not null",
        "order": "order_category_ids is not null",
        "pay": "pay_category_ids is not null",
    }
    # The position in the joined list tells which of the lists an id comes from.
    tests = [
        f"when pos < {' + '.join(f'size({k}_ids)' for k in kinds[: i + 1])} then '{kind}'"
        for i, kind in enumerate(kinds)
    ]
    return actions.sparkSession.sql(
        f"""
        select session_id, category_id, case {' '.join(tests)} end as kind
        from (
          select *, posexplode(concat({', '.join(f'{k}_ids' for k in kinds)})) as (pos, category_id)
          from (
            select session_id, {', '.join(f'coalesce({lists[k]}, array()) as {k}_ids' for k in kinds)}
            from {{actions}} where {' or '.join(given[k] for k in kinds)}))
        where category_id is not null""",
        actions=actions,
    )


def category_counts(
    actions: DataFrame, sessions: DataFrame, kinds: tuple[str, ...] = KINDS
) -> DataFrame:
    """Clicks, orders and payments per category over the actions of `sessions`.

    Counts are first summed per session and category, so that a session with very
    many actions is a few rows by the time it meets the session list; both sides
    may be large, so that join is left to Spark.
    """
    counted = ", ".join(f"count_if(kind = '{k}') as {k}_count" for k in kinds)
    summed = ", ".join(f"sum({k}_count) as {k}_count" for k in kinds)
    return actions.sparkSession.sql(
        f"""
        select category_id, {summed}
        from (select session_id, category_id, {counted} from {{touches}} group by session_id, category_id)
        left semi join {{sessions}} using (session_id)
        group by category_id""",
        touches=category_touches(actions, kinds),
        sessions=sessions,
    )


def rank_categories(counts: DataFrame) -> DataFrame:
    """All categories with their position in the order of `top_categories`."""
    return rank_all(counts, [F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), F.asc("category_id")])


def top_categories(counts: DataFrame, task_id: int, k: int = TOP) -> DataFrame:
    """The k categories with most clicks, then orders, then payments; lowest id on ties."""
    return (
        counts.orderBy(
            F.desc("click_count"), F.desc("order_count"), F.desc("pay_count"), "category_id"
        )
        .limit(k)
        .selectExpr(f"{task_id}L as task_id", "category_id", "click_count", "order_count", "pay_count")
    )


def top_category_sessions(
    actions: DataFrame, top: DataFrame, task_id: int, k: int = TOP
) -> DataFrame:
    """For each category of `top` (a list of at most k rows) its k sessions with most clicks."""
    touched = actions.select("session_id", F.col("click_category_id").alias("category_id"))
    clicks = (
        touched.join(F.broadcast(top.select("category_id").limit(k)), "category_id", "left_semi")
        .groupBy("category_id", "session_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )
    ranked = top_per_group(clicks, ["category_id"], [F.desc("click_count"), F.col("session_id")], k)
    return ranked.selectExpr(f"{task_id}L as task_id", "category_id", "session_id", "click_count")


def top_session_detail(actions: DataFrame, top_sessions: DataFrame, task_id: int) -> DataFrame:
    """All action rows of the sessions ranked by `top_category_sessions`."""
    return session_detail(actions, top_sessions, task_id)
