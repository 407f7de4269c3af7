"""The session histogram of every task of the task table in one pass over the sessions.

Sessions meet tasks one condition at a time, never as pairs of a session and a task. A
filter is a list of conditions (CONDITIONS); tasks of the same conditions share one, and
filters that begin with the same conditions share these as a node of a tree. Rows of
sessions go down that tree: at each step a row goes to those children of its node whose
condition it meets, loses the value that the condition looked at, and rows that have
become alike are summed. So what is kept are sums for a node and the values that later
conditions look at, and in the end one row for each filter.

Conditions that a session meets few of come first, and those that rows multiply at come
last, when most values are gone: the order goes by what the given sessions meet.
"""

from pyspark.sql import Column, DataFrame, functions as F

from footfall.conf import materialize, shuffles_dropped
from footfall.functions.columns import ratio
from footfall.operators.states import session_spans, sessions_of
from footfall.operators.stats import _within
from footfall.schemas import STEP_BUCKETS, VISIT_BUCKETS

#: A step of the tree with so many nodes and entries goes to all tasks; a larger one is joined by shuffles.
FEW = 100_000
#: Rows are summed before and after a step at which a row is expected to become so many.
GROWTH = 2.0

#: Conditions that are met by a common entry: the value of a session each looks at, and the entries of value and condition.
SETS = {
    "professionals": ("professional", "split(professional, ',')", "professionals"), "cities": ("city", "split(city, ',')", "cities"),
    "sex": ("sex", "array(sex)", "array(sex)"), "keywords": ("search_keywords", "split(search_keywords, ',')", "keywords"),
    "category_ids": ("click_category_ids", "split(click_category_ids, ',')", "category_ids"),
}
#: Conditions that are bounds, the values each looks at, and when a session meets one.
BOUNDS = {
    "start_date": (("after", "since"), "case when start_date is null then after is null else since >= start_date and (after is null or after < start_date) end"),
    "end_date": (("until", "before"), "case when end_date is null then before is null else until <= end_date and (before is null or before > end_date) end"),
    "low_age": (("age",), "low_age is null or age >= low_age"),
    "high_age": (("age",), "high_age is null or age <= high_age"),
}
CONDITIONS = [*SETS, *BOUNDS]
#: What conditions look at.
VALUES = ["after", "since", "until", "before", "age", "professional", "city", "sex", "search_keywords", "click_category_ids"]
_BUCKETS = [
    (f"{column}_{suffix}", _within(column, low, high))
    for column, table in (("visit_length", VISIT_BUCKETS), ("step_length", STEP_BUCKETS))
    for suffix, low, high in table
]
_SUMS = ["session_count", *[name for name, _ in _BUCKETS]]


def task_filters(params: DataFrame) -> DataFrame:
    """task_id and conditions in comparable form; null where the task does not restrict."""
    lists = {c: f"array_sort(array_distinct(split({c}, ',')))" for c in ("professionals", "cities", "keywords", "category_ids")}
    both = "start_age is not null and end_age is not null"
    return params.selectExpr(
        "task_id", "start_date", "end_date", f"case when {both} then cast(start_age as int) end as low_age",
        f"case when {both} then cast(end_age as int) end as high_age", "sex", *[f"{sql} as {c}" for c, sql in lists.items()],
    )


def session_profiles(states: DataFrame, users: DataFrame) -> DataFrame:
    """What filters look at, with the number of sessions and of those in each bucket."""
    sessions = sessions_of(session_spans(states)).join(users.select("user_id", "age", "professional", "city", "sex"), "user_id")
    sums = [F.expr(f"count_if({test})").alias(name) for name, test in _BUCKETS]
    return sessions.groupBy(*VALUES).agg(F.count(F.lit(1)).alias("session_count"), *sums)


def _nodes(order: list[str]) -> list[Column]:
    """The nodes that a filter goes through: the root, then one for each condition of `order`, hashed with 128 bits."""
    nodes = [F.lit(b"")]
    for condition in order:
        nodes.append(F.unhex(F.md5(F.concat(nodes[-1], F.to_json(F.struct(condition)).cast("binary")))))
    return nodes


def _entries(sql: str, none: str) -> str:
    """SQL for the entries to join on: '=' before each, and '' for no restriction where `none` holds."""
    given = f"transform(array_distinct(array_compact(coalesce({sql}, array()))), e -> '=' || e)"
    return f"concat({given}, if({none}, array(''), array()))"


def _growth(profiles: DataFrame, filters: DataFrame) -> dict[str, float]:
    """For each condition, how many rows a row is about expected to become where the tree has all conditions at each node."""
    values = ", ".join(f"struct('{c}' as field, {_entries(value, 'true')} as entries)" for c, (_, value, _) in SETS.items())
    often = profiles.selectExpr("session_count", f"inline(array({values}))").selectExpr("session_count", "field", "explode(entries) as entry")
    often = often.groupBy("field", "entry").agg(F.sum("session_count").alias("often"))
    given = ", ".join(f"struct('{c}' as field, {_entries(wanted, f'{c} is null')} as entries)" for c, (_, _, wanted) in SETS.items())
    lists = filters.selectExpr(f"inline(array({given}))").distinct().selectExpr("field", "explode(entries) as entry").groupBy("field", "entry").count()
    total = profiles.agg(F.sum("session_count")).first()[0] or 1
    met = often.join(lists, ["field", "entry"]).groupBy("field").agg(F.sum(F.col("often").cast("double") * F.col("count")).alias("met"))
    growth = dict.fromkeys(SETS, 0.0) | {r.field: r.met / total for r in met.collect()}
    # About half of the bounds are met.
    seen = filters.agg(*[F.approx_count_distinct(c).alias(c) for c in BOUNDS], *[F.count_if(F.col(c).isNull()).alias(f"{c}_none") for c in BOUNDS]).first()
    return growth | {c: (seen[c] + 1) / 2 + (seen[f"{c}_none"] > 0) for c in BOUNDS}


def _few(rows: DataFrame, n: int) -> DataFrame:
    return F.broadcast(rows) if n <= FEW else rows


def _summed(rows: DataFrame) -> DataFrame:
    """Rows of the same node and values as one."""
    keys = [c for c in rows.columns if c not in _SUMS]
    return rows.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in _SUMS])


def _sizes(filters: DataFrame, nodes: list[Column], order: list[str]) -> dict[str, float]:
    """About how much each step holds: its nodes, times the entries of a list, each of which comes with the list."""
    lists = {c: F.expr(f"avg(pow(coalesce(size({wanted}), 1), 2))") for c, (_, _, wanted) in SETS.items()}
    found = filters.agg(*[F.approx_count_distinct(n).alias(c) for n, c in zip(nodes[1:], order)], *[sql.alias(f"{c}_list") for c, sql in lists.items()]).first()
    return {c: found[c] * ((found[f"{c}_list"] or 1) if c in SETS else 1) for c in order}


def filter_counts(profiles: DataFrame, filters: DataFrame) -> tuple[DataFrame, list[str]]:
    """node and sums of each filter that a session meets, and the order of conditions that nodes go by."""
    growth = _growth(profiles, filters)
    order = sorted(CONDITIONS, key=lambda c: growth[c])
    nodes = _nodes(order)
    sizes = _sizes(filters, nodes, order)
    rows = profiles.withColumn("node", nodes[0])
    for at, condition in enumerate(order):
        left = {value for c in order[at + 1 :] for value in (BOUNDS[c][0] if c in BOUNDS else SETS[c][:1])}
        kept = [c for c in VALUES if c in left]
        steps = filters.select(nodes[at].alias("_node"), nodes[at + 1].alias("_child"), condition).distinct()
        if condition in SETS:
            _, value, wanted = SETS[condition]
            steps = steps.selectExpr("_node", "_child", f"{_entries(wanted, f'{condition} is null')} as _wanted").selectExpr("*", "explode(_wanted) as _entry")
            rows = rows.selectExpr("node", *kept, *_SUMS, f"{_entries(value, 'true')} as _entries").selectExpr("*", "explode(_entries) as entry")
            # Of several common entries the least one counts.
            test = "entry = _entry and (size(_wanted) = 1 or array_min(array_intersect(_entries, _wanted)) = entry)"
        else:
            test = BOUNDS[condition][1]
        rows = rows.join(_few(steps, sizes[condition]), (F.col("node") == F.col("_node")) & F.expr(test))
        rows = rows.select(F.col("_child").alias("node"), *kept, *_SUMS)
        if max(growth[c] for c in order[at : at + 2]) >= GROWTH or at + 1 == len(order):
            rows = _summed(rows)
    return rows, order


def all_tasks_stat(params: DataFrame, states: DataFrame, users: DataFrame) -> DataFrame:
    """`session_agg_stat` of each task of `task_params`, over daily session states.

    A task whose filter no session meets has the count 0 and null ratios.
    """
    spark = states.sparkSession
    with shuffles_dropped(spark):
        tasks = materialize(task_filters(params), "task-filters")
        filters = materialize(tasks.select(*CONDITIONS).distinct(), "filters")
        profiles = materialize(session_profiles(states, users), "session-profiles")
    counts, order = filter_counts(profiles, filters)
    given = tasks.select("task_id", _nodes(order)[-1].alias("node"))
    counts = given.join(counts, "node", "left").select("task_id", *[F.coalesce(n, F.lit(0)).alias(n) for n in _SUMS])
    ratios = ", ".join(f"{ratio(name, 'session_count')} as {name}_ratio" for name, _ in _BUCKETS)
    return spark.sql(f"select task_id, session_count, {ratios} from {{counts}}", counts=counts)
