"""Conversion from one page of a flow to the next."""

from pyspark.sql import DataFrame, Window, functions as F

from footfall.functions.columns import parse_time


def page_convert_rate(actions: DataFrame, flow: str) -> DataFrame:
    """For each step of the flow "p1,p2,...": views of the first page, moves, and their ratio.

    A move is a pair of consecutive actions of one session in order of
    (action_time, page_id). A session with an unreadable time is left out.

    Equal (time, page) rows of a session are counted before anything is ordered,
    and a session is ordered hour by hour; the moves from one hour to the next are
    added from the last and first page of the hours. So no task orders a whole
    session.
    """
    pages = [int(p) for p in flow.split(",")]
    steps = list(zip(pages, pages[1:]))
    by_hour = Window.partitionBy("session_id", "hour").orderBy("acted", "page_id")
    rows = (
        actions.select("session_id", "page_id", parse_time("action_time").alias("acted"))
        .groupBy("session_id", "acted", "page_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("hour", F.left(F.col("acted").cast("string"), F.lit(13)))
        .withColumn("next_page", F.lead("page_id").over(by_hour))
    )
    # One row per session and hour: sums for each step, and the pages at both ends.
    sums = [F.expr(f"sum(if(page_id = {a}, n, 0)) as views_{i}") for i, (a, b) in enumerate(steps)]
    sums += [F.expr(f"sum({_moves(a, b)}) as moves_{i}") for i, (a, b) in enumerate(steps)]
    hours = rows.groupBy("session_id", "hour").agg(
        *sums,
        F.expr("min_by(page_id, (acted, page_id)) as first_page"),
        F.expr("max_by(page_id, (acted, page_id)) as last_page"),
    )
    following = Window.partitionBy("session_id").orderBy("hour")
    unreadable = F.max(F.col("hour").isNull()).over(Window.partitionBy("session_id"))
    readable = hours.withColumn("unreadable", unreadable).where("not unreadable")
    totals = readable.withColumn("next_first", F.lead("first_page").over(following)).agg(
        *[F.expr(f"coalesce(sum(views_{i}), 0) as views_{i}") for i in range(len(steps))],
        *[
            F.expr(f"coalesce(sum(moves_{i} + int(last_page <=> {a} and next_first <=> {b})), 0) as moves_{i}")
            for i, (a, b) in enumerate(steps)
        ],
    )
    lines = [
        f"named_struct('page_from', {a}L, 'page_to', {b}L, 'views', views_{i}, 'moves', moves_{i})"
        for i, (a, b) in enumerate(steps)
    ]
    return totals.selectExpr(f"inline(array({', '.join(lines)}))").withColumn(
        "rate", F.expr("moves / nullif(views, 0)")
    )


def _moves(a: int, b: int) -> str:
    """SQL for the moves from page a to page b that begin at one counted row."""
    move = f"int(page_id <=> {a} and next_page <=> {b})"
    # n equal rows are also n - 1 moves from the page to itself.
    return f"{move} + if(page_id = {a}, n - 1, 0)" if a == b else move


def page_funnel(actions: DataFrame, flow: str) -> DataFrame:
    """For each step of the flow "p1,p2,...": sessions that saw its pages up to that step in order.

    Other pages may lie between. `rate` is the share of the sessions of the step before
    (null for the first step, or if there are none). Rows are in order of (action_time,
    page_id); a session with an unreadable time is left out, and so are rows without
    a session.

    A piece of a session is a function from the steps done before it to the steps done
    after it, an array of a few numbers. Such functions compose in any grouping, here
    hours into days into sessions. Equal rows are counted first, so an hour has at most
    one row for each second and page of the flow, and no task holds a whole session.
    """
    pages = [int(p) for p in flow.split(",")]
    steps = len(pages)
    listed = ", ".join(f"{p}L" for p in pages)
    rows = (
        actions.where("session_id is not null")
        .select("session_id", "page_id", parse_time("action_time").alias("acted"))
        .where(f"acted is null or page_id in ({listed})")
        .groupBy("session_id", "acted", "page_id")
        .agg(F.expr(f"int(least(count(*), {steps})) as n"))  # more repeats than steps do no more
        .withColumn("hour", F.left(F.col("acted").cast("string"), F.lit(13)))
    )
    unreadable = F.expr("bool_or(unreadable) as unreadable")
    start = f"sequence(0, {steps})"
    once = f"(t, i) -> if(get(array({listed}), t) <=> x.page_id, t + 1, t)"
    hours = rows.groupBy("session_id", "hour").agg(
        F.expr(
            f"""aggregate(array_sort(collect_list(struct(acted, page_id, n))), {start},
              (f, x) -> transform(f, s -> aggregate(sequence(1, x.n), s, {once}))) as moved"""
        ),
        F.expr("bool_or(acted is null) as unreadable"),
    )
    composed = f"""aggregate(array_sort(collect_list(struct(hour, moved))), {start},
      (f, x) -> transform(f, s -> x.moved[s])) as moved"""
    days = hours.groupBy("session_id", F.left("hour", F.lit(10)).alias("day")).agg(F.expr(composed), unreadable)
    sessions = days.withColumnRenamed("day", "hour").groupBy("session_id").agg(F.expr(composed), unreadable)
    totals = sessions.where("not unreadable").agg(*[F.expr(f"count_if(moved[0] >= {i}) as s{i}") for i in range(1, steps + 1)])
    lines = [
        f"named_struct('step', {i}L, 'page_id', {p}L, 'sessions', s{i}, 'rate', {f's{i} / nullif(s{i - 1}, 0)' if i > 1 else 'double(null)'})"
        for i, p in enumerate(pages, 1)
    ]
    return totals.selectExpr(f"inline(array({', '.join(lines)}))")
