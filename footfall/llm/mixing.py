"""Mixing sources to target weights by weighted fair queueing.

The documents of a source are shuffled into a queue, as many times over as its target
may need. Each gets a virtual finish time, the words of its source up to and with it
over the source's target. All queues are emptied together in order of that time until
the budget is used up, so every source is served in proportion to its target.

A null text has no words; a document without words is never taken. Null is a source of
its own. Rows equal in doc_id, source and text are the same document several times; each
has its own place in the queue, and which of them is which does not matter. Columns other
than doc_id, source and text play no part.
"""

from pyspark.sql import DataFrame, Window, functions as F

from footfall.conf import materialize
from footfall.llm.session import carries_columns

WEIGHTS = (5.0, 2.0, 1.0)
BUDGET = 1.5
PASSES = 2
ROWS_PER_BUCKET = 2_000
WORD = r"[^\x20\x09-\x0D]+"

#: Names a document by doc_id, source and text.
ENTRY = "md5(concat_ws('|', coalesce(cast(doc_id as string), '-'), md5(text), source))"


def source_targets(
    sources: DataFrame, budget: float = BUDGET, weights: tuple[float, ...] = WEIGHTS, passes: int = PASSES
) -> DataFrame:
    """sid, source, source_size, source_rows, target for each row of `sources`.

    A target is the source's share of `budget` x all sizes by weight; weights repeat
    over the sources in order of code points, null last. It stops at `passes` times the
    source's size, and what it leaves is shared again by weight. Taken in order of
    limit over weight, the sources that stop are the first ones: one stops if its share
    of what the ones before it leave is more than its limit. The level of the first one
    that does not stop, the highest of theirs, holds for all of them. The windows run
    over one row for each source.
    """
    weight = ", ".join(f"{w}D" for w in weights)
    return sources.sparkSession.sql(
        f"""
        with weighed as (
          select *, element_at(array({weight}), cast((sid - 1) % {len(weights)} + 1 as int)) as weight,
            {float(passes)}D * source_size as most
          from (select *, row_number() over (order by source is null, encode(source, 'UTF-8')) as sid from {{sources}})),
        shared as (
          select *, ({budget}D * sum(source_size) over () - coalesce(sum(most) over (order by most / weight, sid
              rows between unbounded preceding and 1 preceding), 0D))
            / sum(weight) over (order by most / weight, sid rows between current row and unbounded following) as level
          from weighed)
        select sid, source, source_size, source_rows,
          if(level * weight > most, most, weight * max(if(level * weight > most, null, level)) over ()) as target
        from shared""",
        sources=sources,
    )


def queue_entries(docs: DataFrame) -> DataFrame:
    """entry, doc_id, source, size of each document: names and words, no text."""
    return docs.selectExpr(
        f"{ENTRY} as entry", "doc_id", "source", f"cast(coalesce(regexp_count(text, r'{WORD}'), 0) as bigint) as size"
    )


def _finish_times(entries: DataFrame, targets: DataFrame, passes: int, seed: int) -> DataFrame:
    """entry, nth, pass, sid, size, finish for each time a document may be taken.

    A source is cut into buckets of about ROWS_PER_BUCKET rows by place in the queue;
    sums run over the buckets and then within each.
    """
    queued = entries.sparkSession.sql(
        f"""
        select *, cast(floor(place * ceil(source_rows / {ROWS_PER_BUCKET})) as bigint) as bucket
        from (
          select *, pass + cast(conv(left(md5(concat_ws('/', entry, nth, pass, {seed})), 13), 16, 10) as bigint)
            / 4503599627370496D as place
          from (
            select e.entry, e.size, e.nth, t.sid, t.target, t.source_rows,
              explode(filter(sequence(0, {passes - 1}), p -> p * t.source_size < t.target)) as pass
            from (select *, explode(sequence(1L, rows)) as nth from {{entries}} where size > 0) e
            join {{targets}} t on e.source <=> t.source))""",
        entries=entries,
        targets=targets,
    )
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = queued.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    buckets = buckets.select("sid", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
    in_order = Window.partitionBy("sid", "bucket").orderBy("place", "entry", "nth")
    served = F.col("before") + F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    return queued.join(buckets, ["sid", "bucket"]).select(
        "entry", "nth", "pass", "sid", "size", (served / F.col("target")).alias("finish")
    )


def _truncate(timed: DataFrame, words: float, rows: int) -> DataFrame:
    """The rows of `timed` that come first and have at most `words` words together.

    Rows are counted in ranges of finish time first; only the one range in which the
    budget ends is put in order.
    """
    ranges = max(1, rows // ROWS_PER_BUCKET)
    ranged = timed.withColumn("range", F.floor(F.least("finish", F.lit(2.0)) * ranges))
    up_to = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    sums = ranged.groupBy("range").agg(F.sum("size").alias("words")).withColumn("total", F.sum("words").over(up_to))
    last = sums.where(F.col("total") > words).orderBy("range").first()
    if last is None:
        return timed
    in_order = Window.partitionBy("range").orderBy("finish", "sid", "entry", "nth", "pass")
    total = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0)) + (last["total"] - last["words"])
    cut = ranged.where(F.col("range") == last["range"]).withColumn("total", total).where(F.col("total") <= words)
    return ranged.where(F.col("range") < last["range"]).select(*timed.columns).union(cut.select(*timed.columns))


def fair_queue(
    docs: DataFrame, budget: float = BUDGET, weights: tuple[float, ...] = WEIGHTS, passes: int = PASSES,
    seed: int = 42,
) -> DataFrame:
    """entry, doc_id, source, size, source_size, target, rows, served.

    One row for each different document (by doc_id, source and text), which occurs in
    `rows` rows of `docs`, and which the mix takes `served` times in all.
    """
    entries = queue_entries(docs).groupBy("entry", "doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    entries = materialize(entries, "mixing-entries")
    sources = entries.groupBy("source").agg(
        F.sum(F.col("size") * F.col("rows")).alias("source_size"), F.sum("rows").alias("source_rows")
    )
    targets = materialize(source_targets(sources, budget, weights, passes), "mixing-targets")
    timed = materialize(_finish_times(entries, targets, passes, seed), "mixing-queue")
    whole = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("source_rows"), F.lit(0))).first()
    taken = _truncate(timed, budget * whole[0], whole[1]).groupBy("entry").agg(F.count(F.lit(1)).alias("served"))
    return docs.sparkSession.sql(
        """
        select e.entry, e.doc_id, e.source, e.size, t.source_size, coalesce(t.target, 0D) as target, e.rows,
          coalesce(k.served, 0) as served
        from {entries} e left join {taken} k on e.entry = k.entry join {targets} t on e.source <=> t.source""",
        entries=entries,
        taken=taken,
        targets=targets,
    )


COPIES = "cast(served div rows + if(nth <= served % rows, 1, 0) as int)"


def mix_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, copies, taken for each row of `docs`."""
    return fair_queue(docs, **options).selectExpr("*", "explode(sequence(1L, rows)) as nth").selectExpr(
        "doc_id", "size", "source_size", "target", f"{COPIES} as copies", f"size * {COPIES} as taken"
    )


@carries_columns
def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The rows of the mix: each row of `docs` as many times as it is taken, all columns kept."""
    served = fair_queue(docs, **options).where("served > 0").selectExpr("entry as _entry", "rows as _rows", "served as _served")
    named = docs.withColumn("_entry", F.expr(ENTRY)).join(served, "_entry")
    nth = F.row_number().over(Window.partitionBy("_entry").orderBy(F.lit(1)))
    copies = F.expr(COPIES.replace("rows", "_rows").replace("served", "_served").replace("nth", "_nth"))
    repeated = named.withColumn("_nth", nth).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return repeated.where("_copy > 0").select(*docs.columns)
