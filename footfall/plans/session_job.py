"""The whole session analysis of one task."""

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, types as T

from footfall.conf import remove_folder, scratch_folder
from footfall.operators import categories, pages, sampling, sessions as ops, stats
from footfall.sinks import runs
from footfall.sinks.tables import replace_task
from footfall.sources.actions import actions_in_date_range, read_actions, save_actions
from footfall.sources.tasks import TaskParams, find_task


def filtered_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions of the task: roll-up, user attributes, filters."""
    return ops.filter_sessions(ops.join_users(ops.aggregate_sessions(actions), users), params)


@contextmanager
def session_results(
    tasks: DataFrame, actions: DataFrame, users: DataFrame, task_id: int, n: int, seed: int, at_rest: bool
) -> Iterator[dict[str, DataFrame]]:
    """The result tables of one task by name, to be written within the context.

    Tables that several results need (the filtered sessions and the three id lists) are
    written once to the shared scratch folder and read from there. So are the actions,
    unless they are `at_rest` already, that is a stored table and not a computation. All
    of that goes at the end of the context, also when a result fails. Page conversion is
    a result if the task has a page flow.
    """
    params = find_task(tasks, task_id)
    spark, scratch = actions.sparkSession, []

    def new_folder(name: str) -> str:
        scratch.append(scratch_folder(spark, name))
        return scratch[-1]

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = new_folder(name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    try:
        actions = actions_in_date_range(actions, params)
        if not at_rest:
            path = new_folder("actions")
            save_actions(actions, path)
            actions = read_actions(spark, path)
        sessions = keep(filtered_sessions(actions, users, params), "sessions")
        sample = keep(sampling.random_extract_session(sessions, task_id, n, seed), "sample")
        counts = categories.category_counts(actions, sessions)
        top = keep(categories.top_categories(counts, task_id), "top-categories")
        top_sessions = keep(categories.top_category_sessions(actions, top, task_id), "top-sessions")
        # One detail table holds the rows of both lists.
        ids = sample.select("session_id").union(top_sessions.select("session_id"))
        results = {
            "session_agg_stat": stats.session_agg_stat(sessions, task_id),
            "session_random_extract": sample,
            "top10_category": top,
            "top10_category_session": top_sessions,
            "session_detail": sampling.session_detail(actions, ids, task_id),
        }
        if params.target_page_flow:
            results["page_convert_rate"] = pages.page_convert_rate(actions, params.target_page_flow)
        yield results
    finally:
        for path in scratch:
            remove_folder(spark, path)


def run_session_job(
    tasks: DataFrame, actions: DataFrame, users: DataFrame, task_id: int, output: str,
    n: int = sampling.SAMPLE_SIZE, seed: int = 42, at_rest: bool = False,
) -> dict[str, int]:
    """Replace one task's rows in the result tables under `output`; returns their row counts.

    The tables are replaced one after the other; `publish_session_job` makes them appear
    together.
    """
    with session_results(tasks, actions, users, task_id, n, seed, at_rest) as results:
        return {name: replace_task(df, f"{output}/{name}", task_id) for name, df in results.items()}


def publish_session_job(
    tasks: DataFrame, actions: DataFrame, users: DataFrame, task_id: int, output: str,
    n: int = sampling.SAMPLE_SIZE, seed: int = 42, at_rest: bool = False,
) -> str:
    """Compute all results of one task and make them what readers see, in one step; returns the id of the run.

    A run that fails or stops between two tables leaves the former run's results as they
    are, all of them; what a failed run has written is removed.
    """
    folder = task_folder(output, task_id)
    with session_results(tasks, actions, users, task_id, n, seed, at_rest) as results:
        run = runs.new_run(folder)
        try:
            for name, df in results.items():
                df.write.parquet(f"{runs.run_folder(folder, run)}/{name}")
        except BaseException:
            runs.discard(folder, run)
            raise
        runs.publish(folder, run)
    return run


def task_folder(output: str, task_id: int) -> str:
    return f"{output.rstrip('/')}/task-{task_id}"


def read_published(spark: SparkSession, output: str, task_id: int, name: str, schema: T.StructType) -> DataFrame:
    """One result table of the published run of a task. Tables read after each other may be of two runs: see `published_folder`."""
    return spark.read.schema(schema).parquet(f"{published_folder(output, task_id)}/{name}")


def published_folder(output: str, task_id: int) -> str:
    """The folder of the published run; all tables in it are of that run, and the next run leaves it in place."""
    return runs.current_folder(task_folder(output, task_id))
