"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All read the whole given tables; a range of dates is the feature of one of them.
`oracle.py` has the SQL each must agree with.
"""

import datetime
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from footfall.conf import folder_exists, materialize, scratch_folder
from footfall.functions.concat_fields import concat_field_job
from footfall.functions.time_features import time_feature_job
from footfall.operators import all_tasks, categories, pages, sampling, sessions as ops, states, stats
from footfall.operators.ranking import rank_all
from footfall.plans.session_job import filtered_sessions, publish_session_job, read_published, run_session_job
from footfall.schemas import PERSON_SCHEMA
from footfall.sinks.committed import read_committed, write_committed
from footfall.sinks.partitions import ParquetWriter, write_partitions
from footfall.sinks.tables import read_results, replace_task
from footfall.sources import catalog_tables, files, line_log, views
from footfall.sources.actions import actions_in_date_range, read_actions, stored_actions
from footfall.sources.tasks import TaskParams, task_params
from footfall.streaming import running, tokens

TASK_ID = 1
SEED = 42
WORDS_PER_PARTITION = 20_000
RUN_DATE = datetime.date(2024, 1, 31)

WHOLE_RANGE = TaskParams()
TWO_DAYS = TaskParams(start_date="2024-01-05", end_date="2024-01-06")
FILTER_TASK = TaskParams.from_json(
    '{"startDate":["2024-01-01"],"endDate":["2024-01-31"],"startAge":["10"],"endAge":["50"],'
    '"professionals":["HOUSEHOLD,BUILDING,MACHINERY"],'
    '"cities":["NATION_2,NATION_3,NATION_5,NATION_7,NATION_11"],'
    '"sex":["male"],"keywords":["kw1,kw2,kw3,kw4,kw5"],"categoryIds":[]}'
)
CATEGORY_TASK = TaskParams.from_json('{"startAge":[0],"endAge":[30],"categoryIds":["3,5,7,11,13"]}')
FLOW_TASK = TaskParams.from_json('{"targetPageFlow":["0,1,2"]}')
FUNNEL_TASK = TaskParams.from_json('{"targetPageFlow":["3,1,4,1,1"]}')
#: Sessions to draw over the 30 days of the test tables: 100 for each day.
DRAWN = 3000


def _actions(spark: SparkSession, sf_dir: str, params: TaskParams = WHOLE_RANGE) -> DataFrame:
    return actions_in_date_range(views.user_visit_action(spark, sf_dir), params)


def _actions_and_sessions(
    spark: SparkSession, sf_dir: str, params: TaskParams = WHOLE_RANGE
) -> tuple[DataFrame, DataFrame]:
    actions = _actions(spark, sf_dir, params)
    return actions, filtered_sessions(actions, views.user_info(spark, sf_dir), params)


def _sessions(spark: SparkSession, sf_dir: str, params: TaskParams = WHOLE_RANGE) -> DataFrame:
    return _actions_and_sessions(spark, sf_dir, params)[1]


#: Where this process has stored the actions of a folder of tables, for each Spark application.
_STORED: dict[tuple[str, str], str] = {}


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All actions, derived once for a Spark application and stored by date, for queries that read them more than once."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _STORED and folder_exists(spark, f"{_STORED[key]}/_SUCCESS"):
        return read_actions(spark, _STORED[key])
    actions, _STORED[key] = stored_actions(_actions(spark, sf_dir))
    return actions


def _stored_with_sessions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    actions = _stored(spark, sf_dir)
    return actions, filtered_sessions(actions, views.user_info(spark, sf_dir), WHOLE_RANGE)


def action_scan_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return actions_in_date_range(_stored(spark, sf_dir), TWO_DAYS)


def action_scan_task_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions of the days on which tasks with a page flow and categories begin, from a catalog table."""
    name, path = f"actions_{uuid.uuid4().hex}", scratch_folder(spark, "catalog-actions")
    catalog_tables.save_table(_actions(spark, sf_dir), name, path)
    begun = task_params(views.task(spark, sf_dir)).where("target_page_flow is not null and category_ids is not null")
    return catalog_tables.on_days(spark, name, begun.selectExpr("start_date as date"))


def session_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.aggregate_sessions(_actions(spark, sf_dir))


def session_user_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.join_users(session_agg(spark, sf_dir), views.user_info(spark, sf_dir))


def session_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir, FILTER_TASK)


def session_filter_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sessions(spark, sf_dir, CATEGORY_TASK)


def session_filter_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that each filter alone keeps."""
    sessions = materialize(_sessions(spark, sf_dir), "sessions")
    alone = {
        "age": {"start_age": "10", "end_age": "50"},
        "professional": {"professionals": FILTER_TASK.professionals},
        "city": {"cities": FILTER_TASK.cities},
        "sex": {"sex": FILTER_TASK.sex},
        "keyword": {"keywords": FILTER_TASK.keywords},
        "category": {"category_ids": CATEGORY_TASK.category_ids},
    }
    kept = [
        ops.filter_sessions(sessions, TaskParams(**given)).select(F.lit(name).alias("filter"), "session_id")
        for name, given in alone.items()
    ]
    return functools.reduce(DataFrame.union, kept)


def session_agg_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.session_agg_stat(_sessions(spark, sf_dir), TASK_ID)


def _stored_states(spark: SparkSession, sf_dir: str) -> str:
    """Daily session states, stored in two steps: the second one adds its days only."""
    actions, path = _stored(spark, sf_dir), scratch_folder(spark, "states")
    for days in ("date <= '2024-01-15'", "date > '2024-01-15'"):
        states.store_states(states.daily_states(actions.where(days)), path)
    return path


def session_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions, merged from stored daily states."""
    return states.sessions_of(states.merge_states(states.read_states(spark, _stored_states(spark, sf_dir))))


def session_states_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions by hour of two days, from the states of these days."""
    kept = states.read_states(spark, _stored_states(spark, sf_dir), TWO_DAYS)
    return stats.session_hour_count(states.sessions_of(states.merge_states(kept)))


def all_tasks_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histogram of every task of the task table."""
    kept = states.read_states(spark, _stored_states(spark, sf_dir))
    return all_tasks.all_tasks_stat(task_params(views.task(spark, sf_dir)), kept, views.user_info(spark, sf_dir))


def session_hour_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.session_hour_count(_sessions(spark, sf_dir))


def extract_quota(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.extract_quota(_sessions(spark, sf_dir), DRAWN)


def _sample(sessions: DataFrame) -> DataFrame:
    return sampling.random_extract_session(materialize(sessions, "sessions"), TASK_ID, DRAWN, seed=SEED)


def random_extract_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sample(_sessions(spark, sf_dir))


def extract_in_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sample out of heaps that merge, with sessions computed once."""
    return sampling.extract_in_one_pass(_sessions(spark, sf_dir), TASK_ID, DRAWN, seed=SEED)


def session_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions, sessions = _stored_with_sessions(spark, sf_dir)
    return sampling.session_detail(actions, _sample(sessions), TASK_ID)


def category_click_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_counts(*_stored_with_sessions(spark, sf_dir), ("click",))


def category_order_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_counts(*_stored_with_sessions(spark, sf_dir), ("order",))


def category_pay_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_counts(*_stored_with_sessions(spark, sf_dir), ("pay",))


def _top(actions: DataFrame, sessions: DataFrame) -> DataFrame:
    return categories.top_categories(categories.category_counts(actions, sessions), TASK_ID)


def top10_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top(*_stored_with_sessions(spark, sf_dir))


def category_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.rank_categories(categories.category_counts(*_stored_with_sessions(spark, sf_dir)))


def session_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sessions by steps, then length; ranges are small here so that there are several."""
    sessions = _sessions(spark, sf_dir).select("session_id", "step_length", "visit_length")
    return rank_all(sessions, [F.desc("step_length"), F.desc("visit_length"), F.asc("session_id")], rows_per_task=500)


def top10_category_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions, sessions = _stored_with_sessions(spark, sf_dir)
    return categories.top_category_sessions(actions, _top(actions, sessions), TASK_ID)


def top10_session_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    actions, sessions = _stored_with_sessions(spark, sf_dir)
    ranked = categories.top_category_sessions(actions, _top(actions, sessions), TASK_ID)
    return categories.top_session_detail(actions, ranked, TASK_ID)


def job_session_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The detail table of the whole job: the drawn and the ranked sessions together."""
    output = scratch_folder(spark, "job")
    tasks = spark.createDataFrame([(TASK_ID, '{"targetPageFlow":["0,1,2"]}')], "task_id bigint, task_param string")
    actions, users = _stored(spark, sf_dir), views.user_info(spark, sf_dir)
    run_session_job(tasks, actions, users, TASK_ID, output, n=DRAWN, seed=SEED, at_rest=True)
    schema = sampling.session_detail(actions, actions, TASK_ID).schema
    return read_results(spark, f"{output}/session_detail", schema)


def job_published_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most active sessions out of a published run; a run of two days before it is replaced as a whole."""
    output = scratch_folder(spark, "published")
    two_days = f'{{"startDate":["{TWO_DAYS.start_date}"],"endDate":["{TWO_DAYS.end_date}"]}}'
    actions, users = _stored(spark, sf_dir), views.user_info(spark, sf_dir)
    for param in (two_days, "{}"):
        tasks = spark.createDataFrame([(TASK_ID, param)], "task_id bigint, task_param string")
        publish_session_job(tasks, actions, users, TASK_ID, output, n=DRAWN, seed=SEED, at_rest=True)
    schema = "task_id bigint, category_id bigint, session_id string, click_count bigint"
    return read_published(spark, output, TASK_ID, "top10_category_session", StructType.fromDDL(schema))


def task_param_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return task_params(views.task(spark, sf_dir))


def concat_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return concat_field_job(_sessions(spark, sf_dir))


def time_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return time_feature_job(_actions(spark, sf_dir), RUN_DATE)


def _person_lines(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_folder(spark, "person-text")
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("id", "name", "age")]
    views.person(spark, sf_dir).select(F.concat_ws(",", *parts)).write.text(path)
    return path


def text_struct_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    person = files.read_delimited(spark, _person_lines(spark, sf_dir), PERSON_SCHEMA)
    return files.query_table(person, "person", "select * from {person}")


def text_sql_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    person = files.read_delimited(spark, _person_lines(spark, sf_dir), PERSON_SCHEMA)
    return files.query_table(person, "person", "select * from {person} where age > 20")


def _person_json(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_folder(spark, "person-json")
    views.person(spark, sf_dir).write.json(path)
    return path


def json_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_json(spark, _person_json(spark, sf_dir), PERSON_SCHEMA)


def json_inferred_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.read_json(spark, _person_json(spark, sf_dir))


def _mixed_json(spark: SparkSession, sf_dir: str) -> str:
    """Lines of JSON whose values are of several types: numbers, texts, lists, objects, null, or missing."""
    path = scratch_folder(spark, "mixed-json")
    k = "get_json_object(props, '$.k')"
    views.table(spark, sf_dir, "events").selectExpr(
        f"""case event_id % 4
          when 0 then concat('{{"id":', event_id, ',"k":', {k}, ',"tag":"', event_type, '"}}')
          when 1 then concat('{{"id":', event_id, ',"k":"', {k}, '","tag":null}}')
          when 2 then concat('{{"id":', event_id, ',"k":', {k}, '.5}}')
          else concat('{{"id":', event_id, ',"k":[', {k}, '],"tag":{{"kind":"', event_type, '"}}}}') end"""
    ).write.text(path)
    return path


def json_variant_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = files.variant_path
    return files.read_variants(spark, _mixed_json(spark, sf_dir)).select(
        at("$.id", "bigint").alias("id"), at("$.k", "string").alias("k"), at("$.k", "bigint").alias("k_number"),
        at("$.k[0]", "bigint").alias("k_first"), at("$.tag.kind", "string").alias("kind"),
    )


def json_variant_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.variant_types(files.read_variants(spark, _mixed_json(spark, sf_dir)), ["$.id", "$.k", "$.tag"])


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "person-csv")
    views.person(spark, sf_dir).write.option("header", True).csv(path)
    return files.read_csv(spark, path, PERSON_SCHEMA)


def _word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the words of text files that hold the documents, line by line."""
    path = scratch_folder(spark, "document-text")
    views.table(spark, sf_dir, "documents").select("text").write.text(path)
    return files.word_counts(files.read_lines(spark, path))


def partitioned_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_counts(spark, sf_dir)


def word_count_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts dealt over as many partitions as their number asks for: partitions, their rows in all."""
    counts = materialize(_word_counts(spark, sf_dir), "word-counts")
    dealt = counts.repartition(1 + counts.count() // WORDS_PER_PARTITION)
    sizes = files.partition_sizes(dealt)
    return sizes.agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"))


def _token_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        "event_id", F.concat_ws(",", "event_type", F.get_json_object("props", "$.k")).alias("value")
    )


def stream_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts over a log: the stream stops, the log grows, the stream goes on."""
    folder = scratch_folder(spark, "running-count")
    for step in (0, 1):
        lines = _token_lines(spark, sf_dir).where(f"pmod(hash(event_id), 2) = {step}").select("value")
        lines.write.text(f"{folder}/lines/{step}")
        stream = line_log.read_line_log(spark, f"{folder}/lines")
        running.start_running_count(stream, f"{folder}/checkpoint", idle_seconds=3600).awaitTermination()
    return running.read_running_counts(spark, f"{folder}/checkpoint")


def stream_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over at least three micro-batches, of which all but the last are then compacted."""
    folder = scratch_folder(spark, "token-stream")
    lines = _token_lines(spark, sf_dir).select("value")
    lines.repartition(3).write.text(f"{folder}/lines/1")  # dealt anew only so that there are three files
    given = len(spark.read.text(f"{folder}/lines/*").inputFiles())
    stream = tokens.read_line_stream(spark, f"{folder}/lines/*", files_per_batch=max(1, given // 3))
    tokens.start_token_count(stream, f"{folder}/counts", f"{folder}/checkpoint").awaitTermination()
    tokens.compact_token_counts(spark, f"{folder}/counts")
    return tokens.read_token_counts(spark, f"{folder}/counts")


def task_partition_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tasks are written; then the first is replaced and the third cleared by a run without rows."""
    table = scratch_folder(spark, "top10-category")
    counts = materialize(categories.category_counts(*_stored_with_sessions(spark, sf_dir)), "category-counts")
    top = categories.top_categories(counts, TASK_ID)
    for task in (1, 2, 3):
        replace_task(categories.top_categories(counts, task, k=25), table, task)
    replace_task(top, table, 1)
    replace_task(top.where("false"), table, 3)
    return read_results(spark, table, top.schema)


def foreach_partition_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions dealt by session, each partition written through a writer of its own, and read back."""
    folder = scratch_folder(spark, "partitions")
    actions = _actions(spark, sf_dir).repartition("session_id")
    write_partitions(actions, functools.partial(ParquetWriter, folder))
    return spark.read.schema(actions.schema).parquet(folder)


def committed_partition_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks are written first, then all actions in fewer partitions, which replace them; read back."""
    folder = scratch_folder(spark, "committed")
    actions = _stored(spark, sf_dir)
    write_committed(actions.where("click_category_id is not null").repartition(12, "session_id"), folder)
    write_committed(actions.repartition(5, "session_id"), folder)
    return read_committed(spark, folder, actions.schema)


def page_convert_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_convert_rate(_actions(spark, sf_dir), FLOW_TASK.target_page_flow)


def page_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_funnel(_actions(spark, sf_dir), FUNNEL_TASK.target_page_flow)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "action_scan_date_range": action_scan_date_range,
    "action_scan_task_dates": action_scan_task_dates,
    "session_agg": session_agg,
    "session_user_join": session_user_join,
    "session_filter": session_filter,
    "session_filter_category": session_filter_category,
    "session_filter_each": session_filter_each,
    "session_agg_stat": session_agg_stat,
    "session_hour_count": session_hour_count,
    "session_states": session_states,
    "session_states_range": session_states_range,
    "all_tasks_stat": all_tasks_stat,
    "extract_quota": extract_quota,
    "random_extract_session": random_extract_session,
    "extract_in_one_pass": extract_in_one_pass,
    "session_detail": session_detail,
    "category_click_count": category_click_count,
    "category_order_count": category_order_count,
    "category_pay_count": category_pay_count,
    "top10_category": top10_category,
    "category_rank": category_rank,
    "session_rank": session_rank,
    "top10_category_session": top10_category_session,
    "top10_session_detail": top10_session_detail,
    "job_session_detail": job_session_detail,
    "job_published_sessions": job_published_sessions,
    "task_params": task_param_scan,
    "concat_field_job": concat_fields,
    "time_feature_job": time_features,
    "text_struct_scan": text_struct_scan,
    "text_sql_filter": text_sql_filter,
    "json_scan": json_scan,
    "json_inferred_scan": json_inferred_scan,
    "json_variant_scan": json_variant_scan,
    "json_variant_types": json_variant_types,
    "csv_scan": csv_scan,
    "partitioned_word_count": partitioned_word_count,
    "word_count_partitions": word_count_partitions,
    "stream_token_count": stream_token_count,
    "stream_running_count": stream_running_count,
    "task_partition_overwrite": task_partition_overwrite,
    "foreach_partition_sink": foreach_partition_sink,
    "committed_partition_sink": committed_partition_sink,
    "page_convert_rate": page_convert_rate,
    "page_funnel": page_funnel,
}
