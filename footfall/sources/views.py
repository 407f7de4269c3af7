"""Action, user and task tables derived from the given test tables."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.operators.skew import with_group_values


# Columns of the given tables; stated so that no job is spent on reading them.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def user_visit_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actions out of `events`.

    The grain of a session depends on the user (month, ten days or day). All
    actions of a session get the hour of its first event plus an offset. Rows are
    shuffled by the short text that the id of a session is the hash of.
    """
    events = spark.sql(
        """
        select event_id, ts, user_id, event_type, value, cast(get_json_object(props, '$.k') as bigint) as k,
          concat(cast(user_id as string), '_',
            case when user_id % 10 = 0 then 'm' || left(day, 6)
                 when user_id % 10 in (1, 2) then 'd' || left(day, 6) || cast((dayofmonth(ts) - 1) div 10 as string)
                 else day end) as session
        from (select *, replace(left(cast(ts as string), 10), '-', '') as day from {events})""",
        events=table(spark, sf_dir, "events"),
    )
    first_hour = F.expr("left(cast(min(ts) as string), 13) as base")
    return spark.sql(
        """
        select left(base, 10) as date, user_id, md5(session) as session_id, event_id % 10 as page_id,
          cast(cast(base || ':00:00' as timestamp_ntz)
            + make_dt_interval(0, 0, 0, cast(floor(value * 10) as decimal(18, 6))) as string) as action_time,
          case when event_type = 'view' then 'kw' || cast(k % 10 as string) end as search_keyword,
          case when event_type = 'click' then k end as click_category_id,
          case when event_type = 'click' then (k * 7) % 100 end as click_product_id,
          case when event_type = 'signup' then cast(k as string) || case when event_id % 2 = 0
            then ',' || cast((k + 1) % 100 as string) else '' end end as order_category_ids,
          case when event_type = 'signup' then cast((k * 7) % 100 as string) end as order_product_ids,
          case when event_type = 'purchase' then cast(k as string) || case when event_id % 2 = 0
            then ',' || cast((k + 1) % 100 as string) else '' end end as pay_category_ids,
          case when event_type = 'purchase' then cast((k * 7) % 100 as string) end as pay_product_ids
        from {based}""",
        based=with_group_values(events, "session", [first_hour]),
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users out of `customer` and `nation`."""
    return spark.sql(
        """
        select c_custkey as user_id, 'user' || cast(c_custkey as string) as username, c_name as name,
          cast((c_custkey * 7) % 60 as int) as age, c_mktsegment as professional, n_name as city,
          case when c_custkey % 2 = 0 then 'male' else 'female' end as sex
        from {customer} join {nation} on c_nationkey = n_nationkey""",
        customer=table(spark, sf_dir, "customer"),
        nation=table(spark, sf_dir, "nation"),
    )


def task(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One analysis task per customer, with present, empty and missing parameters."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as task_id",
        "'task ' || cast(c_custkey as string) as task_name",
        "cast(null as string) as create_time",
        "cast(null as string) as start_time",
        "cast(null as string) as finish_time",
        "'session' as task_type",
        "'NEW' as task_status",
        """'{"startDate":["2024-01-' || lpad(cast(c_custkey % 28 + 1 as string), 2, '0')
           || '"],"endDate":["2024-01-31","2024-02-29"]'
           || case c_custkey % 3 when 0 then '' when 1 then ',"startAge":[]'
                   else ',"startAge":["' || cast(c_custkey % 40 as string) || '"]' end
           || ',"endAge":["50"],"professionals":["' || c_mktsegment || ',BUILDING"]'
           || ',"cities":["NATION_' || cast(c_nationkey as string) || '"]'
           || case when c_custkey % 2 = 0 then ',"sex":["male"]' else ',"sex":[""]' end
           || case when c_custkey % 5 = 0 then ',"targetPageFlow":["0,1,2"]' else '' end
           || ',"keywords":["kw1,kw2"],"categoryIds":[' || case when c_custkey % 7 = 0 then cast(c_custkey % 100 as string)
                else '' end || ']}' as task_param""",
    )


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, name and age of every customer."""
    return table(spark, sf_dir, "customer").selectExpr(
        "cast(c_custkey as int) as id", "c_name as name", "cast((c_custkey * 7) % 60 as int) as age"
    )
