"""DuckDB SQL that each registered query must agree with. Used for checking only."""

# Bounds of the histograms, stated apart from the engine's: name, lowest, highest (none: open).
VISIT_BUCKETS = [
    ("1s_3s", 1, 3), ("4s_6s", 4, 6), ("7s_9s", 7, 9), ("10s_30s", 10, 30), ("30s_60s", 31, 60),
    ("1m_3m", 61, 180), ("3m_10m", 181, 600), ("10m_30m", 601, 1800), ("30m", 1801, None),
]
STEP_BUCKETS = [("1_3", 1, 3), ("4_6", 4, 6), ("7_9", 7, 9), ("10_30", 10, 30), ("30_60", 31, 60), ("60", 61, None)]

ACTIONS = """
  with e as (select event_id, ts, user_id, event_type, value,
      cast(json_extract_string(props, '$.k') as bigint) k,
      case when user_id % 10 = 0 then 'm' || strftime(ts, '%Y%m')
           when user_id % 10 in (1, 2) then 'd' || strftime(ts, '%Y%m') || cast((dayofmonth(ts) - 1) // 10 as varchar)
           else strftime(ts, '%Y%m%d') end grain from events),
  b as (select *, md5(cast(user_id as varchar) || '_' || grain) session_id,
      date_trunc('hour', min(ts) over (partition by user_id, grain)) base from e)
  select strftime(base, '%Y-%m-%d') date, user_id, session_id, event_id % 10 page_id,
    strftime(base + to_seconds(cast(floor(value * 10) as bigint)), '%Y-%m-%d %H:%M:%S') action_time,
    case when event_type = 'view' then 'kw' || cast(k % 10 as varchar) end search_keyword,
    case when event_type = 'click' then k end click_category_id,
    case when event_type = 'click' then (k * 7) % 100 end click_product_id,
    case when event_type = 'signup' then cast(k as varchar) || case when event_id % 2 = 0
      then ',' || cast((k + 1) % 100 as varchar) else '' end end order_category_ids,
    case when event_type = 'signup' then cast((k * 7) % 100 as varchar) end order_product_ids,
    case when event_type = 'purchase' then cast(k as varchar) || case when event_id % 2 = 0
      then ',' || cast((k + 1) % 100 as varchar) else '' end end pay_category_ids,
    case when event_type = 'purchase' then cast((k * 7) % 100 as varchar) end pay_product_ids
  from b"""

USERS = """
  select c_custkey user_id, 'user' || cast(c_custkey as varchar) username, c_name name,
    cast((c_custkey * 7) % 60 as int) age, c_mktsegment professional, n_name city,
    case when c_custkey % 2 = 0 then 'male' else 'female' end sex
  from customer join nation on c_nationkey = n_nationkey"""

TWO_DAYS = "date between '2024-01-05' and '2024-01-06'"

SESSIONS = """
  select session_id, min(nullif(user_id, -1)) user_id,
    string_agg(distinct nullif(search_keyword, ''), ',' order by nullif(search_keyword, '')) search_keywords,
    array_to_string(list_transform(list_sort(list_distinct(list(nullif(click_category_id, -1))
      filter (where click_category_id is not null))), lambda x: cast(x as varchar)), ',') click_category_ids,
    epoch(max(acted))::bigint - epoch(min(acted))::bigint visit_length, count(*) step_length,
    strftime(min(acted), '%Y-%m-%d %H:%M:%S') start_time, strftime(max(acted), '%Y-%m-%d %H:%M:%S') end_time
  from (select *, try_strptime(action_time, '%Y-%m-%d %H:%M:%S') acted from actions)
  group by session_id having count(*) filter (where acted is null) = 0"""

FULL = """select s.*, age, professional, city, sex from session_agg s join user_info using (user_id)"""

TOUCHES = """
  select session_id, click_category_id category_id, 'click' kind from actions where click_category_id is not null
  union all
  select session_id, try_cast(unnest(string_split(order_category_ids, ',')) as bigint), 'order' from actions
  union all
  select session_id, try_cast(unnest(string_split(pay_category_ids, ',')) as bigint), 'pay' from actions"""

DETAIL = """user_id, session_id, page_id, action_time, search_keyword, click_category_id, click_product_id,
  order_category_ids, order_product_ids, pay_category_ids, pay_product_ids"""

SAMPLE_COLUMNS = "session_id, start_time, end_time, search_keywords, click_category_ids"


def _ctes(date_range: str, **more: str) -> str:
    parts = {
        "user_visit_action": ACTIONS,
        "user_info": USERS,
        "actions": f"select * from user_visit_action where {date_range}",
        "session_agg": SESSIONS,
        "sessions": FULL,
        **more,
    }
    return "with " + ",\n".join(f"{name} as ({sql})" for name, sql in parts.items()) + "\n"


ALL = _ctes("true")
SAMPLED = dict(
    hours="select start_time[1:10] AS date, start_time[12:13] AS hour, count(*) AS session_count from sessions group by all",
    quotas="""select date, hour, session_count,
      least(cast(floor(cast(session_count as double)
        / cast(sum(session_count) over (partition by date) as double)
        * (3000 // (select count(distinct date) from hours))) as bigint), session_count) quota from hours""",
    sample=f"""select {SAMPLE_COLUMNS} from (select *, row_number() over (
      partition by start_time[1:13] order by md5('42_' || session_id), session_id) rank from sessions)
      join quotas on start_time[1:10] = date and start_time[12:13] = hour where rank <= quota""",
)

DAYS = _ctes("true", **SAMPLED)

COUNTS = """select category_id, count(*) filter (where kind = 'click') click_count,
  count(*) filter (where kind = 'order') order_count, count(*) filter (where kind = 'pay') pay_count
  from touches where category_id is not null and session_id in (select session_id from sessions)
  group by category_id"""
TOPPED = _ctes(
    "true",
    **SAMPLED,
    touches=TOUCHES,
    counts=COUNTS,
    top="""select cast(1 as bigint) task_id, * from counts
      order by click_count desc, order_count desc, pay_count desc, category_id limit 10""",
    top_sessions="""select cast(1 as bigint) task_id, category_id, session_id, click_count from (
      select *, row_number() over (partition by category_id order by click_count desc, session_id) rank from (
        select click_category_id category_id, session_id, count(*) click_count from actions
        where click_category_id in (select category_id from top) group by all)) where rank <= 10""",
)


def _ratio(column: str, low: int, high: int | None) -> str:
    test = f"{column} >= {low}" if high is None else f"{column} between {low} and {high}"
    return f"((200 * count(*) filter (where {test}) + count(*)) // nullif(2 * count(*), 0)) / 100.0"


RATIOS = ", ".join(
    f"{_ratio(column, low, high)} {column}_{suffix}_ratio"
    for column, buckets in (("visit_length", VISIT_BUCKETS), ("step_length", STEP_BUCKETS))
    for suffix, low, high in buckets
)

# The text form `k=v|k=v` of a session and one value out of it.
INFO = """select *, 'sessionId=' || session_id || '|searchKeywords=' || coalesce(search_keywords, '')
  || '|clickCategoryIds=' || coalesce(click_category_ids, '') || '|visitLength=' || visit_length
  || '|stepLength=' || step_length || '|startTime=' || start_time || '|age=' || age
  || '|professional=' || professional || '|city=' || city || '|sex=' || sex info from sessions"""


def _field(name: str) -> str:
    return (
        "list_filter(list_transform(string_split(info, '|'), lambda x: string_split(regexp_replace(x, '=+$', ''), '=')), "
        f"lambda p: len(p) = 2 and p[1] = '{name}')[1][2]"
    )


TASKS = """select c_custkey task_id, '{"startDate":["2024-01-' || lpad(cast(c_custkey % 28 + 1 as varchar), 2, '0')
  || '"],"endDate":["2024-01-31","2024-02-29"]'
  || case c_custkey % 3 when 0 then '' when 1 then ',"startAge":[]'
     else ',"startAge":["' || cast(c_custkey % 40 as varchar) || '"]' end
  || ',"endAge":["50"],"professionals":["' || c_mktsegment || ',BUILDING"]'
  || ',"cities":["NATION_' || cast(c_nationkey as varchar) || '"]'
  || case when c_custkey % 2 = 0 then ',"sex":["male"]' else ',"sex":[""]' end
  || case when c_custkey % 5 = 0 then ',"targetPageFlow":["0,1,2"]' else '' end
  || ',"keywords":["kw1,kw2"],"categoryIds":[' || case when c_custkey % 7 = 0 then cast(c_custkey % 100 as varchar) else '' end
  || ']}' task_param from customer"""

TASK_COLUMNS = ", ".join(
    f"nullif(json_extract_string(task_param, '$.{key}[0]'), '') {name}"
    for name, key in [
        ("start_date", "startDate"), ("end_date", "endDate"), ("start_age", "startAge"), ("end_age", "endAge"),
        ("professionals", "professionals"), ("cities", "cities"), ("sex", "sex"), ("keywords", "keywords"),
        ("category_ids", "categoryIds"), ("target_page_flow", "targetPageFlow"),
    ]
)

# Every task against every session of its dates.
TASKS_AND_SESSIONS = f"""select task_id, count(session_id) session_count, {RATIOS.replace("count(*)", "count(session_id)")}
  from (select task_id, {TASK_COLUMNS} from task) p left join
    (select * from sessions join (select session_id, min(date) date from actions group by session_id) using (session_id)) s on
    s.date >= p.start_date and s.date <= p.end_date
    and (p.start_age is null or p.end_age is null or s.age between cast(p.start_age as int) and cast(p.end_age as int))
    and (p.professionals is null or list_contains(string_split(p.professionals, ','), s.professional))
    and (p.cities is null or list_contains(string_split(p.cities, ','), s.city)) and (p.sex is null or s.sex = p.sex)
    and (p.keywords is null or list_has_any(string_split(s.search_keywords, ','), string_split(p.keywords, ',')))
    and (p.category_ids is null or list_has_any(string_split(s.click_category_ids, ','), string_split(p.category_ids, ',')))
  group by task_id"""

# Sessions at each step of a funnel: the first row of its page after the row of the step before.
FUNNEL = [3, 1, 4, 1, 1]
FUNNEL_STEPS = {"step_0": "select distinct session_id, 0 as reached from placed"} | {
    f"step_{i}": f"""select session_id, min(nr) as reached from placed join step_{i - 1} using (session_id)
      where page_id = {page} and nr > reached group by session_id"""
    for i, page in enumerate(FUNNEL, 1)
}

PERSON = "select cast(c_custkey as int) id, c_name name, cast((c_custkey * 7) % 60 as int) age from customer"

WORDS = """select unnest(string_split(line, ' ')) word from (
  select unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) line from documents)"""

TOKENS = """select token, count(*) cnt from (
  select unnest([event_type, json_extract_string(props, '$.k')]) token from events) where token != '' group by token"""

ORACLE: dict[str, str] = {
    "action_scan_date_range": _ctes(TWO_DAYS) + "select * from actions",
    "action_scan_task_dates": _ctes("true", task=TASKS, begun=f"select {TASK_COLUMNS} from task") + """select * from actions
      where date in (select start_date from begun where target_page_flow is not null and category_ids is not null)""",
    "session_agg": ALL + "select * from session_agg",
    "session_user_join": ALL + "select * from sessions",
    "session_filter": _ctes("date between '2024-01-01' and '2024-01-31'") + """select * from sessions
      where age between 10 and 50 and professional in ('HOUSEHOLD', 'BUILDING', 'MACHINERY')
      and city in ('NATION_2', 'NATION_3', 'NATION_5', 'NATION_7', 'NATION_11') and sex = 'male'
      and list_has_any(string_split(search_keywords, ','), ['kw1', 'kw2', 'kw3', 'kw4', 'kw5'])""",
    "session_filter_category": ALL + """select * from sessions where age between 0 and 30
      and list_has_any(string_split(click_category_ids, ','), ['3', '5', '7', '11', '13'])""",
    "session_filter_each": ALL + """select 'age' as filter, session_id from sessions where age between 10 and 50
      union all select 'professional', session_id from sessions where professional in ('HOUSEHOLD', 'BUILDING', 'MACHINERY')
      union all select 'city', session_id from sessions where city in ('NATION_2', 'NATION_3', 'NATION_5', 'NATION_7', 'NATION_11')
      union all select 'sex', session_id from sessions where sex = 'male'
      union all select 'keyword', session_id from sessions
        where list_has_any(string_split(search_keywords, ','), ['kw1', 'kw2', 'kw3', 'kw4', 'kw5'])
      union all select 'category', session_id from sessions
        where list_has_any(string_split(click_category_ids, ','), ['3', '5', '7', '11', '13'])""",
    "session_agg_stat": ALL + f"select cast(1 as bigint) task_id, count(*) session_count, {RATIOS} from sessions",
    "session_hour_count": ALL + """select start_time[1:10] || '_' || start_time[12:13] date_hour,
      count(*) session_count from sessions group by 1""",
    "session_states": ALL + "select * from session_agg",
    "session_states_range": _ctes(TWO_DAYS) + """select start_time[1:10] || '_' || start_time[12:13] date_hour,
      count(*) session_count from session_agg group by 1""",
    "all_tasks_stat": _ctes("true", task=TASKS) + TASKS_AND_SESSIONS,
    "extract_quota": DAYS + "select * from quotas",
    "random_extract_session": DAYS + f"select cast(1 as bigint) task_id, {SAMPLE_COLUMNS} from sample",
    "extract_in_one_pass": DAYS + f"select cast(1 as bigint) task_id, {SAMPLE_COLUMNS} from sample",
    "session_detail": DAYS + f"""select cast(1 as bigint) task_id, {DETAIL} from actions
      where session_id in (select session_id from sample)""",
    "category_click_count": TOPPED + "select category_id, click_count from counts where click_count > 0",
    "category_order_count": TOPPED + "select category_id, order_count from counts where order_count > 0",
    "category_pay_count": TOPPED + "select category_id, pay_count from counts where pay_count > 0",
    "top10_category": TOPPED + "select * from top",
    "category_rank": TOPPED + """select *, row_number() over (
      order by click_count desc, order_count desc, pay_count desc, category_id) as rank from counts""",
    "session_rank": ALL + """select session_id, step_length, visit_length, row_number() over (
      order by step_length desc, visit_length desc, session_id) as rank from sessions""",
    "top10_category_session": TOPPED + "select * from top_sessions",
    "top10_session_detail": TOPPED + f"""select cast(1 as bigint) task_id, {DETAIL} from actions
      where session_id in (select session_id from top_sessions)""",
    "job_session_detail": TOPPED + f"""select cast(1 as bigint) task_id, {DETAIL} from actions
      where session_id in (select session_id from top_sessions union select session_id from sample)""",
    "job_published_sessions": TOPPED + "select * from top_sessions",
    "task_params": f"with task as ({TASKS}) select task_id, {TASK_COLUMNS} from task",
    "concat_field_job": _ctes("true", texts=INFO) + f"""select session_id,
      {_field('searchKeywords')} search_keywords, {_field('clickCategoryIds')} click_category_ids,
      cast({_field('visitLength')} as bigint) visit_length, {_field('startTime')} start_time,
      {_field('city')} city, coalesce({_field('searchKeywords')}, '') = '' no_keywords,
      regexp_replace(info, '[|]stepLength=[0-9]+', '|stepLength=0') info,
      click_category_ids trimmed_ids,
      start_time[12:13] padded_hour from texts""",
    "time_feature_job": _ctes(
        "true", timed="select *, try_strptime(action_time, '%Y-%m-%d %H:%M:%S') acted from actions"
    ) + """select session_id, action_time, strftime(acted, '%Y-%m-%d_%H') date_hour, strftime(acted, '%Y%m%d') date_key,
      strftime(acted, '%Y%m%d%H%M') minute_key, strftime(acted, '%Y-%m-%d %H:%M:%S') full_time, cast(acted as date) as day,
      acted > min(acted) over (partition by session_id) is_after_start,
      epoch(acted)::bigint - epoch(min(acted) over (partition by session_id))::bigint secs_since_session_start,
      hour(acted) < 12 is_before_noon, '2024-01-31' run_date, '2024-01-30' prev_date from timed""",
    "text_struct_scan": PERSON,
    "text_sql_filter": f"select * from ({PERSON}) where age > 20",
    "json_scan": PERSON,
    "json_inferred_scan": "select cast(c_custkey as bigint) id, c_name name, cast((c_custkey * 7) % 60 as bigint) age from customer",
    "json_variant_scan": """select event_id id, case when event_id % 4 = 2 then k || '.5' when event_id % 4 = 3 then '[' || k || ']'
      else k end k, case when event_id % 4 in (0, 1, 2) then cast(k as bigint) end k_number,
      case when event_id % 4 = 3 then cast(k as bigint) end k_first,
      case when event_id % 4 = 3 then event_type end kind
      from (select *, json_extract_string(props, '$.k') k from events)""",
    "json_variant_types": """select path, type, count(*) "rows" from (
      select unnest(['$.id', '$.k', '$.tag']) path, unnest(['BIGINT',
        case event_id % 4 when 0 then 'BIGINT' when 1 then 'STRING' when 2 then 'DECIMAL(' || len(ltrim(k || '5', '0')) || ',1)' else 'ARRAY<BIGINT>' end,
        case event_id % 4 when 0 then 'STRING' when 1 then 'VOID' when 2 then null else 'OBJECT<kind: STRING>' end]) as type
      from (select *, json_extract_string(props, '$.k') k from events)) group by path, type""",
    "csv_scan": PERSON,
    "partitioned_word_count": f"select word, count(*) cnt from ({WORDS}) where word != '' group by word",
    "word_count_partitions": f"""select 1 + count(distinct word) // 20000 partitions, cast(count(distinct word) as bigint) "rows"
      from ({WORDS}) where word != ''""",
    "stream_token_count": TOKENS,
    "stream_running_count": TOKENS,
    "task_partition_overwrite": TOPPED + """select * from top union all
      (select cast(2 as bigint) task_id, * from counts
       order by click_count desc, order_count desc, pay_count desc, category_id limit 25)""",
    "foreach_partition_sink": ALL + "select * from actions",
    "committed_partition_sink": ALL + "select * from actions",
    "page_convert_rate": _ctes(
        "true",
        ordered="""select page_id, lead(page_id) over (partition by session_id order by action_time, page_id) next_page
          from actions where session_id not in (select session_id from actions
            where try_strptime(action_time, '%Y-%m-%d %H:%M:%S') is null and session_id is not null)""",
        steps="select * from (values (0::bigint, 1::bigint), (1::bigint, 2::bigint)) v(page_from, page_to)",
    ) + """select page_from, page_to, count(*) filter (where page_id = page_from) "views",
      count(*) filter (where page_id = page_from and next_page = page_to) moves,
      count(*) filter (where page_id = page_from and next_page = page_to)::double
        / nullif(count(*) filter (where page_id = page_from), 0) rate
      from steps, ordered group by page_from, page_to""",
    "page_funnel": _ctes(
        "true",
        placed="""select session_id, page_id, row_number() over (partition by session_id order by action_time, page_id) nr
          from actions where session_id is not null and session_id not in (select session_id from actions
            where try_strptime(action_time, '%Y-%m-%d %H:%M:%S') is null and session_id is not null)""",
        **FUNNEL_STEPS,
        sizes=" union all ".join(
            f"select cast({i} as bigint) step, cast({page} as bigint) page_id, count(*) sessions from step_{i}"
            for i, page in enumerate(FUNNEL, 1)
        ),
    ) + """select *, case when step > 1 then sessions / nullif(lag(sessions) over (order by step), 0) end rate from sizes""",
}
