"""Column layouts of the input and result tables (fixed values)."""

ACTION_SCHEMA = (
    "date string, user_id bigint, session_id string, page_id bigint, "
    "action_time string, search_keyword string, click_category_id bigint, "
    "click_product_id bigint, order_category_ids string, order_product_ids string, "
    "pay_category_ids string, pay_product_ids string"
)

USER_SCHEMA = (
    "user_id bigint, username string, name string, age int, professional string, "
    "city string, sex string"
)

TASK_SCHEMA = (
    "task_id bigint, task_name string, create_time string, start_time string, "
    "finish_time string, task_type string, task_status string, task_param string"
)

PERSON_SCHEMA = "id int, name string, age int"

PEOPLE_SCHEMA = "name string, age int, job string"

# Every parameter of a task is a JSON array of which only element 0 counts.
TASK_PARAM_KEYS = {
    "start_date": "startDate",
    "end_date": "endDate",
    "start_age": "startAge",
    "end_age": "endAge",
    "professionals": "professionals",
    "cities": "cities",
    "sex": "sex",
    "keywords": "keywords",
    "category_ids": "categoryIds",
    "target_page_flow": "targetPageFlow",
}

# The user or category id that stands for "no id" in the logs.
NOT_FOUND = -1

DETAIL_COLUMNS = [
    "user_id", "session_id", "page_id", "action_time", "search_keyword",
    "click_category_id", "click_product_id", "order_category_ids",
    "order_product_ids", "pay_category_ids", "pay_product_ids",
]

# (suffix, lowest, highest) in whole seconds, both ends included. A session of
# 0 seconds is in no bucket.
VISIT_BUCKETS = [
    ("1s_3s", 1, 3),
    ("4s_6s", 4, 6),
    ("7s_9s", 7, 9),
    ("10s_30s", 10, 30),
    ("30s_60s", 31, 60),
    ("1m_3m", 61, 180),
    ("3m_10m", 181, 600),
    ("10m_30m", 601, 1800),
    ("30m", 1801, None),
]

# (suffix, lowest, highest) in number of actions, both ends included.
STEP_BUCKETS = [
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_30", 10, 30),
    ("30_60", 31, 60),
    ("60", 61, None),
]

# Keys of the `k=v|k=v` text form of a session, and the column behind each.
SESSION_TEXT_KEYS = {
    "sessionId": "session_id",
    "searchKeywords": "search_keywords",
    "clickCategoryIds": "click_category_ids",
    "visitLength": "visit_length",
    "stepLength": "step_length",
    "startTime": "start_time",
    "age": "age",
    "professional": "professional",
    "city": "city",
    "sex": "sex",
}
