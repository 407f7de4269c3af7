"""Columns that hold `k=v|k=v` text and comma-separated lists."""

import re

from pyspark.sql import Column, DataFrame, functions as F

from footfall.functions.columns import col
from footfall.schemas import SESSION_TEXT_KEYS

DELIMITER = "|"


def is_empty(c: Column | str) -> Column:
    return col(c).isNull() | (col(c) == "")


def render_fields(fields: dict[str, Column | str], delimiter: str = DELIMITER) -> Column:
    """`k=v|k=v` text of the given columns; a null is written as an empty value."""
    return F.concat_ws(
        delimiter,
        *[F.concat(F.lit(f"{k}="), F.coalesce(col(c).cast("string"), F.lit(""))) for k, c in fields.items()],
    )


def get_field(c: Column | str, field: str, delimiter: str = DELIMITER) -> Column:
    """Value of the first `field=value` part.

    Null when there is none, when the value is empty or contains `=`; any `=` at
    the end of a part does not count.
    """
    d = re.escape(delimiter)
    pattern = f"(?:^|{d}){re.escape(field)}=((?:(?!{d})[^=])+)=*(?={d}|\\z)"
    return F.nullif(F.regexp_extract(col(c), pattern, 1), F.lit(""))


def set_field(c: Column | str, field: str, value: str, delimiter: str = DELIMITER) -> Column:
    """The text with the value of the first part named `field` replaced.

    Delimiters at the end are dropped. Text without such a part keeps its parts.
    """
    d = re.escape(delimiter)
    new = re.sub(r"([\\$])", r"\\\1", f"{field}={value}")
    trimmed = F.regexp_replace(col(c), f"(?:{d})+\\z", "")
    first = f"(?s)^((?:.*?{d})??){re.escape(field)}(?:=(?:(?!{d}).)*)?(?={d}|\\z)"
    return F.regexp_replace(trimmed, first, f"$1{new}")


def trim_comma(c: Column | str) -> Column:
    """The text without one comma at each end."""
    return F.regexp_replace(F.regexp_replace(col(c), "^,", ""), ",\\z", "")


def pad_two(c: Column | str) -> Column:
    """Text of two characters as it is, any other with a 0 in front."""
    return F.when(F.length(col(c)) == 2, col(c)).otherwise(F.concat(F.lit("0"), col(c)))


def concat_field_job(sessions: DataFrame) -> DataFrame:
    """Sessions through their text form: written, read back, one value replaced."""
    start = F.split("start_time", "[ :]")
    text = sessions.select(
        "session_id",
        render_fields(SESSION_TEXT_KEYS).alias("info"),
        F.concat(F.lit(","), "click_category_ids", F.lit(",")).alias("list"),
        start[1].cast("int").cast("string").alias("hour"),
    )
    return text.select(
        "session_id",
        get_field("info", "searchKeywords").alias("search_keywords"),
        get_field("info", "clickCategoryIds").alias("click_category_ids"),
        get_field("info", "visitLength").cast("bigint").alias("visit_length"),
        get_field("info", "startTime").alias("start_time"),
        get_field("info", "city").alias("city"),
        is_empty(get_field("info", "searchKeywords")).alias("no_keywords"),
        set_field("info", "stepLength", "0").alias("info"),
        trim_comma("list").alias("trimmed_ids"),
        pad_two("hour").alias("padded_hour"),
    )
