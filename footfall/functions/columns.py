"""Column expressions shared by the operators."""

from pyspark.sql import Column, functions as F

# Fixed value: the text format of a day as a key.
DATE_KEY_FORMAT = "yyyyMMdd"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_time_sql(name: str) -> str:
    """SQL for the time a text `yyyy-MM-dd H:mm:ss` names, null when it cannot be read.

    Log times are what a clock on the wall showed, so they have no time zone. The cast
    alone would also read texts of other forms.
    """
    form = r"r'\A\d\d\d\d-\d\d-\d\d \d?\d:\d\d:\d\d\z'"
    return f"case when {name} rlike {form} then try_cast({name} as timestamp_ntz) end"


def parse_time(name: str) -> Column:
    return F.expr(parse_time_sql(name))


def parse_date_key(c: Column | str) -> Column:
    """Date of a `yyyyMMdd` string, null when it cannot be read."""
    return F.try_to_timestamp(col(c), F.lit(DATE_KEY_FORMAT)).cast("date")


def format_time(c: Column | str) -> Column:
    """`yyyy-MM-dd HH:mm:ss` of a time without zone."""
    return F.left(col(c).cast("string"), F.lit(19))


def format_date(c: Column | str) -> Column:
    return col(c).cast("date").cast("string")


def is_before(a: Column, b: Column) -> Column:
    """Whether time a is before time b; false when either is missing."""
    return F.coalesce(a < b, F.lit(False))


def is_after(a: Column, b: Column) -> Column:
    return is_before(b, a)


def seconds_between(a: Column, b: Column) -> Column:
    """Whole seconds from b to a; 0 when either is missing."""
    return F.coalesce((a - b).cast("bigint"), F.lit(0))


def id_list(name: str) -> str:
    """SQL for the numbers in a comma-separated list; a part that is no number becomes null."""
    return f"try_cast(split({name}, ',') as array<bigint>)"


def ratio(part: str, total: str) -> str:
    """SQL for part / total rounded half up to two digits, in exact integer arithmetic."""
    return f"(200 * {part} + {total}) div nullif(2 * {total}, 0) / 100"
