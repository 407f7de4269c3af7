"""The task table: JSON parameters of an analysis run."""

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from footfall.schemas import TASK_PARAM_KEYS


@dataclass(frozen=True)
class TaskParams:
    """Parameters of one run, all as text; None means the run does not restrict on it."""

    start_date: str | None = None
    end_date: str | None = None
    start_age: str | None = None
    end_age: str | None = None
    professionals: str | None = None
    cities: str | None = None
    sex: str | None = None
    keywords: str | None = None
    category_ids: str | None = None
    target_page_flow: str | None = None

    @classmethod
    def from_json(cls, text: str | None) -> "TaskParams":
        """Parameters of a task given as JSON text, as `task_params` gives them."""
        given = json.loads(text) if text else {}
        return cls(**{n: _text((given.get(key) or [None])[0]) for n, key in TASK_PARAM_KEYS.items()})


def _text(value: object) -> str | None:
    """A JSON value as text; null and empty text are missing."""
    return (value if isinstance(value, str) else json.dumps(value)) or None if value is not None else None


def task_params(tasks: DataFrame) -> DataFrame:
    """One row per task: the id and each parameter, null when missing or empty.

    Broken JSON is an error, for a task without parameters would select everything.
    """
    schema = ", ".join(f"{key} array<string>" for key in TASK_PARAM_KEYS.values())
    parsed = tasks.select(
        "task_id", F.from_json("task_param", schema, {"mode": "FAILFAST"}).alias("p")
    )
    return parsed.select(
        "task_id", *[F.nullif(F.get(f"p.{key}", F.lit(0)), F.lit("")).alias(n) for n, key in TASK_PARAM_KEYS.items()]
    )


def find_task(tasks: DataFrame, task_id: int) -> TaskParams:
    """Parameters of one task. At most two rows come to the driver."""
    rows = task_params(tasks.where(F.col("task_id") == task_id)).take(2)
    if len(rows) != 1:
        raise LookupError(f"{'several rows of' if rows else 'no'} task {task_id}")
    return TaskParams(**{n: rows[0][n] for n in TASK_PARAM_KEYS})
