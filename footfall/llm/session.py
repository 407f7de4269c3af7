"""Settings that jobs over texts need."""

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

BATCH_BYTES = 4 << 20

#: The columns of documents that stages work on.
WORKED_ON = ("doc_id", "source", "text")
#: The one column that holds all others meanwhile.
CARRIED = "_carried"


def carries_columns(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A stage over documents that keeps all other columns, whatever their names are.

    The stage sees doc_id, source and text, and the others as fields of one struct, so none
    of its own names can meet one of theirs. A column that the stage adds replaces one of
    that name and comes last.
    """

    @functools.wraps(stage)
    def carried(docs: DataFrame, *args, **options) -> DataFrame:
        others = [c for c in docs.columns if c not in WORKED_ON]
        if not others:
            return stage(docs, *args, **options)
        fields = [F.col(f"`{c.replace('`', '``')}`") for c in others]
        packed = docs.select(*[c for c in docs.columns if c in WORKED_ON], F.struct(*fields).alias(CARRIED))
        result = stage(packed, *args, **options)
        added = [c for c in result.columns if c not in packed.columns]
        back = [
            F.col(c) if c in WORKED_ON else F.col(CARRIED).getField(c).alias(c) for c in docs.columns if c not in added
        ]
        return result.select(*back, *added)

    return carried


def text_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, as ten thousand texts may be any size. A given bound stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def tasks_for(rows: int, per_task: int = 20_000) -> int:
    """Tasks for a step over a counted number of rows."""
    return 1 + rows // per_task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
