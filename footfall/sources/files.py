"""Text, CSV and JSON sources, and what is done with lines of text."""

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def read_delimited(spark: SparkSession, path: str, schema: str, delimiter: str = ",") -> DataFrame:
    """Lines cut at every delimiter (no quoting) and cast to `schema`.

    A value that does not fit its type is an error, as are missing and surplus parts.
    """
    parts = F.split("value", re.escape(delimiter))
    fields = T.StructType.fromDDL(schema).fields
    whole = F.when(F.size(parts) == len(fields), parts).otherwise(
        F.raise_error(F.concat(F.lit(f"not {len(fields)} parts: "), F.col("value")))
    )
    lines = read_lines(spark, path).select(whole.alias("parts"))
    return lines.select(*[F.col("parts")[i].cast(f.dataType).alias(f.name) for i, f in enumerate(fields)])


def query_table(df: DataFrame, name: str, sql: str) -> DataFrame:
    """SQL over `df`, which the text calls {name}; views of the session stay as they are."""
    return df.sparkSession.sql(sql, **{name: df})


def read_json(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON lines; a broken line is an error. Without a schema Spark infers one, which reads the data twice."""
    reader = spark.read.option("mode", "FAILFAST")
    return (reader if schema is None else reader.schema(schema)).json(path)


def read_variants(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines as one variant column `value`, read in one pass without a schema; a broken line is an error."""
    return read_lines(spark, path).select(F.parse_json("value").alias("value"))


def variant_path(path: str, kind: str) -> Column:
    """The value of a variant at a path; null where the path is missing or its value has no form of that type."""
    return F.try_variant_get("value", path, kind)


def variant_types(variants: DataFrame, paths: list[str]) -> DataFrame:
    """path, type, rows: the types found at each path over all rows; type is null where the path is missing.

    A JSON null is of type VOID. Counts are partial before the shuffle.
    """
    found = [F.struct(F.lit(p).alias("path"), F.schema_of_variant(F.variant_get("value", p, "variant")).alias("type")) for p in paths]
    return variants.select(F.explode(F.array(*found)).alias("x")).groupBy("x.path", "x.type").agg(F.count(F.lit(1)).alias("rows"))


def read_csv(spark: SparkSession, path: str, schema: str, header: bool = True) -> DataFrame:
    return spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)


def word_counts(lines: DataFrame, column: str = "value") -> DataFrame:
    """How often each word occurs; words are separated by one space, empty ones dropped."""
    return (
        lines.select(F.explode(F.split(column, " ")).alias("word"))
        .where("word != ''")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("cnt"))
    )


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows in each partition of `df`; partitions without rows are not listed."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count(F.lit(1)).alias("rows"))
