"""The registered queries of the operators, and the SQL they agree with.

Every query applies its operator with its default parameters to the whole table.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from footfall.llm import (
    chosen_path, decontamination, fingerprints, importance, language_id, mixing, packing, periodic_runs, sentence_spans,
    sharding, spelling, token_counts, url_filter,
)
from footfall.llm.session import table

URL_RULES = [
    url_filter.Rule("org/", "allow"),
    url_filter.Rule("example.org/es/", "block"),
    url_filter.Rule("example.org/en/1", "block"),
    url_filter.Rule("com/fr/", "allow"),
    url_filter.Rule("com/de/", "block"),
]


def op1_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op3_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join_report(table(spark, sf_dir, "documents"))


def op4_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeats(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.suffix_sums(token_counts.length_histogram(table(spark, sf_dir, "documents")))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(spelling.count_words(table(spark, sf_dir, "documents")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.runs_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_importance_resampling": op1_importance_resampling,
    "op2_mixing": op2_mixing,
    "op3_chosen_path_join": op3_chosen_path_join,
    "op4_sentence_spans": op4_sentence_spans,
    "op5_token_counts": op5_token_counts,
    "op6_sharding": op6_sharding,
    "op7_fingerprints": op7_fingerprints,
    "op8_url_filter": op8_url_filter,
    "op9_decontamination": op9_decontamination,
    "op10_language_id": op10_language_id,
    "op11_packing": op11_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_periodic_runs": op13_periodic_runs,
}
