"""Registered queries of the operators: thin wrappers over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (
    decontaminate,
    licenses,
    line_index,
    line_rules,
    mixing,
    ngram_join,
    quality_knn,
    spelling,
    substring_fm,
    suffix_dedup,
    token_counts,
    toxicity,
    whitening,
)
from strata.session import in_own_session, scratch_path

#: Whether a query's shuffle files go when it has ended, or when the driver collects its garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def store_alone(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """:func:`store` for a plan of which only the stored rows are used again: its shuffle files go with it."""
    path = scratch_path(spark, name)
    with in_own_session(df) as (session, frame):
        session.conf.set(FREE_SHUFFLES, "true")
        frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), store=partial(store_alone, spark))


def op2_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_knn.score_quality(docs, quality_knn.fit(docs, table(spark, sf_dir, "labels")))


def op3_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.line_quality(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"), partial(store, spark))
    return found.select("doc_id", "n_shingles", "component_id", "n_links", "component_links")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = store(spark, token_counts.encode_documents(table(spark, sf_dir, "documents")), "token_files")
    return token_counts.token_counts(files)


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_substring_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_fm.remove_repeats(table(spark, sf_dir, "documents"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.documents_mix(spark, table(spark, sf_dir, "documents"), partial(store, spark))


def op11_line_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_index.drop_common_lines(table(spark, sf_dir, "documents"), partial(store, spark))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(table(spark, sf_dir, "documents"), partial(store, spark))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_quality_knn": op2_quality_knn,
    "op3_line_rules": op3_line_rules,
    "op4_ngram_join": op4_ngram_join,
    "op5_token_counts": op5_token_counts,
    "op6_licenses": op6_licenses,
    "op7_toxicity": op7_toxicity,
    "op8_decontaminate": op8_decontaminate,
    "op9_substring_fm": op9_substring_fm,
    "op10_mixing": op10_mixing,
    "op11_line_index": op11_line_index,
    "op12_spelling": op12_spelling,
    "op13_whitening": op13_whitening,
}
