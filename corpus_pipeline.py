"""Clean, deduplicate, decontaminate and mix the documents table.

Each stage is ``(name, function)``; the function takes ``(spark, docs,
sf_dir)`` and returns the rows that the next stage works on.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, line_rules, mixing, ngram_join, suffix_dedup
from strata.llm.queries import store, store_alone, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the line rules."""
    return line_rules.keep_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates."""
    return ngram_join.keep_one(docs, partial(store, spark))


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that start earlier elsewhere."""
    return suffix_dedup.drop_repeats(docs, store=partial(store_alone, spark))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark item."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's share of the mix."""
    return mixing.documents_mix(spark, docs, partial(store, spark))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated strings", repeated_strings),
    ("decontamination", decontamination),
    ("mixing", mixture),
]

#: SQL cannot express the near-duplicate search or the line rules' scans; the tests run a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(spark, stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
