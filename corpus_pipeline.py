"""The corpus pipeline: documents pass through stages, each an operator of pennant.llm.

Every stage takes all rows that the one before kept, and all but the last return
the columns of documents, whatever they are named. Null and empty texts pass the
filters as texts of their own (one of them stays in exact dedup); rows without a
doc_id, or with one that comes twice, are rows like others. Without labels of
both kinds no document is toxic; without items none is contaminated; without
documents every stage returns none. Long texts are scored, compared and searched
whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pennant.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from pennant.llm.common import materialize, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the network learns from the labels of the documents at hand."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return exact_dedup.remove_repeats(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near-duplicates stays."""
    return near_dedup.remove_near(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources."""
    return mixing.replicate(docs)


STAGES = [("toxicity", toxic), ("exact_dedup", exact), ("near_dedup", near), ("decontaminate", clean), ("mixing", mix)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
