"""Corpus pipeline: the stages that a collection of documents goes through.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet in the shared folder and reads again as the next one's docs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from abflow.llm import stages
from abflow.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", stages.good_quality),
    ("ngram_jaccard_join", stages.one_of_each_group),
    ("benchmark_decontamination", stages.without_benchmark),
    ("secret_scan", stages.without_secrets),
    ("best_fit_packing", stages.packed),
]

#: No SQL twin: the classifier, the forest and the packing are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch_path(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
