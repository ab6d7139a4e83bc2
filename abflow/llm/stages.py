"""The operators as pipeline stages: (spark, docs, sf_dir) -> documents that stay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import compress_quality, decontam, ngram_join, packing, secret_scan
from .common import read_table



def good_quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores under its cutoff go."""
    model = compress_quality.fit(docs, read_table(spark, sf_dir, "labels"))
    name = "_quality_score"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return compress_quality.score(docs, model, name).filter(F.col(name) >= compress_quality.CUTOFF).drop(name)


def one_of_each_group(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest ``doc_id`` stays (the
    component's name). Documents without words have no group and stay; a row whose
    ``doc_id`` is null can't be compared and stays. Rows of one id are one document: each of
    its texts stays once, so no text goes without another of its group being kept."""
    found = ngram_join.ngram_join(docs)
    gone = found.filter("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    # whole rows are shuffled for this only if any row is repeated
    repeats = docs.filter("doc_id is not null").groupBy("doc_id", F.xxhash64("text").alias("h")).count().filter("count > 1")
    if repeats.isEmpty():
        return kept
    return kept.filter("doc_id is not null").dropDuplicates(["doc_id", "text"]).unionByName(kept.filter("doc_id is null"))


def without_benchmark(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontam.clean(docs, read_table(spark, sf_dir, "benchmark"), remove="documents")


def without_secrets(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts, every document stays; ``n_chars`` follows the text."""
    out = secret_scan.redact(docs, secret_scan.forest_of(docs))
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    return out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars"))) if kind else out


def packed(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their place in a training sequence."""
    return packing.pack(packing.pieces(docs, packing.TOKENIZER)).drop("copy")
