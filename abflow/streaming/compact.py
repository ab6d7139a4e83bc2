"""Compaction of the ingested event table.

Ingest writes a folder per (hour, query, batch), so that a replayed batch
replaces exactly what it wrote; an hour of short batches is then many small files.
``compact_hours`` copies the batches of given hours into few files and
names them in a manifest. A reader takes the compacted rows of the
manifest's runs and the batch folders that no run covers, so it sees each batch once
before, during and after a compaction. A replay of a covered batch writes its folder
again with the same rows, which readers leave aside.

``data/run=<n>/curr_time=<hour>`` holds rows, ``manifest/run=<n>`` (one file, written last) the
batches covered; a run that died before its manifest is never read and written over by the next.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..session import short_methods
from .ingest import QUERY_ID, dealt

BATCH = [S.INGEST_PARTITION, QUERY_ID, "batch_id"]


def _typed(df: DataFrame) -> DataFrame:
    """Partition values as written (discovery turns hours into numbers)."""
    return df.withColumns({S.INGEST_PARTITION: F.col(S.INGEST_PARTITION).cast("string"), QUERY_ID: F.col(QUERY_ID).cast("string"),
                           "batch_id": F.col("batch_id").cast("bigint")})


def _raw(spark: SparkSession, path: str) -> DataFrame:
    return _typed(spark.read.parquet(path))


def covered(spark: SparkSession, compacted: str) -> DataFrame | None:
    """(hour, query, batch, run) of every finished run, None before the first."""
    try:
        return spark.read.option("basePath", f"{compacted}/manifest").parquet(f"{compacted}/manifest/run=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def compact_hours(spark: SparkSession, path: str, compacted: str, start: str, end: str) -> int | None:
    """Compact what the hours [start, end] hold beyond earlier runs; returns the run, None if there is nothing new.

    The batches are listed first and the copy takes those alone, so that batches which arrive meanwhile stay for the next run."""
    done = covered(spark, compacted)
    hours = _raw(spark, path).filter(F.col(S.INGEST_PARTITION).between(start, end))
    new = hours.select(*BATCH).distinct()
    if done is not None:
        new = new.join(done.select(*BATCH), BATCH, "left_anti")
    run = 1 + (done.agg(F.max("run")).first()[0] if done is not None else 0)
    listed = f"{compacted}/listed/run={run}"
    new.coalesce(1).write.mode("overwrite").parquet(listed)
    new = spark.read.schema(new.schema).parquet(listed)
    if new.isEmpty():
        return None
    rows = hours.join(new, BATCH, "left_semi")
    with short_methods(spark):
        dealt(rows).write.option("partitionOverwriteMode", "static").mode("overwrite").partitionBy(S.INGEST_PARTITION).parquet(f"{compacted}/data/run={run}")
    new.coalesce(1).write.mode("overwrite").parquet(f"{compacted}/manifest/run={run}")
    return run


def read_events(spark: SparkSession, path: str, compacted: str) -> DataFrame:
    """The event table: compacted batches from the runs, all others from their folders."""
    raw, done = _raw(spark, path), covered(spark, compacted)
    if done is None:
        return raw
    runs = [r[0] for r in done.select("run").distinct().collect()]   # a row per compaction
    old = _typed(spark.read.option("basePath", f"{compacted}/data").parquet(*(f"{compacted}/data/run={n}" for n in sorted(runs))))
    return raw.join(done.select(*BATCH), BATCH, "left_anti").select(*raw.columns).unionByName(old.select(*raw.columns))
