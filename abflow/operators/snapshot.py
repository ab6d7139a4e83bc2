"""Bucketed copy-on-write snapshot of keyed rows.

Rows are dealt into ``buckets`` by a hash of their key. A load reads and
rewrites only the buckets that its keys fall into; the files of all others
stay as they are. ``data/version=<n>/bucket=<b>`` holds what load n
wrote, ``manifest/version=<n>`` (one file) names the version of every bucket. The manifest is
written last and appears as a whole, so a reader sees the state before
or after a load, and a load that died halfway is written over by the next.

The driver handles one row per bucket. A key with very many incoming rows is
reduced map-side (``max_by``).

Defined cases: rows with a null key form one key; an empty load makes a new version with the old files; a
load with another bucket count than the snapshot's fails.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .keyed import upsert_by_key

BUCKETS = 64


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def manifest(spark: SparkSession, path: str, version: int | None = None) -> tuple[int, int, dict[int, int]]:
    """(version, bucket count, bucket -> data version), of the newest version by default; (0, 0, {}) without one."""
    try:
        every = spark.read.option("basePath", f"{path}/manifest").parquet(f"{path}/manifest/version=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, 0, {}
    at = version or every.agg(F.max("version")).first()[0]
    rows = every.filter(F.col("version") == at).collect()   # a row per bucket
    return int(at), rows[0]["buckets"], {r["bucket"]: r["data_version"] for r in rows if r["bucket"] is not None}


def _folders(path: str, where: dict[int, int], buckets=None) -> list[str]:
    return [f"{path}/data/version={v}/bucket={b}" for b, v in sorted(where.items()) if buckets is None or b in buckets]


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """The snapshot (of one version), None if there is none yet."""
    folders = _folders(path, manifest(spark, path, version)[2])
    return spark.read.parquet(*folders) if folders else None


def load(spark: SparkSession, path: str, incoming: DataFrame, key: str, buckets: int = BUCKETS) -> int:
    """Upsert ``incoming`` (with ``_load`` and ``_pos`` of :func:`.keyed.load_order`) and return the new version."""
    version, had, where = manifest(spark, path)
    if version and had != buckets:
        raise ValueError(f"the snapshot has {had} buckets, not {buckets}")
    touched = sorted(r[0] for r in incoming.select(bucket_of(key, buckets)).distinct().collect())   # a row per bucket
    if touched:
        old = _folders(path, where, set(touched))
        names = [c for c in incoming.columns if c not in ("_load", "_pos")]
        current = spark.read.parquet(*old).select(*names) if old else incoming.limit(0).select(*names)
        current = current.withColumn("_load", F.lit(0)).withColumn("_pos", F.lit(None).cast(incoming.schema["_pos"].dataType))
        rows = upsert_by_key(current, incoming, key).withColumn("bucket", bucket_of(key, buckets))
        rows.hint("rebalance", "bucket").write.option("partitionOverwriteMode", "static").mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/version={version + 1}")
    where = where | dict.fromkeys(touched, version + 1)
    rows = [(b, v, buckets) for b, v in sorted(where.items())] or [(None, None, buckets)]
    spark.createDataFrame(rows, "bucket int, data_version int, buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version + 1}")
    return version + 1
