"""Session helpers: a local session for tests and bench, and the shared
checkpoint folder every lineage cut goes through."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces small
# shuffle partitions at runtime, and splits skewed partitions of
# sort-merge joins; the broadcast threshold is the size check for
# every small side (AQE applies it to the measured shuffle output).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for the ~100 TB target (about 1000 executors). Shuffles start
# with many partitions and AQE coalesces them to ~256 MB each; inputs are
# split at 256 MB; a shuffle partition more than 5x the median and over
# 512 MB is split (skew join / rebalance). Nothing here is needed for
# correctness; every plan also runs with Spark's defaults.
CLUSTER_CONF = {
    **DEFAULT_CONF,
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "abflow", extra: dict | None = None) -> SparkSession:
    """Local session used by tests and bench (the cluster passes its own)."""
    b = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("ABFLOW_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this setting names a shared file system folder and is
    only read. When it is unset (local tests) a scratch folder is made
    and registered, so ``checkpoint()`` and written lineage cuts work.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a client session without a local SparkContext
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder") from None
        return d
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        # one process: a folder of this run, removed when it ends
        d = tempfile.mkdtemp(prefix="abflow-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def spread(df):
    """Round-robin rows over tasks before CPU-heavy per-row work (JSON parsing)
    on a source of too few splits. AQE sets their number by the bytes shuffled
    and the cores, so it grows with the input."""
    return df.hint("rebalance")


@contextmanager
def short_methods(spark: SparkSession):
    """Within this block Spark runs generated code of more than 8,000 bytes a method in pieces
    instead: the JVM never compiles longer ones, and rows of 45 columns make such methods."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)
