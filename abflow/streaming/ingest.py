"""Streaming ingest: JSON messages -> flattened 45-column events, appended
by arrival hour (``curr_time``).

One Structured Streaming plan. Parsing is per-row expressions (see
``operators.flatten``), so there is no streaming state. Each micro-batch
is written in ``foreachBatch`` with dynamic partition overwrite of
(curr_time, query_id, batch_id): re-running a batch after a failure replaces
exactly what that batch wrote, so the output is exactly-once; offsets
live in the checkpoint and advance only after the batch commits (an
empty batch writes nothing). Malformed messages go to a reject folder
instead of failing the job.
"""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.groups import ab_group
from ..operators.flatten import allow_repeated_keys, flatten_bounded, ingest_hour, level_bound, project_event
from ..operators.keyed import ledger_to_offsets, offset_ledger, offset_ranges, starting_offsets_json
from ..operators.partials import write_partials
from ..session import short_methods


def read_event_stream(spark: SparkSession, topics: list[str] | str, servers: str,
                      starting_offsets: str = "latest", **options) -> DataFrame:
    """Kafka source (needs the Kafka connector on the classpath).

    ``starting_offsets`` is 'latest' / 'earliest' or the JSON made by
    ``operators.keyed.starting_offsets_json`` from a stored ledger; it
    applies to a first start only, later starts resume from the checkpoint.
    """
    topics = ",".join(topics) if isinstance(topics, (list, tuple)) else topics
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topics).option("startingOffsets", starting_offsets))
    for k, v in options.items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def read_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Same ``value`` column from newline-delimited files (tests, replays)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


ARRIVAL = "_arrival_hour"
LEVELS = "_levels"
# event columns of the partial aggregates
PARTIAL_COLUMNS = {"uid": "userId", "scene_id": "sceneId", "action_type": "optType"}
QUERY_ID = "query_id"


PIECES = 16


def dealt(events: DataFrame) -> DataFrame:
    """Rows dealt out for a write by hour: each hour in up to ``PIECES`` pieces by a hash of the row. The rebalance (not
    repartition) merges pieces until each core has one (of 1 MB at least, so a small batch has one writer) and splits those that are still large."""
    piece = F.pmod(F.xxhash64(*S.EVENT_FIELDS), F.lit(PIECES))
    return events.withColumn("_piece", piece).hint("rebalance", S.INGEST_PARTITION, "_piece").drop("_piece")


def write_batch(batch: DataFrame, batch_id: int, path: str, rejects_path: str | None, query_id: str,
                tz: str = S.DEFAULT_TZ, ledger_path: str | None = None, unwrap_same_key: bool = False,
                ranges_path: str | None = None, partials_path: str | None = None, partial_columns: dict[str, str] | None = None) -> None:
    """Idempotent write of one micro-batch of (value, arrival hour); an empty batch writes nothing
    (its offsets still commit). ``query_id`` tells checkpoints apart.

    The batch is read from its source once. ``ranges_path``: the batch's offset ranges (see
    ``keyed.offset_audit``). ``partials_path``: hourly partial aggregates of the batch's events, by arrival
    hour (see ``operators.partials``); ``partial_columns`` names the event columns that hold uid, scene_id and action_type."""
    allow_repeated_keys(batch)
    batch = batch.withColumn(LEVELS, level_bound("value")).persist()
    try:
        with short_methods(batch.sparkSession):
            rows, most = batch.agg(F.count(F.lit(1)), F.max(LEVELS)).first()
            if rows:
                _write(batch, most or 1, batch_id, path, rejects_path, query_id, tz, ledger_path, unwrap_same_key, ranges_path, partials_path, partial_columns)
    finally:
        batch.unpersist()


def _write(batch, most, batch_id, path, rejects_path, query_id, tz, ledger_path, unwrap_same_key, ranges_path, partials_path, partial_columns) -> None:
    mark = [F.lit(query_id).alias(QUERY_ID), F.lit(batch_id).alias("batch_id")]
    flat = flatten_bounded(batch.filter(F.col(LEVELS).isNotNull()), LEVELS, most, "value", "fields", unwrap_same_key)
    if partials_path:   # read again for them; the other outputs need no flattening
        flat = flat.select("fields", ARRIVAL).persist()
    try:
        events = project_event(flat, "fields", tz, arrival=F.col(ARRIVAL)).select("*", *mark)
        (dealt(events).write
         .option("partitionOverwriteMode", "dynamic").mode("overwrite")
         .partitionBy(S.INGEST_PARTITION, QUERY_ID, "batch_id").parquet(path))
        if rejects_path:
            (batch.filter(F.col(LEVELS).isNull()).select("value", *mark).write
             .option("partitionOverwriteMode", "dynamic").mode("overwrite")
             .partitionBy(QUERY_ID, "batch_id").parquet(rejects_path))
        if ledger_path and {"topic", "partition", "offset"} <= set(batch.columns):
            # per-batch offset ledger (partition|untilOffset per topic), replaced on replay
            (offset_ledger(batch).select("*", *mark).write
             .option("partitionOverwriteMode", "dynamic").mode("overwrite")
             .partitionBy(QUERY_ID, "batch_id").parquet(ledger_path))
        if ranges_path and {"topic", "partition", "offset"} <= set(batch.columns):
            (offset_ranges(batch).select("*", *mark).write
             .option("partitionOverwriteMode", "dynamic").mode("overwrite")
             .partitionBy(QUERY_ID, "batch_id").parquet(ranges_path))
        if partials_path:
            own = events.select(*(F.nullif(F.col(c), F.lit("")).alias(k) for k, c in (PARTIAL_COLUMNS | (partial_columns or {})).items()), S.INGEST_PARTITION)
            write_partials(own.withColumn("grp", ab_group("uid")), F.col(S.INGEST_PARTITION), partials_path, query_id, batch_id)
    finally:
        if partials_path:
            flat.unpersist()


def once(stream: DataFrame, within: str, keys: tuple[str, ...] = ("topic", "partition", "offset")) -> DataFrame:
    """Each message once, however often the source delivers it within ``within`` (e.g. ``1 day``) of arrival.

    Spark keeps the keys seen so far as state, dealt by their hash, and lets them go ``within`` after they came. The clock is the
    arrival time, which Spark stores with a batch's offsets: it never runs backwards, so no message counts as late and none is lost. A row without one of the
    keys can't be told apart from others and would be dropped as their repeat, so it keeps a key of its own: its text."""
    own = F.when(F.greatest(*(F.col(k).isNull().cast("int") for k in keys)) == 1, F.col("value"))
    return (stream.withColumn("_key", own).withColumn("_came", F.current_timestamp()).withWatermark("_came", within)
            .dropDuplicatesWithinWatermark([*keys, "_key"]).drop("_key", "_came"))


def start_ingest(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                 tz: str = S.DEFAULT_TZ, rejects_path: str | None = None,
                 unwrap_same_key: bool = False, query_name: str | None = None,
                 ledger_path: str | None = None, dedup_within: str | None = None, **batch_options):
    """Start the ingest query. ``trigger`` e.g. {"processingTime": "30 seconds"}
    (default) or {"availableNow": True} for a catch-up run. ``dedup_within``: leave out messages that the
    source delivers again within that time (see :func:`once`). ``batch_options``: see :func:`write_batch`.

    The arrival hour is a column of the streaming plan: Spark stores a batch's
    time with its offsets, so a replay gets the same hour. The query id is stored
    in the checkpoint, so another checkpoint writes other partitions.
    """
    started, ids = threading.Event(), []

    def each(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        write_batch(batch, batch_id, path, rejects_path, ids[0], tz, ledger_path, unwrap_same_key, **batch_options)

    if dedup_within:
        stream = once(stream, dedup_within)
    w = (stream.withColumn(ARRIVAL, ingest_hour(tz)).writeStream.option("checkpointLocation", checkpoint).foreachBatch(each))
    w = w.trigger(**(trigger or {"processingTime": "30 seconds"}))
    if query_name:
        w = w.queryName(query_name)
    q = w.start()
    ids.append(q.id)
    started.set()
    return q


def stored_offsets(spark: SparkSession, ledger_path: str) -> str | None:
    """``startingOffsets`` JSON behind everything that the ledger holds, None without a ledger."""
    try:
        ledger = spark.read.parquet(ledger_path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    last = ledger_to_offsets(ledger).groupBy("topic", "partition").agg(F.max("offset").alias("offset"))
    return starting_offsets_json(last)


def read_ingested(spark: SparkSession, path: str) -> DataFrame:
    """The event table as written (45 string columns + query_id, batch_id); partition
    values are read back as text (discovery would turn hours into ints)."""
    df = spark.read.parquet(path)
    return df.withColumn(S.INGEST_PARTITION, F.col(S.INGEST_PARTITION).cast("string"))
