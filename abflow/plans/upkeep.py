"""Registered queries over kept tables: activity bitmaps, hourly partial
aggregates, sketches, the scene index, the bucketed snapshot and the compacted event table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..functions.timefn import epoch_to_hour
from ..operators import activity, partials, sketches
from ..operators.funnel import funnel_daily
from ..operators.groups import with_group
from ..operators.keyed import offset_audit, offset_ranges
from ..session import scratch_path, spread
from ..sources.fixture import ITEM_FIELDS, item_lines, mixed_log_lines, raw_events_json, read_table
from ..sources.logs import with_event_day
from .catalog import ARRIVAL as ARRIVAL_HOUR
from .catalog import DROP_SPLIT, JSON_KEYS, SCENE_REL, START, gblog, register, rel_members
from .oracle import MEMBERS, ORACLE, with_blog

BASE = "20231101"   # of the bitmaps; before the first day, so that windows cross words


def kept_bitmaps(spark, sf_dir):
    """Bitmaps of all but the last two days, then each of those added as its own member day."""
    m = rel_members(spark, sf_dir)
    table = activity.bitmaps(m.filter("dt < '20240129'"), BASE)
    for k, day in enumerate(("dt = '20240129'", "dt >= '20240130'")):
        path = f"{scratch_path(spark, 'bitmaps')}/version={k}"
        activity.advance(table, m.filter(day), BASE).write.parquet(path)
        table = spark.read.parquet(path)
    return table


@register("retention_bitmap")
def q_retention_bitmap(spark, sf_dir):
    """7-day retention of every day from one row per user."""
    return activity.retention(kept_bitmaps(spark, sf_dir), 7, BASE, START)


@register("report_retention_bitmap")
def q_report_retention_bitmap(spark, sf_dir):
    """7 and 30 days in one pass over the bitmaps, as the wide report row."""
    r = activity.retention(kept_bitmaps(spark, sf_dir), (7, 30), BASE, START)
    wide = [F.coalesce(F.max(F.when(F.col("grp") == g, F.col(m))), F.lit(0)).cast("bigint").alias(f"{g.lower()}_{m}")
            for g in ("A", "B") for m in r.columns if m.startswith("user_")]
    return r.groupBy(F.col("dt").alias("date"), F.lit(SCENE_REL).alias("scene_id")).agg(*wide)


ORACLE["retention_bitmap"] = ORACLE["retention_7"]
ORACLE["report_retention_bitmap"] = ORACLE["report_retention_ab"]


@register("user_stats_bitmap")
def q_user_stats_bitmap(spark, sf_dir):
    """New, retained, active and all users per day from one row per user."""
    return activity.user_stats(kept_bitmaps(spark, sf_dir), BASE, START)


ORACLE["user_stats_bitmap"] = with_blog("""
SELECT t.grp, t.dt, CAST(count_if(NOT seen) AS BIGINT) AS user_new, CAST(count_if(seen) AS BIGINT) AS user_remain, count(*) AS user_active,
       CAST((SELECT count(DISTINCT uid) FROM m y WHERE y.grp = t.grp AND y.dt BETWEEN '20240101' AND t.dt) AS BIGINT) AS total_users
FROM (SELECT x.*, EXISTS (SELECT 1 FROM m h WHERE h.grp = x.grp AND h.uid = x.uid AND h.dt >= '20240101' AND h.dt < x.dt) AS seen FROM m x) t
WHERE t.dt >= '20240101' GROUP BY t.grp, t.dt
""", MEMBERS)


def kept_partials(spark, sf_dir):
    """Hourly partials written batch by batch, batches mixing days; two batches are replayed."""
    path = scratch_path(spark, "partials")
    ev = gblog(spark, sf_dir)
    hour = epoch_to_hour(F.col("action_sec").cast("string"), "UTC")
    for b in (0, 1, 2, 1, 0):
        partials.write_partials(ev.filter(F.col("event_id") % 7 % 3 == b), hour, path, "replay", b)
    return partials.read_partials(spark, path)


@register("funnel_from_partials")
def q_funnel_from_partials(spark, sf_dir):
    """The daily funnel from hourly partials, after replayed batches."""
    return partials.funnel(kept_partials(spark, sf_dir), SCENE_REL)


@register("report_from_partials")
def q_report_from_partials(spark, sf_dir):
    """The wide daily report from partials and bitmaps alone."""
    t = kept_partials(spark, sf_dir)
    new = activity.user_stats(activity.bitmaps(partials.members(t, SCENE_REL), BASE), BASE, START)
    return partials.daily_report(t, SCENE_REL, new)


@register("players_from_partials")
def q_players_from_partials(spark, sf_dir):
    """Distinct players per group and day, from compacted partials."""
    return partials.players(partials.compact(kept_partials(spark, sf_dir)), SCENE_REL)


ORACLE["funnel_from_partials"] = ORACLE["funnel_daily_ab"]
ORACLE["report_from_partials"] = ORACLE["report_daily_ab"]
ORACLE["players_from_partials"] = ORACLE["players_ab"]

RANGES = [("20240101", "20240107"), ("20240105", "20240124"), ("20240130", "20240130")]


def kept_sketches(spark, sf_dir):
    """Daily sketches of two halves of the members, merged."""
    m = rel_members(spark, sf_dir)
    half = F.crc32(F.col("uid").cast("binary")) % 2 == 0
    both = reduce(lambda a, b: a.unionByName(b), (sketches.daily(m.filter(x)) for x in (half, ~half)))
    return sketches.merge(both, ["grp", "dt"])


@register("active_sketch")
def q_active_sketch(spark, sf_dir):
    """Distinct users of day ranges from daily sketches (exact up to 65,536 users)."""
    s = kept_sketches(spark, sf_dir)
    return reduce(lambda a, b: a.unionByName(b), (sketches.active(s, a, b).select(F.lit(a).alias("day_from"), F.lit(b).alias("day_to"), "grp", "users") for a, b in RANGES))


@register("retention_sketch")
def q_retention_sketch(spark, sf_dir):
    """7-day retention by intersection and difference of sketches (exact up to 65,536 users)."""
    return sketches.retention(kept_sketches(spark, sf_dir), 7, START)


ORACLE["active_sketch"] = with_blog("\nUNION ALL\n".join(
    f"SELECT '{a}' AS day_from, '{b}' AS day_to, grp, count(DISTINCT uid) AS users FROM m WHERE dt BETWEEN '{a}' AND '{b}' GROUP BY grp" for a, b in RANGES), MEMBERS)
ORACLE["retention_sketch"] = ORACLE["retention_7"]


@register("item_job_bucketed")
def q_item_job_bucketed(spark, sf_dir):
    """The item job over a bucketed snapshot: each dump rewrites only the buckets of its keys."""
    from ..jobs import items_job
    base = scratch_path(spark, "items")
    lines = item_lines(spark, sf_dir, with_rejects=True)
    for k, part in enumerate((lines.filter(F.col("_ts") < "2024-01-16"), lines.filter(F.col("_ts") >= "2024-01-16"))):
        part.select("value").write.text(f"{base}/dump{k}")
        _, out = items_job(spark, f"{base}/dump{k}", ",".join(ITEM_FIELDS), 0, f"{base}/snapshot", f"{base}/export", date=f"run{k}", buckets=16)
    return spark.read.text(out).select(F.col("value").alias("line"))


ORACLE["item_job_bucketed"] = ORACLE["item_job"]


def delivered(spark, sf_dir):
    """The JSON messages (of two hours) as a topic delivers them: partition by event id mod 4, offsets from 0."""
    hour = F.when(F.col("ts") < DROP_SPLIT, ARRIVAL_HOUR["first"]).otherwise(ARRIVAL_HOUR["second"])
    raw = spread(raw_events_json(spark, sf_dir, hour))
    return raw.select("value", F.lit("ev").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
                      F.floor(F.col("event_id") / 4).cast("bigint").alias("offset"), "event_id")


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Each message arrives twice, over two batches and a restart; each is written once."""
    from ..streaming.ingest import read_ingested, start_ingest
    base = scratch_path(spark, "stream_dedup")
    rows = delivered(spark, sf_dir)
    drops = [rows.filter("event_id % 3 <> 2"), rows.filter("event_id % 3 <> 0").unionByName(rows.filter("event_id % 3 <> 1"))]
    for drop in drops:
        drop.drop("event_id").write.mode("append").parquet(f"{base}/in")
        stream = spark.readStream.schema("value string, topic string, partition int, offset long").parquet(f"{base}/in")
        start_ingest(stream, f"{base}/events", f"{base}/ck", trigger={"availableNow": True}, dedup_within="1 day").awaitTermination()
    return read_ingested(spark, f"{base}/events").select(*JSON_KEYS)


@register("ingest_compacted")
def q_ingest_compacted(spark, sf_dir):
    """Two batches, a compaction after each, then a covered batch is replayed."""
    from ..streaming.compact import compact_hours, read_events
    from ..streaming.ingest import ARRIVAL, write_batch
    base = scratch_path(spark, "compacted")
    rows = delivered(spark, sf_dir).withColumn(ARRIVAL, F.lit("2024020100"))
    parts = [rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1")]
    for k, part in enumerate(parts):
        write_batch(part, k, f"{base}/events", None, "q")
        compact_hours(spark, f"{base}/events", f"{base}/compacted", "2024010100", "2024013123" if k else "2024011623")
    write_batch(parts[0], 0, f"{base}/events", None, "q")
    return read_events(spark, f"{base}/events", f"{base}/compacted").select(*JSON_KEYS)


ORACLE["stream_dedup"] = ORACLE["ingest_compacted"] = ORACLE["stream_ingest"]


@register("stream_arrival")
def q_stream_arrival(spark, sf_dir):
    """Messages without an hour of their own take the one of their arrival, the same for a whole batch."""
    from ..streaming.ingest import read_ingested, read_text_stream, start_ingest
    base = scratch_path(spark, "stream_arrival")
    raw = spread(raw_events_json(spark, sf_dir, F.lit(None).cast("string")))
    raw.select("value").write.text(f"{base}/in")
    now = epoch_to_hour(F.unix_timestamp().cast("string"), "Asia/Shanghai")
    began = spark.range(1).select(now.alias("h")).first()[0]
    start_ingest(read_text_stream(spark, f"{base}/in"), f"{base}/events", f"{base}/ck", trigger={"availableNow": True}).awaitTermination()
    ended = spark.range(1).select(now.alias("h")).first()[0]
    ev = read_ingested(spark, f"{base}/events")
    return ev.groupBy("bizType").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("curr_time").between(began, ended)).alias("n_arrival_hour"))


ORACLE["stream_arrival"] = "SELECT event_type AS bizType, count(*) AS n, count(*) AS n_arrival_hour FROM events GROUP BY 1"

@register("scene_indexed")
def q_scene_indexed(spark, sf_dir):
    """The funnel of raw day folders from the files that may hold the scene: three quarters of the lines lie in files of
    few scenes and are indexed, the rest comes later and is unknown to the index."""
    from ..sources import scene_index
    path, index = scratch_path(spark, "scene-logs"), scratch_path(spark, "scene-index")
    lines = mixed_log_lines(spark, sf_dir)
    late = F.crc32("value") % 4 == 0
    lines.filter(~late).repartition("dt", F.get(F.split("value", "\t"), F.lit(2))).write.partitionBy("dt").text(path)
    scene_index.update(spark, path, index, folder_prefix="dt=")
    lines.filter(late).hint("rebalance", "dt").write.mode("append").partitionBy("dt").text(path)
    rows = scene_index.read_scene_log(spark, path, index, SCENE_REL, folder_prefix="dt=", min_fields=5)
    return funnel_daily(with_group(with_event_day(rows, "UTC")), by=("grp", "folder_dt", "dt"))


ORACLE["scene_indexed"] = ORACLE["funnel_from_logs"]

RANGE = 100   # offsets of a batch in the audit


@register("offset_audit")
def q_offset_audit(spark, sf_dir):
    """Of every five batches one is lost, one lost its 51st message, and one read the ten messages before it again."""
    ev = read_table(spark, sf_dir, "events").select(F.lit("ev").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"), F.floor(F.col("event_id") / 4).cast("bigint").alias("offset"))
    ev = ev.withColumn("batch_id", F.floor(F.col("offset") / RANGE))
    turn, at = F.col("batch_id") % 5, F.col("offset") % RANGE
    again = ev.filter((turn == 4) & (at >= 90)).withColumn("batch_id", F.col("batch_id") + 1)
    more = ev.groupBy("topic", "partition").agg(F.max("batch_id").alias("_last"))
    again = again.join(more, ["topic", "partition"]).filter("batch_id <= _last").drop("_last")
    read = ev.filter((turn != 2) & ~((turn == 4) & (at == 50))).unionByName(again)
    return offset_audit(offset_ranges(read, ["batch_id"]))


ORACLE["offset_audit"] = f"""
WITH p AS (SELECT CAST(event_id % 4 AS INTEGER) AS part, max(event_id // 4) AS top FROM events GROUP BY 1),
b AS (SELECT part, top, unnest(generate_series(0, top // {RANGE})) AS b FROM p),
f AS (SELECT part, 'gap' AS kind, b * {RANGE} AS low, (b + 1) * {RANGE} AS high, {RANGE} AS n FROM b WHERE b % 5 = 2 AND top >= (b + 1) * {RANGE}
      UNION ALL SELECT part, 'overlap', b * {RANGE} - 10, b * {RANGE}, 10 FROM b WHERE b % 5 = 0 AND b > 0
      UNION ALL SELECT part, 'hole', b * {RANGE}, least((b + 1) * {RANGE}, top + 1), 1 FROM b WHERE b % 5 = 4 AND top > b * {RANGE} + 50)
SELECT 'ev' AS topic, part AS "partition", kind, CAST(low AS BIGINT) AS low, CAST(high AS BIGINT) AS high, CAST(n AS BIGINT) AS n FROM f
"""
