"""Behaviour logs derived from the shared test tables.

``blog`` turns the ``events`` table into the behaviour-log shape the
operators read (uid, scene, action code, epoch seconds, day, watch and
duration seconds, slot and slot-type lists). ``log_lines`` renders the
same rows as the raw tab-separated text the production jobs read, and
``raw_events_json`` renders them as nested JSON messages for the ingest
path. All three are plain projections, so they scale with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def blog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The behaviour-log view of ``events`` (see FIXTURES.md §3)."""
    ev = read_table(spark, sf_dir, "events")
    k = F.col("k")
    return (ev.withColumn("k", _k())
            .select(
                "event_id",
                F.concat(F.col("user_id").cast("string"), F.lit("_"),
                         (F.col("event_id") % 37).cast("string")).alias("uid"),
                F.when(F.col("event_id") % 3 == 0, "S_NEWS")
                 .when(F.col("event_id") % 3 == 1, "S_REL")
                 .otherwise("S_OTHER").alias("scene_id"),
                F.when(F.col("event_type") == "view", "1")
                 .when(F.col("event_type") == "click", "2")
                 .when(F.col("event_type") == "signup", "3")
                 .when(F.col("event_type") == "purchase", "6")
                 .otherwise("9").alias("action_type"),
                F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                                 F.col("ts")).alias("action_sec"),
                F.date_format("ts", "yyyyMMdd").alias("dt"),
                F.floor("value").cast("bigint").alias("watch_s"),
                k.cast("bigint").alias("dur_s"),
                F.concat((k % 10 + 1).cast("string"), F.lit(";"),
                         ((k + 3) % 10 + 1).cast("string")).alias("rec_pos"),
                F.concat((k % 2 + 1).cast("string"), F.lit(";"),
                         ((k / 10).cast("int") % 2 + 1).cast("string")).alias("rec_type"),
            ))


def ext_text(df: DataFrame) -> Column:
    """The ext field of a raw log line: ``v:<version>,p:<product>,w:<watch>,x:0,y:0,d:<duration>``.

    Version and product vary with event id and uid so the release filter
    has something to keep and to drop (FIXTURES.md §3c).
    """
    version = F.when(F.col("event_id") % 2 == 0, "V2.1").otherwise("V1.0")
    uid_num = F.split("uid", "_").getItem(0).cast("bigint")
    product = (F.when(uid_num % 3 == 0, "SC823").when(uid_num % 3 == 1, "SC818")
               .otherwise("SC999"))
    return F.concat(F.lit("v:"), version, F.lit(",p:"), product,
                    F.lit(",w:"), F.col("watch_s").cast("string"), F.lit(",x:0,y:0,d:"),
                    F.col("dur_s").cast("string"))


def log_lines(spark: SparkSession, sf_dir: str, with_rejects: bool = False) -> DataFrame:
    """Raw tab-separated behaviour-log lines (``value``) plus their folder day ``dt``.

    Fields: 0 uid, 1 event id, 2 scene, 3 action, 4 epoch seconds,
    5 ext, 6 slot list, 7 slot-type list. With ``with_rejects`` the lines
    of error events are cut after field 4 (malformed lines).
    """
    b = blog(spark, sf_dir)
    head = [F.col("uid"), F.col("event_id").cast("string"), F.col("scene_id"), F.col("action_type"),
            F.col("action_sec").cast("string")]
    line = F.concat_ws("\t", *head, ext_text(b), F.col("rec_pos"), F.col("rec_type"))
    if with_rejects:
        line = F.when(F.col("action_type") == "9", F.concat_ws("\t", *head)).otherwise(line)
    return b.select(line.alias("value"), "dt")


def mixed_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log lines as they come: by event id mod 10, 1 is a day late (the folder of the day
    before), 2 has 7 fields, 3 has 6, 4 has 5, 5 an empty time, 6 a time out of range, 7 has 3
    fields, 8 has 2; the others are whole."""
    b = blog(spark, sf_dir)
    kind = F.col("event_id") % 10
    sec = F.when(kind == 5, "").when(kind == 6, "9999999999999999").otherwise(F.col("action_sec").cast("string"))
    f = F.array(F.col("uid"), F.col("event_id").cast("string"), F.col("scene_id"), F.col("action_type"), sec,
                ext_text(b), F.col("rec_pos"), F.col("rec_type"))
    size = F.when(kind == 2, 7).when(kind == 3, 6).when(kind == 4, 5).when(kind == 7, 3).when(kind == 8, 2).otherwise(8)
    folder = F.when(kind == 1, F.date_format(F.date_sub(F.to_date("dt", "yyyyMMdd"), 1), "yyyyMMdd")).otherwise(F.col("dt"))
    return b.select(F.array_join(F.slice(f, 1, size), "\t").alias("value"), folder.alias("dt"))


ITEM_FIELDS = ["user_id", "event_id", "event_type", "ts", "value"]


def item_lines(spark: SparkSession, sf_dir: str, with_rejects: bool = False) -> DataFrame:
    """Media-item style dump lines from ``events``: user_id (the row key),
    event_id, event_type, ts text, value. With ``with_rejects`` error
    events carry one extra field (wrong field count)."""
    ev = read_table(spark, sf_dir, "events")
    parts = [F.col("user_id").cast("string"), F.col("event_id").cast("string"), F.col("event_type"),
             F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.col("value").cast("string")]
    line = F.concat_ws("\t", *parts)
    if with_rejects:
        line = F.when(F.col("event_type") == "error", F.concat(line, F.lit("\textra"))).otherwise(line)
    return ev.select(line.alias("value"), F.col("ts").alias("_ts"))


def raw_events_json(spark: SparkSession, sf_dir: str, curr_time: Column | None = None) -> DataFrame:
    """Nested JSON messages (``value``) built from ``events`` (FIXTURES.md §3b).

    ``curr_time`` defaults to the event hour; a stream test passes the
    arrival hour of the drop a message arrives in.
    """
    ev = read_table(spark, sf_dir, "events")
    hour = curr_time if curr_time is not None else F.date_format("ts", "yyyyMMddHH")
    msg = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("eventId"),
        F.col("event_type").alias("bizType"),
        F.struct(F.col("user_id").cast("string").alias("userId"),
                 F.struct(F.concat(F.lit("m"), F.col("user_id").cast("string")).alias("mac"),
                          F.lit("shadow").alias("eventId")).alias("dev")).alias("user"),
        F.array(F.struct(F.lit("p").alias("id")),
                F.struct((F.col("event_id") % 7).cast("string").alias("id"))).alias("lst"),
        F.array(F.lit(1), F.lit(2)).alias("ids"),
        F.lit('{"x":1}').alias("name"),
        hour.alias("curr_time"),
    ))
    return ev.select(F.col("event_id"), F.col("ts"), msg.alias("value"))
