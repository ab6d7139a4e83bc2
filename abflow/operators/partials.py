"""Hourly partial aggregates: reports that never read the events again.

The table has one row per (hour, grp, scene, uid) and source batch, with that
user's action counts. Counts merge by adding; the rows' uids are the state of the distinct
counts, so users and players of any span of hours, groups and scenes are
exact. A batch replaces its own partition when it is written again, so a replay
changes nothing; late events arrive as rows of their hour in a later batch.

A user's events of an hour become one row in the writing task already
(partial aggregation), so a hot uid, scene or hour never meets in one task whole.

Defined cases: rows without a group (no uid) are left out; a null scene stays a scene of its own; an
unreadable or missing time has the hour 未知 and its rows the day 未知; an empty batch writes nothing and
leaves what it wrote before only if it is the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from .filters import action_cond

COUNTS = ["exposures", "clicks", "orders", "plays", "plays_like"]
KEYS = ["hour", "grp", "scene_id", "uid"]
BATCH = ["source", "batch_id"]


def partials(events: DataFrame, hour: Column) -> DataFrame:
    """(hour, grp, scene_id, uid, counts) of event rows (grp, scene_id, uid, action_type)."""
    rows = events.filter("grp is not null").withColumn("hour", F.coalesce(hour, F.lit(S.UNKNOWN_TIME)))
    return rows.groupBy(*KEYS).agg(
        F.count_if(action_cond(S.ACTION_EXPOSURE, "numeric")).alias("exposures"), F.count_if(action_cond(S.ACTION_CLICK, "numeric")).alias("clicks"),
        F.count_if(action_cond(S.ACTION_ORDER, "numeric")).alias("orders"), F.count_if(action_cond(S.ACTION_PLAY)).alias("plays"),
        F.count_if(action_cond(S.ACTION_PLAY, "contains")).alias("plays_like"))


def write_partials(events: DataFrame, hour: Column, path: str, source: str, batch_id: int) -> None:
    """Write one batch's partial rows; the batch's partition is replaced as a whole."""
    rows = partials(events, hour).withColumns({"source": F.lit(source), "batch_id": F.lit(batch_id)})
    rows.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(*BATCH).parquet(path)


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(*BATCH)


def compact(table: DataFrame) -> DataFrame:
    """The same table with one row per (hour, grp, scene, uid)."""
    return table.groupBy(*KEYS).agg(*(F.sum(c).alias(c) for c in COUNTS))


def _day() -> Column:
    return F.when(F.col("hour") == S.UNKNOWN_TIME, F.col("hour")).otherwise(F.substring("hour", 1, 8))


def funnel(table: DataFrame, scene: str | None = None, by: tuple[str, ...] = ("grp", "dt")) -> DataFrame:
    """Exposures, clicks, distinct users and orders, from partial rows alone; ``by``: of grp, dt, hour, scene_id."""
    t = table if scene is None else table.filter(F.col("scene_id") == scene)
    return t.withColumn("dt", _day()).groupBy(*by).agg(
        F.sum("exposures").alias("exposures"), F.sum("clicks").alias("clicks"), F.count_distinct("uid").alias("users"), F.sum("orders").alias("orders"))


def players(table: DataFrame, scene: str | None = None, by: tuple[str, ...] = ("grp", "dt")) -> DataFrame:
    t = table if scene is None else table.filter(F.col("scene_id") == scene)
    return t.filter("plays > 0").withColumn("dt", _day()).groupBy(*by).agg(F.count_distinct("uid").alias("players"))


def members(table: DataFrame, scene: str) -> DataFrame:
    """Distinct (grp, dt, uid) of a scene."""
    return table.filter(F.col("scene_id") == scene).select("grp", _day().alias("dt"), "uid").dropDuplicates(["grp", "dt", "uid"])


def daily_report(table: DataFrame, scene: str, new_users: DataFrame) -> DataFrame:
    """The wide daily report from partial rows; ``new_users``: (grp, dt, user_new) of a day, from
    the activity bitmaps or the first-seen table."""
    per = table.filter(F.col("scene_id") == scene).withColumn("dt", _day()).groupBy("dt", "grp").agg(
        F.sum("exposures").alias("expose"), F.sum("clicks").alias("click"), F.count_distinct("uid").alias("user_active"),
        F.sum("orders").alias("order"), F.sum("plays_like").alias("play"))
    rows = per.join(new_users.select("grp", "dt", "user_new"), ["grp", "dt"], "left")
    wide = rows.groupBy("dt").agg(*(F.max(F.when(F.col("grp") == g, F.col(m))).alias(f"{g.lower()}_{m}") for g in ("A", "B") for m in S.DAILY_REPORT_METRICS))
    return wide.select(F.col("dt").alias("date"), F.lit(scene).alias("scene_id"),
                       *(F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in S.DAILY_REPORT_FIELDS[2:]))
