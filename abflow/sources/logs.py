"""Behaviour-log source: ``<path>/<yyyyMMdd>/*`` tab-separated text.

All days of a range are read by ONE scan (a brace glob over the day
folders), the folder day comes from the file path, and each line is
split once into an array that every field reads from. Nothing loops
over days on the driver.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.fields import field, split_keep


def day_list(start: str, end: str) -> list[str]:
    """Calendar days start..end (``yyyyMMdd``). Bounded by the range, not the data."""
    d0 = date(int(start[:4]), int(start[4:6]), int(start[6:]))
    d1 = date(int(end[:4]), int(end[4:6]), int(end[6:]))
    return [(d0 + timedelta(days=i)).strftime("%Y%m%d") for i in range((d1 - d0).days + 1)]


def day_glob(path: str, start: str | None, end: str | None, prefix: str = "") -> str:
    path = path.rstrip("/")
    if start is None or end is None:
        return f"{path}/{prefix}[0-9]*/*"
    return f"{path}/{{{','.join(prefix + d for d in day_list(start, end))}}}/*"


def with_folder_day(lines: DataFrame) -> DataFrame:
    """(value, dt) of lines just read: the day of the folder that their file is in."""
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/[^/]*?([0-9]{8})/[^/]*$", 1)
    return lines.select("value", folder.alias("dt"))


def read_log_text(spark: SparkSession, path: str, start: str | None = None,
                  end: str | None = None, folder_prefix: str = "") -> DataFrame:
    """Lines of every day folder in [start, end] -> (value, dt), one scan.

    Day folders are ``<path>/<prefix><yyyyMMdd>/``; ``folder_prefix='dt='``
    reads folders written by ``partitionBy('dt')``.
    """
    from pyspark.errors import AnalysisException
    try:
        df = spark.read.text(day_glob(path, start, end, folder_prefix))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND" or start is None or end is None:
            raise
        # days may be missing under an existing root; a root without any day folder fails here
        spark.read.text(day_glob(path, None, None, folder_prefix))
        return spark.createDataFrame([], "value string, dt string")
    return with_folder_day(df)


def parse_log_lines(lines: DataFrame, min_fields: int = S.LOG_FIELDS) -> DataFrame:
    """(value, dt) lines -> behaviour-log columns; split once with limit -1.

    Adds ``n_fields``; rows shorter than ``min_fields`` keep nulls in the
    missing positions and are separated by :func:`valid_rows`.
    """
    f = split_keep("value", "\t")
    return (lines.select(f.alias("_f"), *[c for c in lines.columns if c != "value"])
            .select(
                field("_f", S.F_UID).alias("uid"),
                field("_f", S.F_UNUSED).alias("aux"),
                field("_f", S.F_SCENE).alias("scene_id"),
                field("_f", S.F_ACTION).alias("action_type"),
                F.trim(field("_f", S.F_TIME)).try_cast("bigint").alias("action_sec"),
                field("_f", S.F_TIME).alias("action_time_text"),
                field("_f", S.F_EXT).alias("ext"),
                field("_f", S.F_SLOTS).alias("rec_pos"),
                field("_f", S.F_SLOT_TYPES).alias("rec_type"),
                F.size("_f").alias("n_fields"),
                *[c for c in lines.columns if c != "value"]))


def valid_rows(df: DataFrame, min_fields: int = S.LOG_FIELDS,
               observation: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """Split parsed rows into (valid, rejects) by field count.

    A line with no text at all is dropped silently (as the analysed jobs
    do); a short line is a reject. When an ``Observation`` is given the
    reject count is recorded on the valid frame's first action, without
    an extra pass.
    """
    blank = F.col("n_fields") <= 1
    blank = blank & (F.coalesce(F.col("uid"), F.lit("")) == "")
    ok = F.col("n_fields") >= min_fields
    valid = df.filter(ok)
    if observation is not None:
        valid = df.observe(observation, F.count_if(~ok & ~blank).alias("rejects"),
                           F.count_if(ok).alias("valid")).filter(ok)
    rejects = df.filter(~ok & ~blank)
    return valid, rejects


def with_event_day(df: DataFrame, tz: str = S.DEFAULT_TZ) -> DataFrame:
    """``folder_dt`` = the folder day, ``dt`` = the event day of the
    epoch-seconds field in ``tz``. Every row stays: a late line keeps both
    days, a missing or unreadable time has the event day 未知."""
    from ..functions.timefn import epoch_to_date
    ev = F.coalesce(epoch_to_date(F.col("action_time_text"), tz), F.lit(S.UNKNOWN_TIME))
    return df.withColumn("folder_dt", F.col("dt")).withColumn("dt", ev)


def read_behavior_log(spark: SparkSession, path: str, start: str | None = None,
                      end: str | None = None, folder_prefix: str = "",
                      min_fields: int = S.LOG_FIELDS, rejects_path: str | None = None) -> DataFrame:
    """Behaviour-log rows of all days in [start, end] with at least the
    ``min_fields`` fields that the caller reads, one scan. With
    ``rejects_path`` the shorter lines are written there by folder day
    (a second, filtered pass) before the rows are returned."""
    parsed = parse_log_lines(read_log_text(spark, path, start, end, folder_prefix))
    valid, rejects = valid_rows(parsed, min_fields)
    if rejects_path:
        (rejects.select("uid", "scene_id", "action_type", "action_time_text", "n_fields", "dt")
         .write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("dt").parquet(rejects_path))
    return valid
