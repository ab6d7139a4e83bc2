"""Table-shaped sources: date spine, membership ranges, cumulative
totals, media items and keyed snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fields import split_keep
from ..functions.groups import label
from ..functions.timefn import date_range_days, date_to_day, day_to_date


def date_spine(df: DataFrame, start: str | None = None, end: str | None = None,
               day_col: str = "dt") -> DataFrame:
    """All calendar days (``dt``) from start to end; missing bounds come from
    the min / max day of ``df``. One row is exploded, no loop."""
    if start is not None and end is not None:
        base = df.sparkSession.range(1).select(date_range_days(start, end).alias("_d"))
        return base.select(F.explode("_d").alias("dt"))
    b = df.agg(F.min(day_col).alias("_lo"), F.max(day_col).alias("_hi"))
    lo = F.lit(start) if start is not None else F.col("_lo")
    hi = F.lit(end) if end is not None else F.col("_hi")
    seq = F.sequence(day_to_date(lo), day_to_date(hi), F.expr("INTERVAL 1 DAY"))
    return b.select(F.explode(seq).alias("_d")).select(date_to_day("_d").alias("dt"))


def date_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Days start..end as rows (``dt``); replaces a driver loop over dates."""
    return date_spine(spark.range(1), start, end)


def members(df: DataFrame, grp: str, d1: str, d2: str, inclusive_end: bool = True) -> DataFrame:
    """Members of group ``grp`` with ``d1 <= dt <= d2`` (``< d2`` when not
    inclusive). On a table partitioned by (grp, dt) both predicates are
    partition filters. A legacy ``time`` label column is also accepted."""
    if "grp" in df.columns:
        hi = F.col("dt") <= d2 if inclusive_end else F.col("dt") < d2
        return df.filter((F.col("grp") == grp) & (F.col("dt") >= d1) & hi)
    lo_l, hi_l = f"{grp}-{d1}", f"{grp}-{d2}"
    hi = F.col("time") <= hi_l if inclusive_end else F.col("time") < hi_l
    return df.filter((F.col("time") >= lo_l) & hi)


def read_totals(spark: SparkSession, fmt: str = "jdbc", path: str | None = None,
                **options) -> DataFrame:
    """Cumulative totals ``(date, user_num)`` through any reader format
    (``jdbc`` with url/dbtable/user/password in production, parquet in tests)."""
    r = spark.read.format(fmt).options(**options)
    return r.load(path) if path else r.load()


def read_items(spark: SparkSession, path: str, fields: list[str] | str, sep: str = "\t",
               field_sep_regex: str = ",") -> DataFrame:
    """Media-item dump -> one row per line with exactly ``len(fields)`` fields.

    ``fields`` may be the runtime field-list string, split by
    ``field_sep_regex``. Lines are read splittably (no whole-file records).
    """
    if isinstance(fields, str):
        import re
        fields = [f for f in re.split(field_sep_regex, fields)]
    lines = spark.read.option("lineSep", "\n").text(path)
    return name_fields(lines, fields, sep)


def name_fields(lines: DataFrame, fields: list[str], sep: str = "\t",
                key_index: int | None = None) -> DataFrame:
    """(value) lines -> named string columns; rows whose field count differs
    are dropped. ``key_index`` adds ``row_key`` = that field (the upsert key)."""
    arr = split_keep("value", sep)
    keep = lines.select(arr.alias("_f"), F.col("value")).filter(F.size("_f") == len(fields))
    cols = [F.col("_f")[i].alias(f) for i, f in enumerate(fields)]
    if key_index is not None:
        cols.append(F.col("_f")[int(key_index)].alias("row_key"))
    return keep.select(*cols)


def item_rejects(lines: DataFrame, fields: list[str], sep: str = "\t") -> DataFrame:
    arr = split_keep("value", sep)
    return lines.filter(F.size(arr) != len(fields))


def read_snapshot(spark: SparkSession, source: str, fields: list[str], fmt: str = "parquet",
                  **options) -> DataFrame:
    """Current keyed table, listed columns only (pruned at the scan);
    a missing column reads as null."""
    if fmt == "table":
        df = spark.read.table(source)
    else:
        df = spark.read.format(fmt).options(**options).load(source)
    have = set(df.columns)
    return df.select(*[F.col(f) if f in have else F.lit(None).cast("string").alias(f) for f in fields])
