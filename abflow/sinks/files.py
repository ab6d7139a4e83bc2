"""Sinks: partitioned appends and re-runnable overwrites, report and
totals writers through any format, and the dated TSV export.

A re-run of a member write replaces only the partitions it carries (dynamic
partition overwrite). Report and total writes append, as the analysed jobs do: a
re-run adds its rows again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_partitioned(df: DataFrame, path: str, by: list[str] | str, mode: str = "append",
                      fmt: str = "parquet") -> None:
    """Dynamic-partition write (e.g. the event table by ``curr_time``).

    Rows are clustered by the partition columns first (an AQE rebalance:
    a partition value holding most rows is split over several writers,
    small ones are merged) so each task writes few files.
    """
    by = [by] if isinstance(by, str) else list(by)
    (df.hint("rebalance", *by).write.mode(mode).format(fmt).partitionBy(*by).save(path))


def write_members(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Members (grp, dt, uid) partitioned by (grp, dt), both groups and all
    days in one write; a re-run replaces exactly the (grp, dt) partitions
    it writes (``partitionOverwriteMode=dynamic`` set on the write)."""
    (df.select("uid", "grp", "dt").hint("rebalance", "grp", "dt").write
     .option("partitionOverwriteMode", "dynamic").mode("overwrite")
     .format(fmt).partitionBy("grp", "dt").save(path))


def write_report(df: DataFrame, fmt: str = "parquet", path: str | None = None,
                 mode: str = "append", as_text: bool = False, **options) -> None:
    """Report rows to any sink format (a document-store connector in
    production, parquet / json in tests). ``as_text`` casts metrics to
    strings for sinks that store text."""
    if as_text:
        df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    w = df.write.format(fmt).mode(mode).options(**options)
    w.save(path) if path else w.save()


def write_totals(df: DataFrame, fmt: str = "jdbc", path: str | None = None,
                 mode: str = "append", **options) -> None:
    """Cumulative totals ``(date, user_num)`` (JDBC in production)."""
    write_report(df.select("date", "user_num"), fmt, path, mode, **options)


def tsv_line(fields: list[str], missing: str = "null") -> Column:
    """Each field followed by a tab (so the line ends with one); a null or
    absent field is written as the text ``null``."""
    return F.concat(F.concat_ws("\t", *[F.coalesce(F.col(f).cast("string"), F.lit(missing))
                                       for f in fields]), F.lit("\t"))


def yesterday(tz: str = "Asia/Shanghai") -> str:
    """Yesterday's ``yyyyMMdd`` in ``tz`` (driver clock; a folder name only)."""
    from datetime import datetime, timedelta
    from zoneinfo import ZoneInfo
    return (datetime.now(ZoneInfo(tz)) - timedelta(days=1)).strftime("%Y%m%d")


def export_tsv(df: DataFrame, fields: list[str], path: str, date: str | None = None,
               single_file: bool = False, tz: str = "Asia/Shanghai") -> str:
    """Write the snapshot as TSV lines under ``<path>/<date>`` (default:
    yesterday in ``tz``).

    ``single_file`` coalesces to one output file (one task writes all; use
    only when a single file is required downstream).
    """
    date = date or yesterday(tz)
    have = set(df.columns)
    cols = [F.col(f) if f in have else F.lit(None).cast("string").alias(f) for f in fields]
    out = df.select(*cols).select(tsv_line(fields).alias("value"))
    if single_file:
        out = out.coalesce(1)
    target = f"{path.rstrip('/')}/{date}"
    out.write.mode("overwrite").text(target)
    return target
