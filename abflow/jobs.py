"""Runnable jobs: the seven batch / streaming jobs of the analysed system,
each one declarative plan over the whole date range.

    python -m abflow.jobs <job> --help

Every job reads and writes through format names, so the same code runs on
parquet / json / text in tests and on the production connectors.
"""

from __future__ import annotations

import argparse
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema as S
from .functions.fields import watch_fields
from .operators import activity, snapshot
from .operators.filters import action_cond, by_release, by_scene
from .operators.groups import members_daily, with_group
from .operators.keyed import load_order, upsert_by_key
from .operators.retention import advance_first_seen, first_seen, user_metrics, user_stats_daily
from .plans.reports import daily_report, news_report, retention_report
from .session import ensure_checkpoint_dir
from .sinks.files import export_tsv, write_members, write_report, write_totals
from .sources.logs import read_behavior_log, with_event_day
from .sources.scene_index import read_scene_log
from .sources.scene_index import update as update_scene_index
from .sources.tables import read_items, read_snapshot, read_totals
from .streaming.compact import compact_hours
from .streaming.ingest import read_event_stream, read_text_stream, start_ingest, stored_offsets


# fields that a line must have: the last one that the job reads always, plus one
REL_SPLIT_FIELDS = S.F_SCENE + 1
FUNNEL_FIELDS = S.F_TIME + 1
NEWS_FIELDS = S.F_EXT + 1


def scene_log(spark, path, start, end, scene, folder_prefix, min_fields, rejects=None, scene_index=None):
    """One scene's rows of the day folders. With ``scene_index`` (kept by ``scene-index``) only files that may hold
    the scene are read, so short lines of the others can't be reported."""
    if scene_index and rejects:
        raise ValueError("rejects need every file: give either rejects or a scene index")
    if scene_index:
        return read_scene_log(spark, path, scene_index, scene, start, end, folder_prefix, min_fields)
    return by_scene(read_behavior_log(spark, path, start, end, folder_prefix, min_fields, rejects), scene)


def news_members_job(spark, path, start, end, out, version, folder_prefix="", scene=S.SCENE_NEWS, rejects=None):
    """News uid split: release + scene filter, distinct uids of each folder day, groups qianA / qianB."""
    lg = read_behavior_log(spark, path, start, end, folder_prefix, NEWS_FIELDS, rejects)
    write_members(members_daily(lg, scene, version=version, a="qianA", b="qianB"), out)


def rel_members_job(spark, path, start, end, out, scene=S.SCENE_RELATED, folder_prefix="", rejects=None):
    """Related-recommendation uid split into groups A / B for every folder day."""
    lg = read_behavior_log(spark, path, start, end, folder_prefix, REL_SPLIT_FIELDS, rejects)
    write_members(members_daily(lg, scene), out)


def news_metrics_job(spark, path, start, end, out, version, fmt="parquet",
                     folder_prefix="", scene=S.SCENE_NEWS, slot_match="whole", rejects=None, scene_index=None, **options):
    """News metrics per folder day: AI-slot exposures, watch sum / mean, plays. A line
    without slot fields has no slots."""
    lg = scene_log(spark, path, start, end, scene, folder_prefix, NEWS_FIELDS, rejects, scene_index)
    lg = watch_fields(by_release(with_group(lg), version))
    write_report(news_report(lg, slot_match=slot_match), fmt, out, **options)


def rel_metrics(lg: DataFrame) -> DataFrame:
    """Funnel counts per (folder day, group, event day) and players per (folder day,
    group), from one scan by grouping sets; ``dt`` is null in the players' rows."""
    sets = [["folder_dt", "grp", "dt"], ["folder_dt", "grp"]]
    play = action_cond(S.ACTION_PLAY)
    return lg.groupingSets([[F.col(c) for c in x] for x in sets], "folder_dt", "grp", "dt").agg(
        F.count_if(action_cond(S.ACTION_EXPOSURE, "numeric")).alias("exposures"),
        F.count_if(action_cond(S.ACTION_CLICK, "numeric")).alias("clicks"),
        F.count_distinct("uid").alias("users"),
        F.count_if(action_cond(S.ACTION_ORDER, "numeric")).alias("orders"),
        F.count_distinct(F.when(play, F.col("uid"))).alias("players"),
        F.grouping("dt").alias("whole_folder"))


def rel_metrics_job(spark, path, start, end, members_path, out, history_start=S.HISTORY_START,
                    scene=S.SCENE_RELATED, fmt="parquet", tz=S.DEFAULT_TZ, folder_prefix="", rejects=None, scene_index=None, **options):
    """Click-anchored A / B funnel reports by folder day and event day (late lines have
    rows of their own), 7-day retention, and players by folder day."""
    lg = scene_log(spark, path, start, end, scene, folder_prefix, FUNNEL_FIELDS, rejects, scene_index)
    lg = with_group(with_event_day(lg, tz))
    ensure_checkpoint_dir(spark)
    all_ = rel_metrics(lg).checkpoint(eager=True)   # a row per day and group: the scan runs once
    for g in ("A", "B"):
        rows = all_.filter((F.col("whole_folder") == 0) & (F.col("grp") == g) & (F.col("clicks") > 0))
        report = rows.select("folder_dt", F.col("dt").alias("action_time"), F.nullif("users", F.lit(0)).alias(f"userNum{g}"),
                             F.nullif("exposures", F.lit(0)).alias(f"exposure{g}"), F.col("clicks").alias(f"clickNum{g}"),
                             F.nullif("orders", F.lit(0)).alias(f"orderNum{g}"))
        write_report(report.orderBy("folder_dt", "action_time"), fmt, f"{out}/funnel_{g.lower()}", **options)
    m = spark.read.parquet(members_path)
    write_report(retention_report(m, scene, history_start, start, end, windows=(7,)), fmt,
                 f"{out}/retention", **options)
    played = all_.filter((F.col("whole_folder") == 1) & (F.col("players") > 0))
    write_report(played.select("grp", F.col("folder_dt").alias("dt"), "players"), fmt, f"{out}/players", **options)


def rel_reports_job(spark, path, start, end, members_path, out_daily, out_retention,
                    history_start=S.HISTORY_START, scene=S.SCENE_RELATED, fmt="parquet",
                    folder_prefix="", as_text=True, rejects=None, first_seen_path=None, groups=("A", "B"), **options):
    """Wide daily and retention (7, 30) report rows, one per folder day.

    With ``first_seen_path`` (kept by :func:`first_seen_job`) only member days of
    [start - 59, end] are read, whatever the length of the history."""
    lg = with_group(read_behavior_log(spark, path, start, end, folder_prefix, FUNNEL_FIELDS, rejects))
    m = spark.read.parquet(members_path).withColumn("dt", F.col("dt").cast("string"))
    seen = read_version(spark, first_seen_path)[0] if first_seen_path else None
    days = m.filter(F.col("dt").between(start, end)) if seen is not None else m
    daily = daily_report(lg, scene, history_start, members=days, groups=groups, first_seen=seen).filter(F.col("date").between(start, end))
    write_report(daily, fmt, out_daily, as_text=as_text, **options)
    write_report(retention_report(m, scene, history_start, start, end, groups=groups, first_seen=seen), fmt, out_retention,
                 as_text=as_text, **options)


def first_seen_job(spark, members_path, first_seen_path, start, end, history_start=S.HISTORY_START):
    """Bring the first-seen table up to ``end`` with the member days [start, end] alone."""
    m = spark.read.parquet(members_path).withColumn("dt", F.col("dt").cast("string")).filter(F.col("dt").between(start, end))
    now, version = read_version(spark, first_seen_path)
    new = first_seen(m, history_start) if now is None else advance_first_seen(now, m, history_start)
    return write_version(new, first_seen_path, version + 1)


def bitmaps_job(spark, members_path, bitmaps_path, start, end, base):
    """Bring the activity bitmaps up to ``end`` with the member days [start, end] alone."""
    m = spark.read.parquet(members_path).withColumn("dt", F.col("dt").cast("string")).filter(F.col("dt").between(start, end))
    now, version = read_version(spark, bitmaps_path)
    new = activity.bitmaps(m, base) if now is None else activity.advance(now, m, base)
    return write_version(new, bitmaps_path, version + 1)


def news_retention_job(spark, members_path, out, scene=S.SCENE_NEWS, history_start=S.HISTORY_START, start=None, end=None,
                       groups=("qianA", "qianB"), windows=(7,), fmt="parquet", bitmaps_path=None, base=None, **options):
    """n-day retention of the news groups: from the member days, or with ``bitmaps_path`` (kept by
    :func:`bitmaps_job`) from one row per user."""
    if bitmaps_path:
        rows = activity.retention(read_version(spark, bitmaps_path)[0], tuple(windows), base, history_start, start, end)
        rows = rows.select(F.col("dt").alias("date"), F.lit(scene).alias("scene_id"), *[c for c in rows.columns if c != "dt"])
    else:
        m = spark.read.parquet(members_path).withColumn("dt", F.col("dt").cast("string"))
        rows = retention_report(m, scene, history_start, start, end, windows=tuple(windows), groups=groups)
    write_report(rows, fmt, out, **options)


def user_metrics_job(spark, members_path, first_seen_path, day, out, totals_read, totals_write, history_start=S.HISTORY_START):
    """New, retained and active users of a day, and the running total: yesterday's total
    is read, today's written (``totals_read`` / ``totals_write``: format, path and options
    of the totals table). A group without yesterday's total is reported with
    the text ``missing`` and writes none."""
    m = spark.read.parquet(members_path).withColumn("dt", F.col("dt").cast("string")).filter(F.col("dt") == day)
    st = user_stats_daily(m, history_start, first_seen=read_version(spark, first_seen_path)[0])
    ensure_checkpoint_dir(spark)
    rows = user_metrics(st, read_totals(spark, **totals_read)).checkpoint(eager=True)   # two rows, read before the write
    write_report(rows, "parquet", out)
    write_totals(rows.filter("total_users is not null").select("date", "user_num"), **totals_write)


def read_version(spark, path) -> tuple[DataFrame | None, int]:
    """The newest ``version=<n>`` folder of a versioned table and n; (None, 0) if there is none.
    Only a missing path counts as none: any other failure is one."""
    try:
        every = spark.read.option("basePath", path).parquet(f"{path.rstrip('/')}/version=*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, 0
    n = every.agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{path.rstrip('/')}/version={n}"), int(n)


def write_version(df: DataFrame, path: str, version: int) -> str:
    """A new version beside the old ones, which stay; the write commits as a whole."""
    target = f"{path.rstrip('/')}/version={version}"
    df.write.parquet(target)
    return target


def items_job(spark, dump_path, fields, key_index, snapshot_path, export_path, field_sep_regex=",",
              date=None, single_file=False, buckets=None):
    """Load a media-item dump into the keyed snapshot (later lines win) and
    export the whole snapshot as dated TSV. The snapshot is versioned:
    a run reads the newest version and writes the next, so runs with the
    same arguments accumulate and no run overwrites what it reads. With ``buckets`` a
    run rewrites only the key buckets that the dump falls into (``operators.snapshot``)."""
    names = re.split(field_sep_regex, fields) if isinstance(fields, str) else list(fields)
    key = names[int(key_index)]
    incoming = load_order(read_items(spark, dump_path, names), 1)
    if buckets:
        snapshot.load(spark, snapshot_path, incoming, key, buckets)
        stored = snapshot.read(spark, snapshot_path)
        stored = incoming.limit(0).select(*names) if stored is None else stored
        return snapshot_path, export_tsv(stored, names, export_path, date, single_file=single_file)
    now, version = read_version(spark, snapshot_path)
    current = incoming.limit(0).withColumn("_load", F.lit(0)) if now is None else load_order(now, 0, position_cols=[key])
    new_path = write_version(upsert_by_key(current, incoming, key), snapshot_path, version + 1)
    snap = read_snapshot(spark, new_path, names)
    return new_path, export_tsv(snap, names, export_path, date, single_file=single_file)


def ingest_job(spark, source, path, checkpoint, topics=None, servers=None, starting=None,
               trigger_seconds=30, rejects_path=None, ledger_path=None, tz=S.DEFAULT_TZ, available_now=False,
               max_offsets=None, max_files=None, **ingest_options):
    """Streaming ingest from Kafka (``servers``) or a folder of JSON lines.

    A first start begins at ``starting`` (latest, earliest or offsets JSON), or
    behind the stored ledger when ``starting`` is not given and ``ledger_path``
    holds one, else at latest. ``max_offsets`` / ``max_files`` bound a batch."""
    if servers:
        if starting is None:
            starting = stored_offsets(spark, ledger_path) if ledger_path else None
        options = {"maxOffsetsPerTrigger": max_offsets} if max_offsets else {}
        stream = read_event_stream(spark, topics.split(","), servers, starting or "latest", **options)
    else:
        stream = read_text_stream(spark, source, max_files)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{trigger_seconds} seconds"}
    return start_ingest(stream, path, checkpoint, trigger, tz, rejects_path=rejects_path, ledger_path=ledger_path, **ingest_options)


def main(argv=None):
    p = argparse.ArgumentParser(prog="abflow.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--path", required=True)
    common.add_argument("--start", required=True)
    common.add_argument("--end", required=True)
    common.add_argument("--tz", default=S.DEFAULT_TZ)
    common.add_argument("--folder-prefix", default="")
    common.add_argument("--rejects", help="folder for lines with too few fields")
    a = sub.add_parser("news-members", parents=[common])
    a.add_argument("--out", required=True)
    a.add_argument("--version", required=True)
    a = sub.add_parser("rel-members", parents=[common])
    a.add_argument("--out", required=True)
    a = sub.add_parser("news-metrics", parents=[common])
    a.add_argument("--out", required=True)
    a.add_argument("--version", required=True)
    a.add_argument("--format", default="parquet")
    a.add_argument("--scene", default=S.SCENE_NEWS)
    a.add_argument("--slot-match", choices=["whole", "any"], default="whole")
    a.add_argument("--scene-index")
    a = sub.add_parser("rel-metrics", parents=[common])
    a.add_argument("--members", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--format", default="parquet")
    a.add_argument("--scene", default=S.SCENE_RELATED)
    a.add_argument("--history-start", default=S.HISTORY_START)
    a.add_argument("--scene-index")
    a = sub.add_parser("scene-index", parents=[common], help="index the log files that are new or changed")
    a.add_argument("--index", required=True)
    a = sub.add_parser("rel-reports", parents=[common])
    a.add_argument("--members", required=True)
    a.add_argument("--out-daily", required=True)
    a.add_argument("--out-retention", required=True)
    a.add_argument("--history-start", default=S.HISTORY_START)
    a.add_argument("--format", default="parquet")
    a.add_argument("--first-seen")
    a = sub.add_parser("first-seen")
    for k in ("--members", "--first-seen", "--start", "--end"):
        a.add_argument(k, required=True)
    a.add_argument("--history-start", default=S.HISTORY_START)
    a = sub.add_parser("items")
    for k in ("--dump", "--fields", "--key-index", "--snapshot", "--export"):
        a.add_argument(k, required=True)
    a.add_argument("--field-sep-regex", default=",")
    a.add_argument("--single-file", action="store_true")
    a.add_argument("--buckets", type=int)
    a = sub.add_parser("bitmaps")
    for k in ("--members", "--bitmaps", "--start", "--end", "--base"):
        a.add_argument(k, required=True)
    a = sub.add_parser("user-metrics")
    for k in ("--members", "--first-seen", "--day", "--out", "--totals"):
        a.add_argument(k, required=True)
    a.add_argument("--totals-format", default="parquet")
    a.add_argument("--history-start", default=S.HISTORY_START)
    a = sub.add_parser("news-retention")
    a.add_argument("--members")
    a.add_argument("--bitmaps")
    a.add_argument("--base")
    a.add_argument("--out", required=True)
    a.add_argument("--start")
    a.add_argument("--end")
    a.add_argument("--days", type=int, nargs="+", default=[7])
    a.add_argument("--history-start", default=S.HISTORY_START)
    a = sub.add_parser("compact")
    for k in ("--events", "--compacted", "--start", "--end"):
        a.add_argument(k, required=True)
    a = sub.add_parser("ingest")
    a.add_argument("--source")
    a.add_argument("--servers")
    a.add_argument("--topics")
    a.add_argument("--out", required=True)
    a.add_argument("--checkpoint", required=True)
    a.add_argument("--rejects")
    a.add_argument("--ledger")
    a.add_argument("--trigger-seconds", type=int, default=30)
    a.add_argument("--starting")
    a.add_argument("--max-offsets", type=int)
    a.add_argument("--max-files", type=int)
    a.add_argument("--dedup-within", help="leave out messages delivered again within e.g. '1 day'")
    a.add_argument("--ranges", help="folder for each batch's offset ranges")
    a.add_argument("--partials", help="folder for hourly partial aggregates")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"abflow-{args.job}").getOrCreate()
    j = args.job
    if j == "news-members":
        news_members_job(spark, args.path, args.start, args.end, args.out, args.version, args.folder_prefix, rejects=args.rejects)
    elif j == "rel-members":
        rel_members_job(spark, args.path, args.start, args.end, args.out, folder_prefix=args.folder_prefix, rejects=args.rejects)
    elif j == "news-metrics":
        news_metrics_job(spark, args.path, args.start, args.end, args.out, args.version, args.format,
                         args.folder_prefix, scene=args.scene, slot_match=args.slot_match, rejects=args.rejects, scene_index=args.scene_index)
    elif j == "rel-metrics":
        rel_metrics_job(spark, args.path, args.start, args.end, args.members, args.out, args.history_start, args.scene, args.format,
                        tz=args.tz, folder_prefix=args.folder_prefix, rejects=args.rejects, scene_index=args.scene_index)
    elif j == "scene-index":
        update_scene_index(spark, args.path, args.index, args.start, args.end, args.folder_prefix)
    elif j == "rel-reports":
        rel_reports_job(spark, args.path, args.start, args.end, args.members, args.out_daily, args.out_retention,
                        args.history_start, fmt=args.format, folder_prefix=args.folder_prefix, rejects=args.rejects,
                        first_seen_path=args.first_seen)
    elif j == "first-seen":
        first_seen_job(spark, args.members, args.first_seen, args.start, args.end, args.history_start)
    elif j == "items":
        items_job(spark, args.dump, args.fields, args.key_index, args.snapshot, args.export, args.field_sep_regex,
                  single_file=args.single_file, buckets=args.buckets)
    elif j == "bitmaps":
        bitmaps_job(spark, args.members, args.bitmaps, args.start, args.end, args.base)
    elif j == "user-metrics":
        totals = {"fmt": args.totals_format, "path": args.totals}
        user_metrics_job(spark, args.members, args.first_seen, args.day, args.out, totals, totals, args.history_start)
    elif j == "news-retention":
        news_retention_job(spark, args.members, args.out, history_start=args.history_start, start=args.start, end=args.end,
                           windows=args.days, bitmaps_path=args.bitmaps, base=args.base)
    elif j == "compact":
        compact_hours(spark, args.events, args.compacted, args.start, args.end)
    elif j == "ingest":
        ingest_job(spark, args.source, args.out, args.checkpoint, args.topics, args.servers, args.starting,
                   trigger_seconds=args.trigger_seconds, rejects_path=args.rejects,
                   ledger_path=args.ledger, max_offsets=args.max_offsets, max_files=args.max_files,
                   dedup_within=args.dedup_within, ranges_path=args.ranges, partials_path=args.partials).awaitTermination()


if __name__ == "__main__":
    main()
