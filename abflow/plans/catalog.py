"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
computed over the whole test tables (or data Spark derives from them)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import timefn as TF
from ..functions.fields import duration_seconds, watch_fields, watch_seconds
from ..functions.groups import ab_group, label
from ..operators import retention as R
from ..operators import slots as SL
from ..operators.filters import by_release, by_scene
from ..operators.flatten import flatten_json, project_event
from ..operators.funnel import funnel_daily, funnel_report, players, plays, province_report
from ..operators.groups import members_daily, with_group
from ..operators.keyed import join_distinct, offset_ledger, upsert_by_key
from ..plans.reports import daily_report, news_report, retention_report
from ..plans.sqlviews import sql_funnel_report
from ..session import spread
from ..sinks.files import tsv_line
from ..sources.fixture import ITEM_FIELDS, blog, item_lines, log_lines, mixed_log_lines, raw_events_json, read_table
from ..sources.logs import parse_log_lines, valid_rows, with_event_day
from ..sources.tables import date_spine, name_fields
from ..sources.tables import members as member_range

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# scenes and history start of the test fixture (FIXTURES.md §3)
SCENE_REL = "S_REL"
SCENE_NEWS = "S_NEWS"
START = "20240101"


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def gblog(spark, sf_dir) -> DataFrame:
    return with_group(blog(spark, sf_dir))


@register("funnel_daily_ab")
def q_funnel_daily_ab(spark, sf_dir):
    """Exposures, clicks, active users and orders per group and day (one aggregate)."""
    return funnel_daily(by_scene(gblog(spark, sf_dir), SCENE_REL))


# ---------------------------------------------------------------- filters, groups
@register("scene_filter")
def q_scene_filter(spark, sf_dir):
    """Rows of one scene per day and action code."""
    b = by_scene(blog(spark, sf_dir), SCENE_NEWS)
    return b.groupBy("dt", "action_type").agg(F.count(F.lit(1)).alias("n"))


@register("ab_group")
def q_ab_group(spark, sf_dir):
    """Rows and distinct uids per A/B bucket."""
    b = blog(spark, sf_dir).withColumn("grp", ab_group("uid"))
    return b.groupBy("grp").agg(F.count(F.lit(1)).alias("n_rows"),
                                F.count_distinct("uid").alias("n_uids"))


def rel_members(spark, sf_dir):
    return members_daily(blog(spark, sf_dir), SCENE_REL)


@register("members_daily")
def q_members_daily(spark, sf_dir):
    """Distinct uids per group and day of the related-recommendation scene."""
    return rel_members(spark, sf_dir)


@register("member_range")
def q_member_range(spark, sf_dir):
    """Group B members of 20240105..20240112 via the partition label."""
    m = rel_members(spark, sf_dir).withColumn("time", label("grp", "dt"))
    r = member_range(m.select("uid", "time"), "B", "20240105", "20240112")
    return r.groupBy("time").agg(F.count(F.lit(1)).alias("n"))


@register("players_ab")
def q_players_ab(spark, sf_dir):
    """Distinct players (action 3) per group and day."""
    return players(by_scene(gblog(spark, sf_dir), SCENE_REL))


@register("play_contains")
def q_play_contains(spark, sf_dir):
    """Play rows by substring match on the action code, per group and day."""
    return plays(by_scene(gblog(spark, sf_dir), SCENE_REL), match="contains")


# ---------------------------------------------------------------- retention


@register("new_users_daily")
def q_new_users_daily(spark, sf_dir):
    return R.new_users(rel_members(spark, sf_dir), START)


@register("user_stats_daily")
def q_user_stats_daily(spark, sf_dir):
    return R.user_stats_daily(rel_members(spark, sf_dir), START)


@register("retention_7")
def q_retention_7(spark, sf_dir):
    return R.retention(rel_members(spark, sf_dir), 7, START)


@register("retention_30")
def q_retention_30(spark, sf_dir):
    return R.retention(rel_members(spark, sf_dir), 30, START)


@register("retention_rate")
def q_retention_rate(spark, sf_dir):
    return R.retention_rate(R.retention(rel_members(spark, sf_dir), 7, START), 7)


@register("retention_incremental")
def q_retention_incremental(spark, sf_dir):
    """7-day retention for the last three end days from a first-seen table:
    reads only member days [D-13, D] plus one row per user."""
    m = rel_members(spark, sf_dir)
    return R.retention(m, 7, START, "20240128", "20240130", first_seen=R.first_seen(m, START))


@register("user_metrics_news")
def q_user_metrics_news(spark, sf_dir):
    """New, retained, active and total news users of 20240115 from a first-seen table
    and yesterday's stored total, group B's of which is missing."""
    m = members_daily(blog(spark, sf_dir), SCENE_NEWS, a="qianA", b="qianB")
    before = m.filter(F.col("dt") < "20240115")
    stored = R.cumulative_users(before, START).filter("grp = 'qianA' and dt = '20240114'").select("date", "user_num")
    today = R.user_stats_daily(m.filter(F.col("dt") == "20240115"), START, first_seen=R.first_seen(m, START))
    return R.user_metrics(today, stored).drop("user_num")


@register("totals_incremental")
def q_totals_incremental(spark, sf_dir):
    """Totals of every day as yesterday's stored total plus today's new users."""
    m = rel_members(spark, sf_dir)
    stored = R.cumulative_users(m, START).select("date", "user_num")
    return R.advance_totals(stored, R.new_users(m, START))


@register("cumulative_users")
def q_cumulative_users(spark, sf_dir):
    return R.cumulative_users(rel_members(spark, sf_dir), START)


# ---------------------------------------------------------------- slots


def news(spark, sf_dir):
    return by_scene(gblog(spark, sf_dir), SCENE_NEWS)


@register("slot_explode")
def q_slot_explode(spark, sf_dir):
    """(slot, type) pairs of the news scene per day, group and type."""
    ex = SL.explode_slots(news(spark, sf_dir))
    return ex.groupBy("dt", "grp", "rec_typei").agg(F.count(F.lit(1)).alias("n"),
                                                   F.count_distinct("rec_posi").alias("n_slots"))


@register("ai_slots")
def q_ai_slots(spark, sf_dir):
    return SL.ai_slots(news(spark, sf_dir))


@register("slot_exposure_ab")
def q_slot_exposure_ab(spark, sf_dir):
    return SL.slot_exposures(news(spark, sf_dir))


@register("slot_exposure_cumulative")
def q_slot_exposure_cumulative(spark, sf_dir):
    """Slot exposures with the AI set and counts accumulated over days."""
    return SL.slot_exposures(news(spark, sf_dir), cumulative=True)


@register("watch_stats_cumulative")
def q_watch_stats_cumulative(spark, sf_dir):
    """Watch stats of plays in slots seen as AI slots on their day or before."""
    return SL.watch_stats(news(spark, sf_dir), slot_match="any", cumulative=True)


@register("watch_stats_ab")
def q_watch_stats_ab(spark, sf_dir):
    """Plays in the day's AI slots (a play row lists two slots here, so any
    listed slot counts), players, plausible watch sum and mean."""
    return SL.watch_stats(news(spark, sf_dir), slot_match="any")


@register("watch_stats_whole")
def q_watch_stats_whole(spark, sf_dir):
    """Plays whose whole slot field is an AI slot of the day: odd events name one slot here."""
    one = F.when(F.col("event_id") % 2 == 1, F.substring_index("rec_pos", ";", 1)).otherwise(F.col("rec_pos"))
    return SL.watch_stats(news(spark, sf_dir).withColumn("rec_pos", F.when(F.col("action_type") == "3", one).otherwise(F.col("rec_pos"))),
                          slot_match="whole")


@register("slot_report")
def q_slot_report(spark, sf_dir):
    return SL.slot_report(news(spark, sf_dir), man_type="1", ai_type="2")


# ---------------------------------------------------------------- reports


@register("funnel_report_a")
def q_funnel_report_a(spark, sf_dir):
    return funnel_report(by_scene(gblog(spark, sf_dir), SCENE_REL), "A")


@register("funnel_report_b")
def q_funnel_report_b(spark, sf_dir):
    return funnel_report(by_scene(gblog(spark, sf_dir), SCENE_REL), "B")


@register("province_report")
def q_province_report(spark, sf_dir):
    return province_report(by_scene(gblog(spark, sf_dir), SCENE_REL), "A")


# ---------------------------------------------------------------- parsing


def parsed_logs(spark, sf_dir, with_rejects=False):
    """Derived raw lines written as day folders in the shared scratch folder,
    then read back by the day-range reader (one text scan, folder day = dt)."""
    from ..session import scratch_path
    from ..sources.logs import read_log_text
    path = scratch_path(spark, "logs")
    log_lines(spark, sf_dir, with_rejects).hint("rebalance", "dt").write.partitionBy("dt").text(path)
    return parse_log_lines(read_log_text(spark, path, folder_prefix="dt="))


@register("log_parse")
def q_log_parse(spark, sf_dir):
    """Raw lines split once (limit -1) and read by position."""
    v, _ = valid_rows(parsed_logs(spark, sf_dir))
    return v.groupBy("dt", "scene_id", "action_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("action_sec").alias("sum_sec"),
        F.count_distinct("uid").alias("n_uid"),
        F.count_if(TF.epoch_to_date("action_time_text", "UTC") == F.col("dt")).alias("n_same_day"))


@register("log_rejects")
def q_log_rejects(spark, sf_dir):
    """Valid and rejected (too few fields) lines per folder day."""
    p = parsed_logs(spark, sf_dir, with_rejects=True)
    ok = F.col("n_fields") >= S.LOG_FIELDS
    return p.groupBy("dt").agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("rejects"))


@register("ext_parse")
def q_ext_parse(spark, sf_dir):
    """Watch and duration read from the ext field (items 2 and 5, after ':')."""
    v, _ = valid_rows(parsed_logs(spark, sf_dir))
    v = v.select("dt", watch_seconds("ext").alias("w"), duration_seconds("ext").alias("d"))
    return v.groupBy("dt").agg(F.sum("w").alias("watch"), F.sum("d").alias("duration"),
                               F.count_if(F.col("w") <= F.col("d") * 2).alias("plausible"))


@register("release_filter")
def q_release_filter(spark, sf_dir):
    """Rows of version V2.1 on products SC823 / SC818, per day and scene."""
    v, _ = valid_rows(parsed_logs(spark, sf_dir))
    return by_release(v, "V2.1").groupBy("dt", "scene_id").agg(F.count(F.lit(1)).alias("n"))


@register("date_spine")
def q_date_spine(spark, sf_dir):
    return date_spine(blog(spark, sf_dir))


@register("time_funcs")
def q_time_funcs(spark, sf_dir):
    """Epoch -> day / hour and compact time -> epoch ms / s, Asia/Shanghai;
    error events carry the text 'null' (-> 未知)."""
    ev = spread(read_table(spark, sf_dir, "events"))
    secs = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), F.col("ts"))
    b = ev.select("event_id", "ts", "event_type", secs.alias("action_sec"))
    sec = (F.when(F.col("event_type") == "error", F.lit("null")).when(F.col("event_id") % 11 == 3, "9999999999999999")
           .when(F.col("event_id") % 11 == 4, "-99999999999999").when(F.col("event_id") % 11 == 5, "12x").otherwise(F.col("action_sec").cast("string")))
    compact = F.when(F.col("event_type") == "error", F.lit("null")).otherwise(
        F.date_format("ts", "yyyyMMddHHmmssSSS"))
    return b.select("event_id",
                    TF.epoch_to_date(sec, "Asia/Shanghai").alias("day"),
                    TF.epoch_to_hour(sec, "Asia/Shanghai").alias("hour"),
                    TF.compact_to_epoch_ms(compact, "Asia/Shanghai").alias("ms"),
                    TF.time_to_timestamp(compact, "Asia/Shanghai", unit="s").alias("sec"))


@register("date_funcs")
def q_date_funcs(spark, sf_dir):
    d = blog(spark, sf_dir).select("dt").distinct()
    return d.select("dt", TF.shift_date("dt", 1).alias("next_day"), TF.shift_date("dt", -1).alias("prev_day"),
                    TF.window_bounds("dt", 30).alias("w30"), TF.last_two_weeks("dt").alias("w7")).select(
        "dt", "next_day", "prev_day",
        F.col("w7.cur_start").alias("w7_cur_start"), F.col("w7.prev_start").alias("w7_prev_start"),
        F.col("w7.prev_end").alias("w7_prev_end"),
        F.col("w30.cur_start").alias("w30_cur_start"), F.col("w30.prev_start").alias("w30_prev_start"),
        F.col("w30.prev_end").alias("w30_prev_end"))


# ---------------------------------------------------------------- wide reports, SQL views


@register("report_daily_ab")
def q_report_daily_ab(spark, sf_dir):
    return daily_report(gblog(spark, sf_dir), SCENE_REL, START)


@register("report_retention_ab")
def q_report_retention_ab(spark, sf_dir):
    return retention_report(rel_members(spark, sf_dir), SCENE_REL, START)


@register("join_distinct")
def q_join_distinct(spark, sf_dir):
    """Distinct action codes per group and day joined by '||'."""
    return join_distinct(by_scene(gblog(spark, sf_dir), SCENE_REL), ["grp", "dt"], "action_type")


@register("sql_view_funnel")
def q_sql_view_funnel(spark, sf_dir):
    """The click-anchored group-A report through temp views and SQL text."""
    return sql_funnel_report(spark, by_scene(gblog(spark, sf_dir), SCENE_REL), "A")


# ---------------------------------------------------------------- items, ledger
def items(spark, sf_dir, with_rejects=False):
    return name_fields(item_lines(spark, sf_dir, with_rejects), ITEM_FIELDS)


@register("item_parse")
def q_item_parse(spark, sf_dir):
    """Item lines with exactly the declared field count, named by the field list."""
    it = items(spark, sf_dir, with_rejects=True)
    return it.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"),
                                        F.count_distinct("user_id").alias("n_keys"))


def item_snapshot(spark, sf_dir):
    it = items(spark, sf_dir)
    first = it.filter(F.col("ts") < "2024-01-16")
    second = it.filter(F.col("ts") >= "2024-01-16")
    return upsert_by_key(first, second, "user_id", order_by=["ts", F.col("event_id").cast("bigint")])


@register("item_upsert")
def q_item_upsert(spark, sf_dir):
    """Snapshot after two loads: the latest item row per key."""
    s = item_snapshot(spark, sf_dir)
    return s.select(F.col("user_id").cast("bigint").alias("user_id"),
                    F.col("event_id").cast("bigint").alias("event_id"),
                    "event_type", "ts", F.col("value").cast("double").alias("value"))


@register("item_export")
def q_item_export(spark, sf_dir):
    """TSV export lines of the snapshot (a field absent from it -> 'null', trailing tab)."""
    s = item_snapshot(spark, sf_dir)
    fields = ["user_id", "event_id", "event_type", "ts", "value", "region"]
    s = s.withColumn("region", F.lit(None).cast("string"))
    return s.select(tsv_line(fields).alias("line"))


@register("item_job")
def q_item_job(spark, sf_dir):
    """The item job on two dumps with equal arguments: the snapshot accumulates, the export is its text."""
    from ..jobs import items_job
    from ..session import scratch_path
    base = scratch_path(spark, "items")
    lines = item_lines(spark, sf_dir, with_rejects=True)
    for k, part in enumerate((lines.filter(F.col("_ts") < "2024-01-16"), lines.filter(F.col("_ts") >= "2024-01-16"))):
        part.select("value").write.text(f"{base}/dump{k}")
        _, out = items_job(spark, f"{base}/dump{k}", ",".join(ITEM_FIELDS), 0, f"{base}/snapshot", f"{base}/export", date=f"run{k}")
    return spark.read.text(out).select(F.col("value").alias("line"))


@register("offset_ledger")
def q_offset_ledger(spark, sf_dir):
    """Per topic 'partition|untilOffset' list (topic = event type, partition = user mod 4)."""
    ev = read_table(spark, sf_dir, "events")
    o = ev.select(F.concat(F.lit("ev_"), "event_type").alias("topic"),
                  (F.col("user_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset"))
    return offset_ledger(o)


# ---------------------------------------------------------------- JSON ingest

JSON_KEYS = ["eventId", "bizType", "userId", "mac", "id", "ids", "name", "curr_time"]


@register("json_flatten")
def q_json_flatten(spark, sf_dir):
    f = flatten_json(spread(raw_events_json(spark, sf_dir)))
    return f.select(*[F.col("fields")[k].alias(k) for k in JSON_KEYS])


@register("json_levels")
def q_json_levels(spark, sf_dir):
    """Messages of 1 to 12 levels with a key at the bottom, and a key twice in the lowest object."""
    ev = read_table(spark, sf_dir, "events")
    n = (F.col("event_id") % 12).cast("int")
    value = F.concat(F.expr("repeat('{\"o\":', int(event_id % 12))"), F.lit('{"mac":"x","mac":"m'), F.col("user_id").cast("string"), F.lit('"}'),
                     F.expr("repeat('}', int(event_id % 12))"))
    d = spread(ev.select("event_id", n.alias("levels"), value.alias("value")))
    return flatten_json(d).select("event_id", "levels", F.col("fields")["mac"].alias("mac"))


@register("event_project")
def q_event_project(spark, sf_dir):
    return project_event(flatten_json(spread(raw_events_json(spark, sf_dir))))


# messages arrive in two drops; each drop's messages carry its arrival hour
DROP_SPLIT = "2024-01-16"
ARRIVAL = {"first": "2024011600", "second": "2024013100"}


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Messages arrive in two drops; the stream restarts from its checkpoint
    after each; the written event table is read back (a run with nothing
    new is covered in tests/test_stream.py)."""
    from ..session import scratch_path
    from ..streaming.ingest import read_ingested, read_text_stream, start_ingest
    base = scratch_path(spark, "stream_ingest")
    src, out, ck = f"{base}/in", f"{base}/events", f"{base}/ck"
    arrival = F.when(F.col("ts") < DROP_SPLIT, ARRIVAL["first"]).otherwise(ARRIVAL["second"])
    raw = spread(raw_events_json(spark, sf_dir, curr_time=arrival))
    drops = [raw.filter(F.col("ts") < DROP_SPLIT), raw.filter(F.col("ts") >= DROP_SPLIT)]
    for part in drops:
        part.select("value").write.mode("append").text(src)
        q = start_ingest(read_text_stream(spark, src), out, ck, trigger={"availableNow": True},
                         rejects_path=f"{base}/rejects")
        q.awaitTermination()
    return read_ingested(spark, out).select(*JSON_KEYS)


@register("member_write")
def q_member_write(spark, sf_dir):
    """Members written partitioned by (grp, dt) twice (a re-run); read back."""
    from ..session import scratch_path
    from ..sinks.files import write_members
    path = scratch_path(spark, "members")
    m = rel_members(spark, sf_dir)
    write_members(m, path)
    write_members(m, path)
    back = spark.read.parquet(path)
    return back.groupBy("grp", F.col("dt").cast("string").alias("dt")).agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- whole jobs from raw day folders


def mixed_folders(spark, sf_dir) -> str:
    """Late, short and timeless lines among whole ones, written as day folders."""
    from ..session import scratch_path
    path = scratch_path(spark, "mixed-logs")
    mixed_log_lines(spark, sf_dir).hint("rebalance", "dt").write.partitionBy("dt").text(path)
    return path


def mixed_rows(spark, sf_dir, min_fields):
    from ..sources.logs import read_behavior_log
    return read_behavior_log(spark, mixed_folders(spark, sf_dir), folder_prefix="dt=", min_fields=min_fields)


@register("funnel_from_logs")
def q_funnel_from_logs(spark, sf_dir):
    """Raw lines (5 fields needed) -> folder day and event day -> A/B -> funnel; late lines keep a row."""
    lg = with_event_day(by_scene(mixed_rows(spark, sf_dir, 5), SCENE_REL), "UTC")
    return funnel_daily(with_group(lg), by=("grp", "folder_dt", "dt"))


@register("players_from_logs")
def q_players_from_logs(spark, sf_dir):
    """Players and funnel totals from one scan, players by folder day whatever their time."""
    from ..jobs import rel_metrics
    lg = with_event_day(by_scene(mixed_rows(spark, sf_dir, 5), SCENE_REL), "UTC")
    return rel_metrics(with_group(lg)).filter("whole_folder = 1").select("grp", "folder_dt", "players", "users")


@register("members_from_logs")
def q_members_from_logs(spark, sf_dir):
    """Related A/B uid split by folder day: 3 fields are enough, the time isn't read."""
    return members_daily(mixed_rows(spark, sf_dir, 3), SCENE_REL)


@register("news_members")
def q_news_members(spark, sf_dir):
    """News A/B uid split of release V2.1 on products SC823 / SC818 by folder day: 6 fields needed."""
    return members_daily(mixed_rows(spark, sf_dir, 6), SCENE_NEWS, version="V2.1")


@register("mixed_rejects")
def q_mixed_rejects(spark, sf_dir):
    """Lines too short for the funnel, as a job writes them, by folder day."""
    from ..session import scratch_path
    from ..sources.logs import read_behavior_log
    out = scratch_path(spark, "rejects")
    read_behavior_log(spark, mixed_folders(spark, sf_dir), folder_prefix="dt=", min_fields=5, rejects_path=out)
    return spark.read.parquet(out).groupBy(F.col("dt").cast("string").alias("dt"), "n_fields").agg(F.count(F.lit(1)).alias("n"))


@register("news_report")
def q_news_report(spark, sf_dir):
    """Per day and group, release V2.1 on SC823 / SC818 only: AI-slot exposures,
    plausible watch sum and mean, plays in AI slots."""
    v, _ = valid_rows(parsed_logs(spark, sf_dir))
    logs = watch_fields(with_group(by_release(by_scene(v, SCENE_NEWS), "V2.1")))
    return news_report(logs, slot_match="any")
