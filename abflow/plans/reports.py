"""Wide report rows: the daily A/B report and the retention report, for
every day of a range in one plan each.

The analysed job ran ~28 Spark actions per date and built one driver
Row per report; here the log is aggregated once (conditional counts for
both groups), new users come from one membership window pass, and the
retention report from one range-delta pass for n = 7 and 30 together. The per-day
results are one row per day and are joined on the day key (small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..operators.filters import action_cond
from ..operators.groups import members_daily
from ..operators.retention import retention, user_stats_daily
from ..operators.slots import slot_texts, text_exposures, text_watch


def one_of(labels: tuple[str, str]):
    """The group label, which must be one of the two (a report of other groups would be all zeros)."""
    g = F.col("grp")
    return F.when(g.isin(*labels), g).otherwise(F.raise_error(F.concat(F.lit(f"group not in {labels}: "), F.coalesce(g, F.lit("null")))))


def daily_report(logs: DataFrame, scene: str, start: str, members: DataFrame | None = None,
                 play_match: str = "contains", action_match: str = "numeric", groups: tuple[str, str] = ("A", "B"),
                 first_seen: DataFrame | None = None) -> DataFrame:
    """date, scene_id, then for A and B: expose, click, user_active, order,
    user_new, play (bigint; 0 where nothing happened).

    ``logs`` carries grp (A / B); ``members`` defaults to the distinct members of
    the same logs (as the membership table holds them), ``groups`` are their
    two labels (``("qianA", "qianB")`` for news members). With ``first_seen`` only
    the given member days are needed, not the history.
    """
    lg = logs.filter(F.col("scene_id") == scene)
    if members is None:
        members = members_daily(logs, scene)
    # one distinct expression, grouped by (dt, grp): partial aggregation on
    # (dt, grp, uid), no Expand of the log rows; the pivot to A / B columns
    # runs on per-day rows only
    per = lg.groupBy("dt", "grp").agg(
        F.count_if(action_cond(S.ACTION_EXPOSURE, action_match)).alias("expose"),
        F.count_if(action_cond(S.ACTION_CLICK, action_match)).alias("click"),
        F.count_distinct("uid").alias("user_active"),
        F.count_if(action_cond(S.ACTION_ORDER, action_match)).alias("order"),
        F.count_if(action_cond(S.ACTION_PLAY, play_match)).alias("play"))
    metrics = ["expose", "click", "user_active", "order", "play"]
    day = per.groupBy("dt").agg(*[F.max(F.when(F.col("grp") == g, F.col(m))).alias(f"{g.lower()}_{m}")
                                  for g in ("A", "B") for m in metrics])
    st = user_stats_daily(members.withColumn("grp", one_of(groups)), start, first_seen=first_seen)
    new = st.groupBy("dt").agg(
        *[F.sum(F.when(F.col("grp") == label, F.col("user_new"))).alias(f"{g}_user_new") for g, label in zip("ab", groups, strict=True)])
    out = day.join(new, "dt", "left").select(
        F.col("dt").alias("date"), F.lit(scene).alias("scene_id"),
        *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in S.DAILY_REPORT_FIELDS[2:]])
    return out


def retention_report(members: DataFrame, scene: str, start: str, d1: str | None = None,
                     d2: str | None = None, windows=S.RETENTION_WINDOWS, groups: tuple[str, str] = ("A", "B"),
                     first_seen: DataFrame | None = None) -> DataFrame:
    """date, scene_id, then for A and B and each n: user_new_n,
    user_new_n_stay, user_active_n, user_active_n_stay. ``groups``: the two
    labels of the members; any other label fails."""
    r = retention(members.withColumn("grp", one_of(groups)), tuple(windows), start, d1, d2, first_seen)   # all n in one pass
    metrics = [m.format(n=n) for n in windows for m in S.RETENTION_MEASURES]
    joined = r.groupBy("dt").agg(*[F.max(F.when(F.col("grp") == label, F.col(m))).alias(f"{g}_{m}")
                                   for g, label in zip("ab", groups, strict=True) for m in metrics])
    fields = [f"{g}_{m.format(n=n)}" for g in ("a", "b") for n in windows for m in S.RETENTION_MEASURES]
    return joined.select(F.col("dt").alias("date"), F.lit(scene).alias("scene_id"),
                         *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in fields])


def news_report(logs: DataFrame, factor: int = S.WATCH_FACTOR, slot_match: str = "whole") -> DataFrame:
    """Per day, for A and B: AI-slot exposures, total and mean plausible
    watch time and plays in AI slots (the news metrics job as one plan).

    ``logs`` are one scene's rows with grp. They are read once: the first aggregate has a row
    per distinct slot text of the exposures, and per distinct slot field and user of the plays;
    lists are cut up and slots matched on those rows alone, so what follows grows with them and
    not with the log. Rows without a day or slots have no part in it.
    """
    lists = slot_texts(logs, factor)
    per_slot = text_exposures(lists)
    ex = per_slot.groupBy("dt").agg(
        F.sum("a_n").cast("bigint").alias("a_expose"),
        F.sum(F.when(F.col("a_n") > 0, F.col("b_n")).otherwise(0)).cast("bigint").alias("b_expose"))
    ws = text_watch(lists, per_slot.filter("a_n > 0").select("dt", "rec_posi"), slot_match)
    wide = ws.groupBy("dt").agg(*[F.max(F.when(F.col("grp") == g, F.col(c))).alias(f"{g.lower()}_{c}")
                                  for g in ("A", "B") for c in ("watch_sum", "watch_mean", "plays")])
    cols = [f"{g}_{c}" for g in ("a", "b") for c in ("expose", "watch_sum", "watch_mean", "plays")]
    out = ex.join(wide, "dt", "full")
    return out.select(F.col("dt").alias("date"),
                      *[(F.col(c) if c.endswith("watch_mean") else F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(c)
                        for c in cols])
