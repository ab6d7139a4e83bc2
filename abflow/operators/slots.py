"""Recommendation-slot metrics.

The analysed job filled driver-side lists and a set from executors and
bubble-sorted the set on the driver. Here the AI slot set is a
DataFrame (distinct (dt, slot) of group A exposures with the AI type),
slot exposures are one aggregate keyed by (dt, slot) with map-side
partial counts, and slot membership of plays is a semi join that AQE
broadcasts when the measured set is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.fields import split_java
from .filters import action_cond, in_slots


def in_slots_since(df: DataFrame, first: DataFrame, match: str = "whole") -> DataFrame:
    """Rows whose slot was an AI slot on their day or before: an equi-join on
    the slot with ``first_dt <= dt`` (no cross product)."""
    f = first.select(F.col("rec_posi").alias("_pos"), F.col("first_dt").alias("_first"))
    if match == "whole":
        return df.join(f, (df["rec_pos"] == f["_pos"]) & (f["_first"] <= df["dt"]), "left_semi")
    # the distinct list texts of a day decide, not the rows
    texts = df.select("dt", "rec_pos").distinct().select("dt", "rec_pos", F.explode(split_java("rec_pos", ";")).alias("_p"))
    hit = texts.join(f, (texts["_p"] == f["_pos"]) & (f["_first"] <= texts["dt"]), "left_semi").select("dt", "rec_pos").distinct()
    return df.join(hit, ["dt", "rec_pos"], "left_semi")


def explode_slots(df: DataFrame) -> DataFrame:
    """Pair slot i with type i (the type list drives); one row per pair.

    Adds ``rec_posi`` / ``rec_typei`` and ``slot_idx``. A type without a
    slot (slot list shorter) is dropped; extra slots without a type are
    not paired.
    """
    z = F.arrays_zip(split_java("rec_type", ";").alias("t"), split_java("rec_pos", ";").alias("p"))
    return (df.select("*", F.posexplode(z).alias("slot_idx", "_z"))
            .filter(F.col("_z.t").isNotNull() & F.col("_z.p").isNotNull())
            .withColumn("rec_posi", F.col("_z.p"))
            .withColumn("rec_typei", F.col("_z.t"))
            .drop("_z"))


def explode_slot_list(df: DataFrame) -> DataFrame:
    """One row per entry of the slot list alone (``rec_posi``)."""
    return df.select("*", F.explode(split_java("rec_pos", ";")).alias("rec_posi"))


def _exposures(df: DataFrame, match: str) -> DataFrame:
    return df.filter(action_cond(S.ACTION_EXPOSURE, match))


def ai_slots(df: DataFrame, ai_type: str = S.AI_SLOT_TYPE, match: str = "equals",
             ordered: bool = True) -> DataFrame:
    """AI slot set per day: distinct slots of group-A exposures whose type
    is ``ai_type``; ordered by day and slot number (numeric sort).
    """
    a = explode_slots(_exposures(df.filter(F.col("grp") == "A"), match))
    s = a.filter(F.col("rec_typei") == ai_type).select("dt", "rec_posi").distinct()
    return sort_slots(s) if ordered else s


def sort_slots(df: DataFrame, col: str = "rec_posi", by=("dt",)) -> DataFrame:
    """Slots in numeric order (text that is no number sorts last, by text)."""
    return df.orderBy(*by, F.col(col).try_cast("int").asc_nulls_last(), col)


def slot_exposures(df: DataFrame, ai_type: str = S.AI_SLOT_TYPE, match: str = "equals",
                   cumulative: bool = False) -> DataFrame:
    """Per day: ``a_expose`` = (row, slot) pairs of A exposures with the AI
    type; ``b_expose`` = (row, slot) pairs of B exposures whose slot is in
    that day's A set (any type).

    One exploded scan, one aggregate on (dt, slot) with partial counts
    (a hot slot collapses map-side), then a per-day sum: no join.
    ``cumulative=True``: the AI set of day D holds every slot seen as an AI
    slot on D or before, and both counts are running totals over days
    (the analysed job never reset its lists between days).
    """
    e = _exposures(df, match)
    z = F.arrays_zip(split_java("rec_pos", ";").alias("p"), split_java("rec_type", ";").alias("t"))
    ex = (e.select("dt", "grp", F.explode(z).alias("_z"))
          .select("dt", "grp", F.col("_z.p").alias("pos"), F.col("_z.t").alias("typ"))
          .filter(F.col("pos").isNotNull()))
    per_slot = ex.groupBy("dt", "pos").agg(
        F.count_if((F.col("grp") == "A") & (F.col("typ") == ai_type)).alias("a_n"),
        F.count_if(F.col("grp") == "B").alias("b_n"))
    if cumulative:
        # first day each slot was an AI slot: a window over (day, slot)-sized rows
        first = F.min(F.when(F.col("a_n") > 0, F.col("dt"))).over(Window.partitionBy("pos"))
        in_set = F.col("_first") <= F.col("dt")
        per_slot = per_slot.withColumn("_first", first)
    else:
        in_set = F.col("a_n") > 0
    daily = per_slot.groupBy("dt").agg(
        F.sum("a_n").cast("bigint").alias("a_expose"),
        F.sum(F.when(in_set, F.col("b_n")).otherwise(0)).cast("bigint").alias("b_expose"))
    if not cumulative:
        return daily
    # running totals over per-day rows (one row per day)
    run = Window.orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    return daily.select("dt", F.sum("a_expose").over(run).cast("bigint").alias("a_expose"),
                        F.sum("b_expose").over(run).cast("bigint").alias("b_expose"))


def cumulative_ai_slots(df: DataFrame, ai_type: str = S.AI_SLOT_TYPE, match: str = "equals") -> DataFrame:
    """(rec_posi, first_dt): the day each slot first appeared as an AI slot of
    group A; the cumulative set of day D is the slots with first_dt <= D."""
    return ai_slots(df, ai_type, match, ordered=False).groupBy("rec_posi").agg(F.min("dt").alias("first_dt"))


def watch_stats(df: DataFrame, factor: int = S.WATCH_FACTOR, ai_type: str = S.AI_SLOT_TYPE,
                slot_match: str = "whole", match: str = "equals",
                cumulative: bool = False) -> DataFrame:
    """Per group and day, over plays in that day's AI slots of group A:

    ``plays`` rows, ``players`` distinct uids (before the outlier filter),
    ``watch_sum`` over plays with ``watch <= factor * duration``, and
    ``watch_mean`` = watch_sum div players (integer; null with no player).
    ``cumulative=True`` uses the set of slots seen as AI slots up to the day.
    """
    p = df.filter(action_cond(S.ACTION_PLAY, match))
    if cumulative:
        hit = in_slots_since(p, cumulative_ai_slots(df, ai_type, match), slot_match)
    else:
        hit = in_slots(p, ai_slots(df, ai_type, match, ordered=False), slot_match, keys=("dt",))
    # a product out of range (null) is over any watch time
    ok = F.col("watch_s") <= F.coalesce(F.try_multiply("dur_s", F.lit(factor)), F.col("dur_s"))
    agg = hit.groupBy("grp", "dt").agg(
        F.count(F.lit(1)).alias("plays"),
        F.count_distinct("uid").alias("players"),
        F.coalesce(F.sum(F.when(ok, F.col("watch_s"))), F.lit(0)).cast("bigint").alias("watch_sum"))
    return agg.withColumn("watch_mean", F.expr("watch_sum div nullif(players, 0)"))


def slot_texts(df: DataFrame, factor: int = S.WATCH_FACTOR, match: str = "equals") -> DataFrame:
    """One row per day, group and distinct slot text: exposures (``n``, ``watch`` null) by slot
    and type list, plays (``n``, ``watch`` the plausible seconds) by slot field and uid.

    Both kinds come out of one aggregate, and every later filter is on ``watch``, which only
    the aggregate knows: no filter goes below it, so plans that use the result twice share its exchange.
    """
    play = action_cond(S.ACTION_PLAY, match)
    ok = F.col("watch_s") <= F.coalesce(F.try_multiply("dur_s", F.lit(factor)), F.col("dur_s"))
    rows = df.filter((action_cond(S.ACTION_EXPOSURE, match) | play) & F.col("dt").isNotNull() & F.col("rec_pos").isNotNull())
    keyed = rows.select("dt", "grp", "rec_pos", play.alias("play"), F.when(~play, F.col("rec_type")).alias("rec_type"), F.when(play, F.col("uid")).alias("uid"),
                        F.when(play, F.when(ok, F.col("watch_s")).otherwise(0)).alias("_w"))
    return keyed.groupBy("dt", "grp", "rec_pos", "play", "rec_type", "uid").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_w").alias("watch")).drop("play")


def text_exposures(lists: DataFrame, ai_type: str = S.AI_SLOT_TYPE) -> DataFrame:
    """dt, rec_posi, a_n (exposures of group A with the AI type), b_n (of group B) from ``slot_texts``."""
    z = F.arrays_zip(split_java("rec_pos", ";").alias("p"), split_java("rec_type", ";").alias("t"))
    ex = lists.filter("watch is null").select("dt", "grp", "n", F.explode(z).alias("_z")).filter("_z.p is not null")
    return ex.groupBy("dt", F.col("_z.p").alias("rec_posi")).agg(
        F.sum(F.when((F.col("grp") == "A") & (F.col("_z.t") == ai_type), F.col("n")).otherwise(0)).alias("a_n"),
        F.sum(F.when(F.col("grp") == "B", F.col("n")).otherwise(0)).alias("b_n"))


def text_watch(lists: DataFrame, slots: DataFrame, slot_match: str = "whole") -> DataFrame:
    """``watch_stats`` from ``slot_texts`` and the AI slots of each day (dt, rec_posi)."""
    # n is never 0: naming it keeps the count in the aggregate where only the texts are asked for, so that is the shared one
    hit = in_slots(lists.filter("watch is not null and n > 0"), slots, slot_match, keys=("dt",))
    agg = hit.groupBy("grp", "dt").agg(F.sum("n").alias("plays"), F.count_distinct("uid").alias("players"), F.sum("watch").cast("bigint").alias("watch_sum"))
    return agg.withColumn("watch_mean", F.expr("watch_sum div nullif(players, 0)"))


def slot_report(df: DataFrame, man_type: str, ai_type: str = S.AI_SLOT_TYPE,
                by=("dt", "rec_posi"), match: str = "numeric") -> DataFrame:
    """Per slot: exposure / click / order x {AI, manual} x {A, B}, null where none.

    The 12-way left join of per-metric views is one grouped aggregate
    over the exploded (slot, type) pairs.
    """
    ex = explode_slots(df)
    cols = []
    for g in ("a", "b"):
        for kind, t in (("ai", ai_type), ("man", man_type)):
            for metric, code in (("exposure", S.ACTION_EXPOSURE), ("click", S.ACTION_CLICK),
                                 ("order", S.ACTION_ORDER)):
                cond = ((F.col("grp") == g.upper()) & (F.col("rec_typei") == t)
                        & action_cond(code, match))
                cols.append(F.nullif(F.count_if(cond), F.lit(0)).alias(f"{metric}_{kind}_{g}"))
    return ex.groupBy(*by).agg(*cols)
