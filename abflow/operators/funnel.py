"""Daily funnel metrics per group: exposures, clicks, active users,
orders, plays and players, all from ONE aggregate over the log.

The analysed jobs ran four SQL aggregates per group and day, each its
own scan; here every metric is a conditional aggregate of the same
``groupBy``, so the log is read once for all groups and days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from .filters import action_cond


def select_actions(df: DataFrame, day_col: str = "dt") -> DataFrame:
    """(uid, action_type, action_time) projection the per-metric views read."""
    return df.select("uid", "action_type", F.col(day_col).alias("action_time"))


def funnel_daily(df: DataFrame, by=("grp", "dt"), match: str = "numeric",
                 approx: bool = False) -> DataFrame:
    """exposures / clicks / users / orders per ``by``.

    ``users`` counts distinct uids over all actions; ``approx=True`` uses
    a HyperLogLog sketch instead of an exact distinct.
    """
    users = F.approx_count_distinct("uid") if approx else F.count_distinct("uid")
    return df.groupBy(*by).agg(
        F.count_if(action_cond(S.ACTION_EXPOSURE, match)).alias("exposures"),
        F.count_if(action_cond(S.ACTION_CLICK, match)).alias("clicks"),
        users.alias("users"),
        F.count_if(action_cond(S.ACTION_ORDER, match)).alias("orders"),
    )


def plays(df: DataFrame, by=("grp", "dt"), match: str = "contains") -> DataFrame:
    """Play rows per ``by``; ``contains`` reproduces the substring test ("13" counts)."""
    return df.groupBy(*by).agg(F.count_if(action_cond(S.ACTION_PLAY, match)).alias("plays"))


def players(df: DataFrame, by=("grp", "dt"), match: str = "equals") -> DataFrame:
    """Distinct uids that played (reported as a play count by the analysed job)."""
    return (df.filter(action_cond(S.ACTION_PLAY, match))
            .groupBy(*by).agg(F.count_distinct("uid").alias("players")))


def funnel_report(df: DataFrame, grp: str, columns: list[str] | None = None,
                  anchor: str = "clicks") -> DataFrame:
    """Report of one group anchored on click days, as the 4-way left join did.

    Days without a click vanish; a metric with no rows is null. Built from
    the one-pass aggregate: no join. ``columns`` orders the output
    (default ``action_time, userNum<G>, exposure<G>, clickNum<G>, orderNum<G>``).
    """
    g = grp
    agg = funnel_daily(df.filter(F.col("grp") == g), by=("dt",))
    out = agg.filter(F.col(anchor) > 0).select(
        F.col("dt").alias("action_time"),
        F.nullif(F.col("users"), F.lit(0)).alias(f"userNum{g}"),
        F.nullif(F.col("exposures"), F.lit(0)).alias(f"exposure{g}"),
        F.col("clicks").alias(f"clickNum{g}"),
        F.nullif(F.col("orders"), F.lit(0)).alias(f"orderNum{g}"),
    )
    if columns is not None:
        out = out.select(*columns)
    return out.orderBy("action_time")


def province_report(df: DataFrame, grp: str = "A") -> DataFrame:
    """Same rows as :func:`funnel_report`, the province column order."""
    g = grp
    return funnel_report(df, g, columns=["action_time", f"clickNum{g}", f"exposure{g}",
                                          f"userNum{g}", f"orderNum{g}"])
