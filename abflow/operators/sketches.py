"""Distinct users by mergeable Theta sketches.

One sketch per (grp, dt) answers how many users were active in any span of
days, how many of a span came back in another (intersection) and how many
hadn't been there before (difference), without a uid: a report over years
reads a row per group and day. A sketch keeps at most 2**lg_k hashes; up to that many
users it is exact, beyond it a union's relative standard error is 2**(-lg_k / 2), and an
intersection's or difference's is that error times the root of the union's size over its own.

Defined cases: null groups, uids and days are left out; repeated rows count
once; a span without rows has 0 users.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import day_from_number, day_number

LG_K = 16


def daily(members: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """(grp, dt, users): a sketch of each group and day; partial sketches merge map-side."""
    m = members.filter("grp is not null and dt is not null and uid is not null")
    return m.groupBy("grp", "dt").agg(F.theta_sketch_agg("uid", lg_k).alias("users"))


def merge(sketches: DataFrame, by: list[str], lg_k: int = LG_K) -> DataFrame:
    """Union of the sketches of ``by`` (e.g. of two batches of one day)."""
    return sketches.groupBy(*by).agg(F.theta_union_agg("users", lg_k).alias("users"))


def estimate(sketch: Column) -> Column:
    return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("bigint")


def active(sketches: DataFrame, start: str, end: str, lg_k: int = LG_K) -> DataFrame:
    """Distinct users of each group in the days [start, end]."""
    return merge(sketches.filter(F.col("dt").between(start, end)), ["grp"], lg_k).select("grp", estimate(F.col("users")).alias("users"))


def _spread(sketches: DataFrame, kind: str, lo: int, hi: Column | int) -> DataFrame:
    """Each day's sketch to the end days D whose window ``kind`` holds it: D = day + lo .. day + hi."""
    d = F.col("_day")
    to = d + hi if isinstance(hi, int) else hi
    return sketches.select("grp", "users", F.explode(F.when(d + lo <= to, F.sequence(d + lo, to))).alias("D"), F.lit(kind).alias("kind"))


def retention(sketches: DataFrame, n: int, start: str, lg_k: int = LG_K) -> DataFrame:
    """n-day retention of every end day, as :func:`abflow.operators.retention.retention`
    counts it, estimated: per group and day only sketches meet, never users."""
    s = sketches.withColumn("_day", day_number("dt")).filter("_day is not null")
    bounds = s.groupBy("grp").agg(F.min("_day").alias("_lo"), F.max("_day").alias("_hi"))
    s = s.join(bounds, "grp")
    history = s.filter(F.col("_day") >= day_number(F.lit(start)))
    rows = _spread(s, "prev", n, 2 * n - 1).unionByName(_spread(s, "cur", 0, n - 1)).unionByName(
        _spread(history, "hist", 2 * n, F.col("_hi")))
    wins = rows.groupBy("grp", "D").agg(*(F.theta_union_agg(F.when(F.col("kind") == k, F.col("users")), lg_k).alias(k) for k in ("prev", "cur", "hist")))
    days = bounds.select("grp", F.explode(F.sequence("_lo", "_hi")).alias("D"))
    w = days.join(wins, ["grp", "D"], "left")
    prev, cur, hist = F.col("prev"), F.col("cur"), F.col("hist")
    new = F.theta_difference(prev, hist)
    return w.select("grp", day_from_number("D").alias("dt"), estimate(new).alias(f"user_new_{n}"), estimate(F.theta_intersection(new, cur)).alias(f"user_new_{n}_stay"),
                    estimate(prev).alias(f"user_active_{n}"), estimate(F.theta_intersection(prev, cur)).alias(f"user_active_{n}_stay"))
