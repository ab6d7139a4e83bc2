"""Sketches: merging, and the error against exact counts."""
import math

from pyspark.sql import functions as F

from abflow.operators import sketches as K


def test_error_bound(spark):
    """1,024 hashes kept, 40,000 users a day: all estimates within four standard errors."""
    lg, users = 10, 40_000
    m = spark.range(users * 4).select(F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("grp"), F.concat(F.lit("u"), (F.col("id") % (users + users // 2)).cast("string")).alias("uid"),
                                      F.concat(F.lit("2024010"), (1 + F.floor(F.col("id") / users)).cast("string")).alias("dt"))
    s = K.daily(m, lg).cache()
    for lo, hi in (("20240101", "20240101"), ("20240101", "20240103"), ("20240102", "20240104")):
        exact = {r.grp: r.n for r in m.filter(F.col("dt").between(lo, hi)).groupBy("grp").agg(F.count_distinct("uid").alias("n")).collect()}
        for r in K.active(s, lo, hi, lg).collect():
            assert abs(r.users - exact[r.grp]) <= 4 * exact[r.grp] / math.sqrt(1 << lg)
            assert r.users != 0
    day = {(r.grp, r.dt): r.users for r in m.groupBy("grp", "dt").agg(F.collect_set("uid").alias("users")).collect()}
    for r in K.retention(s, 1, "20240101", lg).collect():
        prev = set(day.get((r.grp, str(int(r.dt) - 1)), ()))
        back, whole = len(prev & set(day[r.grp, r.dt])), len(prev | set(day[r.grp, r.dt]))
        assert abs(r.user_active_1 - len(prev)) <= 4 * len(prev) / math.sqrt(1 << lg)
        assert abs(r.user_active_1_stay - back) <= 4 * math.sqrt(whole * max(back, 1)) / math.sqrt(1 << lg)


def test_merge_is_the_sketch_of_all(spark):
    rows = [("A", "20240101", f"u{i}") for i in range(300)] + [("A", "20240101", "u1"), (None, "20240101", "x"), ("A", None, "x"), ("A", "20240101", None)]
    m = spark.createDataFrame(rows, "grp string, dt string, uid string")
    parts = K.daily(m.filter("uid < 'u2'")).unionByName(K.daily(m.filter("uid >= 'u15'")))
    assert [r.n for r in K.merge(parts, ["grp", "dt"]).select(K.estimate(F.col("users")).alias("n")).collect()] == [300]
    assert K.active(K.daily(m), "20240102", "20240105").collect() == []
    assert K.retention(K.daily(m.limit(0)), 7, "20240101").collect() == []
