"""Retention one-pass plans against the literal set form, per end date."""
import pytest
from pyspark.sql import functions as F

from abflow.functions.timefn import shift_date
from abflow.operators import retention as R
from abflow.plans.catalog import rel_members


def literal(members, D, n, start):
    """The per-date form: distinct windows, anti join (subtract), intersection."""
    def window(lo, hi, strict_hi=False):
        c = (F.col("dt") >= lo) & ((F.col("dt") < hi) if strict_hi else (F.col("dt") <= hi))
        return members.filter(c).select("grp", "uid").distinct()
    sd = lambda k: members.sparkSession.range(1).select(shift_date(F.lit(D), k)).first()[0]
    prev = window(sd(-(2 * n - 1)), sd(-n))
    hist = window(start, sd(-(2 * n - 1)), strict_hi=True)
    cur = window(sd(-(n - 1)), D)
    new = prev.join(hist, ["grp", "uid"], "left_anti")
    out = {}
    for g in ("A", "B"):
        p, nw, c = (x.filter(F.col("grp") == g) for x in (prev, new, cur))
        out[g] = (p.count(), nw.count(), p.intersect(c).count(), nw.intersect(c).count())
    return out


@pytest.mark.parametrize("D,n,start", [("20240122", 7, "20240101"), ("20240105", 7, "20240101"),
                                       ("20240130", 30, "20240101"), ("20240120", 7, "20240110")])
def test_retention_equals_literal(spark, sf, D, n, start):
    m = rel_members(spark, sf).cache()
    r = R.retention(m, n, start, D, D).collect()
    got = {x.grp: (x[f"user_active_{n}"], x[f"user_new_{n}"], x[f"user_active_{n}_stay"], x[f"user_new_{n}_stay"])
           for x in r}
    assert got == literal(m, D, n, start)


def test_user_stats_equal_literal(spark, sf):
    m = rel_members(spark, sf)
    st = {(r.grp, r.dt): (r.user_new, r.user_remain, r.user_active)
          for r in R.user_stats_daily(m, "20240101").collect()}
    for D in ("20240101", "20240115", "20240130"):
        hist = m.filter((F.col("dt") >= "20240101") & (F.col("dt") < D)).select("grp", "uid").distinct()
        today = m.filter(F.col("dt") == D).select("grp", "uid")
        for g in ("A", "B"):
            t, h = today.filter(F.col("grp") == g), hist.filter(F.col("grp") == g)
            exp = (t.join(h, ["grp", "uid"], "left_anti").count(), t.intersect(h).count(), t.count())
            assert st[(g, D)] == exp


def test_cumulative_batch_equals_incremental(spark, sf):
    m = rel_members(spark, sf)
    batch = R.cumulative_users(m, "20240101")
    yesterday = batch.filter(F.col("dt") == "20240114").select("date", "user_num")
    new_today = R.new_users(m, "20240101").filter(F.col("dt") == "20240115")
    inc = {r.date: r.user_num for r in R.advance_totals(yesterday, new_today).collect()}
    want = {r.date: r.user_num for r in batch.filter(F.col("dt") == "20240115").collect()}
    assert inc == want and len(inc) == 2
    # a missing yesterday gives null instead of failing
    none = R.advance_totals(yesterday.limit(0), new_today).collect()
    assert all(r.user_num is None for r in none)


def test_duplicate_member_rows_count_like_subtract(spark):
    m = spark.createDataFrame([("A", "u1", "20240101"), ("A", "u1", "20240102"), ("A", "u1", "20240102"),
                               ("A", "u2", "20240102"), ("A", "u2", "20240102")], "grp string, uid string, dt string")
    st = {r.dt: (r.user_new, r.user_remain, r.user_active) for r in R.user_stats_daily(m, "20240101").collect()}
    # 0102: u2 twice is new (subtract keeps repeats), u1 retained once, 4 rows active
    assert st["20240102"] == (2, 1, 4)


def test_first_seen_table_equals_full_history(spark, sf):
    m = rel_members(spark, sf).cache()
    full = {(x.grp, x.dt): tuple(x) for x in R.retention(m, (7, 30), "20240101").collect()}
    # the first-seen table, built in two steps as a daily job would keep it
    fs = R.advance_first_seen(R.first_seen(m.filter(F.col("dt") < "20240115"), "20240101"),
                              m.filter(F.col("dt") >= "20240115"), "20240101")
    for d1, d2 in (("20240128", "20240130"), ("20240110", "20240110")):
        inc = R.retention(m, (7, 30), "20240101", d1, d2, first_seen=fs)
        got = {(x.grp, x.dt): tuple(x) for x in inc.collect()}
        assert got and all(got[k] == full[k] for k in got)
        assert sorted(got) == sorted(k for k in full if d1 <= k[1] <= d2)


def test_user_stats_with_first_seen_table(spark, sf):
    m = rel_members(spark, sf).cache()
    full = {(x.grp, x.dt): tuple(x) for x in R.user_stats_daily(m, "20240101").collect()}
    fs = R.first_seen(m, "20240101")
    got = {(x.grp, x.dt): tuple(x) for x in
           R.user_stats_daily(m, "20240101", "20240130", first_seen=fs, begin="20240125").collect()}
    assert sorted(got) == sorted(k for k in full if k[1] >= "20240125")
    assert all(got[k] == full[k] for k in got)
