"""Numbers pinned in FIXTURES.md (computed independently in Spark and DuckDB)."""
from pyspark.sql import functions as F

from abflow.operators import retention as R
from abflow.operators import slots as SL
from abflow.operators.filters import by_scene
from abflow.plans.catalog import gblog, rel_members


def test_rows_and_uids_by_group(spark, sf):
    g = gblog(spark, sf).groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("uid").alias("u"))
    got = {r.grp: (r.n, r.u) for r in g.collect()}
    assert got == {"A": (5405, 2518), "B": (4595, 2110)}


def test_retention_pinned(spark, sf):
    r = R.retention(rel_members(spark, sf), 7, "20240101").filter(F.col("dt") == "20240122")
    got = {x.grp: (x.user_active_7, x.user_new_7, x.user_active_7_stay, x.user_new_7_stay) for x in r.collect()}
    assert got == {"A": (396, 341, 56, 50), "B": (337, 291, 42, 39)}


def test_funnel_pinned(spark, sf):
    from abflow.operators.funnel import funnel_daily
    f = funnel_daily(by_scene(gblog(spark, sf), "S_REL"))
    r = f.filter((F.col("grp") == "A") & (F.col("dt") == "20240101")).collect()[0]
    assert (r.exposures, r.users, r.orders) == (12, 65, 14)


def test_plausible_plays_pinned(spark, sf):
    n = by_scene(gblog(spark, sf), "S_NEWS").filter(F.col("action_type") == "3")
    n = n.filter(F.col("watch_s") <= F.col("dur_s") * 2)
    got = {r.grp: (r.w, r.n) for r in n.groupBy("grp").agg(F.sum("watch_s").alias("w"),
                                                          F.count(F.lit(1)).alias("n")).collect()}
    assert got == {"A": (10078, 280), "B": (9132, 245)}


def test_user_stats_pinned(spark, sf):
    st = R.user_stats_daily(rel_members(spark, sf), "20240101").filter(F.col("grp") == "A")
    got = {r.dt: (r.user_new, r.user_remain, r.user_active) for r in st.collect()}
    assert got["20240101"] == (65, 0, 65)
    assert got["20240102"] == (59, 2, 61)


def test_slot_exposures_pinned(spark, sf):
    s = SL.slot_exposures(by_scene(gblog(spark, sf), "S_NEWS"))
    got = {r.dt: (r.a_expose, r.b_expose) for r in s.collect()}
    assert got["20240101"] == (13, 22)
    assert got["20240102"] == (8, 12)


def test_exploded_slots_pinned(spark, sf):
    news = by_scene(gblog(spark, sf), "S_NEWS")
    assert SL.explode_slots(news).count() == 6668
    assert SL.ai_slots(news).count() == 198


def test_latest_item_pinned(spark, sf):
    from abflow.plans.catalog import q_item_upsert
    s = q_item_upsert(spark, sf)
    assert s.count() == 150
    assert s.filter(F.col("user_id") == 0).collect()[0].event_id == 9907
