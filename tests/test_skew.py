"""A hot key holding a third of all rows: results stay whole and exact, and
the plans reduce the hot key map-side before any shuffle."""
from pyspark.sql import functions as F

from abflow.operators import retention as R
from abflow.operators import slots as SL
from abflow.operators.keyed import upsert_by_key


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _members_with_hot_uid(spark, n_rows=30000):
    base = spark.range(n_rows).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 997).cast("string")).alias("uid"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 30).cast("int")), "yyyyMMdd").alias("dt"))
    return base.withColumn("grp", F.when((F.col("uid") == "hot") | (F.length("uid") % 2 == 0), "A").otherwise("B"))


def test_hot_uid_retention_whole(spark):
    m = _members_with_hot_uid(spark).cache()
    r = {(x.grp, x.dt): x for x in R.retention(m, 7, "20240101").collect()}
    # brute force for one end day: sets of users per window
    D = "20240120"
    rows = m.select("grp", "uid", "dt").distinct().collect()
    for g in ("A", "B"):
        days = {}
        for x in rows:
            if x.grp == g:
                days.setdefault(x.uid, set()).add(x.dt)
        prev = {u for u, ds in days.items() if any("20240107" <= d <= "20240113" for d in ds)}
        hist = {u for u, ds in days.items() if any("20240101" <= d <= "20240106" for d in ds)}
        cur = {u for u, ds in days.items() if any("20240114" <= d <= D for d in ds)}
        got = r[(g, D)]
        assert (got.user_active_7, got.user_new_7) == (len(prev), len(prev - hist))
        assert (got.user_active_7_stay, got.user_new_7_stay) == (len(prev & cur), len((prev - hist) & cur))
    st = {(x.grp, x.dt): x.user_active for x in R.user_stats_daily(m, "20240101").collect()}
    assert sum(st.values()) == m.count()       # every member row counted, none dropped


def test_hot_key_upsert_is_partial(spark):
    cur = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                    F.col("id").alias("v"))
    inc = spark.range(30000, 30010).select(F.lit(0).alias("k"), F.col("id").alias("v"))
    out = upsert_by_key(cur, inc, "k", order_by=["v"])
    assert "partial_max_by" in _plan(out)
    res = {r.k: r.v for r in out.collect()}
    assert res[0] == 30009 and len(res) == 1 + 30000 - 10000


def test_hot_slot_exposures_exact(spark):
    n = 30000
    j = (F.col("id") / 2).cast("long")          # ids 2j (group A) and 2j+1 (group B) share a slot
    df = spark.range(n).select(
        F.when(j % 3 == 0, F.lit("1")).otherwise(((j % 50) + 2).cast("string")).alias("rec_pos"),
        F.lit("2").alias("rec_type"), F.lit("1").alias("action_type"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("grp"),
        F.lit("20240101").alias("dt"))
    out = SL.slot_exposures(df)
    assert "partial_count" in _plan(out)
    r = out.collect()[0]
    assert r.a_expose == n // 2 and r.b_expose == n // 2   # every B slot is also an A AI slot here
