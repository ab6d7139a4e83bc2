"""Scalar functions on hand-made rows (FIXTURES.md §4)."""
from pyspark.sql import functions as F

from abflow.functions import timefn as TF
from abflow.functions.fields import duration_seconds, split_java, watch_seconds
from abflow.functions.groups import ab_group, total_key


def test_ab_group_edges(spark):
    uids = ["u0", "u1", "u2", "u3", "u4", "u5", "u6", "u7", "u8", "u9", "ua", "", None, "x\U0001F600"]
    df = spark.createDataFrame([(u,) for u in uids], "uid string")
    got = {r.uid: r.g for r in df.select("uid", ab_group("uid").alias("g")).collect()}
    for d in "23456":
        assert got[f"u{d}"] == "A"
    for d in "01789":
        assert got[f"u{d}"] == "B"
    assert got["ua"] == ("A" if ord("a") % 10 < 5 else "B")   # 97 % 10 = 7 -> B
    assert got[""] is None and got[None] is None
    # outside the BMP the last UTF-16 unit is the low surrogate
    low = 0xDC00 + (0x1F600 - 0x10000) % 1024
    assert got["x\U0001F600"] == ("A" if low % 10 < 5 else "B")


def test_epoch_conversions(spark):
    df = spark.createDataFrame([("1554395536",), (None,), ("",), ("null",), ("abc",)], "t string")
    r = df.select(TF.epoch_to_hour("t").alias("h"), TF.epoch_to_date("t").alias("d")).collect()
    assert (r[0].h, r[0].d) == ("2019040500", "20190405")
    assert [x.h for x in r[1:4]] == ["未知"] * 3
    assert r[4].h is None  # not a number: null (a reject), the job does not fail


def test_compact_time(spark):
    df = spark.createDataFrame([("20190319172347227",), ("20190231000000000",), ("null",), ("123",)], "t string")
    r = df.select(TF.compact_to_epoch_ms("t").alias("ms"), TF.time_to_timestamp("t", unit="s").alias("s")).collect()
    assert r[0].ms == "1552987427227" and r[0].s == "1552987427"
    assert r[1].ms is None          # impossible day
    assert r[2].ms == "未知"
    assert r[3].ms is None


def test_time_independent_of_session_zone(spark):
    df = spark.createDataFrame([("1554395536", "20190319172347227")], "a string, b string")
    q = df.select(TF.epoch_to_hour("a").alias("h"), TF.compact_to_epoch_ms("b").alias("ms"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        res = []
        for tz in ("UTC", "America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            res.append(tuple(q.collect()[0]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert len(set(res)) == 1 and res[0] == ("2019040500", "1552987427227")


def test_date_ranges_over_month_and_year_end(spark):
    df = spark.createDataFrame([("20191231",), ("20200301",)], "d string")
    r = df.select(TF.shift_date("d", 1).alias("n"), TF.shift_date("d", -1).alias("p"),
                  TF.window_bounds("d", 7).alias("w")).collect()
    assert (r[0].n, r[0].p) == ("20200101", "20191230")
    assert (r[1].n, r[1].p) == ("20200302", "20200229")
    assert (r[0].w.cur_start, r[0].w.prev_start, r[0].w.prev_end) == ("20191225", "20191218", "20191224")


def test_split_java_and_ext(spark):
    df = spark.createDataFrame([("1;2;",), (";;",), ("",), ("a",)], "s string")
    got = [r.x for r in df.select(split_java("s", ";").alias("x")).collect()]
    assert got == [["1", "2"], [], [""], ["a"]]
    e = spark.createDataFrame([("v:1,p:SC823,w:40,x:0,y:0,d:25",), ("v:1,p,w,x,y,d",), ("short",)], "ext string")
    r = e.select(watch_seconds("ext").alias("w"), duration_seconds("ext").alias("d")).collect()
    assert (r[0].w, r[0].d) == (40, 25)
    assert (r[1].w, r[1].d) == (None, None)   # item without ':' -> null, not a failure
    assert (r[2].w, r[2].d) == (None, None)


def test_total_key(spark):
    df = spark.createDataFrame([("A", "20190413"), ("qianB", "20190414")], "g string, d string")
    assert [r.k for r in df.select(total_key("g", "d").alias("k")).collect()] == ["a20190413", "b20190414"]


def test_small_named_helpers(spark):
    from abflow.functions.fields import watch_fields
    from abflow.operators.funnel import select_actions
    from abflow.operators.retention import user_stats_daily
    from abflow.operators.slots import sort_slots
    from abflow.sources.tables import date_range, name_fields
    assert [r.dt for r in date_range(spark, "20200227", "20200301").collect()] == ["20200227", "20200228", "20200229", "20200301"]
    w = watch_fields(spark.createDataFrame([("v:1,p:2,w:9,x:0,y:0,d:4",)], "ext string")).collect()[0]
    assert (w.watch_s, w.dur_s) == (9, 4)
    s = sort_slots(spark.createDataFrame([("d", "10"), ("d", "9"), ("d", "x"), ("d", "1")], "dt string, rec_posi string"))
    assert [r.rec_posi for r in s.collect()] == ["1", "9", "10", "x"]
    a = select_actions(spark.createDataFrame([("u", "1", "20240101")], "uid string, action_type string, dt string"))
    assert a.columns == ["uid", "action_type", "action_time"]
    m = spark.createDataFrame([("A", "u", "20240101"), ("A", "u", "20240102"), ("A", "v", "20240102")],
                              "grp string, uid string, dt string")
    assert {r.dt: r.user_remain for r in user_stats_daily(m, "20240101").collect()} == {"20240101": 0, "20240102": 1}
    n = name_fields(spark.createDataFrame([("a\tb",), ("c",)], "value string"), ["x", "y"], key_index=1).collect()
    assert [(r.x, r.y, r.row_key) for r in n] == [("a", "b", "b")]
