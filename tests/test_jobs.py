"""The runnable jobs end to end on files written from the fixture, compared
with the registered (oracle-checked) queries."""
from pyspark.sql import functions as F

from abflow import jobs
from abflow.plans.catalog import q_report_daily_ab, q_report_retention_ab, rel_members
from abflow.sources.fixture import item_lines, log_lines


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_member_and_report_jobs(spark, sf, tmp_path):
    logs = str(tmp_path / "logs")
    log_lines(spark, sf).write.partitionBy("dt").text(logs)
    mem, daily, ret = (str(tmp_path / x) for x in ("members", "daily", "retention"))
    kw = dict(folder_prefix="dt=")
    jobs.rel_members_job(spark, logs, "20240101", "20240130", mem, scene="S_REL", **kw)
    got_m = spark.read.parquet(mem).select("grp", F.col("dt").cast("string").alias("dt"), "uid")
    assert _rows(got_m) == _rows(rel_members(spark, sf).select("grp", "dt", "uid"))
    jobs.rel_reports_job(spark, logs, "20240101", "20240130", mem, daily, ret, history_start="20240101",
                         scene="S_REL", as_text=False, **kw)
    assert _rows(spark.read.parquet(daily).select(*q_report_daily_ab(spark, sf).columns)) == _rows(q_report_daily_ab(spark, sf))
    want = q_report_retention_ab(spark, sf)
    assert _rows(spark.read.parquet(ret).select(*want.columns)) == _rows(want)


def test_news_and_metrics_jobs(spark, sf, tmp_path):
    from abflow.operators.groups import members_daily
    from abflow.plans.catalog import parsed_logs, q_funnel_report_a, q_funnel_report_b, q_news_report, q_players_ab
    logs = str(tmp_path / "logs")
    log_lines(spark, sf).write.partitionBy("dt").text(logs)
    kw = dict(folder_prefix="dt=")
    nm, nr, rm, mem = (str(tmp_path / x) for x in ("news_members", "news_report", "rel_metrics", "members"))
    jobs.news_members_job(spark, logs, "20240101", "20240130", nm, "V2.1", scene="S_NEWS", **kw)
    got = spark.read.parquet(nm).select(F.substring("grp", -1, 1).alias("grp"), F.col("dt").cast("string"), "uid")
    assert _rows(got) == _rows(members_daily(parsed_logs(spark, sf), "S_NEWS", version="V2.1").select("grp", "dt", "uid"))
    jobs.news_metrics_job(spark, logs, "20240101", "20240130", nr, "V2.1", scene="S_NEWS", slot_match="any", **kw)
    want = q_news_report(spark, sf)
    assert _rows(spark.read.parquet(nr).select(*want.columns)) == _rows(want)
    jobs.rel_members_job(spark, logs, "20240101", "20240130", mem, scene="S_REL", **kw)
    jobs.rel_metrics_job(spark, logs, "20240101", "20240130", mem, rm, history_start="20240101", scene="S_REL", tz="UTC", **kw)
    for g, q in (("a", q_funnel_report_a), ("b", q_funnel_report_b)):
        w = q(spark, sf)
        assert _rows(spark.read.parquet(f"{rm}/funnel_{g}").select(*w.columns)) == _rows(w)
    w = q_players_ab(spark, sf)
    assert _rows(spark.read.parquet(f"{rm}/players").select(*w.columns)) == _rows(w)
    assert spark.read.parquet(f"{rm}/retention").count() == 30


def test_items_job_two_loads(spark, sf, tmp_path):
    it = item_lines(spark, sf)
    first, second = str(tmp_path / "d1"), str(tmp_path / "d2")
    it.filter(F.col("_ts") < "2024-01-16").select("value").write.text(first)
    it.filter(F.col("_ts") >= "2024-01-16").select("value").write.text(second)
    fields = "user_id,event_id,event_type,ts,value"
    snap = str(tmp_path / "snap")
    jobs.items_job(spark, first, fields, 0, snap, str(tmp_path / "exp"), date="20240116")
    s2, exp = jobs.items_job(spark, second, fields, 0, snap, str(tmp_path / "exp"), date="20240131", single_file=True)
    latest = {r.user_id: r.event_id for r in spark.read.parquet(s2).collect()}
    from abflow.plans.catalog import q_item_upsert
    assert latest == {str(r.user_id): str(r.event_id) for r in q_item_upsert(spark, sf).collect()}
    lines = spark.read.text(exp).collect()
    assert len(lines) == len(latest) and all(r.value.endswith("\t") for r in lines)


def test_unreadable_snapshot_fails(spark, sf, tmp_path):
    import pytest
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "x").write_text("k\tv\n")
    (tmp_path / "snap" / "version=1").mkdir(parents=True)
    (tmp_path / "snap" / "version=1" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        jobs.items_job(spark, str(tmp_path / "d"), "a,b", 0, str(tmp_path / "snap"), str(tmp_path / "e"), date="d")
    assert not (tmp_path / "snap" / "version=2").exists()


LINE = "{uid}\tx\t171587_4\t{code}\t{sec}\tv:V2,p:SC823,w:40,x:0,y:0,d:25\t1;2\t2;1"


def test_late_short_and_timeless_lines(spark, tmp_path):
    """Every line that has the fields a job reads counts; shorter ones are kept as rejects."""
    day = tmp_path / "logs" / "20190405"
    day.mkdir(parents=True)
    whole = [LINE.format(uid=f"u{i}", code=c, sec=s) for i, c, s in ((2, 2, 1554395536), (3, 3, 1554220800), (4, 2, ""), (5, 6, 1554395536))]
    short = ["u6\tx\t171587_4\t2\t1554395536", "u7\tx\t171587_4\t3", "u8\tx\t171587_4", "u9\tx"]
    (day / "p").write_text("\n".join(whole + short) + "\n")
    logs, mem, out, rej = (str(tmp_path / x) for x in ("logs", "mem", "out", "rej"))
    jobs.rel_members_job(spark, logs, "20190405", "20190406", mem, rejects=rej)
    assert {r.uid for r in spark.read.parquet(mem).collect()} == {f"u{i}" for i in range(2, 9)}
    assert [r.uid for r in spark.read.parquet(rej).collect()] == ["u9"]
    jobs.rel_metrics_job(spark, logs, "20190405", "20190406", mem, out, rejects=rej)
    b = {(r.folder_dt, r.action_time): r for r in spark.read.parquet(f"{out}/funnel_b").collect()}
    a = {(r.folder_dt, r.action_time): r for r in spark.read.parquet(f"{out}/funnel_a").collect()}
    days = {**a, **b}
    assert set(days) == {("20190405", "20190405"), ("20190405", "未知")}
    players = spark.read.parquet(f"{out}/players").collect()
    assert sum(r.players for r in players) == 1     # u3, though its time is two days late; u7's line is too short
    assert sorted(r.n_fields for r in spark.read.parquet(rej).collect()) == [2, 3, 4]


def test_first_seen_table_and_news_totals(spark, sf, tmp_path):
    """Daily runs on the first-seen table give what the whole history gives."""
    from abflow.operators.groups import members_daily
    from abflow.operators.retention import cumulative_users, user_stats_daily
    from abflow.plans.reports import retention_report
    from abflow.sinks.files import write_members
    from abflow.sources.fixture import blog
    mem, seen, tot, out = (str(tmp_path / x) for x in ("mem", "seen", "tot", "out"))
    m = members_daily(blog(spark, sf), "S_NEWS", a="qianA", b="qianB")
    write_members(m, mem)
    for a, b in (("20240101", "20240114"), ("20240115", "20240115")):
        jobs.first_seen_job(spark, mem, seen, a, b, history_start="20240101")
    cumulative_users(m, "20240101").filter("dt = '20240114'").select("date", "user_num").write.parquet(tot)
    table = dict(fmt="parquet", path=tot)
    jobs.user_metrics_job(spark, mem, seen, "20240115", out, table, table, history_start="20240101")
    got = {r.grp: (r.user_new, r.user_remain, r.user_active, r.state) for r in spark.read.parquet(out).collect()}
    want = {r.grp: (r.user_new, r.user_remain, r.user_active, "ok") for r in user_stats_daily(m, "20240101").filter("dt = '20240115'").collect()}
    assert got == want
    stored = {r.date: r.user_num for r in spark.read.parquet(tot).collect()}
    assert len(stored) == 4 and {k: v for k, v in stored.items() if k.endswith("15")} == {
        r.date: r.user_num for r in cumulative_users(m, "20240101").filter("dt = '20240115'").collect()}
    kw = dict(scene="n", start="20240101", d1="20240114", d2="20240115", groups=("qianA", "qianB"))
    first = jobs.read_version(spark, seen)[0]
    assert _rows(retention_report(m, first_seen=first, **kw)) == _rows(retention_report(m, **kw))
    assert any(v for r in retention_report(m, **kw).collect() for v in r[2:])
    import pytest
    with pytest.raises(Exception, match="group not in"):
        retention_report(m, "n", "20240101", groups=("A", "B")).collect()
    stored_days = spark.read.parquet(mem).withColumn("dt", F.col("dt").cast("string"))
    plan = retention_report(stored_days.filter(F.col("dt") >= "20240101"), first_seen=first, **kw)
    assert "20231116" in plan._jdf.queryExecution().toString()   # 60 days back from the first end day, no more
