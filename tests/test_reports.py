"""Reports and sinks: join form == aggregate form, wide rows, re-runnable writes."""
import pytest
from pyspark.sql import functions as F

from abflow import schema as S
from abflow.operators.filters import by_scene
from abflow.operators.funnel import funnel_report
from abflow.plans.catalog import gblog, rel_members
from abflow.plans.reports import daily_report, retention_report
from abflow.plans.sqlviews import sql_funnel_report
from abflow.sinks.files import write_members, write_partitioned, write_report, write_totals
from abflow.operators.retention import cumulative_users
from abflow.sources.tables import read_totals


def test_join_form_equals_aggregate_form(spark, sf):
    logs = by_scene(gblog(spark, sf), "S_REL")
    for g in ("A", "B"):
        a = sorted(tuple(r) for r in funnel_report(logs, g).collect())
        b = sorted(tuple(r) for r in sql_funnel_report(spark, logs, g).collect())
        assert a == b and len(a) == 30


def test_daily_report_layout(spark, sf):
    rep = daily_report(gblog(spark, sf), "S_REL", "20240101")
    assert rep.columns == S.DAILY_REPORT_FIELDS
    r = {x.date: x for x in rep.collect()}["20240101"]
    assert (r.a_expose, r.a_user_active, r.a_order, r.a_user_new) == (12, 65, 14, 65)


def test_retention_report_layout(spark, sf):
    rep = retention_report(rel_members(spark, sf), "S_REL", "20240101")
    assert rep.columns == S.RETENTION_REPORT_FIELDS
    r = {x.date: x for x in rep.collect()}["20240122"]
    assert (r.a_user_active_7, r.a_user_new_7, r.a_user_active_7_stay, r.a_user_new_7_stay) == (396, 341, 56, 50)
    assert (r.b_user_active_7, r.b_user_new_7, r.b_user_active_7_stay, r.b_user_new_7_stay) == (337, 291, 42, 39)


def test_member_write_is_rerunnable(spark, sf, tmp_path):
    path = str(tmp_path / "m")
    m = rel_members(spark, sf)
    write_members(m, path)
    write_members(m.filter(F.col("dt") == "20240101"), path)   # re-run of one day replaces only that day
    back = spark.read.parquet(path)
    assert back.count() == m.count()
    assert sorted(c for c in back.columns) == ["dt", "grp", "uid"]


def test_report_and_totals_sinks(spark, sf, tmp_path):
    rep = daily_report(gblog(spark, sf), "S_REL", "20240101")
    write_report(rep, "json", str(tmp_path / "rep"), as_text=True)
    back = spark.read.json(str(tmp_path / "rep"))
    assert back.count() == 30 and dict(back.dtypes)["a_expose"] == "string"
    tot = cumulative_users(rel_members(spark, sf), "20240101")
    write_totals(tot, "parquet", str(tmp_path / "tot"))
    t = read_totals(spark, "parquet", str(tmp_path / "tot"))
    assert t.columns == ["date", "user_num"] and t.count() == 60


def test_write_partitioned(spark, tmp_path):
    df = spark.createDataFrame([("a", "2024010100"), ("b", "2024010100"), ("c", "2024010101")], "v string, curr_time string")
    write_partitioned(df, str(tmp_path / "e"), "curr_time")
    names = sorted(p.name for p in (tmp_path / "e").iterdir() if p.name.startswith("curr_time="))
    assert names == ["curr_time=2024010100", "curr_time=2024010101"]


@pytest.mark.parametrize("match", ["whole", "any"])
def test_news_report_reads_the_log_once(spark, sf, match):
    """As slot_exposures and watch_stats on the log itself; one scan, and no checkpoint."""
    from abflow.functions.fields import watch_fields
    from abflow.operators.filters import by_scene
    from abflow.operators.groups import with_group
    from abflow.operators.slots import slot_exposures, watch_stats
    from abflow.plans.catalog import SCENE_NEWS, parsed_logs
    from abflow.plans.reports import news_report
    logs = watch_fields(with_group(by_scene(parsed_logs(spark, sf), SCENE_NEWS)))
    # a play in one slot, as the whole field is compared
    logs = logs.withColumn("rec_pos", F.when(F.col("action_type") == "3", F.substring_index("rec_pos", ";", 1)).otherwise(F.col("rec_pos")))
    df = news_report(logs, slot_match=match)
    got = {r.date: r for r in df.collect()}
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan") == 1 and "ExistingRDD" not in final and final.count("ReusedExchange") >= 2, final
    ex = {r.dt: r for r in slot_exposures(logs).collect()}
    assert set(got) == set(ex) and {d: (r.a_expose, r.b_expose) for d, r in got.items()} == {d: (r.a_expose, r.b_expose) for d, r in ex.items()}
    ws = watch_stats(logs, slot_match=match).collect()
    assert len(ws) > 20
    for r in ws:
        g = r.grp.lower()
        assert (r.plays, r.watch_sum, r.watch_mean) == tuple(got[r.dt][f"{g}_{c}"] for c in ("plays", "watch_sum", "watch_mean"))
