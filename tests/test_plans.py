"""Plan checks: no Python in any registered plan, pruning reaches the scan,
partition filters on the membership table, one shuffle per retention pass."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from abflow.operators import retention as R
from abflow.plans.catalog import QUERIES, rel_members
from abflow.sinks.files import write_members
from abflow.sources.tables import members

# every query without Python: the library's own, and the operators of the pipeline that are built from functions alone
NATIVE = [*QUERIES, *(n for n in E.queries() if n.startswith(("op4_", "op7_")))]
PYTHON = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "PythonUDTF", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow",
          "FlatMapCoGroupsInPandas", "FlatMapCoGroupsInArrow", "AggregateInPandas", "ArrowAggregatePython", "WindowInPandas", "ArrowWindowPython")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_no_python_no_nested_loop(spark, sf, name):
    p = plan(E.queries()[name](spark, sf))
    for bad in (*PYTHON, *(() if name.startswith("op") else ("NestedLoopJoin", "CartesianProduct"))):
        assert bad not in p


@pytest.mark.parametrize("name", ["funnel_report_a", "funnel_report_b", "province_report"])
def test_reports_come_in_day_order(spark, sf, name):
    days = [r.action_time for r in E.queries()[name](spark, sf).collect()]
    assert len(days) > 20 and days == sorted(days)


def test_scan_prunes_columns(spark, sf):
    df = E.queries()["funnel_daily_ab"](spark, sf)
    p = plan(df)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,event_type:string" in p
    assert "value:double" not in p   # value is not needed by the funnel


def test_member_partition_filters(spark, sf, tmp_path):
    path = str(tmp_path / "members")
    write_members(rel_members(spark, sf), path)
    m = spark.read.parquet(path)
    q = members(m, "B", "20240105", "20240112")
    txt = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(grp" in txt and "(grp#" in txt
    assert q.count() > 0


def test_retention_single_pass(spark, sf):
    """One scan, one shuffle of member rows on (grp, uid); the rest is per-day sized."""
    import re
    r = R.retention(rel_members(spark, sf), 7, "20240101")
    txt = plan(r)
    assert txt.count("FileScan") == 1
    assert len(re.findall(r"Exchange hashpartitioning\(grp#\d+, uid#\d+, \d+\)", txt)) == 1
    # the only other exchanges: the partial distinct and per-day sized aggregates / windows
    assert len(re.findall(r"Exchange hashpartitioning", txt)) == 4
    assert "CartesianProduct" not in txt and "NestedLoopJoin" not in txt


@pytest.mark.parametrize("name", ["report_daily_ab", "funnel_daily_ab", "watch_stats_ab", "log_parse"])
def test_distinct_counts_do_not_expand_rows(spark, sf, name):
    """One distinct expression per aggregate: no Expand multiplying the log rows."""
    assert "Expand" not in plan(E.queries()[name](spark, sf))


def test_retention_prunes_member_partitions(spark, sf, tmp_path):
    """End days [d1, d2] read only member partitions in [min(start, d1-2n+1), d2], same counts."""
    path = str(tmp_path / "members")
    write_members(rel_members(spark, sf), path)
    m = spark.read.parquet(path).withColumn("dt", F.col("dt").cast("string"))
    r = R.retention(m, 7, "20240110", "20240125", "20240127")
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")   # plan text is cut at 100 chars by default
    try:
        txt = plan(r)
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    pf = txt[txt.index("PartitionFilters"):].split("]")[0]
    assert ">= 20240110" in pf and "<= 20240127" in pf, pf  # min(start, d1 - 13) .. d2
    full = {(x.grp, x.dt): tuple(x) for x in R.retention(m, 7, "20240110").collect()}
    part = {(x.grp, x.dt): tuple(x) for x in r.collect()}
    assert sorted(part) == sorted(k for k in full if "20240125" <= k[1] <= "20240127"), (sorted(part), len(full))
    assert all(part[k] == full[k] for k in part), [(k, part[k], full[k]) for k in part if part[k] != full[k]]
