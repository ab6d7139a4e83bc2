"""Empty inputs (a scene or range without data) give empty results, not errors."""
from abflow.operators import retention as R
from abflow.operators import slots as SL
from abflow.operators.funnel import funnel_daily, funnel_report
from abflow.operators.keyed import offset_ledger, upsert_by_key
from abflow.plans.reports import daily_report, retention_report

LOG = ("uid string, grp string, dt string, scene_id string, action_type string, rec_pos string, "
       "rec_type string, watch_s bigint, dur_s bigint, event_id bigint")


def test_empty_inputs(spark):
    logs = spark.createDataFrame([], LOG)
    mem = spark.createDataFrame([], "grp string, uid string, dt string")
    assert funnel_daily(logs).count() == 0
    assert funnel_report(logs, "A").count() == 0
    assert SL.slot_exposures(logs).count() == 0
    assert SL.watch_stats(logs, slot_match="any").count() == 0
    assert SL.slot_exposures(logs, cumulative=True).count() == 0
    assert R.retention(mem, (7, 30), "20240101").count() == 0
    assert R.user_stats_daily(mem, "20240101").count() == 0
    assert retention_report(mem, "S", "20240101").count() == 0
    assert daily_report(logs, "S", "20240101", members=mem).count() == 0
    kv = spark.createDataFrame([], "k string, v string")
    assert upsert_by_key(kv, kv, "k").count() == 0
    assert offset_ledger(spark.createDataFrame([], "topic string, partition int, offset long")).count() == 0
