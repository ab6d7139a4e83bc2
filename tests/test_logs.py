"""Behaviour-log source over day folders: one scan, rejects, filters."""
import os

from pyspark.sql import Observation
from pyspark.sql import functions as F

from abflow.operators.filters import action_cond, by_release, in_slots
from abflow.sources.logs import day_list, parse_log_lines, read_behavior_log, read_log_text, valid_rows

GOOD = "u2\tx\tQXW_1\t1\t1554395536\tv:V2,p:SC823,w:40,x:0,y:0,d:25\t1;2\t2;1"


def _write_days(tmp_path, days):
    for day, lines in days.items():
        d = tmp_path / day
        d.mkdir()
        (d / "part-0").write_text("\n".join(lines) + "\n")


def test_day_list_over_year_end():
    assert day_list("20191230", "20200102") == ["20191230", "20191231", "20200101", "20200102"]


def test_read_range_one_scan_and_rejects(spark, tmp_path):
    _write_days(tmp_path, {
        "20191231": [GOOD, "u3\tx\tQXW_1"],                      # second line too short
        "20200101": [GOOD, GOOD.replace("\t2;1", "\t2;1\t\t")],    # trailing empty fields kept
        "20200105": [GOOD],                                       # outside the range
    })
    lines = read_log_text(spark, str(tmp_path), "20191231", "20200102")
    parsed = parse_log_lines(lines)
    obs = Observation("log")
    valid, rejects = valid_rows(parsed, observation=obs)
    rows = valid.collect()
    assert sorted(r.dt for r in rows) == ["20191231", "20200101", "20200101"]
    assert obs.get["rejects"] == 1 and obs.get["valid"] == 3
    assert rejects.count() == 1
    assert max(r.n_fields for r in rows) == 10
    df = read_behavior_log(spark, str(tmp_path))
    assert df.count() == 4   # all day folders


def test_event_day(spark, tmp_path):
    from abflow.sources.logs import with_event_day
    late = GOOD.replace("1554395536", "1554393600")   # 2019-04-05 00:00 +08 = 2019-04-04 16:00 UTC
    _write_days(tmp_path, {"20190405": [GOOD, late, GOOD.replace("1554395536", "1554220800")]})
    df = read_behavior_log(spark, str(tmp_path), "20190405", "20190405")
    assert sorted(r.dt for r in with_event_day(df).collect()) == ["20190403", "20190405", "20190405"]
    assert sorted(r.dt for r in with_event_day(df, tz="UTC").collect()) == ["20190402", "20190404", "20190404"]
    assert {r.folder_dt for r in with_event_day(df).collect()} == {"20190405"}
    odd = df.limit(1).withColumn("action_time_text", F.explode(F.array(F.lit(""), F.lit("x"), F.lit("9999999999999999"))))
    assert [r.dt for r in with_event_day(odd).collect()] == ["未知"] * 3   # no line is lost for its time


def test_wrong_root_fails_missing_days_do_not(spark, tmp_path):
    import pytest
    from pyspark.errors import AnalysisException
    _write_days(tmp_path, {"20190405": [GOOD]})
    assert read_log_text(spark, str(tmp_path), "20200101", "20200102").count() == 0
    with pytest.raises(AnalysisException):
        read_log_text(spark, str(tmp_path / "wrong"), "20190405", "20190405")


def test_action_matches(spark):
    df = spark.createDataFrame([("1",), ("01",), ("13",), ("3",), ("x",)], "action_type string")
    eq = [r.action_type for r in df.filter(action_cond("3", "equals")).collect()]
    num = [r.action_type for r in df.filter(action_cond("1", "numeric")).collect()]
    sub = [r.action_type for r in df.filter(action_cond("3", "contains")).collect()]
    assert eq == ["3"] and sorted(num) == ["01", "1"] and sorted(sub) == ["13", "3"]


def test_release_filter(spark):
    df = spark.createDataFrame([("V2,SC823",), ("V2,SC818",), ("V1,SC823",), ("V2,SC999",)], "ext string")
    assert by_release(df, "V2").count() == 2


def test_slot_membership_whole_vs_any(spark):
    plays = spark.createDataFrame([(1, "d", "3"), (2, "d", "3;6"), (3, "d", "6"), (4, "e", "3")],
                                  "event_id int, dt string, rec_pos string")
    slots = spark.createDataFrame([("d", "3"), ("d", "6")], "dt string, rec_posi string")
    whole = sorted(r.event_id for r in in_slots(plays, slots, "whole").collect())
    anym = sorted(r.event_id for r in in_slots(plays, slots, "any").collect())
    assert whole == [1, 3]          # "3;6" is not a slot as a whole
    assert anym == [1, 2, 3]        # kept once although two slots match


def test_explode_pairs_type_list_drives(spark):
    from abflow.operators.slots import explode_slot_list, explode_slots
    df = spark.createDataFrame([("1;2", "2;1;2"), ("5;6;7", "2"), ("1;2;", "2;2")], "rec_pos string, rec_type string")
    pairs = sorted((r.rec_posi, r.rec_typei) for r in explode_slots(df).collect())
    # row 1: third type has no slot -> dropped; row 2: only the first slot has a type; row 3: trailing ';' ignored
    assert pairs == [("1", "2"), ("1", "2"), ("2", "1"), ("2", "2"), ("5", "2")]
    assert explode_slot_list(df).count() == 2 + 3 + 2


def test_range_without_folders_gives_no_rows(spark, tmp_path):
    _write_days(tmp_path, {"20240101": [GOOD]})
    assert read_behavior_log(spark, str(tmp_path), "20240201", "20240203").count() == 0
    assert read_behavior_log(spark, str(tmp_path), "20231231", "20240102").count() == 1
