"""Partial aggregates, bucketed snapshot, compaction: replays, crashes, files left alone."""
import os

import pytest
from pyspark.sql import functions as F

from abflow.operators import partials as P
from abflow.operators import snapshot as SN
from abflow.operators.keyed import offset_audit, offset_ranges
from abflow.streaming.compact import compact_hours, read_events
from abflow.streaming.ingest import ARRIVAL, write_batch


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.startswith("part-")}


def test_partials_edge_rows_and_replay(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = [("A", "s", "u1", "1", "2024010100"), ("A", "s", "u1", "1", "2024010100"), ("A", "s", "u1", "2", "2024010101"), ("A", "s", "u2", "13", "2024010123"),
            ("B", None, "u3", "3", "2024010200"), (None, "s", None, "1", "2024010100"), ("A", "s", "u4", "6", None)]
    ev = spark.createDataFrame(rows, "grp string, scene_id string, uid string, action_type string, h string")
    for k in (0, 1, 0):
        P.write_partials(ev.filter("uid is null or uid < 'u3'") if k else ev.filter("uid >= 'u3'"), F.col("h"), path, "q", k)
    P.write_partials(ev.limit(0), F.col("h"), path, "q", 2)
    t = P.read_partials(spark, path)
    for x in (t, P.compact(t)):
        assert sorted(tuple(r) for r in P.funnel(x, "s").collect()) == [("A", "20240101", 2, 1, 2, 0), ("A", "未知", 0, 0, 1, 1)]
        assert [tuple(r) for r in P.players(x).collect()] == [("B", "20240102", 1)]
    assert sorted(tuple(r) for r in P.funnel(t, "s", ("hour",)).collect()) == [("2024010100", 2, 0, 1, 0), ("2024010101", 0, 1, 1, 0), ("2024010123", 0, 0, 1, 0), ("未知", 0, 0, 1, 1)]
    assert P.compact(t).count() == t.count() == 5
    plan = P.funnel(t, "s")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(scene_id), EqualTo(scene_id,s)]" in plan and "plays" not in plan.split("ReadSchema")[-1]


def items(spark, rows, load=1):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "k string, v string, _i int")
    return df.select("k", "v", F.lit(load).alias("_load"), F.struct(F.lit("f").alias("f"), F.lit(0).cast("bigint").alias("b"), F.col("_i").cast("bigint").alias("r")).alias("_pos"))


def test_snapshot_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "s")
    assert SN.read(spark, path) is None
    assert SN.load(spark, path, items(spark, [(f"k{i}", "a") for i in range(200)] + [("k7", "late"), (None, "n")]), "k", 16) == 1
    before = files(f"{path}/data")
    assert SN.load(spark, path, items(spark, [("k3", "b"), ("new", "c"), ("k3", "d")]), "k", 16) == 2
    after = files(f"{path}/data")
    assert before.items() <= after.items()   # no file of the first load was touched
    touched = {int(r[0]) for r in spark.createDataFrame([("k3",), ("new",)], "k string").select(SN.bucket_of("k", 16)).collect()}
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in set(after) - set(before)} == touched
    got = {r.k: r.v for r in SN.read(spark, path).collect()}
    assert got == {**{f"k{i}": "a" for i in range(200)}, "k7": "late", None: "n", "k3": "d", "new": "c"}
    assert {r.k: r.v for r in SN.read(spark, path, 1).collect()}["k3"] == "a"   # the old version stays readable
    assert SN.load(spark, path, items(spark, []), "k", 16) == 3
    assert SN.read(spark, path).count() == 202
    with pytest.raises(ValueError, match="16 buckets"):
        SN.load(spark, path, items(spark, [("a", "b")]), "k", 8)


def test_snapshot_survives_a_dead_load(spark, tmp_path):
    """Data without a manifest is never read, and the next load writes over it."""
    path = str(tmp_path / "s")
    SN.load(spark, path, items(spark, [("a", "1"), ("b", "1")]), "k", 4)
    spark.createDataFrame([("a", "broken")], "k string, v string").write.parquet(f"{path}/data/version=2/bucket=0")
    assert {r.k: r.v for r in SN.read(spark, path).collect()} == {"a": "1", "b": "1"}
    assert SN.load(spark, path, items(spark, [("b", "2")]), "k", 4) == 2
    assert {r.k: r.v for r in SN.read(spark, path).collect()} == {"a": "1", "b": "2"}
    assert SN.load(spark, str(tmp_path / "e"), items(spark, []), "k", 4) == 1 and SN.read(spark, str(tmp_path / "e")) is None


def batch(spark, ids, hour="2024010100"):
    return spark.createDataFrame([(f'{{"eventId":"{i}"}}', hour) for i in ids], f"value string, {ARRIVAL} string")


def test_compaction_before_during_after_and_replay(spark, tmp_path):
    raw, comp = str(tmp_path / "ev"), str(tmp_path / "c")
    ids = lambda: sorted(int(r.eventId) for r in read_events(spark, raw, comp).select("eventId").collect())
    for k in range(6):
        write_batch(batch(spark, range(10 * k, 10 * k + 10), f"202401010{k % 2}"), k, raw, None, "q")
    assert ids() == list(range(60))
    # during: rows copied, no manifest yet
    spark.read.parquet(raw).write.partitionBy("curr_time").parquet(f"{comp}/data/run=1")
    assert ids() == list(range(60))
    assert compact_hours(spark, raw, comp, "2024010100", "2024010100") == 1
    assert ids() == list(range(60)) and len(files(f"{comp}/data/run=1")) < len(files(raw))
    assert compact_hours(spark, raw, comp, "2024010100", "2024010100") is None
    write_batch(batch(spark, range(0, 10)), 0, raw, None, "q")       # a covered batch is replayed
    write_batch(batch(spark, range(60, 70)), 6, raw, None, "q")      # and a late one arrives in the hour
    assert ids() == list(range(70))
    assert compact_hours(spark, raw, comp, "2024010100", "2024010199") == 2
    assert ids() == list(range(70))
    assert {r.curr_time for r in read_events(spark, raw, comp).select("curr_time").collect()} == {"2024010100", "2024010101"}


def test_offset_audit_cases(spark):
    rows = [("t", 0, o, 1) for o in range(0, 5)] + [("t", 0, o, 2) for o in range(3, 8)] + [("t", 0, o, 3) for o in (10, 11, 13)] + [("t", 1, 4, 1), ("t", 1, 4, 1)]
    r = offset_ranges(spark.createDataFrame(rows, "topic string, partition int, offset long, batch_id int"), ["batch_id"])
    start = spark.createDataFrame([("t", 0, 0), ("t", 1, 2)], "topic string, partition int, offset long")
    got = sorted(tuple(x) for x in offset_audit(r, start).collect())
    assert got == [("t", 0, "gap", 8, 10, 2), ("t", 0, "hole", 10, 14, 1), ("t", 0, "overlap", 3, 5, 2), ("t", 1, "gap", 2, 4, 2)]
    assert offset_audit(r.limit(0)).collect() == []
