"""Activity bitmaps against sets of days, and against the one-pass retention."""
import random
from collections import defaultdict
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from abflow import jobs
from abflow.operators import activity as A
from abflow.operators import retention as R
from abflow.sinks.files import write_members

BASE = date(2023, 12, 1)


def day(i):
    return (BASE + timedelta(days=i)).strftime("%Y%m%d")


def rows(seed=4, users=40, days=150):
    """Member rows over three words of bits, word edges included."""
    rng = random.Random(seed)
    out = [(rng.choice("AB") if u else "A", f"u{u}", day(d)) for u in range(users) for d in rng.sample(range(days), rng.randrange(1, 25))]
    out += [("A", "edge", day(d)) for d in (0, 61, 62, 123, 124, 149)]
    return out + out[:50] + [(None, "u", day(1)), ("A", None, day(1)), ("A", "bad", "x")]


def frame(spark, r):
    return spark.createDataFrame([(*x, 1) for x in r], "grp string, uid string, dt string, bits int")


def by_key(df):
    cols = sorted(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_bits_windows_and_first_days(spark):
    r = rows()
    days = defaultdict(set)
    for g, u, d in r:
        if g and u and d.isdigit():
            days[g, u].add((date(int(d[:4]), int(d[4:6]), int(d[6:])) - BASE).days)
    t = A.bitmaps(frame(spark, r), day(0))
    lo = [-40, -1, 0, 1, 30, 60, 61, 62, 63, 100, 123, 140, 160, 400]
    got = t.select("grp", "uid", *[A.active_days(F.lit(x), n).alias(f"c{x}_{n}") for x in lo for n in (1, 7, 62)],
                   *[A.first_day(F.lit(x)).alias(f"f{x}") for x in lo], A.last_day().alias("last")).collect()
    assert {(x.grp, x.uid) for x in got} == set(days)
    for x in got:
        own = days[x.grp, x.uid]
        for a in lo:
            for n in (1, 7, 62):
                assert x[f"c{a}_{n}"] == len(own & set(range(a, a + n)))
            assert x[f"f{a}"] == min((d for d in own if d >= a), default=None)
        assert x["last"] == max(own)


@pytest.mark.parametrize("n", [1, 7, 30])
def test_same_as_one_pass_retention(spark, n):
    m = frame(spark, [x for x in rows(n) if x[2] != "x"])
    t = A.bitmaps(m, day(0))
    for start in (day(0), day(70)):
        assert by_key(A.retention(t, n, day(0), start)) == by_key(R.retention(m, n, start))
    assert by_key(A.retention(t, n, day(0), day(0), day(90), day(95))) == by_key(R.retention(m, n, day(0), day(90), day(95)))
    stats = A.user_stats(t, day(0), day(70))
    assert by_key(stats.drop("total_users")) == by_key(R.user_stats_daily(m.dropDuplicates(["grp", "uid", "dt"]).filter("grp is not null and uid is not null"), day(70)))


def test_advance_day_by_day(spark):
    r = [x for x in rows(9, 12, 70) if x[2] < day(70)]
    m = frame(spark, r)
    t = A.bitmaps(m.filter(F.col("dt") < day(66)), day(0))
    for d in range(66, 70):
        new = m.filter(F.col("dt") == day(d))
        t = A.advance(t, new, day(0))
    t = A.advance(t, m.filter(F.col("dt") == day(69)), day(0))   # the same day again
    assert by_key(t) == by_key(A.bitmaps(m, day(0)))
    assert by_key(A.advance(A.bitmaps(m, day(0)), m.limit(0), day(0))) == by_key(A.bitmaps(m, day(0)))


def test_empty_and_too_early(spark):
    m = frame(spark, rows())
    assert A.bitmaps(m.limit(0), day(0)).count() == 0
    assert A.retention(A.bitmaps(m.limit(0), day(0)), 7, day(0), day(0)).count() == 0
    with pytest.raises(Exception, match="before the bitmap's base"):
        A.bitmaps(m, day(1)).collect()
    with pytest.raises(ValueError):
        A.window_bits(F.lit(0), 63)


def test_daily_update_reads_one_member_day(spark, tmp_path):
    """The job's plan has a partition filter on the day; a report has no window and no member scan."""
    members, kept = str(tmp_path / "m"), str(tmp_path / "b")
    m = frame(spark, [x for x in rows() if x[2] != "x"]).select("grp", "uid", "dt").filter("grp is not null and uid is not null")
    write_members(m, members)
    jobs.bitmaps_job(spark, members, kept, day(0), day(148), day(0))
    jobs.bitmaps_job(spark, members, kept, day(149), day(149), day(0))
    table, version = jobs.read_version(spark, kept)
    assert version == 2 and by_key(table) == by_key(A.bitmaps(m, day(0)))
    stored = spark.read.parquet(members).withColumn("dt", F.col("dt").cast("string"))
    new = A.advance(table, stored.filter(F.col("dt") == day(149)), day(0))
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = new._jdf.queryExecution().executedPlan().toString()
        report = A.retention(table, (7, 30), day(0), day(0), day(140), day(149))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)
    scan = next(x for x in plan.splitlines() if "FileScan" in x and members in x)
    assert f"= {day(149)}" in scan[scan.index("PartitionFilters"):]
    assert "Window" not in report and "Join" not in report and report.count("FileScan") == 1

    out = str(tmp_path / "ret")
    jobs.news_retention_job(spark, None, out, scene="N", history_start=day(0), start=day(120), end=day(149), bitmaps_path=kept, base=day(0))
    want = R.retention(m, 7, day(0), day(120), day(149))
    assert by_key(spark.read.parquet(out).withColumnRenamed("date", "dt").drop("scene_id")) == by_key(want)
