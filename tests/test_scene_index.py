"""The scene index leaves out files that can't hold a scene, and only those."""
import os
import random

import pytest
from pyspark.sql import functions as F

from abflow import jobs
from abflow.operators.filters import by_scene
from abflow.sources import scene_index as X
from abflow.sources.logs import read_behavior_log

LINE = "{uid}\tx\t{scene}\t1\t{sec}"


def put(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(LINE.format(uid=f"u{i}", scene=s, sec=t) + "\n" for i, (s, t) in enumerate(rows)))


def same(spark, logs, index, scene, **kw):
    got = X.read_scene_log(spark, logs, index, scene, "20240101", "20240105", min_fields=5, **kw)
    want = by_scene(read_behavior_log(spark, logs, "20240101", "20240105", min_fields=5), scene)
    if "seconds" in kw:
        want = want.filter(F.col("action_sec").between(*kw["seconds"]))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    return want.count()


def names(paths):
    return sorted(os.path.basename(p) for p in paths)


def test_files_are_chosen_by_scene_and_time(spark, tmp_path):
    logs, index = str(tmp_path / "logs"), str(tmp_path / "index")
    one, two = tmp_path / "logs" / "20240101", tmp_path / "logs" / "20240103"
    put(one, "a", [("S1", 100), ("S2", 200)])
    put(one, "b{1}[x]", [("S2", 300), ("S3", "")])
    put(two, "c", [("S3", 400), ("Ü 3", "9999999999999999999999")])
    (two / "short").write_text("u\tx\n\n")
    (two / "empty").write_text("")
    assert names(X.choose(spark, logs, index, "S1", "20240101", "20240105")) == sorted(["a", "b\\{1\\}\\[x\\]", "c", "short"])  # no index yet; a file without bytes is none
    assert same(spark, logs, index, "S1") == 1
    X.update(spark, logs, index, "20240101", "20240105")
    chosen = lambda s, **kw: set(names(X.choose(spark, logs, index, s, "20240101", "20240105", **kw)))
    assert chosen("S1") == {"a"} and chosen("S2") == {"a", "b\\{1\\}\\[x\\]"} and chosen("Ü 3") == {"c"} and chosen("S9") == set()
    assert chosen("S2", seconds=(0, 250)) == {"a"} and chosen("S3", seconds=(250, 1000)) == {"b\\{1\\}\\[x\\]", "c"}
    assert [same(spark, logs, index, s) for s in ("S1", "S2", "S3", "Ü 3", "S9", "")] == [1, 2, 2, 1, 0, 0]
    assert same(spark, logs, index, "S2", seconds=(150, 250)) == 1
    # what comes or changes later is read until it is indexed
    put(two, "d", [("S1", 500)])
    put(one, "a", [("S4", 100), ("S1", 150), ("S5", 150)])
    put(tmp_path / "logs" / "20240109", "z", [("S1", 1)])
    assert chosen("S2") == {"a", "b\\{1\\}\\[x\\]", "d"} and same(spark, logs, index, "S1") == 2 and same(spark, logs, index, "S2") == 1
    assert X.update(spark, logs, index, "20240101", "20240105") == 2
    assert X.update(spark, logs, index, "20240101", "20240105") == 0
    assert chosen("S2") == {"b\\{1\\}\\[x\\]"} and chosen("S5") == {"a"} and same(spark, logs, index, "S1") == 2
    # a range without folders is empty, a root without any fails
    assert X.choose(spark, logs, index, "S1", "20250101", "20250102") == []
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        X.choose(spark, str(tmp_path / "none"), index, "S1", "20250101", "20250102")


def test_filter_never_loses_a_scene(spark):
    """The bits that are set are the ones that are asked for, over many scenes; few others pass."""
    rng = random.Random(3)
    has = [f"scene {rng.random()}" for _ in range(300)]
    rows = spark.createDataFrame([(s,) for s in has], "s string").select(F.explode(F.array(*X._positions(F.col("s")))).alias("bit"))
    bits = rows.agg(F.bitmap_construct_agg("bit").alias("scenes")).first().scenes
    df = spark.createDataFrame([(bytes(bits),)], "scenes binary")
    assert all(df.select(*[X.may_hold(F.col("scenes"), s).alias(str(i)) for i, s in enumerate(has[:30])]).first())
    others = df.select(*[X.may_hold(F.col("scenes"), f"no {i}").alias(str(i)) for i in range(60)]).first()
    assert sum(others) <= 2


def test_jobs_with_an_index(spark, tmp_path):
    logs, index = str(tmp_path / "logs"), str(tmp_path / "index")
    put(tmp_path / "logs" / "20240102", "a", [("S_REL", 1704153600), ("S_REL", 1704153700)])
    put(tmp_path / "logs" / "20240102", "b", [("S_NEWS", 1704153600)])
    X.update(spark, logs, index, "20240101", "20240105")
    args = (spark, logs, "20240101", "20240105", "S_REL", "", 5)
    assert sorted(map(str, jobs.scene_log(*args, scene_index=index).collect())) == sorted(map(str, jobs.scene_log(*args).collect()))
    read = jobs.scene_log(*args, scene_index=index).inputFiles()
    assert names(read) == ["a"]
    with pytest.raises(ValueError):
        jobs.scene_log(*args, rejects=str(tmp_path / "r"), scene_index=index)
