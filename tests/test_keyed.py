"""Keyed upsert, TSV export, offset ledger, distinct join."""
from pyspark.sql import functions as F

from abflow.operators.keyed import (join_distinct, ledger_to_offsets, load_order, offset_ledger,
                                    starting_offsets_json, upsert_by_key)
from abflow.sinks.files import export_tsv
from abflow.sources.tables import item_rejects, read_items, read_snapshot

FIELDS = ["id", "name", "kind"]


def test_upsert_later_line_and_load_win(spark, tmp_path):
    (tmp_path / "cur").mkdir()
    (tmp_path / "inc").mkdir()
    (tmp_path / "cur" / "a.txt").write_text("k1\told\tx\nk2\tkeep\tx\n")
    (tmp_path / "inc" / "b.txt").write_text("k1\tfirst\ty\nk1\tsecond\ty\nbad\tline\n\nk3\tnew\ty\t\n")
    cur = load_order(read_items(spark, str(tmp_path / "cur"), "id,name,kind"), 0)
    inc = load_order(read_items(spark, str(tmp_path / "inc"), FIELDS), 1)
    snap = {r.id: r.name for r in upsert_by_key(cur, inc, "id").collect()}
    assert snap == {"k1": "second", "k2": "keep"}   # later line of the later load wins; bad lines dropped
    lines = spark.read.text(str(tmp_path / "inc"))
    assert item_rejects(lines, FIELDS).count() == 3  # short, empty, and one-field-too-many lines


def test_export_tsv(spark, tmp_path):
    df = spark.createDataFrame([("k1", "n1"), ("k2", None)], "id string, name string")
    target = export_tsv(df, ["id", "name", "missing"], str(tmp_path), "20240101", single_file=True)
    out = sorted(r.value for r in spark.read.text(target).collect())
    assert out == ["k1\tn1\tnull\t", "k2\tnull\tnull\t"]
    assert len([p for p in (tmp_path / "20240101").iterdir() if p.name.startswith("part-")]) == 1
    snap = read_snapshot(spark, target, ["value", "absent"], fmt="text")
    assert snap.columns == ["value", "absent"]


def test_export_default_folder_is_yesterday(spark, tmp_path):
    from abflow.sinks.files import yesterday
    df = spark.createDataFrame([("k1",)], "id string")
    target = export_tsv(df, ["id"], str(tmp_path))
    assert target.endswith("/" + yesterday()) and len(yesterday()) == 8


def test_ledger_round_trip(spark):
    df = spark.createDataFrame([("t1", 0, 5), ("t1", 0, 9), ("t1", 1, 3), ("t2", 0, 0)],
                               "topic string, partition int, offset long")
    led = {r.topic: r.ledger for r in offset_ledger(df).collect()}
    assert led == {"t1": "0|10,1|4", "t2": "0|1"}
    back = ledger_to_offsets(offset_ledger(df))
    assert starting_offsets_json(back) == '{"t1": {"0": 10, "1": 4}, "t2": {"0": 1}}'


def test_join_distinct(spark):
    df = spark.createDataFrame([("a", "12"), ("a", "15"), ("a", "12"), ("b", "1")], "k string, v string")
    got = {r.k: r.joined for r in join_distinct(df, "k", "v").collect()}
    assert got == {"a": "12||15", "b": "1"}
