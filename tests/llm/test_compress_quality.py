"""Operator 6: held-out accuracy, folds and odd inputs."""

import zlib

import pytest

from abflow.llm import compress_quality as Q
from abflow.llm.common import read_table
from abflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op6_compression_quality"](spark, SF).collect()}
    docs = read_table(spark, SF, "documents")
    assert len(got) == docs.count()
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    labels = [tuple(r) for r in read_table(spark, SF, "labels").select("doc_id", "quality").collect() if got[r.doc_id].held_out]
    good = [got[d].predicted for d, q in labels if q == 1]
    bad = [got[d].predicted for d, q in labels if q == 0]
    print(len(good), sum(good) / len(good), len(bad), sum(bad) / len(bad))
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1
    # calibration: the mean score is near the share of label 1
    scores = [got[d].score for d, _ in labels]
    assert abs(sum(scores) / len(scores) - len(good) / len(labels)) < 0.03


def test_held_out_labels_do_not_matter(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    labels = read_table(spark, "/root/testdata/sf0.01", "labels")
    flipped = labels.withColumn("quality", Q.F.when(Q.held_out(Q.F.col("doc_id")), 1 - Q.F.col("quality")).otherwise(Q.F.col("quality")))
    assert Q.fit(docs, labels) == Q.fit(docs, flipped)


@pytest.mark.parametrize("labels,score", [([], 0.5), ([(1, 1), (3, 1)], 1.0), ([(1, 0)], 0.0), ([(None, 1), (3, 7)], 0.5)])
def test_missing_classes(spark, labels, score):
    docs = spark.createDataFrame([(1, "a"), (2, None), (None, ""), (3, "x " * 200000)], "doc_id long, text string")
    m = Q.fit(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert [r.score for r in Q.score(docs, m).collect()] == [score] * 4


def test_few_labels_repeated_rows_and_names(spark):
    good, bad = "the quiet river ran past the old mill and the town ", "BUY!!! $$$ NOW ### CLICK *** "
    docs = spark.createDataFrame([(i, (good if i % 2 else bad) * (3 + i % 5), 9.0, "q") for i in range(60)] * 2 + [(500, good, 1.0, "k"), (501, None, 0.0, None)],
                                 "doc_id long, text string, score double, label string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] * 2, "doc_id long, quality int")
    out = Q.score(docs, Q.fit(docs, labels))
    assert out.columns == ["doc_id", "text", "label", "score"] and out.count() == 122
    by = {r.doc_id: r.score for r in out.collect()}
    assert by[500] > 0.5 and all((by[i] > 0.5) == bool(i % 2) for i in range(60))
    assert Q.score(docs.limit(0), Q.fit(docs.limit(0), labels)).collect() == []
