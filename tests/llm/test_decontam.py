"""Operator 9 against a word-by-word search."""

from abflow.llm import decontam as D
from abflow.llm.common import read_table
from abflow.llm.queries import QUERIES

from .brute import decontam as brute

COLS = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def digest(df):
    return {r.doc_id: tuple(r[c] for c in COLS) for r in df.collect()}


def test_query_on_the_given_table(spark):
    d = "/root/testdata/sf0.01"
    docs, bench = ([tuple(r) for r in read_table(spark, d, t).select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    want = brute(docs, bench)
    assert digest(QUERIES["op9_benchmark_decontamination"](spark, d)) == want
    assert sum(x[-1] for x in want.values()) > 3


def tables(spark):
    item = " ".join(f"b{i}" for i in range(20))
    docs = [(1, None), (2, ""), (3, "!!! ..."), (4, "Start " + item.upper() + " end"), (5, "a b c " + item[:40]), (6, "Écolé, x2 y"),
            (7, "say x2-Y x2 y2 often " + "pad " * 50), (8, "w " * 200000 + item), (9, item), (9, item), (10, " ".join(f"b{i}" for i in range(12)))]
    bench = [(1, item), (10, "x2 y"), (2, None), (3, ""), (4, "..."), (5, item), (2, "écolé"), (None, "often")]
    dd = spark.createDataFrame([(*r, "k", 1) for r in docs], "doc_id long, text string, items string, n_hit int")
    return docs, bench, dd, spark.createDataFrame(bench, "item_id long, text string")


def test_cases(spark):
    docs, bench, dd, bb = tables(spark)
    want = brute(docs, [("null" if i is None else i, t) for i, t in bench])
    assert digest(D.find(dd, bb)) == want
    assert digest(D.find(dd, bb, part_bytes=30)) == want  # several broadcast parts
    assert digest(D.find(dd.limit(0), bb)) == {}
    assert {x[1] for x in digest(D.find(dd, bb.limit(0))).values()} == {0}


def test_clean(spark):
    docs, bench, dd, bb = tables(spark)
    bad = {d for d, x in brute(docs, [("null" if i is None else i, t) for i, t in bench]).items() if x[-1]}
    out = D.clean(dd, bb)
    assert out.columns == dd.columns
    assert {r.doc_id for r in out.collect()} == {d for d, _ in docs} - bad
    cut = {r.doc_id: r.text for r in D.clean(dd, bb, remove="spans").collect()}
    assert cut[4] == "Start  end" and cut[1] is None and cut[9] == "" and cut[7].startswith("say -Y x2 y2  pad") is False
    again = digest(D.find(D.clean(dd, bb, remove="spans"), bb))
    assert again[4][1] == 0
