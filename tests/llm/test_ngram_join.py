"""Operator 2 against all pairs."""

import random


from abflow.llm import ngram_join as N
from abflow.llm.common import read_table
from abflow.llm.queries import QUERIES

from .brute import ngram_join as brute
from .brute import shingles

DDL = "doc_id long, text string, source string, p string, n long"


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, None, "x", 3) for r in rows], DDL).repartition(4)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in N.ngram_join(df, **kw).collect()}


def family(rng, n, base_words, edits, start):
    base = [f"w{rng.randrange(5000)}" for _ in range(base_words)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        out.append((start + i, " ".join(w)))
    return out


def test_query_on_the_given_table(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in read_table(spark, d, "documents").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op2_ngram_jaccard_join"](spark, d).collect()}
    assert got == brute(docs)


def test_near_copies_chains_and_shared_lines(spark):
    rng = random.Random(5)
    rows = family(rng, 40, 120, 4, 0) + family(rng, 25, 30, 2, 100) + family(rng, 15, 8, 1, 200)
    line = " ".join(f"common{i}" for i in range(60))
    rows += [(300 + i, line + " " + " ".join(f"u{i}_{j}" for j in range(rng.randrange(2, 40)))) for i in range(30)]
    # a chain: each links to the next, the ends are far apart
    w = [f"c{i}" for i in range(100)]
    for i in range(12):
        rows.append((400 + i, " ".join(w)))
        w[4 + 8 * i] = f"x{i}"
    rng.shuffle(rows)
    want = brute(rows)
    assert run(spark, rows) == want
    assert run(spark, rows, group_bytes=4000, bucket_values=50, fragments=4) == want
    assert len({c for i, (_, c) in want.items() if 400 <= i < 412}) == 1


def test_null_empty_short_and_repeated(spark):
    long = " ".join(f"t{i % 977}" for i in range(30000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c"), (5, "A  B\nc"), (6, "a b"), (7, "a b c d e"), (8, "x" * 300000),
            (9, long), (10, long + " tail"), (11, "a b c"), (11, "a b c")]
    assert run(spark, rows) == brute(rows[:-1])
    assert run(spark, []) == {}
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c")], "doc_id long, text string")
    assert [(r.doc_id, r.component_id) for r in N.ngram_join(df).collect()] == [(1, 1)]


def test_one_id_with_several_texts(spark):
    """Rows of one doc_id are one document: what links to any of its texts is in its component."""
    rng = random.Random(8)
    a, b, c = ([f"{x}{rng.randrange(10**6)}" for _ in range(40)] for x in "abc")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join([*a, "z"])), (3, " ".join([*b, "z"])), (9, " ".join([*c, "y"])), (5, " ".join(c)), (5, " ".join([*b, "q"])),
            (7, ""), (7, " ".join([*a, "w"])), (8, " ".join(f"u{i}" for i in range(30)))]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in N.ngram_join(df).collect())
        by_id = {d: comp for d, (_, comp) in brute(order).items()}
        assert got == sorted((d, len(shingles(t)), by_id[d]) for d, t in order)
        assert by_id == {1: 1, 2: 1, 3: 1, 5: 1, 7: 1, 8: 8, 9: 1}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(40)]
    got = {r.id: r.comp for r in N.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(100):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_components_are_carried_on(spark, monkeypatch):
    """The driver keeps plans and stages of every job: later steps start from the components of the earlier ones and run no rounds without new links."""
    rows = [(100 * f + i, " ".join([*(f"w{f}_{k}" for k in range(80)), f"e{f}_{i}"])) for f in range(6) for i in range(8)]
    calls, whole = [], N.components
    monkeypatch.setattr(N, "components", lambda edges: calls.append(edges) or whole(edges))
    assert run(spark, rows) == brute(rows)
    assert len(calls) == 1


def test_links_between_components(spark):
    """``_merged`` joins components by later links, also along a chain of them."""
    label = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 5), (9, 9)], "doc_id long, comp long")
    for links, want in (([], {5: 5, 4: 3}), ([(1, 2)], {5: 5, 4: 3}), ([(4, 6), (2, 3), (3, 4)], {5: 1, 4: 1})):
        got = {r.doc_id: r.comp for r in N._merged(label, spark.createDataFrame(links, "a long, b long")).collect()}
        assert got == {1: 1, 2: 1, 3: want[4], 4: want[4], 5: want[5], 6: want[5], 9: 9}


def test_sets_stay_exact_in_integers(spark):
    # 4 of 5 n-grams shared is exactly 0.8 and links; 7 of 9 doesn't
    a = [f"q{i}" for i in range(8)]
    assert len({c for _, c in run(spark, [(1, " ".join(a)), (2, " ".join([*a, "z"]))]).values()}) == 1
    assert N.spare(4, 80) == 0 and N.spare(5, 80) == 1
