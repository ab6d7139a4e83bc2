"""Operator 12 against a window-by-window search."""

import hashlib
import random
from collections import defaultdict

import pytest

from abflow.llm import debruijn as D
from abflow.llm.common import read_table
from abflow.llm.queries import QUERIES

from .brute import SPACED


def brute(docs, k=20):
    """Sorted rows (doc_id, n_words, n_removed, kept_sha256)."""
    words = [(d, SPACED.findall(t or "")) for d, t in docs if d is not None]
    least, place = {}, defaultdict(dict)
    for n, (d, w) in enumerate(words):
        for i in range(len(w) - k + 1):
            x = tuple(w[i:i + k])
            least[x] = min(least.get(x, d), d)
            place[n].setdefault(x, i)
    out = []
    for n, (d, w) in enumerate(words):
        gone = set()
        for i in range(len(w) - k + 1):
            x = tuple(w[i:i + k])
            if least[x] < d or place[n][x] < i:
                gone |= set(range(i, i + k))
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    return sorted(out)


def got(df):
    from pyspark.sql import functions as F
    return sorted(tuple(r) for r in df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect())


def test_query_on_the_given_table(spark):
    d = "/root/testdata/sf0.01"
    want = brute([tuple(r) for r in read_table(spark, d, "documents").select("doc_id", "text").collect()])
    out = QUERIES["op12_debruijn_substring_dedup"](spark, d)
    assert out.dtypes == [("doc_id", "bigint"), ("n_words", "bigint"), ("n_removed", "bigint"), ("kept_sha256", "string")]
    assert sorted(tuple(r) for r in out.collect()) == want
    assert sum(r[2] > 0 for r in want) > 50


def tables(seed=1):
    """Passages cut and joined at random, periodic texts, edits, repeated ids and rows."""
    rng = random.Random(seed)
    word = lambda: rng.choice("a b c dé É 7 , x-y".split()) + str(rng.randrange(40))
    base = [[word() for _ in range(rng.randrange(20, 70))] for _ in range(12)]
    docs = []
    for i in range(70):
        w = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(base)
            a = rng.randrange(len(p))
            w += p[a:a + rng.randrange(80)] + [word() for _ in range(rng.randrange(15))]
        if rng.random() < 0.3 and w:
            w[rng.randrange(len(w))] = "edit"
        docs.append((i, rng.choice([" ", "\n", "  \t"]).join(w)))
    docs += [(100, "p q " * 40), (101, "p q " * 15 + "q"), (102, "z " * 200), (103, None), (104, ""), (105, " \n\t "), (106, " ".join(base[0])), (106, " ".join(base[0])),
             (106, " ".join(base[0][:-1])), (5, " ".join(base[0])), (None, " ".join(base[0])), (107, "long " + " ".join(f"u{j}" for j in range(30_000)) + " " + " ".join(base[1] * 2)),
             (-3, "  " + " ".join(base[1]) + "  "), (108, "nbsp stays " * 30), (109, "\x0b".join(base[2]) + "\x1c")]
    rng.shuffle(docs)
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(*r, 1, "s") for r in docs], "doc_id long, text string, h int, spans string").repartition(5)


@pytest.mark.parametrize(("bits", "hot"), [(48, 5000), (48, 2), (7, 5000), (7, 30)])
def test_cases(spark, bits, hot):
    """Also with colliding hashes, and with branches settled window by window."""
    docs = tables()
    assert got(D.dedup(frame(spark, docs), bits=bits, hot=hot)) == brute(docs)


def test_unique_ids(spark):
    docs = [(i, t) for i, (_, t) in enumerate(tables(3))]
    assert got(D.dedup(frame(spark, docs))) == brute(docs)


def test_text_travels_once(spark):
    """One exchange of the compressed texts serves all uses, and one of the traces."""
    df = D.dedup(frame(spark, tables()))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("squeeze(") == 1
    assert final.count("ReusedExchange") >= 3


def test_spans_and_empty_table(spark):
    docs = tables(2)
    df = frame(spark, docs)
    assert got(D.dedup(df.limit(0))) == []
    for r in D.dedup(df, k=8, m=3).collect():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert len(r.kept.split()) <= r.n_words
    assert got(D.dedup(df, k=8, m=3)) == brute(docs, 8)


def test_collisions_reach_the_second_look(spark):
    """With one-bit digests the paths' words do differ, so the case above isn't empty."""
    a, b = ([f"{c}{i}" for i in range(40)] for c in "ab")
    docs = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(a)), (4, " ".join(b[5:]))]
    for bits in (1, 2, 3):
        assert got(D.dedup(frame(spark, docs), bits=bits)) == brute(docs)
