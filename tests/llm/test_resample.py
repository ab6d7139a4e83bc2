"""Operator 13 against a plain version."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np

from abflow.llm import resample as R
from abflow.llm.common import PLAIN as IS_WORD
from abflow.llm.common import Words, read_table
from abflow.llm.queries import QUERIES

from .brute import PLAIN, UPPER


def runs(text):
    w = PLAIN.findall((text or "").translate(UPPER))
    return w, [zlib.crc32(x.encode()) % 10000 for x in [*w, *map(" ".join, zip(w, w[1:]))]]


def brute(docs, bench, percent=25, least=20):
    """Rows (doc_id, n_features, weight, score, rank), ranks of equal rows in any order."""
    s, t = (Counter(b for _, x in rows for b in runs(x)[1]) for rows in (docs, bench))
    s_all, t_all = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in range(10000)]
    rows = []
    for d, text in docs:
        w, f = runs(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= least))
    drawn = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], math.inf if r[0] is None else r[0], r[1]))
    drawn = drawn[:percent * len(drawn) // 100]
    left, out = Counter(rows), []
    for k, r in enumerate(drawn):
        left[r] -= 1
        out.append((*r[:4], k + 1))
    return sorted(out + [(*r[:4], None) for r in left.elements()], key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select(*R.RESULT).collect()), key=repr)


def test_query_on_the_given_table(spark):
    d = "/root/testdata/sf0.01"
    docs, bench = ([tuple(r) for r in read_table(spark, d, t).select(k, "text").collect()] for t, k in (("documents", "doc_id"), ("benchmark", "item_id")))
    want = brute(docs, bench)
    out = QUERIES["op13_importance_resampling"](spark, d)
    assert {c: t for c, t in out.dtypes} == dict.fromkeys(R.RESULT, "bigint")
    assert got(out) == want
    assert sum(r[4] is not None for r in want) > 100


def tables(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["Alpha", "béta", "x1", "THE", "w" * 63, "w" * 64, "w" * 65, "é" * 40, "z" * 300])
    docs = [(i, " ".join(word() for _ in range(rng.randrange(60)))) for i in range(120)]
    docs += [(None, "the " * 30), (200, None), (201, ""), (202, "-- ,, !"), (203, "A-b_c d" * 20_000), *[(204, "same words " * 15)] * 5, (204, "other words " * 15)]
    bench = [(1, "the x1 the béta"), (1, "the x1 the béta"), (None, None), (2, ""), (3, "z" * 300 + " alpha")]
    return docs, bench, spark.createDataFrame([(*r, 1, "s") for r in docs], "doc_id long, text string, weight int, rank string"), spark.createDataFrame(bench, "item_id long, text string")


def test_cases(spark):
    docs, bench, dd, bb = tables(spark)
    want = brute(docs, bench)
    assert got(R.resample(dd, bb)) == want
    assert got(R.resample(dd.repartition(7), bb, finish=1)) == want  # medians to the end
    assert got(R.resample(dd, bb, percent=100, finish=3)) == brute(docs, bench, 100)
    assert got(R.resample(dd, bb, percent=0)) == brute(docs, bench, 0)
    assert got(R.resample(dd, bb.limit(0))) == brute(docs, [])
    assert got(R.resample(dd.limit(0), bb)) == []


def test_cutoff_is_exact_with_ties(spark):
    rng = random.Random(5)
    keys = [(rng.randrange(6), rng.randrange(3), rng.randrange(2)) for _ in range(500)]
    df = spark.createDataFrame(keys, "k1 long, k2 long, k3 long").repartition(9)
    for need in (1, 2, 250, 499, 500):
        assert R.cutoff(df, need, finish=1) == sorted(keys)[need - 1]


def test_pivot_discards_a_quarter():
    rng = random.Random(1)
    for _ in range(50):
        parts = [sorted((rng.random(), 0, 0) for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(1, 12))]
        p = R.weighted_median([(x[(len(x) - 1) // 2], len(x)) for x in parts])
        every = [k for x in parts for k in x]
        assert 4 * sum(k < p for k in every) <= 3 * len(every) and 4 * sum(k > p for k in every) <= 3 * len(every)


def test_crc_in_step():
    raw = ("ab C é" + " x" * 70 + "y" * 64 + " " + "y" * 65 + " " + "q" * 1000 + " end").encode()
    data = np.frombuffer(raw, np.uint8)
    w = Words(data, np.array([0, 2, 2, len(raw)]), IS_WORD)
    doc, bucket = R.features(w, 1 << 32)
    want = []
    for a, b in ((0, 2), (2, len(raw))):
        x = PLAIN.findall(raw[a:b].decode().translate(UPPER))
        want += [zlib.crc32(y.encode()) for y in [*x, *map(" ".join, zip(x, x[1:]))]]
    assert sorted(bucket.tolist()) == sorted(want) and len(doc) == len(want)
