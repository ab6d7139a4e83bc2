"""Operator 3 against a table of all 50-byte strings."""

import random

import numpy as np
import pyarrow as pa

from abflow.llm import suffix_dedup as S
from abflow.llm.common import read_table
from abflow.llm.queries import QUERIES

from .brute import suffix_dedup as brute

COLS = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def digest(df):
    return {r.doc_id: tuple(r[c] for c in COLS) for r in df.collect()}


def test_query_on_the_given_table(spark):
    d = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in read_table(spark, d, "documents").select("doc_id", "text").collect()]
    want = brute(docs)
    assert digest(QUERIES["op3_suffix_array_dedup"](spark, d)) == want
    assert sum(x[1] for x in want.values()) > 0


def test_passages_and_edges(spark):
    rng = random.Random(3)
    letters = "abcdefgh é"
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [text(n) for n in (49, 50, 51, 80, 300)]
    docs = []
    for i in range(60):
        docs.append((i * 3, "".join(rng.choice([text(rng.randrange(120)), rng.choice(shared)]) for _ in range(5))))
    docs += [(1, None), (2, ""), (4, "x" * 49), (5, "x" * 50), (7, "x" * 9000), (8, "x" * 51), (200, docs[10][1]), (-5, docs[11][1]),
             (300, "ab" * 40), (301, "ba" * 40), (303, "".join(chr(97 + i % 26) for i in range(20000)))]
    rng.shuffle(docs)
    df = spark.createDataFrame([(*r, "z", b"q") for r in docs], "doc_id long, text string, p string, blob binary").repartition(5)
    want = brute(docs)
    assert digest(S.suffix_dedup(df)) == want
    assert digest(S.suffix_dedup(df, group_bytes=2000, bucket_values=100)) == want
    assert digest(S.suffix_dedup(df, group_bytes=2000, bucket_values=100, hot=2)) == want
    assert digest(S.suffix_dedup(df, hot=5)) == want
    assert digest(S.suffix_dedup(df.limit(0))) == {}


def test_rows_with_one_id(spark):
    t = "".join(chr(97 + i * i % 26) for i in range(70)) + "tail of this one"
    df = spark.createDataFrame([(4, t), (4, t), (4, t + "more"), (5, t), (None, t)], "doc_id long, text string")
    rows = sorted((r.doc_id, r.n_removed) for r in S.suffix_dedup(df).collect())
    assert rows == [(4, 0), (4, 0), (4, 0), (5, len(t))]


def test_refinement_finds_equal_strings():
    rng = np.random.default_rng(2)
    runs = [rng.integers(97, 99, n).astype(np.uint8) for n in (50, 60, 120, 75)]
    runs.append(runs[2][10:90])
    text = np.concatenate(runs)
    ends = np.cumsum([len(r) for r in runs])
    left = np.repeat(ends, [len(r) for r in runs]) - np.arange(len(text))
    got = S.refine(text, left)
    at = np.flatnonzero(left >= 50)
    assert (got[left < 50] == -1).all()
    raw = text.tobytes()
    for i in at:
        for j in at:
            assert (got[i] == got[j]) == (raw[i:i + 50] == raw[j:j + 50])


def test_no_key_grows_with_the_documents_of_a_frequent_string():
    rng = np.random.default_rng(4)
    middle, letters = b"the same thirty bytes of text.", np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    texts = [letters[rng.integers(0, 26, 60)].tobytes() + middle + letters[rng.integers(0, 26, 60)].tobytes() for _ in range(2000)] + [b"x" * 20 + middle + b"y" * 20] * 3
    data, off = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    a, b, key, d = S.runs(data, off)
    keys, n = np.unique(key, return_counts=True)
    assert n.max() > 100  # one key of many documents with distinct runs
    i, j, k, e = S.one_by_one(data, a, b, key, d, np.isin(key, keys[n >= 50]))
    assert np.unique(k, return_counts=True)[1].max() < 50
    assert sorted(x for p, q in zip(a.tolist(), b.tolist()) for x in range(p, q)) == sorted(x for p, q in zip(i.tolist(), j.tolist()) for x in range(p, q))
    by = {}
    raw = data.tobytes()
    for p, q, x in zip(i.tolist(), j.tolist(), k.tolist()):
        for w in range(p, q):
            by.setdefault(raw[w:w + 50], set()).add(x)
    assert all(len(x) == 1 for x in by.values())  # equal windows meet


def test_a_bucket_refined_key_by_key(monkeypatch):
    """Any number of whole keys at a time gives the spans of a plain search."""
    rng = random.Random(8)
    passages = ["".join(rng.choice("abc") for _ in range(n)).encode() for n in (50, 60, 120)]
    rows, want = [], set()
    by_key: dict[int, list] = {}
    for p in range(3):
        runs = [(k, rng.choice([b"", b"x", b"yz"]) + x + rng.choice([b"", b"q"])) for k, x in enumerate(passages) for _ in range(2)]
        runs = list(dict.fromkeys(runs))
        owner = [(n, rng.randrange(9) * 3 + p, 7, rng.randrange(1000)) for n in range(len(runs)) for _ in range(2)]
        for n, doc, mark, start in owner:
            by_key.setdefault(runs[n][0], []).append((p, doc, mark, start, runs[n][1]))
        columns = [np.array(c, np.int64) for c in zip(*owner, strict=True)]
        rows.append((0, p, False, S._squeeze(np.array([k for k, _ in runs], np.uint64), np.array([len(x) for _, x in runs], np.int32),
                                             b"".join(x for _, x in runs), columns[0].astype(np.int32), *columns[1:])))
    for found in by_key.values():
        least: dict[bytes, int] = {}
        for _, doc, _, _, x in found:
            for i in range(len(x) - S.WIDTH + 1):
                least[x[i:i + S.WIDTH]] = min(doc, least.get(x[i:i + S.WIDTH], doc))
        for p, doc, _, start, x in found:
            want |= {(p, doc, start + i + j) for i in range(len(x) - S.WIDTH + 1) if least[x[i:i + S.WIDTH]] < doc for j in range(S.WIDTH)}
    table = pa.Table.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(S._RUNS)], schema=S._RUNS)
    for size in (1, 300, 1 << 20):
        monkeypatch.setattr(S, "SORT_BYTES", size)
        got = set()
        for r in S._bucket(table).to_pylist():
            doc, mark, start, end = S._unsqueeze(r["blob"], "qqqq")
            got |= {(r["p"], d, x) for d, a, z in zip(doc.tolist(), start.tolist(), end.tolist(), strict=True) for x in range(a, z)}
            assert set(mark.tolist()) == {7}
        assert got == want and want
