"""Operator 1 against a dynamic program per word."""

import math
import random

from abflow.llm import token_counts as C
from abflow.llm.common import read_table
from abflow.llm.queries import QUERIES
from abflow.llm.tokens import public_path

SF = "/root/testdata/sf0.001"


def brute(text, scores):
    """Best segmentation of each word by trying every last piece."""
    low = min(scores.values()) - C.BYTE_SCORE
    total = 0
    for word in C.WORD.findall(text or ""):
        w = C.MARK + word
        best = [(0.0, 0)]
        for e in range(1, len(w) + 1):
            size = len(w[e - 1].encode())
            options = [(best[e - 1][0] + size * low, -best[e - 1][1] - size)]
            options += [(best[a][0] + scores[w[a:e]], -best[a][1] - 1) for a in range(e) if w[a:e] in scores]
            top = max(options)
            best.append((top[0], -top[1]))
        total += best[-1][1]
    return total


def test_query(spark):
    scores = C.piece_scores(public_path("piece_bpe_32k.model"))
    docs = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    rows = QUERIES["op1_trie_token_counts"](spark, SF).collect()
    assert {(r.doc_id, r.n_words, r.n_tokens) for r in rows} == {(d, len(C.WORD.findall(t)), brute(t, scores)) for d, t in docs.items()}
    assert len(rows) == len(docs)


def test_trie_shares_prefixes_and_renews(monkeypatch):
    rng = random.Random(2)
    pieces = {"".join(rng.choice("ab" + C.MARK) for _ in range(rng.randrange(1, 5))) for _ in range(30)} | {"a"}
    scores = {p: -math.log(k + 2) for k, p in enumerate(sorted(pieces))}
    words = ["".join(rng.choice("abc") for _ in range(rng.randrange(1, 12))) for _ in range(400)] + ["ab" * 300, "é😀"]
    t = C.Trie(scores)
    calls = []
    plain = C.Trie.forward
    monkeypatch.setattr(C.Trie, "forward", lambda self, w, i, b, c: calls.append(w[:i + 1]) or plain(self, w, i, b, c))
    assert [t.tokens(w) for w in words] == [brute(w, scores) for w in words]
    short = [c for c in calls if len(c) <= C.LONGEST]
    assert len(short) == len(set(short))  # a prefix is scored once
    monkeypatch.setattr(C, "NODES", 20)
    assert [t.tokens(w) for w in words] == [brute(w, scores) for w in words]


def test_cases(spark):
    scores = {C.MARK + "a": -1.0, "b": -2.0}
    docs = spark.createDataFrame([(1, None, 3), (2, "", 1), (3, " \n\t", 1), (None, "ab", 1), (4, "ab", 2), (4, "ab", 2), (5, "x" * 100000, 1)],
                                 "doc_id long, text string, n_tokens int")
    got = sorted((r.doc_id or 0, r.n_words, r.n_tokens) for r in C.token_counts(docs, scores).collect())
    assert got == [(0, 1, 2), (1, 0, 0), (2, 0, 0), (3, 0, 0), (4, 1, 2), (4, 1, 2), (5, 1, 100003)]
    assert C.token_counts(docs.limit(0), scores).collect() == []
