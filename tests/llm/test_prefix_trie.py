"""Operator 11 against plain dictionaries."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from abflow.llm import prefix_trie as T
from abflow.llm.common import read_table
from abflow.llm.queries import QUERIES


def rebuild(rows):
    """{conv_id: turns}, for rows whose (conv_id, turn) are unique."""
    by = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - int(np.fmod(c, 5)), [])[:h] + own[c][h:]
    return out


def brute(convs):
    """{(conv_id, depth): (parent, n_convs, n_children, n_leaves, saved, sha)}"""
    at = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            at[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for k in at:
        if k:
            kids[k[:-1]].append(k)
    out, sums = {}, {}
    for k in sorted(at, key=len, reverse=True):
        own = (len(at[k]) - 1) * len(k[-1][1].encode()) if k else 0
        sums[k] = (sum(sums[x][0] for x in kids[k]) if kids[k] else 1, own + sum(sums[x][1] for x in kids[k]))
    for k, m in at.items():
        ends = ",".join(map(str, sorted(c for c in m if len(convs[c]) == len(k))))
        out[min(m), len(k)] = (min(at[k[:-1]]) if k else None, len(m), len(kids[k]), *sums[k], hashlib.sha256(ends.encode()).hexdigest())
    return out


def got(df):
    rows = df.select(*T.RESULT).collect()
    out = {(r.conv_id, r.depth): tuple(r)[2:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_on_the_given_table(spark):
    d = "/root/testdata/sf0.01"
    want = brute(rebuild([tuple(r) for r in read_table(spark, d, "conversations").select("conv_id", "turn", "role", "text").collect()]))
    out = QUERIES["op11_conversation_prefix_trie"](spark, d)
    assert out.dtypes == [(c, "string" if c == "ends_sha256" else "bigint") for c in T.RESULT]
    assert got(out) == want


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in range(160):
        turns, t = rng.choice([1, 2, 3, 5, 9, 12]), rng.choice([-4, 0, 7])
        for k in range(turns):
            rows.append((c, t + k, rng.choice(["user", "assistant", None]) if rng.random() < 0.2 else "user", rng.choice(["", None, "a", "é", "bb", "same", "same"]) if k < 3 else f"x{rng.randrange(3)}"))
    for c in range(5000, 5400):  # one path of many members, over several blocks of ids
        rows += [(c * 7, 0, "user", "hot"), (c * 7, 1, "bot", "answer")]
    rows += [(-3, 0, "u", "minus"), (-5, 0, "u", "base"), (-5, None, "u", "first"), (None, 0, "u", "nobody"), (9001, 4, "user", None)]
    rows += [(9010, k, "user", f"long {k}") for k in range(700)] + [(9011, k, "user", f"long {k}" if k < 650 else "other") for k in range(700)]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, key int, depth string").repartition(6)


@pytest.mark.parametrize(("turns", "fan"), [(10**6, 64), (60, 64), (60, 4)])
def test_cases(spark, turns, fan):
    """One shard; many shards with one merge of spines; many shards and several merges."""
    rows = conversations(turns + fan)
    assert got(T.trie(T.rebuilt(frame(spark, rows)), turns, fan)) == brute(rebuild(rows))


def test_plain_ties_and_empty(spark):
    rows = [(1, 0, "u", "b"), (1, 0, "u", "a"), (2, 0, "u", "a"), (2, 0, "u", "b"), (3, 1, "u", "a"), (3, 1, "u", "a")]
    out = got(T.trie(T.plain(frame(spark, rows))))
    assert out[1, 2][1] == 2 and len(out) in (5, 4)  # turns with one number have one order, whatever the rows' order
    assert got(T.trie(T.rebuilt(frame(spark, rows).limit(0)))) == {}
    assert got(T.trie(T.plain(frame(spark, rows).limit(0)))) == {}


def test_findclose():
    rng = random.Random(2)
    for _ in range(40):
        step, depth = [1], 1
        while depth:
            up = len(step) < rng.randrange(1, 900) and rng.random() < 0.6
            step.append(1 if up else -1)
            depth += step[-1]
        p = T.Parens(np.array(step, np.int8))
        stack, want = [], {}
        for i, s in enumerate(step):
            if s > 0:
                stack.append(i)
            else:
                want[stack.pop()] = i
        assert p.findclose().tolist() == [want[i] for i in sorted(want)]
