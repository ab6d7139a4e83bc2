"""Encoder, token store (operator 10) and packing (operator 8) against the library on whole texts."""

import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from abflow.llm import packing as K
from abflow.llm import token_store as T
from abflow.llm.common import read_table
from abflow.llm.queries import QUERIES
from abflow.llm.tokens import Encoder, public_path

from .brute import crc

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"
SF = "/root/testdata/sf0.001"
TEXTS = [None, "", " ", "  ", "a", " a b  c   d\n e\n\n  f \n \n g\t h ", "It's don't 'S we'll’s", "éÉ é ÀÖ ́x", "   a  b",
         "x\x1c y \x1d z", "日本語 テキスト 12345", "<|endoftext|> a <|endoftext|>b", "foo\r\n bar\n\tbaz ", "Ω Σας İI ß", "a" * 5000, "w " * 30000]


@pytest.fixture(scope="module")
def tools():
    return {n: (Encoder(public_path(n), limit=30), Tokenizer.from_file(public_path(n))) for n in (BYTE, WORD)}


def ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_cuts_leave_ids_as_they_are(tools):
    for enc, lib in tools.values():
        assert enc.spaced or enc.plain
        for _ in range(2):
            assert [x.tolist() for x in enc.encode(TEXTS)] == [ids(lib, t) for t in TEXTS]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t 'sabS.,!1é́"), st.characters(codec="utf-8")), max_size=40))
def test_any_text(tools, text):
    for enc, lib in tools.values():
        assert enc.encode([text])[0].tolist() == ids(lib, text)


def test_store_query_round_trip(spark, tools):
    lib = tools[BYTE][1]
    want, at = {}, 0
    for d, t in sorted(tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()):
        x = [*ids(lib, t), 0]
        want[d] = (at, len(x), crc(x))
        at += len(x)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op10_token_store"](spark, SF).collect()} == want


def test_store_cases_and_keyed_access(spark, tools, tmp_path):
    lib = tools[BYTE][1]
    rows = [(7 * i - 20, t, "e", i) for i, t in enumerate(TEXTS)] + [(1, "twice"), (1, "again"), (None, "nameless")]
    rows = [(*r, None, None)[:4] for r in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, keys string, lo int").repartition(3)
    T.write_store(docs, str(tmp_path / "s"), BYTE, shard_ids=3000, shard_bytes=20000)
    store = T.read_store(spark, str(tmp_path / "s"))
    keys = spark.createDataFrame([(d,) for d in range(-30, 120)], "doc_id long")
    got = defaultdict(list)
    for r in T.fetch(store, keys).collect():
        got[r.doc_id].append(list(r.ids))
    want = defaultdict(list)
    for d, t, *_ in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] or "")):
        want[d].append([*ids(lib, t), 0])
    assert got == want
    T.write_store(docs.limit(0), str(tmp_path / "e"), BYTE)
    assert T.fetch(T.read_store(spark, str(tmp_path / "e")), keys).collect() == []


def test_keys_find_their_shard_by_equality(spark, monkeypatch):
    """Shards in many ranges, keys before, between, in and behind them; no range join in the plan."""
    monkeypatch.setattr(T, "MARKS", 7)
    rng = random.Random(5)
    ends = sorted(rng.sample(range(10_000), 120))
    shards = [(ends[i], ends[i + 1], rng.randrange(1, 50)) for i in range(0, 120, 2)]
    store = spark.createDataFrame([*shards[30:], *shards[:30]], "lo long, hi long, n_ids long").repartition(4)
    keys = spark.range(-50, 10_050).select(F.col("id").alias("doc_id"))
    found = T.shard_of(store, keys.union(keys.limit(60)).union(spark.createDataFrame([(None,)], "doc_id long")))
    assert {r.doc_id: r.lo for r in found.collect()} == {d: lo for lo, hi, _ in shards for d in range(lo, hi + 1)}
    at, want = 0, {}
    for lo, _, n in shards:
        want[lo], at = at, at + n
    assert {r.lo: r.base for r in T.starts(store).collect()} == want
    wide = spark.createDataFrame([], T._SHARD_DDL)
    for plan in (found, T.fetch(wide, keys)):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_words_led_by_a_space_and_not(tools):
    """The same word at a text's start, behind a sign and behind a space has ids of its own each time."""
    for enc, lib in tools.values():
        for text in ("the.\nthe the", "the", " the", "the ,the ,", ", the. The.the", "'s 's x's", "\n the\n", " \nthe  the", "12 a12 12a", "the <|endoftext|>the"):
            for _ in range(2):
                assert enc.encode([text])[0].tolist() == ids(lib, text)


def test_index_is_minimal_and_perfect():
    rng = np.random.default_rng(4)
    for n in (1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(-2**62, 2**62, n))
        x = T.Index.from_bytes(T.Index.build(keys, np.arange(len(keys)), np.arange(len(keys))).to_bytes())
        assert sorted(x.slots(keys).tolist()) == list(range(len(keys)))
        assert (x.rows(keys)[0] == np.arange(len(keys))).all()
        absent = np.setdiff1d(rng.integers(-2**62, 2**62, 2000), keys)
        assert (x.rows(absent)[0] == -1).all()


def check_pieces(rows, docs, lib, length):
    by_doc = defaultdict(list)
    by_seq = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, r.piece, r.length, r.ids_crc32))
        by_seq[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for d, t in docs:
        x = [*ids(lib, t), 0]
        want[d] += [(a, a // length, len(x[a:a + length]), crc(x[a:a + length])) for a in range(0, len(x), length)]
    assert {d: sorted(x) for d, x in by_doc.items()} == {d: sorted(x) for d, x in want.items()}
    for places in by_seq.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= length
    total = sum(x[2] for p in want.values() for x in p)
    return len(by_seq), -(-total // length)


def test_packing_query(spark, tools):
    docs = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()]
    used, bound = check_pieces(QUERIES["op8_best_fit_packing"](spark, SF).collect(), docs, tools[WORD][1], 2048)
    assert used <= bound + 1


def test_packing_cases(spark, tools):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1, "twice"), (1, "twice"), (None, "nameless")]
    df = spark.createDataFrame([(*r, 1, "f") for r in rows], "doc_id long, text string, g int, fill string")
    out = K.pack(K.pieces(df, WORD, 64), 64, group_pieces=200)
    used, bound = check_pieces(out.collect(), rows, tools[WORD][1], 64)
    assert used <= bound + 2
    assert K.pack(K.pieces(df.limit(0), WORD)).collect() == []


def test_local_search_raises_squares_and_saves_bins():
    rng = random.Random(6)
    for _ in range(30):
        sizes = [rng.randrange(20, 70) for _ in range(60)]
        start = K.best_fit(sizes, 100)
        end = K.improve(start, sizes, 100)
        assert sorted(i for b in end for i in b) == list(range(60))
        fills = [[sum(sizes[i] for i in b) for b in x] for x in (start, end)]
        assert max(fills[1]) <= 100 and len(end) <= len(start)
        assert sum(f * f for f in fills[1]) >= sum(f * f for f in fills[0])
    # best fit in falling order needs three bins here, an exchange saves one
    sizes = [6, 5, 5, 4, 4, 4, 2]
    assert len(K.improve([[0, 6], [1, 2], [3, 4], [5]], sizes, 15)) == 2


def test_the_best_exchange_is_found():
    rng = random.Random(9)
    for _ in range(300):
        sizes = [rng.randrange(1, 40) for _ in range(9)]
        a, b = list(range(rng.randrange(1, 5))), list(range(5, 5 + rng.randrange(5)))
        room, least = rng.randrange(1, 60), rng.randrange(1, 20)
        groups = [[(), *((i,) for i in x), *((i, j) for i in x for j in x if i < j)] for x in (a, b)]
        nets = [sum(sizes[i] for i in o) - sum(sizes[i] for i in r) for o in groups[0] if o for r in groups[1]
                if len(o) + len(r) <= 3 and 1 in (len(o), len(r))]
        want = max((n for n in nets if least <= n <= room), default=None)
        got = K._shift(K._choices(a, sizes)[0], K._choices(b, sizes)[1], room, least)
        assert (got and sum(sizes[i] for i in got[0]) - sum(sizes[i] for i in got[1])) == want


def test_texts_in_parts_and_nothing_kept_for_later_stages():
    """Workers outlive their stage: a stage after the encoding one lets the encoder go, and a batch's texts become strings a part at a time."""
    import pyarrow as pa

    from abflow.llm import compress_quality, packing, tokens
    texts = ["a" * 10, None, "", "é" * 40, "b" * 300, "c", None, "d" * 90]
    for col in (pa.array(texts), pa.array(["x", *texts, "y"]).slice(1, len(texts))):
        parts = list(tokens.column_texts(col, 100))
        assert [t for _, p in parts for t in p] == texts
        assert [i for i, _ in parts] == [sum(len(p) for _, p in parts[:k]) for k in range(len(parts))]
        assert all(len(p) == 1 or sum(len((t or "").encode()) for t in p) <= 100 for _, p in parts)
    assert list(tokens.column_texts(pa.array([], pa.string()))) == []

    tokens.encoder(public_path(WORD)).encode(["some words"])
    piece = pa.Table.from_pylist([{"doc_id": 1, "copy": 0, "piece": 0, "start": 0, "length": 3, "ids_crc32": 5, "g": 0}],
                                 schema=pa.schema([*packing._PIECES, ("g", pa.int32())]))
    assert packing._pack(2048)(piece).column("offset").to_pylist() == [0] and not tokens._loaded
    assert compress_quality.features([], ["a", None]).shape == (2, 2)
