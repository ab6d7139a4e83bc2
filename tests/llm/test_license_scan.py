"""Operator 5: planted notices, altered copies, spans."""

import re

from abflow.llm import license_scan as L
from abflow.llm.common import read_table
from abflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
SHORT = ["Apache-2.0", "MIT", "GPL-3.0", "CC-BY-NC-4.0"]


def test_query_finds_the_notices(spark):
    docs = {r.doc_id: r.text for r in read_table(spark, SF, "documents").collect()}
    want = sorted((d, k, len(t[:m.start()].encode())) for d, t in docs.items() for k in SHORT
                  for m in re.finditer(r"(?<!\w)" + r"\W+".join(re.findall(r"\w+", L.TEMPLATES[k])) + r"(?!\w)", t))
    got = sorted((r.doc_id, r.license_id, r.start) for r in QUERIES["op5_license_scan"](spark, SF).collect() if r.coverage == 1.0)
    assert [g for g in got if g[1] in SHORT] == want and len(want) > 40


def run(spark, texts, **kw):
    docs = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, license_id string")
    return L.license_scan(docs, **kw).collect()


def test_altered_copies_and_spans(spark):
    mit = L.TEMPLATES["MIT-permission"]
    words = mit.split()
    changed = " ".join(w if i % 12 != 5 else "other" for i, w in enumerate(words))
    missing = " ".join(w for i, w in enumerate(words) if i % 10)
    far = " ".join(w if i % 3 else "x" for i, w in enumerate(words))
    pad = "é pad " * 50
    texts = [pad + mit + " tail", pad + changed.upper(), "# " + missing.replace(" ", "\n# "), far, mit + "\n" + pad + mit, None, "", "w " * 200000 + L.TEMPLATES["BSD"]]
    rows = run(spark, texts)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.license_id for r in by[0]] == ["MIT-permission"] and by[0][0].coverage == 1.0
    assert texts[0].encode()[by[0][0].start:by[0][0].end].decode() == mit
    assert [r.license_id for r in by[1]] == ["MIT-permission"] and 0.85 < by[1][0].coverage < 0.95
    assert [r.license_id for r in by[2]] == ["MIT-permission"] and 0.85 < by[2][0].coverage < 0.95
    assert [r.coverage for r in by[4]] == [1.0, 1.0] and by[4][0].end <= by[4][1].start
    assert [r.license_id for r in by[7]] == ["BSD"]
    assert set(by) == {0, 1, 2, 4, 7}


def test_best_of_alike_templates(spark):
    texts = [L.TEMPLATES[k] for k in L.TEMPLATES]
    got = {}
    for r in run(spark, texts):
        got.setdefault(r.doc_id, []).append(r.license_id)
    assert got == {i: [k] for i, k in enumerate(L.TEMPLATES)}
    assert run(spark, ["abc"])[:1] == [] and L.license_scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_alignment_against_all_cells():
    import random

    rng = random.Random(8)
    for _ in range(60):
        t = [rng.randrange(4) for _ in range(rng.randrange(3, 9))]
        x = [rng.randrange(4) for _ in range(rng.randrange(3, 12))]
        best, h = 0, {}
        for j in range(len(t)):
            for i in range(len(x)):
                s = 2 if t[j] == x[i] else -1
                h[i, j] = max(0, h.get((i - 1, j - 1), 0) + s, h.get((i - 1, j), 0) - 1, h.get((i, j - 1), 0) - 1)
                best = max(best, h[i, j])
        n, a, e = L.align(x, t, 0, 20)
        assert (best == 0) == (n == 0)
        if best:
            assert 2 * n >= best and 0 <= a < e <= len(x)


def legal(n, seed):
    """A text of n words like a whole license: few words, many repeated runs."""
    import random

    rng = random.Random(seed)
    stock = ["of the work", "the copyright holder", "under this license", "to the extent permitted by", "any person", "may copy and distribute", "provided that", "in the event of"]
    out = []
    while len(out) < n:
        out += rng.choice(stock).split() if rng.random() < 0.8 else [f"word{rng.randrange(n)}"]
    return out[:n]


def whole_texts():
    import pathlib

    real = {n: p.read_text() for n in ("Apache-2.0", "BSD", "MPL-2.0") if (p := pathlib.Path("/usr/share/common-licenses") / n).exists()}
    return {"made-900": " ".join(legal(900, 1)), "made-60": " ".join(legal(60, 2)), **real}


def test_whole_licenses(spark):
    for name, text in whole_texts().items():
        words = text.split()
        inserted = " ".join(w + " extra" if i % 9 == 4 else w for i, w in enumerate(words))
        texts = [text, text + "\n" + text, inserted, "head " * 30 + text + " tail", " ".join(words[:len(words) // 2])]
        got = {}
        for r in run(spark, texts, templates={name: text}):
            got.setdefault(r.doc_id, []).append(r)
        assert [r.coverage for r in got[0]] == [1.0] and got[0][0].n_matched == got[0][0].n_words
        assert [r.coverage for r in got[1]] == [1.0, 1.0] and got[1][0].end <= got[1][1].start
        assert [r.coverage for r in got[2]] == [1.0] and [r.coverage for r in got[3]] == [1.0] and 4 not in got


def test_drift_over_the_band(spark):
    words = L.TEMPLATES["MIT-permission"].split()
    drift = " ".join(w + " so" if i % 3 == 2 else w for i, w in enumerate(words))
    assert [(r.license_id, r.coverage) for r in run(spark, [drift])] == [("MIT-permission", 1.0)]
    drift = " ".join(w + " a b c" if i % 6 == 5 else w for i, w in enumerate(words))
    assert [(r.license_id, r.n_matched >= r.n_words - 1) for r in run(spark, [drift])] == [("MIT-permission", True)]  # a last word behind three others costs more than it gives


def test_every_hit_is_in_a_window():
    import random

    rng = random.Random(1)
    for _ in range(50):
        places = sorted((rng.randrange(400), rng.randrange(400)) for _ in range(rng.randrange(1, 90)))
        got = L.windows(places, 7, 60)
        assert {x for g in got for x in g} == set(places) and all(g[-1][0] - g[0][0] <= 60 for g in got)


def test_wide_alignment_as_narrow():
    import random

    import numpy as np

    rng = random.Random(9)
    for _ in range(300):
        t = [rng.randrange(1, 6) for _ in range(rng.randrange(3, 30))]
        x = [rng.randrange(1, 6) for _ in range(rng.randrange(1, 60))]
        d, band = rng.randrange(-20, 40), rng.randrange(1, 30)
        n, a, e = L.align(x, t, d, band)
        m, b, f = L.align_wide(np.array(x, np.uint64), np.array(t, np.uint64), d, band)
        assert (n == 0) == (m == 0)
        if n:
            # matches 2 each, the rest -1 a word: the same score, so no fewer matches
            assert m >= n and 0 <= b < f <= len(x)
