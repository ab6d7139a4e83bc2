"""Benchmark decontamination (operator 9).

Normalised word windows of the benchmark go to every executor as a hash set;
one pass over the documents looks their windows up, compares the words of each
hit, and reports or removes what is covered. No shuffle.

The set is broadcast in parts of at most ``part_bytes`` of benchmark text, and
a task holds one part at a time, so a larger benchmark costs time, not memory.

Defined cases: null or empty text has no words and no hits; a null benchmark
text has no window; repeated rows get the same answer each; repeated items
with one ``item_id`` count as one item; a null ``item_id`` counts under the
name ``null``; other columns are ignored by ``find`` and kept by ``clean``.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLAIN, Words, read_table, release, text_buffers

WINDOW = 13
PART_BYTES = 16 << 20
SCHEMA = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          "items array<string>, spans array<struct<start:int,end:int>>")
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                    ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("items", pa.list_(pa.string())),
                    ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def build(items: list[tuple[object, str | None]], window: int) -> dict[int, tuple[np.ndarray, dict]]:
    """By window length: a bit table over the hashes' top bits, and hash -> [(words, item ids)]."""
    by_len: dict[int, dict[int, dict[bytes, set]]] = defaultdict(lambda: defaultdict(lambda: defaultdict(set)))
    for item, text in items:
        raw = np.frombuffer((text or "").encode(), np.uint8)
        w = Words(raw, np.array([0, len(raw)]), PLAIN)
        n = len(w.hash)
        k = min(window, n)
        if k:
            at, h = w.windows(k)
            for i, x in zip(at.tolist(), h.tolist(), strict=True):
                by_len[k][x][w.words(i, i + k)].add("null" if item is None else str(item))
    out = {}
    for k, found in by_len.items():
        bits = np.zeros(1 << 20, bool)
        bits[np.fromiter(found, np.uint64, len(found)) >> np.uint64(44)] = True
        out[k] = (bits, {x: [(t, sorted(ids)) for t, ids in e.items()] for x, e in found.items()})
    return out


def parts(bench: DataFrame, window: int, part_bytes: int) -> list:
    """The window set as broadcast parts, each of a checked size."""
    sc = bench.sparkSession.sparkContext
    b = bench.select("item_id", F.col("text").cast("string").alias("text")).filter("text is not null").distinct()
    total = b.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // part_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [sc.broadcast(build([tuple(r) for r in b.filter(part == i).collect()], window)) for i in range(n)]


def _hits(w: Words, table: dict, mark: np.ndarray, items: dict[int, set]) -> None:
    for k, (bits, found) in table.items():
        at, h = w.windows(k)
        for i in np.flatnonzero(bits[h >> np.uint64(44)]).tolist():
            e = found.get(int(h[i]))
            if not e:
                continue
            a = int(at[i])
            words = w.words(a, a + k)
            for t, ids in e:
                if t == words:
                    mark[a] += 1
                    mark[a + k] -= 1
                    items[int(w.doc[a])].update(ids)


def scan(bcast: list):
    """Per batch of documents: hit words, items and byte spans."""
    def run(batches):
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), []
            for data, off, first in text_buffers(batch.column("text")):
                w = Words(data, off, PLAIN)
                mark, items = np.zeros(len(w.hash) + 1, np.int64), defaultdict(set)
                for b in bcast:
                    _hits(w, b.value, mark, items)
                    if len(bcast) > 1:  # the next part takes this one's place
                        b.__dict__.pop("_value", None)
                hit = np.cumsum(mark)[:-1] > 0
                for d in range(len(off) - 1):
                    a, z = int(w.first[d]), int(w.first[d + 1])
                    n, got = z - a, sorted(items.get(d, ()))
                    n_hit, spans = 0, []
                    if got:
                        run_ = hit[a:z]
                        n_hit = int(run_.sum())
                        x = np.flatnonzero(np.diff(np.r_[False, run_, False].astype(np.int8)))
                        spans = [{"start": int(w.start[a + i] - off[d]), "end": int(w.end[a + j - 1] - off[d])}
                                 for i, j in zip(x[::2].tolist(), x[1::2].tolist(), strict=True)]
                    rows.append((ids[first + d], n, n_hit, len(got), hashlib.sha256(",".join(got).encode()).hexdigest(),
                                 n_hit > 0 and 20 * n_hit >= n, got, spans))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)
    return run


def find(docs: DataFrame, bench: DataFrame, window: int = WINDOW, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document: words, words inside a benchmark window, the items, byte spans of the
    hits, and whether at least a twentieth of the words is hit."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return d.mapInArrow(scan(parts(bench, window, part_bytes)), SCHEMA)


def clean(docs: DataFrame, bench: DataFrame, remove: str = "documents", window: int = WINDOW,
          part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents with contaminated ones gone (``documents``) or every hit span cut out of
    the text (``spans``); all columns are kept. One pass, the rows stay where they are."""
    if remove not in ("documents", "spans"):
        raise ValueError(remove)
    inner = scan(parts(bench, window, part_bytes))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            (found,) = inner([pa.RecordBatch.from_arrays([batch.column(id_at).cast(pa.int64()), batch.column(text_at)], ["doc_id", "text"])])
            if remove == "documents":
                yield batch.filter(pa.array([not x for x in found.column("contaminated").to_pylist()], pa.bool_()))
                continue
            texts = batch.column(text_at).to_pylist()
            for i, spans in enumerate(found.column("spans").to_pylist()):
                if spans:
                    raw = texts[i].encode()
                    keep, at = [], 0
                    for s in spans:
                        keep.append(raw[at:s["start"]])
                        at = s["end"]
                    texts[i] = b"".join([*keep, raw[at:]]).decode()
            cols = list(batch.columns)
            cols[text_at] = pa.array(texts, batch.schema.field(text_at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)
        release()

    names = docs.columns
    id_at, text_at = names.index("doc_id"), names.index("text")
    return docs.mapInArrow(run, docs.schema)


def op9(spark, sf_dir: str) -> DataFrame:
    """Contract query: benchmark windows of 13 words in all documents."""
    return find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
