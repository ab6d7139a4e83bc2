"""Substring dedup by De Bruijn compaction (operator 12).

Windows of ``k`` words are the edges of a De Bruijn graph (its nodes are the
k-1 words that neighbours share). A word is removed if a window that covers it
also starts earlier: in a document with a smaller ``doc_id`` or further up in its own.

1. *Runs.* Consecutive windows that share their least ``m``-word hash (leftmost
   if tied) are one run. The hash is a function of the window's words, so equal
   windows always lie in runs with the same hash, at the same distance from it.
2. *Compaction*, by joins on that hash with constant-size aggregates: hashes
   seen once go. Where all runs of a hash have one digest no path branches
   inside it; such a run continues the run before it if that one is always followed by
   it and both occur equally often. Chains of them are the repeated nonbranching
   paths, found whole in every document that has them.
3. *Verification.* Each occurrence of a path, given by its source coordinates
   (document, first word, length), gets a strong digest of its words. Paths
   whose occurrences differ (a hash collision) are taken window by window.
4. *Branches.* The windows of a hash with several digests meet under it, by strong digests
   of their words: up to ``hot`` runs of a hash in one place; those of a hash with
   more are made distinct, exploded to windows and joined.
5. Spans that have an earlier equal one go.

A document's text travels once, compressed; that exchange serves both to trace
its runs and to cut its spans. Other shuffles hold a few values a run. No
task's size follows a passage that a third of all documents has: its runs are
counted by partial aggregates and joined by plain equi-joins, which Spark splits where
they are skewed. Nothing goes through the driver but whether any ``doc_id`` is repeated.

Defined cases: null or empty text has no words; a null ``doc_id`` gives no row;
rows with one ``doc_id`` but different texts are documents of their own, of which none
is earlier than the other; repeated rows give equal answers, each its own row; texts of fewer than
``k`` words keep all; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _MULT, CHUNK_BYTES, SPACED, U64, Words, _pow, mix, read_table, text_buffers

WINDOW = 20
SEED_WORDS = 5
RUN_BITS = 48  # of the least hash: a collision only makes two paths look like a branch
HOT = 50_000  # runs under one branching hash that are settled together: some 400,000 windows, 50 MB of arrays
DOC = ["doc_id", "h"]
NONE = -1


# ---------------------------------------------------------------- documents


def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, h, text) to (doc_id, h, compressed text)."""
    z = zstandard.ZstdCompressor(level=3)
    for b in batches:
        texts = b.column(2).cast(pa.binary())
        out = [z.compress(t.as_buffer()) if t.is_valid else b"" for t in texts]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.binary())], ["doc_id", "h", "z"])


def chunks(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, first row) of chunks of whole documents of a compressed column."""
    z, got, size, first = zstandard.ZstdDecompressor(), [], 0, 0
    for i, raw in enumerate(col):
        got.append(z.decompress(raw.as_buffer()) if len(raw.as_buffer()) else b"")
        size += len(got[-1])
        if size >= CHUNK_BYTES or i + 1 == len(col):
            yield np.frombuffer(b"".join(got), np.uint8), np.cumsum([0, *map(len, got)]), first
            got, size, first = [], 0, i + 1


class Text(Words):
    """Unchanged words of a chunk, and its bytes with one space after each word."""

    def __init__(self, data: np.ndarray, off: np.ndarray) -> None:
        super().__init__(data, off, SPACED, None)
        keep = SPACED[data]
        last = np.repeat(off[1:], self.count)
        gap = self.end[self.end < last]
        keep[gap] = True
        flat = data.copy()
        flat[gap] = 32
        self.at = np.concatenate([[0], np.cumsum(keep)])[self.start]
        self.flat = flat[keep]
        self.size = self.end - self.start

    def span(self, a: int, b: int) -> bytes:
        """Words a to b-1, joined by one space."""
        return self.flat[self.at[a]:self.at[b - 1] + self.size[b - 1]].tobytes()


# ---------------------------------------------------------------- runs


def runs_of(w: Words, k: int, m: int, bits: int) -> tuple[np.ndarray, ...]:
    """(first window, windows, least hash, digest of all its words) of every run."""
    n = len(w.hash)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(0, U64)
    g = np.zeros(n - m + 1, U64)
    for j in range(m):
        g += w.hash[j:j + len(g)] * _MULT[j]
    g = mix(g) >> U64(64 - bits)
    best, width, span = np.arange(len(g)), 1, k - m + 1
    while width < span:  # leftmost place of the least hash in ever wider windows
        step = min(width, span - width)
        a, b = best[:len(best) - step], best[step:]
        best = np.where(g[b] < g[a], b, a)
        width += step
    at = np.flatnonzero(w.doc[:n - k + 1] == w.doc[k - 1:])
    place = best[at]
    lo = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(at) else np.zeros(0, np.int64)
    start, wins, place = at[lo], np.diff(np.concatenate([lo, [len(at)]])), place[lo]
    up, down = _pow(n)
    total = np.concatenate([np.zeros(1, U64), np.cumsum(w.hash * up, dtype=U64)])
    digest = mix((total[start + wins + k - 1] - total[start]) * down[start] + (wins * 131 + place - start).astype(U64))
    return start, wins, g[place], digest >> U64(64 - min(bits, 32))


def run_rows(k: int, m: int, bits: int):
    """Per run: its hash, its digest, the hash of the next run of the document, its place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for data, off, first in text_buffers(batch.column(2)):
                w = Words(data, off, SPACED, None)
                start, wins, mini, digest = runs_of(w, k, m, bits)
                if not len(start):
                    continue
                doc, mini = w.doc[start], mini.view(np.int64)
                then = np.full(len(mini), NONE, np.int64)
                same = doc[1:] == doc[:-1]
                then[:-1][same] = mini[1:][same]
                cols = [mini, digest.astype(np.uint32).view(np.int32), then, ids[first + doc], hs[first + doc],
                        (start - w.first[doc]).astype(np.int32), wins.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["mini", "digest", "then", "doc_id", "h", "start", "n"])
    return run


RUNS = "mini long, digest int, then long, doc_id long, h long, start int, n int"


def compacted(runs: DataFrame, hot: int) -> DataFrame:
    """Repeated hashes: of which kind, whether their runs continue the run before, and the least ``doc_id`` that has them."""
    seen = runs.groupBy("mini").agg(
        F.count(F.lit(1)).alias("times"), F.min("digest").alias("d0"), F.max("digest").alias("d1"),
        F.min("then").alias("t0"), F.max("then").alias("t1"), F.min("doc_id").alias("first")).filter("times > 1")
    single = F.col("d0") == F.col("d1")
    kind = F.when(single, PATH).when(F.col("times") <= hot, BRANCH).otherwise(HOT_BRANCH)
    # a hash tells the one that always follows how often; it is linked if it occurs as often
    ahead = F.struct(F.col("t0").alias("mini"), F.lit(None).cast("int").alias("kind"), F.lit(None).cast("long").alias("times"),
                     F.lit(None).cast("long").alias("first"), F.col("times").alias("before"))
    own = F.struct("mini", kind.alias("kind"), "times", "first", F.lit(None).cast("long").alias("before"))
    follows = single & (F.col("t0") == F.col("t1")) & (F.col("t0") != NONE)
    rows = seen.select(F.explode(F.when(follows, F.array(own, ahead)).otherwise(F.array(own))).alias("r")).select("r.*")
    whole = rows.groupBy("mini").agg(*(F.max(c).alias(c) for c in ("kind", "times", "first", "before"))).filter("times is not null")
    return whole.select("mini", "kind", "first", ((F.col("kind") == PATH) & F.coalesce(F.col("before") == F.col("times"), F.lit(False))).alias("linked"))


# ---------------------------------------------------------------- verification


def _lists(col: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row of each element, and the elements' fields."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    off = np.asarray(col.offsets)
    flat = col.values.slice(off[0], off[-1] - off[0])
    return np.repeat(np.arange(len(col)), np.diff(off)), {f.name: flat.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(flat.type)}


TRACES = "mini long, kind int, salt int, doc_id long, h long, start int, n int, first long, digests binary"
PATH, BRANCH, HOT_BRANCH = 0, 1, 2


def _digests(w: "Text", begin: int, n: int, k: int, size: int) -> bytes:
    return b"".join(hashlib.blake2b(w.span(j, j + k), digest_size=size).digest() for j in range(begin, begin + n))


def trace(k: int):
    """Per document: occurrences of whole paths with a digest of all their words, and runs of
    hashes where paths branch with a digest of each window. ``salt`` spreads what may be hot."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            row, f = _lists(batch.column(3))
            order = np.lexsort((f["start"], row))
            order = order[np.concatenate([[True], (np.diff(row[order]) != 0) | (np.diff(f["start"][order]) != 0)])] if len(order) else order
            row, f = row[order], {x: v[order] for x, v in f.items()}
            for data, off, first in chunks(batch.column(2)):
                lo, hi = np.searchsorted(row, [first, first + len(off) - 1])
                if lo == hi:
                    continue
                w = Text(data, off)
                r, x = row[lo:hi], {c: v[lo:hi] for c, v in f.items()}
                kind = x["kind"]
                begin = w.first[r - first] + x["start"]
                head = ~x["linked"].astype(bool) | (kind != PATH)
                head[0] = True
                head[1:] |= (r[1:] != r[:-1]) | (kind[:-1] != PATH) | (begin[1:] != begin[:-1] + x["n"][:-1])
                h = np.flatnonzero(head)
                at, kind, begin = r[h], kind[h], begin[h]
                n = (w.first[r - first] + x["start"] + x["n"])[np.concatenate([h[1:], [len(r)]]) - 1] - begin
                said = [hashlib.blake2b(w.span(b, b + c + k - 1), digest_size=16).digest() if t == PATH else _digests(w, b, c, k, 8)
                        for t, b, c in zip(kind.tolist(), begin.tolist(), n.tolist(), strict=True)]
                salt = np.where(kind == BRANCH, 0, (ids[at] ^ (begin - w.first[at - first])) & 0xFFFF)
                cols = [x["mini"][h], kind.astype(np.int32), salt.astype(np.int32), ids[at], hs[at], (begin - w.first[at - first]).astype(np.int32),
                        n.astype(np.int32), x["first"][h]]
                yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(said, pa.binary())],
                                                 ["mini", "kind", "salt", "doc_id", "h", "start", "n", "first", "digests"])
    return run


def _columns(batch: pa.RecordBatch, keep: np.ndarray, *names: str) -> list[np.ndarray]:
    return [batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)[keep] for c in names]


def _kind(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(1).to_numpy(zero_copy_only=False)


def _joined(batch: pa.RecordBatch, keep: np.ndarray, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column(8).filter(pa.array(keep)).to_pylist()), kind)


def _steps(n: np.ndarray) -> np.ndarray:
    """0 to n-1 for each n in turn."""
    return np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)


SPANS = "doc_id long, h long, start int, len int, first long, k1 long, k2 long"
_SPAN_NAMES = ["doc_id", "h", "start", "len", "first", "k1", "k2"]


def path_spans(k: int):
    """Occurrences of paths as spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mini, doc, h, start, n, first = _columns(batch, _kind(batch) == PATH, "mini", "doc_id", "h", "start", "n", "first")
            yield pa.RecordBatch.from_arrays([*map(pa.array, (doc, h, start, (n + k - 1).astype(np.int32), first, mini, np.zeros(len(mini), np.int64)))], _SPAN_NAMES)
    return run


def path_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = _kind(batch) == PATH
        d = _joined(batch, keep, "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(_columns(batch, keep, "mini")[0]), pa.array(d[:, 0].copy()), pa.array(d[:, 1].copy())], ["k1", "d1", "d2"])


HOT_RUNS = "k1 long, doc_id long, h long, start int, digests binary"
WINDOWS = "k1 long, node binary, at int, k2 long, first long, times long"


def hot_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = _kind(batch) == HOT_BRANCH
        cols = _columns(batch, keep, "mini", "doc_id", "h", "start")
        yield pa.RecordBatch.from_arrays([*map(pa.array, cols), batch.column(8).filter(pa.array(keep))], ["k1", "doc_id", "h", "start", "digests"])


def node_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k1, node, digests, first, times) to a row per window."""
    for b in batches:
        raw = b.column(2).to_pylist()
        n = np.array([len(x) // 8 for x in raw], np.int64)
        at = np.repeat(np.arange(len(raw)), n)
        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(_steps(n).astype(np.int32)),
                                          pa.array(np.frombuffer(b"".join(raw), "<i8")), b.column(3).take(pa.array(at)), b.column(4).take(pa.array(at))],
                                         ["k1", "node", "at", "k2", "first", "times"])


def met(left: DataFrame, right: DataFrame, key: str, *more: str, how: str = "inner") -> DataFrame:
    """Equi-join of a possibly skewed ``left`` with a grouped ``right``. The key is compared inverted: a
    grouped side that is already dealt by the key would join without an exchange of its own, and Spark
    splits a skewed partition only between two exchanges."""
    r = right.withColumns({"_key": F.bitwise_not(key), **{f"_{c}": F.col(c) for c in more}}).drop(key, *more)
    on = F.bitwise_not(left[key]) == r["_key"]
    for c in more:
        on &= left[c] == r[f"_{c}"]
    return left.join(r, on, how).drop("_key", *(f"_{c}" for c in more))


def hot_spans(runs: DataFrame, k: int) -> DataFrame:
    """(doc_id, h, spans) of runs under branching hashes of any number: equal runs are one node, the nodes'
    windows meet, and each run gets its node's answer."""
    runs = runs.withColumn("node", F.unhex(F.md5("digests")))
    nodes = runs.groupBy("k1", "node", "digests").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("times"))
    windows = nodes.select("k1", "node", "digests", "first", "times").mapInArrow(node_windows, WINDOWS)
    shared = windows.groupBy("k1", "k2").agg(F.min("first").alias("first"), F.sum("times").alias("times")).filter("times > 1").drop("times")
    answer = met(windows.drop("first", "times"), shared, "k1", "k2").groupBy("k1", "node").agg(F.collect_list(F.struct("at", "k2", "first")).alias("found"))
    span = lambda w: F.struct((F.col("start") + w["at"]).alias("start"), F.lit(k).alias("len"), w["first"].alias("first"), F.col("k1").alias("k1"), w["k2"].alias("k2"))
    return met(runs.drop("digests"), answer, "k1", "node").select(*DOC, F.transform("found", span).alias("spans"))


def _settled(cols: list[np.ndarray], w: np.ndarray, k: int) -> pa.RecordBatch:
    mini, doc, h, start, n = cols
    at = np.repeat(np.arange(len(n)), n)
    pos = np.repeat(start, n) + _steps(n)
    order = np.lexsort((pos, h[at], doc[at], w, mini[at]))
    a, v, p = at[order], w[order], pos[order]
    new = np.ones(len(a), bool)
    new[1:] = (v[1:] != v[:-1]) | (mini[a[1:]] != mini[a[:-1]])
    text = new.copy()
    text[1:] |= (doc[a[1:]] != doc[a[:-1]]) | (h[a[1:]] != h[a[:-1]])
    i = np.arange(len(a))
    least, mine = (np.maximum.accumulate(np.where(x, i, 0)) for x in (new, text))
    gone = np.empty(len(a), bool)
    gone[order] = (doc[a] > doc[a[least]]) | (p > p[mine])
    edge = gone.copy()
    edge[1:] &= ~gone[:-1] | (at[1:] != at[:-1])
    b = np.flatnonzero(edge)
    size = np.add.reduceat(gone, b) if len(b) else np.zeros(0, np.int64)
    r = at[b]
    return pa.RecordBatch.from_arrays([*map(pa.array, (
        doc[r], h[r], pos[b].astype(np.int32), (size + k - 1).astype(np.int32), np.full(len(b), np.iinfo(np.int64).min), np.zeros(len(b), np.int64), np.zeros(len(b), np.int64)))], _SPAN_NAMES)


def settle(k: int):
    """What goes of the runs under each branching hash; rows come sorted by it, and at most ``hot`` have the same."""
    names = ("mini", "doc_id", "h", "start", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            keep = _kind(batch) == BRANCH
            cols, w = _columns(batch, keep, *names), _joined(batch, keep, "<u8")
            if held:
                cols, w = [np.concatenate(x) for x in zip(held[0], cols, strict=True)], np.concatenate([held[1], w])
            if not len(cols[0]):
                continue
            cut = int(np.searchsorted(cols[0], cols[0][-1]))
            wcut = int(cols[4][:cut].sum())
            held = [c[cut:] for c in cols], w[wcut:]
            if cut:
                yield _settled([c[:cut] for c in cols], w[:wcut], k)
        if held:
            yield _settled(*held, k)
    return run


def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words that stay: a span goes if a smaller doc_id has it, or the same text further up."""
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        row, f = _lists(batch.column(3).fill_null([]) if batch.column(3).null_count else batch.column(3))
        order = np.lexsort((f["start"], f["k2"], f["k1"], row))
        row, f = row[order], {x: v[order] for x, v in f.items()}
        again = np.zeros(len(row), bool)
        again[1:] = (row[1:] == row[:-1]) & (f["k1"][1:] == f["k1"][:-1]) & (f["k2"][1:] == f["k2"][:-1])
        again[1:] &= f["start"][1:] > f["start"][:-1]
        # equal rows of one place: as its first
        same = np.zeros(len(row), bool)
        same[1:] = (row[1:] == row[:-1]) & (f["k1"][1:] == f["k1"][:-1]) & (f["k2"][1:] == f["k2"][:-1]) & (f["start"][1:] == f["start"][:-1])
        again = again[np.maximum.accumulate(np.where(same, 0, np.arange(len(row))))] if len(row) else again
        go = again | (f["first"] < ids[row])
        row, start, length = row[go], f["start"][go], f["len"][go]
        order = np.argsort(row, kind="stable")
        row, start, length = row[order], start[order], length[order]
        n_words, n_removed, spans, texts = [], [], [], []
        for data, off, first in chunks(batch.column(2)):
            w = Text(data, off)
            lo, hi = np.searchsorted(row, [first, first + len(off) - 1])
            edge = np.zeros(len(w.start) + 1, np.int64)
            b = w.first[row[lo:hi] - first] + start[lo:hi]
            np.add.at(edge, b, 1)
            np.add.at(edge, b + length[lo:hi], -1)
            gone = np.cumsum(edge)[:-1] > 0
            stay = np.ones(len(w.flat) + 1, bool)
            after = np.append(w.at[1:], len(w.flat))
            turn = np.zeros(len(w.flat) + 1, np.int64)
            np.add.at(turn, w.at[gone], 1)
            np.add.at(turn, after[gone], -1)
            stay = np.cumsum(turn)[:-1] == 0
            kept = w.flat[stay]
            to = np.concatenate([[0], np.cumsum(stay)])
            ends = np.append(w.at, len(w.flat))[w.first]  # of each document in flat
            sums = np.concatenate([[0], np.cumsum(gone)])[w.first]
            n_words += w.count.tolist()
            n_removed += np.diff(sums).tolist()
            for d in range(len(off) - 1):
                text = kept[to[ends[d]]:to[ends[d + 1]]].tobytes()
                texts.append(text[:-1] if text.endswith(b" ") else text)
                got = []
                if sums[d + 1] > sums[d]:
                    x = np.flatnonzero(np.diff(np.concatenate([[0], gone[w.first[d]:w.first[d + 1]].astype(np.int8), [0]])))
                    got = [{"start": i, "end": j} for i, j in x.reshape(-1, 2).tolist()]
                spans.append(got)
        yield pa.RecordBatch.from_arrays([
            batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
            pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(texts, pa.binary())],
            ["doc_id", "n_words", "n_removed", "spans", "kept"])


# ---------------------------------------------------------------- operator


def dedup(docs: DataFrame, k: int = WINDOW, m: int = SEED_WORDS, bits: int = RUN_BITS, hot: int = HOT) -> DataFrame:
    """Per document: words, removed words, their spans (word numbers) and the text of the kept
    words joined by one space. ``bits``: of the run hashes, fewer only in tests of collisions."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    repeated = not d.groupBy("doc_id").count().filter("count > 1").isEmpty()
    d = d.select("doc_id", (F.xxhash64("text").bitwiseAND((1 << 48) - 1) if repeated else F.lit(0).cast("long")).alias("h"), "text")
    packed = d.mapInArrow(squeeze, "doc_id long, h long, z binary").filter("doc_id is not null and h is not null")
    runs = d.mapInArrow(run_rows(k, m, bits), RUNS)
    found = met(runs.select("mini", "doc_id", "h", "start", "n"), compacted(runs.select("mini", "digest", "then", "doc_id"), hot), "mini")
    run = F.struct("start", "n", F.when(F.col("linked"), 0).otherwise(F.col("mini")).alias("mini"), "kind", "linked", "first")
    per_doc = found.groupBy(*DOC).agg(F.collect_list(run).alias("runs"))
    # one exchange for all uses: each is an opaque step above it, so that Spark runs what is below once
    traces = packed.join(per_doc.hint("shuffle_hash"), DOC).mapInArrow(trace(k), TRACES).repartition("mini", "salt")

    digests = traces.mapInArrow(path_digests, "k1 long, d1 long, d2 long")
    odd = digests.groupBy("k1").agg(*(f(c).alias(f"{c}_{f.__name__}") for c in ("d1", "d2") for f in (F.min, F.max))) \
        .filter("d1_min <> d1_max or d2_min <> d2_max").select("k1")
    paths = traces.mapInArrow(path_spans(k), SPANS)
    apart = met(paths, odd, "k1", how="left_semi").groupBy(*DOC).agg(F.collect_list(F.struct(
        "start", (F.col("len") - (k - 1)).alias("n"), F.col("k1").alias("mini"), F.lit(HOT_BRANCH).alias("kind"), F.lit(False).alias("linked"), "first")).alias("runs"))
    apart = packed.join(apart.hint("shuffle_hash"), DOC).mapInArrow(trace(k), TRACES)
    branches = traces.mapInArrow(hot_runs, HOT_RUNS).unionByName(apart.mapInArrow(hot_runs, HOT_RUNS))
    plain = met(paths, odd, "k1", how="left_anti").unionByName(traces.sortWithinPartitions("mini").mapInArrow(settle(k), SPANS))
    spans = plain.select(*DOC, F.array(F.struct("start", "len", "first", "k1", "k2")).alias("spans")).unionByName(hot_spans(branches, k))
    per_doc = spans.groupBy(*DOC).agg(F.flatten(F.collect_list("spans")).alias("spans"))
    out = packed.join(per_doc.hint("shuffle_hash"), DOC, "left").mapInArrow(
        apply, "doc_id long, n_words long, n_removed long, spans array<struct<start:int,end:int>>, kept binary")
    return out.withColumn("kept", F.col("kept").cast("string"))


def op12(spark, sf_dir: str) -> DataFrame:
    """Contract query: repeated windows of 20 words go, all documents."""
    return dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
