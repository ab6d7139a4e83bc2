"""Exact repeated-substring removal by bucket-pointer refinement (operator 3).

A byte goes if a 50-byte string over it also starts in a document with a
smaller ``doc_id``. The steps:

1. A window of 50 bytes is filed under the smallest hash of its 24-byte pieces.
   Equal windows have equal keys, and neighbouring windows mostly share one,
   so a document falls into runs of windows under one key.
2. Keys that only one document has are left out (``shared``). The windows of a key that ``HOT``
   documents or more have (a frequent string with other neighbours in each) are filed one by one
   under a hash of all their bytes, so a key's size follows the groups, not the documents.
3. Within a group of documents equal runs are joined: only the smallest
   document's run is sent on, and the others' bytes go at once. A passage that
   a third of all documents has so costs one run per group.
4. The runs of one key meet in one bucket. Bucket-pointer refinement orders
   the window starts: buckets of equal 8-byte strings are refined by sorting on
   the bucket identifiers at later offsets (8, 16, then 18 bytes on), each
   round reusing the identifiers that the last one wrote, until a bucket is
   the windows with equal 50 bytes. Buckets of one suffix are final and leave
   the sort. Each bucket's smallest document decides.
5. The spans go back to their document's group, where they are joined and the
   rest of the bytes is hashed.

Hashes only decide where windows meet; equality is decided on the bytes.

Defined cases: null text is empty; texts under 50 bytes stay whole; rows with a
null ``doc_id`` are left out (they have no rank); rows with one ``doc_id``
never remove each other's bytes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from . import shared
from .common import mix, read_table, text_buffers, with_groups

WIDTH = 50
PIECE = 24  # bytes of the pieces whose smallest hash files a window
GROUP_BYTES = 4 << 20
BUCKET_VALUES = 1 << 20
SORT_BYTES = 1 << 20  # run bytes that are refined at once, whole keys
LONGEST = 4096  # windows of one run
HOT = 20_000  # documents of a key from which its windows are filed one by one
_RUNS = pa.schema([("g", pa.int32()), ("p", pa.int32()), ("spans", pa.bool_()), ("blob", pa.binary())])
_RUNS_DDL = "g int, p int, spans boolean, blob binary"
_SPANS = pa.schema([("p", pa.int32()), ("blob", pa.binary())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                  ("kept_sha256", pa.string()), ("spans", pa.list_(pa.int64()))])
_OUT_DDL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"


# ---------------------------------------------------------------- windows and runs


def _piece_hashes(data: np.ndarray) -> np.ndarray:
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    m = len(data) - PIECE + 1
    word = np.ndarray((len(data),), "<u8", padded, 0, (1,))  # 8 bytes from each position
    h = word[:m] * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h += word[8:m + 8]
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    h += word[16:m + 16]
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def runs(data: np.ndarray, off: np.ndarray, width: int = WIDTH):
    """Window runs of a chunk: first window start, end, key and document of each."""
    none = np.zeros(0, np.int64)
    if len(data) < width:
        return none, none, none.astype(np.uint64), none
    low, span, need = _piece_hashes(data), 1, width - PIECE + 1
    while 2 * span <= need:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < need:
        low = np.minimum(low[:span - need], low[need - span:])
    n = len(low)  # window starts
    ok = np.ones(n, bool)
    for a, z in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
        ok[max(a, z - width + 1):z] = False
    first = np.empty(n, bool)
    first[0] = True
    np.not_equal(low[1:], low[:-1], out=first[1:])
    first[1:] |= ~ok[:-1]
    first &= ok
    start = np.flatnonzero(first)
    if not len(start):
        return none, none, none.astype(np.uint64), none
    last = np.empty(n, bool)
    last[-1] = True
    last[:-1] = first[1:] | ~ok[1:]
    end = np.flatnonzero(last & ok) + 1
    key = low[start]
    if (end - start).max() > LONGEST:
        n_cut = -(-(end - start) // LONGEST)
        nth = np.arange(n_cut.sum()) - np.repeat(np.cumsum(n_cut) - n_cut, n_cut)
        stop, key = np.repeat(end, n_cut), np.repeat(key, n_cut)
        start = np.repeat(start, n_cut) + nth * LONGEST
        end = np.minimum(start + LONGEST, stop)
    return start, end, mix(key.copy()), np.searchsorted(off, start, "right") - 1


def one_by_one(data: np.ndarray, start: np.ndarray, end: np.ndarray, key: np.ndarray, doc: np.ndarray, hot: np.ndarray):
    """The runs with the windows of the hot ones as runs of their own, in the old order."""
    n = np.where(hot, end - start, 1)
    each = np.repeat(hot, n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = np.repeat(start, n) + np.where(each, nth, 0)
    end = np.where(each, start + 1, np.repeat(end, n))
    key, at = np.repeat(key, n), start[each]
    h, last = _piece_hashes(data), WIDTH - PIECE
    key[each] = mix(h[at] + h[at + last // 2] * np.uint64(0x9E3779B97F4A7C15) + h[at + last] * np.uint64(0xBF58476D1CE4E5B9))  # the three pieces cover the window
    return start, end, key, np.repeat(doc, n)


def _measure(n_buckets: int):
    def run(t: pa.Table) -> pa.Table:
        keys = [np.zeros(0, np.uint64)]
        for data, off, _ in text_buffers(t.column("text")):
            _, _, key, doc = runs(data, off)
            k = shared.key(key, n_buckets)
            o = np.lexsort((doc, k))
            k, doc = k[o], doc[o]
            keys.append(k[np.r_[True, (k[1:] != k[:-1]) | (doc[1:] != doc[:-1])][:len(k)]])
        return shared.pack(np.concatenate(keys), t.column("p")[0].as_py())
    return run


# ---------------------------------------------------------------- packed rows


def _squeeze(*arrays: np.ndarray | bytes) -> bytes:
    raw = [a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(struct.pack(f"<{len(raw)}q", *map(len, raw)) + b"".join(raw))


def _unsqueeze(blob: bytes, kinds: str) -> list:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    sizes, at, out = struct.unpack_from(f"<{len(kinds)}q", raw), 8 * len(kinds), []
    for n, kind in zip(sizes, kinds, strict=True):
        out.append(raw[at:at + n] if kind == "s" else np.frombuffer(raw, {"q": np.int64, "Q": np.uint64, "i": np.int32}[kind], n // (4 if kind == "i" else 8), at))
        at += n
    return out


def _ident(raw: bytes) -> int:
    """Tells rows with one doc_id but other texts apart."""
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def _joined(doc: np.ndarray, mark: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans in order of document and start (so of end too), with those that meet made one."""
    new = np.r_[True, (doc[1:] != doc[:-1]) | (mark[1:] != mark[:-1]) | (start[1:] > end[:-1])][:len(doc)] if len(doc) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return doc[first], mark[first], start[first], np.maximum.reduceat(end, first) if len(first) else end


def _split(n_buckets: int, n_parts: int, hot: int = HOT):
    """A group's shared runs: the smallest document's go to the buckets, the others' bytes go here."""
    def run(docs: pa.Table, reply: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if docs.num_rows and reply.num_rows:
            p, known, ids = docs.column("p")[0].as_py(), shared.Shared(reply), docs.column("doc_id").to_numpy()
            number: dict[bytes, int] = {}
            which, start, end, doc, mark, keys = [], [], [], [], [], []
            for data, off, first in text_buffers(docs.column("text")):
                a, b, key, d = runs(data, off)
                count = known.count(shared.key(key, n_buckets))
                two = np.flatnonzero(count > 1)
                if not len(two):
                    continue
                raw, a, b, key, d, many = data.tobytes(), a[two], b[two], key[two], d[two], count[two] >= hot
                if many.any():
                    a, b, key, d = one_by_one(data, a, b, key, d, many)
                got = []
                for i, j, k in zip(a.tolist(), (b + WIDTH - 1).tolist(), key.tolist(), strict=True):
                    n = number.setdefault(raw[i:j], len(number))
                    if n == len(keys):
                        keys.append(k)
                    got.append(n)
                names = {x: _ident(raw[off[x]:off[x + 1]]) for x in np.unique(d).tolist()}
                which.append(np.array(got))
                start.append(a - off[d])
                end.append(b - off[d])
                doc.append(ids[d + first])
                mark.append(np.array([names[x] for x in d.tolist()], np.int64))
            if which:
                which, start, end, doc, mark = map(np.concatenate, (which, start, end, doc, mark))
                least = np.full(len(number), np.iinfo(np.int64).max)
                np.minimum.at(least, which, doc)
                later = least[which] < doc
                if later.any():  # no bucket needs them; they travel with the answer of one
                    rows.append((p % n_parts, p, True, _squeeze(*_joined(doc[later], mark[later], start[later], end[later] + WIDTH - 1))))
                keys = np.array(keys, np.uint64)
                sent = np.flatnonzero(~later)
                to = (keys[which[sent]] % np.uint64(n_parts)).astype(np.int64)
                sent = sent[np.argsort(to, kind="stable")]
                to = np.sort(to)
                texts = list(number)
                cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1], True])
                for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                    e = sent[i:j]
                    t, nth = np.unique(which[e], return_inverse=True)
                    own = [texts[x] for x in t.tolist()]
                    rows.append((int(to[i]), p, False, _squeeze(keys[t], np.array([len(x) for x in own], np.int32), b"".join(own),
                                                         nth.astype(np.int32), doc[e], mark[e], start[e])))
        return pa.Table.from_arrays([pa.array([x[i] for x in rows], f.type) for i, f in enumerate(_RUNS)], schema=_RUNS)
    return run


# ---------------------------------------------------------------- bucket-pointer refinement


def refine(text: np.ndarray, left: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Bucket identifier of each position with ``width`` bytes left in its run; equal
    identifiers are equal strings of ``width`` bytes. ``left``: bytes left in the run."""
    n = len(text)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = text
    string = np.ndarray((n,), ">u8", padded, 0, (1,)).astype(np.uint64)
    pointer = np.zeros(n, np.int64)
    at = np.flatnonzero(left >= 8)
    o = at[np.argsort(string[at])]
    s = string[o]
    new = np.r_[True, s[1:] != s[:-1]][:len(o)]
    slot = np.flatnonzero(new)
    pointer[o] = np.repeat(slot, np.diff(np.r_[slot, len(o)]))  # a bucket's pointer is its first slot
    depth = 8
    while depth < width:
        step = min(depth, width - depth)
        at = o[left[o] >= depth + step]  # in bucket order
        b = pointer[at]
        alone = np.r_[True, b[1:] != b[:-1], True]
        alone = alone[:-1] & alone[1:] if len(at) else alone[:0]
        at, b = at[~alone], b[~alone]
        k = (b.astype(np.uint64) << np.uint64(32)) | pointer[at + step].astype(np.uint64)
        r = np.argsort(k)
        at, k, b = at[r], k[r], b[r]
        new = np.r_[True, k[1:] != k[:-1]][:len(at)]
        slot = np.flatnonzero(new)
        size = np.diff(np.r_[slot, len(at)])
        lead = np.flatnonzero(np.r_[True, b[1:] != b[:-1]][:len(at)])
        base = np.repeat(lead, np.diff(np.r_[lead, len(at)]))
        pointer[at] = b + np.repeat(slot, size) - base  # stays within the old bucket's slots
        # the order of all positions that are deep enough, refined buckets in place
        keep = o[left[o] >= depth + step]
        o = keep[np.argsort(pointer[keep], kind="stable")]
        depth += step
    out = np.full(n, -1, np.int64)
    out[o] = pointer[o]
    return out


def _decide(text: bytes, lens: np.ndarray, least: np.ndarray, run: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Spans to remove: number of the entry, first and end offset in its run. text: the runs
    of whole keys one after the other, with their lengths and smallest documents; run, doc: of each entry."""
    ends = np.cumsum(lens)
    first = ends - lens
    bucket = refine(np.frombuffer(text, np.uint8), np.repeat(ends, lens) - np.arange(len(text)), width)
    at = np.flatnonzero(bucket >= 0)
    least_of = np.full(len(text), np.iinfo(np.int64).max)
    np.minimum.at(least_of, bucket[at], np.repeat(least, lens)[at])
    low = np.zeros(len(text), np.int64)
    low[at] = least_of[bucket[at]]
    # the windows of all entries one after the other
    n = lens[run] - width + 1
    base = np.cumsum(n) - n
    gone = low[np.repeat(first[run] - base, n) + np.arange(n.sum())] < np.repeat(doc, n)
    edge = np.zeros(len(gone) + 1, bool)
    edge[base] = True
    before, after = np.r_[False, gone[:-1]], np.r_[gone[1:], False]
    a = np.flatnonzero(gone & (edge[:-1] | ~before))
    z = np.flatnonzero(gone & (np.r_[edge[1:-1], True][:len(gone)] | ~after)) + 1
    e = np.searchsorted(base, a, "right") - 1
    return e, a - base[e], z - base[e] + width - 1


def _bucket(t: pa.Table) -> pa.Table:
    rows: list[tuple] = []
    number: dict[bytes, int] = {}  # distinct runs
    own, keys, entries = [], [], []
    for p, ready, blob in zip(t.column("p").to_pylist(), t.column("spans").to_pylist(), t.column("blob").to_pylist(), strict=True):
        if ready:
            rows.append((p, blob))
            continue
        key, lens, raw, nth, *entry = _unsqueeze(blob, "Qisiqqq")
        z = np.cumsum(lens).tolist()
        got = np.array([number.setdefault(raw[a:b], len(number)) for a, b in zip([0, *z], z, strict=False)])
        own.append(got)
        keys.append(key)
        entries.append((got[nth], np.full(len(nth), p), *entry))
    spans = [np.zeros((5, 0), np.int64)]
    if number:
        which, part, doc, ident, start = map(np.concatenate, zip(*entries, strict=True))
        del entries
        key_of = np.empty(len(number), np.uint64)
        key_of[np.concatenate(own)] = np.concatenate(keys)
        u, key_no = np.unique(key_of, return_inverse=True)
        most = np.iinfo(np.int64).max
        low, high = np.full(len(u), most), np.full(len(u), -most - 1)
        np.minimum.at(low, key_no[which], doc)
        np.maximum.at(high, key_no[which], doc)
        two = low < high  # else one document's own repeats
        e = np.flatnonzero(two[key_no[which]])
        e = e[np.lexsort((which[e], key_no[which[e]]))]
        head = np.flatnonzero(np.r_[True, which[e[1:]] != which[e[:-1]]][:len(e)])  # entries by run, runs by key
        order, count = which[e[head]], np.diff(np.r_[head, len(e)])
        least = np.minimum.reduceat(doc[e], head) if len(e) else doc[e]
        texts = list(number)
        lens = np.array([len(texts[r]) for r in order.tolist()], np.int64)
        done = np.cumsum(lens * (1 + count))
        stop = np.flatnonzero(np.r_[key_no[order[1:]] != key_no[order[:-1]], True][:len(order)]) + 1  # whole keys
        i = 0
        while i < len(order):
            # keys up to about SORT_BYTES, one at least
            k = np.searchsorted(done[stop - 1], (done[i - 1] if i else 0) + SORT_BYTES)
            j = int(stop[min(k, len(stop) - 1)])
            a, z = head[i], head[j - 1] + count[j - 1]
            x = e[a:z]
            n, s, d = _decide(b"".join([texts[r] for r in order[i:j].tolist()]), lens[i:j], least[i:j],
                              np.repeat(np.arange(j - i), count[i:j]), doc[x], WIDTH)
            y = x[n]
            spans.append(np.stack([part[y], doc[y], ident[y], start[y] + s, start[y] + d]))
            i = j
    every = np.concatenate(spans, axis=1)
    every = every[:, np.lexsort(every[::-1])]
    cuts = np.flatnonzero(np.r_[True, every[0, 1:] != every[0, :-1], True]) if every.shape[1] else np.zeros(1, np.int64)
    for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        rows.append((int(every[0, i]), _squeeze(*_joined(*every[1:, i:j]))))
    return pa.Table.from_arrays([pa.array([x[i] for x in rows], f.type) for i, f in enumerate(_SPANS)], schema=_SPANS)


def _finish(docs: pa.Table, spans: pa.Table) -> pa.Table:
    gone: dict[int, list] = {}
    for blob in spans.column("blob").to_pylist():
        for d, *x in zip(*(c.tolist() for c in _unsqueeze(blob, "qqqq")), strict=True):
            gone.setdefault(d, []).append(x)
    rows = []
    ids = docs.column("doc_id").to_pylist() if docs.num_rows else []
    for data, off, first in text_buffers(docs.column("text")) if ids else ():
        whole = data.tobytes()
        for d in range(len(off) - 1):
            raw, doc = whole[off[d]:off[d + 1]], ids[first + d]
            merged: list[list[int]] = []
            if doc in gone:
                name = _ident(raw)
                for a, b in sorted((a, b) for n, a, b in gone[doc] if n == name):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
            kept, at = hashlib.sha256(), 0
            for a, b in merged:
                kept.update(raw[at:a])
                at = b
            kept.update(raw[at:])
            rows.append((doc, len(raw), sum(b - a for a, b in merged), len(merged), kept.hexdigest(), [x for m in merged for x in m]))
    return pa.Table.from_arrays([pa.array([x[i] for x in rows], f.type) for i, f in enumerate(_OUT)], schema=_OUT)


def suffix_dedup(docs: DataFrame, group_bytes: int = GROUP_BYTES, bucket_values: int = BUCKET_VALUES, hot: int = HOT) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, kept_sha256 and the removed byte spans
    (start, end, start, end, ...)."""
    grouped, groups = with_groups(docs.filter("doc_id is not null"), group_bytes)
    buckets = shared.bucket_count(groups, 0.07, bucket_values, group_bytes)
    parts = max(8, groups)
    reply = shared.answers(grouped.groupBy("p").applyInArrow(_measure(buckets), shared.SENT))
    runs_ = grouped.groupBy("p").cogroup(reply.groupBy("p")).applyInArrow(_split(buckets, parts, hot), _RUNS_DDL)
    spans = runs_.groupBy("g").applyInArrow(_bucket, "p int, blob binary")
    return grouped.groupBy("p").cogroup(spans.groupBy("p")).applyInArrow(_finish, _OUT_DDL)


def op3(spark, sf_dir: str) -> DataFrame:
    """Contract query: 50-byte strings of all documents."""
    return suffix_dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
