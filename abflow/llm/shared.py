"""Which fingerprints occur in more than one document: a grouped exchange.

Documents are dealt into groups (``common.with_groups``). A group sends its
distinct fingerprints once, cut into hash buckets as packed 32-bit values; a
bucket adds up the counts of the groups and answers each group with the values
seen in two documents or more. So a fingerprint that every document has costs
one value per group, not one per document.

Two fingerprints of one bucket that agree in 32 bits count as one: the answer
may name a value too many, never one too few. The callers use it only to
leave out what cannot match.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SENT = "r int, p int, fps binary, counts binary"
SENT_ARROW = pa.schema([("r", pa.int32()), ("p", pa.int32()), ("fps", pa.binary()), ("counts", pa.binary())])
MANY = 65535


def key(h: np.ndarray, n_buckets: int) -> np.ndarray:
    """Bucket in the upper half, 32 hash bits in the lower."""
    return (((h >> np.uint64(32)) % np.uint64(n_buckets)) << np.uint64(32)) | (h & np.uint64(0xFFFFFFFF))


def pack(keys: np.ndarray, p: int) -> pa.Table:
    """Rows to send: ``keys`` has each key of the group once per document that has it."""
    u, n = np.unique(keys, return_counts=True)
    b = (u >> np.uint64(32)).astype(np.int64)
    at = np.flatnonzero(np.r_[True, b[1:] != b[:-1]]) if len(u) else np.zeros(0, np.int64)
    to = np.r_[at[1:], len(u)] if len(u) else at
    low, n = (u & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.minimum(n, MANY).astype(np.uint16)
    few = n <= 255
    return pa.Table.from_arrays([
        pa.array(b[at], pa.int32()), pa.array(np.full(len(at), p), pa.int32()),
        pa.array([low[i:j].tobytes() for i, j in zip(at, to, strict=True)], pa.binary()),
        pa.array([(n[i:j].astype(np.uint8) if few[i:j].all() else n[i:j]).tobytes() for i, j in zip(at, to, strict=True)], pa.binary())],
        schema=SENT_ARROW)


def _counts(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, np.uint8 if len(raw) == n else np.uint16).astype(np.int64)


def _answer(t: pa.Table) -> pa.Table:
    r, ps = t.column("r")[0].as_py(), t.column("p").to_pylist()
    fps = [np.frombuffer(x, np.uint32) for x in t.column("fps").to_pylist()]
    counts = [_counts(x, len(f)) for x, f in zip(t.column("counts").to_pylist(), fps, strict=True)]
    every = np.concatenate(fps)
    u, inv = np.unique(every, return_inverse=True)
    total = np.bincount(inv, weights=np.concatenate(counts), minlength=len(u)).astype(np.int64)
    rows, at = [], 0
    for p, f in zip(ps, fps, strict=True):
        n = total[inv[at:at + len(f)]]
        at += len(f)
        two = n > 1
        if two.any():
            rows.append((r, p, f[two].tobytes(), np.minimum(n[two], MANY).astype(np.uint16).tobytes()))
    return pa.Table.from_arrays([pa.array([x[i] for x in rows], f.type) for i, f in enumerate(SENT_ARROW)], schema=SENT_ARROW)


def answers(sent: DataFrame) -> DataFrame:
    """Per bucket and group, the group's values that two documents or more have, with their counts."""
    return sent.select("r", "p", "fps", "counts").groupBy("r").applyInArrow(_answer, SENT)


class Shared:
    """A group's answer, for lookups by key."""

    def __init__(self, t: pa.Table) -> None:
        keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for r, f, c in zip(t.column("r").to_pylist(), t.column("fps").to_pylist(), t.column("counts").to_pylist(), strict=True):
            if f is None:
                continue
            v = np.frombuffer(f, np.uint32).astype(np.uint64)
            keys.append(v | (np.uint64(r) << np.uint64(32)))
            counts.append(np.frombuffer(c, np.uint16).astype(np.int64))
        k, c = np.concatenate(keys), np.concatenate(counts)
        o = np.argsort(k)
        self.keys, self.counts = k[o], c[o]

    def count(self, keys: np.ndarray) -> np.ndarray:
        """Documents with each key, 1 if it isn't shared."""
        if not len(self.keys):
            return np.ones(len(keys), np.int64)
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[i] == keys, self.counts[i], 1)


def bucket_count(groups: int, per_byte: float, bucket_values: int, group_bytes: int) -> int:
    """Buckets of about ``bucket_values`` fingerprints, ``per_byte`` of them in a byte of text."""
    return max(8, int(groups * group_bytes * per_byte / bucket_values))
