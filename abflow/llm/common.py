"""Shared helpers: table reading, the session's shared folder, and numpy word
hashing over the UTF-8 bytes of an Arrow string column.

The byte kernels work on chunks of whole documents of about ``CHUNK_BYTES``
(one longer document is a chunk of its own), so their memory is bounded by
the chunk, not by the batch or the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

CHUNK_BYTES = 1 << 20
U64 = np.uint64


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise in the shared checkpoint folder and cut the lineage there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def group_of(doc_id: str, groups: int) -> Column:
    return F.pmod(F.xxhash64(F.col(doc_id).cast("long")), F.lit(groups)).cast("int")


def with_groups(docs: DataFrame, group_bytes: int) -> tuple[DataFrame, int]:
    """(doc_id, text, p) and the number of groups: ``p`` deals the documents into groups of
    about ``group_bytes`` of text by a hash of ``doc_id``. Every use of the result under
    ``groupBy("p")`` in one query has the same exchange, which Spark runs once."""
    total = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    n = max(1, -(-total // group_bytes))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("p", group_of("doc_id", n)), n


# ---------------------------------------------------------------- Arrow columns


def text_buffers(col: pa.Array | pa.ChunkedArray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(bytes, offsets, first row) of chunks of whole rows; a null counts as empty."""
    chunks = col.chunks if isinstance(col, pa.ChunkedArray) else [col]
    row = 0
    for a in chunks:
        if a.null_count:
            a = a.fill_null(b"" if pa.types.is_binary(a.type) or pa.types.is_large_binary(a.type) else "")
        n = len(a)
        if not n:
            continue
        kind = np.int64 if pa.types.is_large_string(a.type) or pa.types.is_large_binary(a.type) else np.int32
        _, ob, db = a.buffers()
        off = np.frombuffer(ob, dtype=kind, count=a.offset + n + 1)[a.offset:].astype(np.int64)
        data = np.frombuffer(db, dtype=np.uint8) if db is not None and db.size else np.zeros(0, np.uint8)
        i = 0
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK_BYTES, "right")) - 1)
            yield data[off[i]:off[j]], off[i:j + 1] - off[i], row + i
            i = j
        row += n


def release() -> None:
    """Give memory that is free in this Python worker back to the system: workers outlive
    their stage, and what they hold counts beside the next one's."""
    for pool in (pa.default_memory_pool(), pa.system_memory_pool()):  # the latter trims malloc, and so numpy's share
        pool.release_unused()


# ---------------------------------------------------------------- hashing

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_MULT = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_INV = U64(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _pow(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i mod 2**64 for i < n."""
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 2)
        for k, b in enumerate((_BASE, _INV)):
            a = np.full(size, b, U64)
            a[0] = 1
            _powers[k] = np.cumprod(a, dtype=U64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, in place."""
    h ^= h >> U64(33)
    h *= U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32  # A-Z to a-z
# words of all but white space
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
# words of letters, digits and non-ASCII characters
PLAIN = np.zeros(256, bool)
PLAIN[48:58] = PLAIN[97:123] = PLAIN[128:] = True


class Words:
    """Words of a chunk: byte starts and ends, document of each, 64-bit hash.

    ``first``: index of each document's first word, one more entry at the end.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray, is_word: np.ndarray, fold: np.ndarray | None = FOLD) -> None:
        folded = data if fold is None else fold[data]
        inside = is_word[folded]
        n = len(data)
        edge = np.zeros(n + 1, bool)
        edge[off] = True
        if n:
            before = np.empty(n, bool)
            before[0] = False
            before[1:] = inside[:-1]
            self.start = np.flatnonzero(inside & (~before | edge[:n]))
            after = np.empty(n, bool)
            after[-1] = False
            after[:-1] = inside[1:]
            self.end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.folded = folded
        up, down = _pow(n + 1)
        total = np.empty(n + 1, U64)
        total[0] = 0
        np.cumsum(_BYTE[folded] * up[:n], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * down[self.start])
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(off) - 1), self.count)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first word and hash of each run of k words within a document."""
        m = len(self.hash) - k + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, U64)
        h = np.zeros(m, U64)
        for j in range(k):
            h += self.hash[j:j + m] * _MULT[j]
        ok = self.doc[:m] == self.doc[k - 1:]
        at = np.flatnonzero(ok)
        return at, mix(h[at] + U64(k))

    def whole(self, doc: int) -> int:
        """Hash of all words of a short document, in a form no k-word window has."""
        a, b = self.first[doc], self.first[doc + 1]
        h = (self.hash[a:b] * _MULT[:b - a]).sum(dtype=U64)
        return int(mix(np.array([h + U64(b - a)], U64))[0])

    def words(self, a: int, b: int) -> bytes:
        """Folded words a to b-1, joined by a space."""
        f = self.folded
        return b" ".join(f[self.start[i]:self.end[i]].tobytes() for i in range(a, b))
