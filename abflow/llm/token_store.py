"""Token-ID store with a minimal perfect hash index (operator 10).

Documents are range partitioned by ``doc_id`` and encoded in that order into
shards of about ``SHARD_IDS`` ids. A shard is one row of a Parquet table:

=========  ==============================================================
``lo hi``  smallest and largest ``doc_id`` in it; shards don't overlap
``ids``    raw little-endian ids of its documents one after the other, each
           ended by id 0; ``width`` bytes an id (2, or 4 for a vocabulary
           of over 65,536)
``keys``   its document ids, ascending (int64)
``offs``   first id of each document row, and the number of ids (int64)
``index``  minimal perfect hash over the distinct keys, see :class:`Index`
=========  ==============================================================

A key costs one shard (by range), one hash per level (under two on average) and one
fingerprint comparison to its document's offset. A key that isn't there is told
by its fingerprint, save for one in 2**32.

Defined cases: null or empty text is the end id alone; rows with a null
``doc_id`` are left out (they have no key); rows with one ``doc_id`` lie side
by side in order of their text and the key leads to all of them; no rows give
no shards; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import mix, read_table
from .tokens import encoder, public_path, some_texts

END_ID = 0
SHARD_IDS = 4 << 20
SHARD_BYTES = 16 << 20  # text of one range partition
LEVELS = 40
MARKS = 500
_SHARD = pa.schema([("lo", pa.int64()), ("hi", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()),
                    ("keys", pa.binary()), ("offs", pa.binary()), ("index", pa.binary()), ("ids", pa.binary())])
_SHARD_DDL = "lo long, hi long, n_ids long, width int, keys binary, offs binary, index binary, ids binary"
_FOUND = pa.schema([("doc_id", pa.int64()), ("lo", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
_FOUND_DDL = "doc_id long, lo long, at long, n_tokens long, ids_crc32 long"


def _level_hash(keys: np.ndarray, level: int) -> np.ndarray:
    seed = np.uint64((level * 2 + 1) * 0xD6E8FEB86659FD93 % (1 << 64))
    return mix(keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + seed)


class Index:
    """Minimal perfect hash with fingerprints.

    Level by level the keys left over are hashed into a bit table of twice their
    number; a key alone on its bit is settled there. A key's slot is the rank of
    its bit over all levels. The few keys left after ``LEVELS`` are listed. A slot holds a
    32-bit fingerprint of its key and the first and last row of the key.
    """

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray, prints: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
        self.levels, self.rest, self.prints, self.first, self.last = levels, rest, prints, first, last
        sizes = [int(b.sum()) for b in levels]
        self.base = np.r_[0, np.cumsum(sizes)].astype(np.int64)
        self.rank = [np.cumsum(b, dtype=np.int64) - b for b in levels]

    @classmethod
    def build(cls, keys: np.ndarray, first: np.ndarray, last: np.ndarray) -> Index:
        levels, left = [], keys
        while len(left) and len(levels) < LEVELS:
            at = (_level_hash(left, len(levels)) % np.uint64(2 * len(left))).astype(np.int64)
            n = np.bincount(at, minlength=2 * len(left))
            levels.append(n == 1)
            left = left[n[at] != 1]
        out = cls(levels, np.sort(left), np.zeros(0, np.uint32), first, last)
        slot = out.slots(keys)
        place = np.empty(len(keys), np.int64)
        place[slot] = np.arange(len(keys))
        out.prints, out.first, out.last = out.fingerprint(keys)[place], first[place], last[place]
        return out

    @staticmethod
    def fingerprint(keys: np.ndarray) -> np.ndarray:
        return (_level_hash(keys, 1000) >> np.uint64(32)).astype(np.uint32)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key of the index; any slot or -1 for others."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for k, (bits, rank) in enumerate(zip(self.levels, self.rank, strict=True)):
            at = (_level_hash(keys[left], k) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            out[left[hit]] = self.base[k] + rank[at[hit]]
            left = left[~hit]
        if len(self.rest) and len(left):
            i = np.minimum(np.searchsorted(self.rest, keys[left]), len(self.rest) - 1)
            hit = self.rest[i] == keys[left]
            out[left[hit]] = self.base[-1] + i[hit]
        return out

    def rows(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row of each key, -1 if its fingerprint isn't there."""
        if not len(self.prints):
            return (np.full(len(keys), -1, np.int64),) * 2
        slot = self.slots(keys)
        ok = (slot >= 0) & (self.prints[slot] == self.fingerprint(keys))
        return np.where(ok, self.first[slot], -1), np.where(ok, self.last[slot], -1)

    def to_bytes(self) -> bytes:
        parts = [self.rest.astype("<i8").tobytes(), self.prints.astype("<u4").tobytes(), self.first.astype("<i8").tobytes(),
                 self.last.astype("<i8").tobytes(), *(struct.pack("<q", len(b)) + np.packbits(b).tobytes() for b in self.levels)]
        return struct.pack(f"<{len(parts) + 1}q", len(parts), *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Index:
        n = struct.unpack_from("<q", raw)[0]
        at, parts = 8 * (n + 1), []
        for size in struct.unpack_from(f"<{n}q", raw, 8):
            parts.append(raw[at:at + size])
            at += size
        levels = [np.unpackbits(np.frombuffer(p, np.uint8, offset=8), count=struct.unpack_from("<q", p)[0]).astype(bool) for p in parts[4:]]
        rest, first, last = (np.frombuffer(parts[i], "<i8") for i in (0, 2, 3))
        return cls(levels, rest, np.frombuffer(parts[1], "<u4"), first, last)


def _shard(keys: list[int], ids: list[np.ndarray]) -> dict:
    """ids: for each key its document's ids and the end."""
    k = np.array(keys, np.int64)
    offs = np.r_[0, np.cumsum([len(x) + 1 for x in ids[::2]])].astype(np.int64)
    u, first, n = np.unique(k, return_index=True, return_counts=True)
    every = np.concatenate(ids)
    return {"lo": keys[0], "hi": keys[-1], "n_ids": len(every), "width": every.dtype.itemsize, "keys": k.tobytes(), "offs": offs.tobytes(),
            "index": Index.build(u, first, first + n - 1).to_bytes(), "ids": every.tobytes()}


def _write(tokenizer: str, shard_ids: int):
    def run(batches):
        enc = encoder(public_path(tokenizer))
        end, keys, ids, size = np.array([END_ID], enc.dtype), [], [], 0
        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, texts in some_texts(batch.column("text").to_pylist()):
                for doc, got in zip(names[first:first + len(texts)], enc.encode(texts), strict=True):
                    if size >= shard_ids and doc != keys[-1]:
                        yield pa.RecordBatch.from_pylist([_shard(keys, ids)], _SHARD)
                        keys, ids, size = [], [], 0
                    keys.append(doc)
                    ids += got, end
                    size += len(got) + 1
        if keys:
            yield pa.RecordBatch.from_pylist([_shard(keys, ids)], _SHARD)
    return run


def write_store(docs: DataFrame, path: str, tokenizer: str, shard_ids: int = SHARD_IDS, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode the documents and write them in ascending ``doc_id`` order."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    n = max(1, -(-(d.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // shard_bytes))
    ordered = d.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_write(tokenizer, shard_ids), _SHARD_DDL).write.parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_SHARD_DDL).parquet(path)


def look_up(shard: dict, keys: np.ndarray):
    """(key, first id, ids) of every row of the keys that the shard has."""
    index, offs = Index.from_bytes(shard["index"]), np.frombuffer(shard["offs"], np.int64)
    ids = np.frombuffer(shard["ids"], f"<u{shard['width']}")
    for key, a, b in zip(keys.tolist(), *(x.tolist() for x in index.rows(keys)), strict=True):
        for row in range(a, b + 1) if a >= 0 else ():
            yield key, int(offs[row]), ids[offs[row]:offs[row + 1]]


def _digest(batches):
    for batch in batches:
        rows = []
        for shard in batch.to_pylist():
            for key, at, ids in look_up(shard, np.unique(np.frombuffer(shard["keys"], np.int64))):
                rows.append((key, shard["lo"], at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], f.type) for i, f in enumerate(_FOUND)], schema=_FOUND)


def _marks(store: DataFrame) -> list[int]:
    """At most ``MARKS`` of the shards' first keys, evenly spread and sorted."""
    at = [(i + 1) / (MARKS + 1) for i in range(MARKS)]
    return sorted(set(store.agg(F.percentile_approx("lo", at, 10 * MARKS)).first()[0] or ()))


def _range(value: str, marks: list[int]) -> Column:
    """Which range between marks a value is in. A mark is a shard's first key, so a key is in its shard's range."""
    every = F.array(*map(F.lit, marks)).cast("array<bigint>")
    return F.size(F.filter(every, lambda m: m <= F.col(value)))


def starts(store: DataFrame) -> DataFrame:
    """(lo, base): ids in all shards before each shard. Sums run within a range of shards;
    only the ranges' totals, ``MARKS`` + 1 rows at most, meet in one task."""
    s = store.select("lo", "n_ids").withColumn("r", _range("lo", _marks(store)))
    up_to = Window.rowsBetween(Window.unboundedPreceding, -1)
    totals = s.groupBy("r").agg(F.sum("n_ids").alias("n")).select("r", F.coalesce(F.sum("n").over(up_to.orderBy("r")), F.lit(0)).alias("all_before"))
    own = s.withColumn("before", F.coalesce(F.sum("n_ids").over(up_to.partitionBy("r").orderBy("lo")), F.lit(0)))
    return own.join(totals, "r").select("lo", (F.col("all_before") + F.col("before")).alias("base"))


def shard_of(store: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, lo): the shard whose range each distinct key falls into, if any. Keys and the
    shards' first keys are sorted together, a range of shards at a time; the last first key up to a key is its shard's."""
    marks = _marks(store)
    wanted = keys.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null").distinct()
    begins = store.select(F.col("lo").alias("doc_id"), F.struct("lo", "hi").alias("shard"))
    both = begins.unionByName(wanted, allowMissingColumns=True).withColumn("r", _range("doc_id", marks))
    seen = Window.partitionBy("r").orderBy("doc_id", F.col("shard").isNull()).rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("near", F.last("shard", ignorenulls=True).over(seen)).filter("shard is null and doc_id <= near.hi")
    return near.select("doc_id", F.col("near.lo").alias("lo"))


def fetch(store: DataFrame, keys: DataFrame) -> DataFrame:
    """(doc_id, ids) of the given keys: keys go to their shard and are looked up
    in its index. Only the shards that hold keys are moved."""
    wanted = shard_of(store, keys).groupBy("lo").agg(F.collect_list("doc_id").alias("wanted"))

    def run(batches):
        for batch in batches:
            rows = [(key, ids.tolist()) for s in batch.to_pylist() for key, _, ids in look_up(s, np.array(s["wanted"], np.int64))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))],
                                             ["doc_id", "ids"])
    return store.join(wanted, "lo").mapInArrow(run, "doc_id long, ids array<long>")


def op10(spark, sf_dir: str) -> DataFrame:
    """Contract query: write all documents, read the files back, look every key up."""
    path = scratch_path(spark, "token_store")
    write_store(read_table(spark, sf_dir, "documents"), path, "byte_bpe_50k.json")
    store = read_store(spark, path)
    return store.mapInArrow(_digest, _FOUND_DDL).join(starts(store), "lo").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
