"""Target-distribution importance resampling (operator 13).

Hashed counts of word runs in the documents (source) and in a target text set
give each bucket a gain, the log ratio of the two distributions in
thousandths. A document's weight is the floored mean gain of its runs; its
score adds Gumbel noise made from a hash of its id, so that the highest scores
are a draw without replacement in proportion to the weights.

Selection finds the exact cutoff key by weighted medians of medians: each
partition names the median of the keys still in question, the median of those
medians, weighted by how many keys each partition has left, splits the rest,
and one count says which side goes; at least a quarter goes each round. Once
half of the keys of the table at hand are gone the others are written anew, so
that all rounds together read a few times the first table. The winners alone
are sorted, by range, and numbered by partition offsets.

A key is (score descending, doc_id ascending, n_features ascending), so equal keys
are equal rows. What reaches the driver: one row per bucket (``BUCKETS``), one median per partition and
round, and at most ``FINISH`` keys at the end.

Defined cases: null or empty text has no words, no features and weight 0; a
null ``doc_id`` is hashed like an empty one, and loses ties; repeated rows count
and are drawn each on its own; without eligible documents nothing is drawn;
without target texts T and t are 0; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import PLAIN, Words, read_table, text_buffers

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7
FINISH = 10_000
LONG = 64  # bytes; the crc of a longer word is taken alone
RESULT = ["doc_id", "n_features", "weight", "score", "rank"]


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t.astype(np.uint32)


_TABLE = _crc_table()


def _step(c: np.ndarray, byte: np.ndarray | int) -> np.ndarray:
    return _TABLE[(c ^ byte) & np.uint32(255)] ^ (c >> np.uint32(8))


def _shifts() -> np.ndarray:
    """[length, byte of the crc, its value]: the crc moved on by ``length`` zero bytes; crc
    registers are linear, so the four bytes of a crc are looked up apart and xored."""
    s = np.zeros((LONG + 1, 4, 256), np.uint32)
    for k in range(4):
        s[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(LONG):
        s[n + 1] = _step(s[n], 0)
    return s


_SHIFT = _shifts()


def word_crcs(w: Words) -> np.ndarray:
    """crc32 of each word: all words of up to ``LONG`` bytes in step, byte by byte."""
    size = w.end - w.start
    order = np.argsort(-size, kind="stable")
    order = order[np.searchsorted(-size[order], -LONG):]
    start, n = w.start[order], size[order]
    c = np.full(len(order), 0xFFFFFFFF, np.uint32)
    for k in range(int(n[0]) if len(n) else 0):
        m = int(np.searchsorted(-n, -k, "left"))  # words of over k bytes come first
        c[:m] = _step(c[:m], w.folded[start[:m] + k])
    out = np.empty(len(size), np.uint32)
    out[order] = ~c
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = zlib.crc32(w.folded[w.start[i]:w.end[i]].tobytes())
    return out


def features(w: Words, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every word and of every two words joined by a space."""
    one = word_crcs(w)
    pair = np.flatnonzero(w.doc[:-1] == w.doc[1:]) if len(one) else np.zeros(0, np.int64)
    first = ~_step(~one[pair], 32)
    size = (w.end - w.start)[pair + 1]
    n = np.minimum(size, LONG)
    two = one[pair + 1]
    for k in range(4):
        two = two ^ _SHIFT[n, k, (first >> np.uint32(8 * k)) & np.uint32(255)]
    for i in np.flatnonzero(size > LONG).tolist():
        a = pair[i] + 1
        two[i] = zlib.crc32(w.folded[w.start[a]:w.end[a]].tobytes(), int(first[i]))
    return np.concatenate([w.doc, w.doc[pair]]), np.concatenate([one, two]).astype(np.int64) % buckets


def counter(buckets: int):
    """Per task: the features in each bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for data, off, _ in text_buffers(batch.column(0)):
                total += np.bincount(features(Words(data, off, PLAIN), buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])
    return run


def counts(texts: DataFrame, buckets: int) -> np.ndarray:
    """Features of all texts by bucket; tasks send sums, at most ``buckets`` rows each."""
    per = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(counter(buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in per.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # bounded by the number of buckets
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket: the floored thousandfold log ratio of the smoothed shares in target and source."""
    b = len(source)
    s_all, t_all = float(source.sum() + b), float(target.sum() + b)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigher(gain: np.ndarray):
    """Per document: words, features and the floored mean gain."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, sums, n = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for data, off, at in text_buffers(batch.column(1)):
                w = Words(data, off, PLAIN)
                doc, bucket = features(w, len(gain))
                to = slice(at, at + len(off) - 1)
                words[to], n[to] = w.count, np.bincount(doc, minlength=len(off) - 1)
                order = np.argsort(doc, kind="stable")
                total = np.concatenate([[0], np.cumsum(gain[bucket[order]])])
                end = np.cumsum(n[to])
                sums[to] = total[end] - total[end - n[to]]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(n), pa.array(np.where(n > 0, sums // np.maximum(n, 1), 0))],
                                             ["doc_id", "n_words", "n_features", "weight"])
    return run


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from a hash of the id."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h.cast("double") + 0.5) / F.lit(4294967296.0))))


def scores(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document; no shuffle of texts."""
    gain = gains(counts(docs, buckets), counts(target, buckets))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        weigher(gain), "doc_id long, n_words long, n_features long, weight long")
    return out.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))


# ---------------------------------------------------------------- selection

KEY = ["k1", "k2", "k3"]
_MAX = (1 << 63) - 1


def keyed(scored: DataFrame) -> DataFrame:
    return scored.withColumns({"k1": -F.col("score"), "k2": F.coalesce("doc_id", F.lit(_MAX)), "k3": F.col("n_features")})


def _key(values: tuple[int, int, int] | None = None) -> Column:
    return F.struct(*([F.col(c) for c in KEY] if values is None else [F.lit(v).cast("long").alias(c) for c, v in zip(KEY, values, strict=True)]))


def _medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The median key of a partition, and how many keys it has."""
    parts = [[b.column(c).to_numpy(zero_copy_only=False) for c in KEY] for b in batches if b.num_rows]
    if parts:
        cols = [np.concatenate(c) for c in zip(*parts, strict=True)]
        n = len(cols[0])
        mid = np.lexsort(cols[::-1])[(n - 1) // 2]
        yield pa.RecordBatch.from_arrays([pa.array([int(c[mid])], pa.int64()) for c in cols] + [pa.array([n], pa.int64())], [*KEY, "n"])


def weighted_median(medians: list[tuple[tuple[int, int, int], int]]) -> tuple[int, int, int]:
    total, seen = sum(n for _, n in medians), 0
    for key, n in sorted(medians):
        seen += n
        if 2 * seen >= total:
            return key
    raise ValueError("no keys")


def cutoff(keys: DataFrame, need: int, finish: int = FINISH) -> tuple[int, int, int]:
    """The ``need``-th smallest key (from 1) of a table of ``KEY`` columns with that many rows."""
    spark = keys.sparkSession
    rest, stored = keys.select(*KEY), None
    while True:
        found = [((r.k1, r.k2, r.k3), r.n) for r in rest.mapInArrow(_medians, "k1 long, k2 long, k3 long, n long").collect()]
        left = sum(n for _, n in found)
        if left <= finish:
            return tuple(sorted(rest.collect())[need - 1])
        pivot = _key(mid := weighted_median(found))
        below, equal = rest.agg(F.count_if(_key() < pivot), F.count_if(_key() == pivot)).first()
        if need > below and need <= below + equal:
            return mid
        lower = need <= below
        rest = rest.filter(_key() < pivot if lower else _key() > pivot)
        kept = below if lower else left - below - equal
        need -= 0 if lower else below + equal
        stored = stored or left
        if 2 * kept <= stored:
            path = scratch_path(spark, "resample-keys")
            rest.write.parquet(path)
            rest, stored = spark.read.parquet(path), kept


def ranked(winners: DataFrame, n_parts: int, drawn: int) -> DataFrame:
    """``winners`` with their place in key order; places beyond ``drawn`` (equal rows at the cutoff) are null."""
    spark = winners.sparkSession
    path = scratch_path(spark, "resample-winners")
    at = F.monotonically_increasing_id()
    winners.repartitionByRange(n_parts, *KEY).sortWithinPartitions(*KEY).withColumn("_at", at).write.parquet(path)
    w = spark.read.parquet(path).withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)})
    before, rows = 0, []
    for r in sorted(w.groupBy("_part").count().collect()):  # a row per partition
        rows.append((r[0], before))
        before += r[1]
    offsets = spark.createDataFrame(rows, "_part long, _before long")
    rank = F.col("_before") + F.col("_at") + 1
    return w.join(F.broadcast(offsets), "_part").withColumn("rank", F.when(rank <= drawn, rank)).drop("_part", "_at", "_before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS,
             seed: int = SEED, finish: int = FINISH) -> DataFrame:
    """Every document with its weight and score, and the rank of those drawn: ``percent`` percent
    (floored) of the documents with ``min_words`` words or more."""
    spark = docs.sparkSession
    path = scratch_path(spark, "resample-scores")
    keyed(scores(docs, target, buckets, seed)).write.parquet(path)
    scored = spark.read.parquet(path)
    eligible = F.col("n_words") >= min_words
    n = scored.filter(eligible).count()
    draw = percent * n // 100
    if not draw:
        return scored.withColumn("rank", F.lit(None).cast("long")).drop(*KEY)
    last = _key(cutoff(scored.filter(eligible), draw, finish))
    won = eligible & (_key() <= last)
    n_parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-draw // 1000)))
    return ranked(scored.filter(won), n_parts, draw).unionByName(scored.filter(~won).withColumn("rank", F.lit(None).cast("long"))).drop(*KEY)


def op13(spark, sf_dir: str) -> DataFrame:
    """Contract query: a quarter of the documents, by how much they read like the benchmark texts."""
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).select(*RESULT)
