"""Quality by compression (operator 6).

Two zstandard dictionaries are built, one from good and one from bad labelled
text. A text is compressed in blocks with either; the difference of the two
sizes per byte of text, with the text's length, becomes a probability of
label 1 by logistic calibration on labelled texts that neither dictionary has seen.

The model is fitted on a bounded sample: at most ``PER_CLASS`` labelled
documents of each class, taken by a hash of their id, half of them for the
dictionaries (at most ``BLOCKS`` blocks a class), half for the calibration.
Every text is scored whole. Blocks keep the difference alike in long and short texts,
as the dictionary would otherwise matter only to a long text's beginning.

Defined cases: null and empty texts are scored by length alone; a null
``doc_id`` is not held out; labels other than 0 and 1 and null ids are
ignored, of several labels of one id the smallest counts; with a class
missing every score is the share of label 1, 0.5 without labels; few blocks
make a dictionary of their raw content; no rows give no rows; other columns
are kept out of the score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import read_table, release
from .tokens import column_texts, forget

PER_CLASS = 8000
BLOCKS = 6000
BLOCK = 1024
DICT_BYTES = 112_640
LEVEL = 3
CUTOFF = 0.7
FOLDS, HELD_OUT = 4, 2


@dataclass
class Model:
    """Dictionaries (bad, good) and weights of (1, difference, shortness); without
    dictionaries every score is ``share``."""

    dictionaries: tuple[bytes, ...] = ()
    raw: bool = False
    weights: tuple[float, ...] = ()
    share: float = 0.5

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        kind = zstandard.DICT_TYPE_RAWCONTENT if self.raw else zstandard.DICT_TYPE_FULLDICT
        out = []
        for raw in self.dictionaries:
            d = zstandard.ZstdCompressionDict(raw, dict_type=kind)
            d.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(x), self.share)
        w = np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))


def features(compressors: list, texts: list[str | None]) -> np.ndarray:
    """Difference of the compressed sizes per byte, and shortness (1 empty, to 0)."""
    out = np.zeros((len(texts), 2))
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        sizes = [0, 0]
        for a in range(0, len(raw), BLOCK):
            block = raw[a:a + BLOCK]
            for k, c in enumerate(compressors):
                sizes[k] += len(c.compress(block))
        out[i] = (sizes[0] - sizes[1]) / max(64, len(raw)) if sizes[0] else 0.0, 1 / (1 + len(raw) / 128)
    return out


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Weights by Newton steps, slightly regularised, for x as it is."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    w = np.zeros(z.shape[1])
    ridge = np.diag([1e-3, *[0.1] * x.shape[1]])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (p - y) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return (float(w[0] - (w[1:] / scale * mean).sum()), *(w[1:] / scale).tolist())


def held_out(doc_id: Column) -> Column:
    """Rows whose label must not be learnt: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def _dictionary(blocks: list[bytes], size: int) -> tuple[bytes, bool]:
    try:
        return zstandard.train_dictionary(size, blocks).as_bytes(), False
    except zstandard.ZstdError:  # too few blocks
        return b"".join(blocks)[:size], True


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, blocks: int = BLOCKS) -> Model:
    """A model from labelled documents (doc_id, quality) that aren't held out."""
    known = labels.filter("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.filter(~held_out(F.col("doc_id")))
    order = F.xxhash64("doc_id", F.lit("sample"))
    counts = {r.quality: r.n for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Model(share=float(next(iter(counts))) if counts else 0.5)
    share = counts[1] / (counts[0] + counts[1])
    taken = [known.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(per_class) for q in (0, 1)]
    # at most 2 * per_class ids, so it may be broadcast
    sample = F.broadcast(taken[0].union(taken[1]).select(F.col("doc_id").alias("known_id"), F.col("quality").alias("label")))
    rows = docs.select(F.col("doc_id").alias("known_id"), F.col("text").cast("string").alias("text")).filter("text <> ''").join(sample, "known_id")
    half = F.pmod(F.xxhash64("known_id", F.lit("half")), F.lit(2)) == 0

    def cut(batches):
        forget()
        for batch in batches:
            ids, out = batch.column("known_id").to_pylist(), []
            for k, (q, t) in enumerate(zip(batch.column("label").to_pylist(), batch.column("text").to_pylist(), strict=True)):
                raw = t.encode()
                out += [(ids[k], a, q, raw[a:a + BLOCK]) for a in range(0, len(raw), BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary()))],
                                             ["known_id", "at", "label", "block"])
        release()

    cuts = rows.filter(half).select("known_id", F.col("label").cast("int").alias("label"), "text").mapInArrow(cut, "known_id long, at long, label int, block binary")
    by_hash = F.xxhash64("known_id", "at")
    lists = [[bytes(r.block) for r in cuts.filter(F.col("label") == q).orderBy(by_hash, "known_id", "at").limit(blocks).collect()] for q in (0, 1)]
    made = [_dictionary(x, DICT_BYTES) for x in lists]
    if any(raw for _, raw in made):
        made = [(b"".join(x)[:DICT_BYTES], True) for x in lists]
    if not all(d for d, _ in made):
        return Model(share=share)
    model = Model(tuple(d for d, _ in made), made[0][1], share=share)

    def measure(batches):
        comp = model.compressors()
        for batch in batches:
            x = features(comp, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1]), batch.column("label").cast(pa.int32())], ["d", "s", "label"])
        release()

    seen = rows.filter(~half).select("text", "label").mapInArrow(measure, "d double, s double, label int").collect()
    y = np.array([r.label for r in seen], float)
    if len(set(y.tolist())) < 2:
        return Model(share=share)
    # classes were sampled evenly; weigh them back to their share of all labels
    model.weights = logistic(np.array([(r.d, r.s) for r in seen]), y)
    lift = math.log(share / (1 - share)) - math.log(y.mean() / (1 - y.mean()))
    model.weights = (model.weights[0] + lift, *model.weights[1:])
    return model


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """All columns of docs with ``name``: the probability of label 1 (a column so named is replaced)."""
    given = docs.drop(name)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of 110 KB
    at = given.columns.index("text")

    def run(batches):
        forget()
        m = shared.value
        comp = m.compressors()
        for batch in batches:
            x = np.zeros((batch.num_rows, 2))
            for first, texts in column_texts(batch.column(at)) if comp else ():
                x[first:first + len(texts)] = features(comp, texts)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(m.score(x), pa.float64())], [*batch.schema.names, name])
        release()

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema) + f", `{name}` double"
    return given.mapInArrow(run, schema)


def op6(spark, sf_dir: str) -> DataFrame:
    """Contract query: every document scored by a model of the rows that aren't held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))
