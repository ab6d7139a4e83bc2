"""N-gram Jaccard join by vertical partitioning (operator 2).

A document is its set of word 5-grams as 64-bit hashes. Documents with equal
sets are one class, kept by its smallest ``doc_id``. The steps:

1. Lossless filter. A document that links to another text keeps at least 80 %
   of its set in it, so at most ``n - ceil(0.8 n)`` of its n-grams can be its
   own. The n-grams that no other class has are counted (``shared``); a
   document with more of them is dropped. Of a pair, no more than either's
   other n-grams can be common, so most pairs need no counting at all.
2. Global order. N-grams are ordered by the number of classes that have them, then by
   hash. Two linked documents share an n-gram among the first
   ``n - ceil(0.8 n) + 1`` of each (prefix filter).
3. Vertical partitioning. The hash space is cut into ``FRAGMENTS`` fragments;
   every document's n-grams are cut along it. The overlap of a candidate pair is
   counted in each fragment by itself, and the partial counts are summed per
   pair and compared with the threshold, exactly in integers.
4. Components without all pairs. In a group of documents that share a prefix
   n-gram, first only pairs with one centre are counted (one centre per
   document, then a few), then every pair that no link has joined yet.
   After that each candidate pair is either counted or within one component.

Defined cases: null or empty text, or text of white space, has an empty set
and links with nothing; rows with a null ``doc_id`` are left out (they can't
be named); repeated rows give repeated results; rows of one ``doc_id`` with different texts are
one document, linked with what any of its texts links to; ties go to the smaller id;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared
from .common import SPACED, Words, cut, group_of, read_table, release, text_buffers, with_groups
from .tokens import forget

N, PERCENT = 5, 80
GROUP_BYTES = 8 << 20
BUCKET_VALUES = 1 << 20
FRAGMENTS = 8
_SIGNS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("sig", pa.binary())])
_SETS = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("c", pa.int64()), ("prefix", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64()))])
_SETS_DDL = "doc_id long, n long, c long, prefix array<long>, grams array<long>"


def spare(n, percent: int):
    """N-grams that a set of n may have outside a linked one."""
    return n - (percent * n + 99) // 100


def sets(t: pa.Table, k: int):
    """(row, sorted distinct hashes) of each document of a table."""
    for data, off, first in text_buffers(t.column("text")):
        w = Words(data, off, SPACED)
        at, h = w.windows(k)
        doc = w.doc[at]
        o = np.lexsort((h, doc))
        h, doc = h[o], doc[o]
        new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])][:len(h)]
        h, doc = h[new], doc[new]
        cuts = np.searchsorted(doc, np.arange(len(off)))
        for d in range(len(off) - 1):
            if 0 < w.count[d] < k:
                yield first + d, np.array([w.whole(d)], np.uint64)
            else:
                yield first + d, h[cuts[d]:cuts[d + 1]]


def _signature(s: np.ndarray) -> bytes:
    """128 bits of a set, with its size."""
    if not len(s):
        return b""
    x = np.array([len(s), 0, 0], np.uint64)
    x[1] = (s * np.uint64(0x9FB21C651E98DF25)).sum(dtype=np.uint64)
    x[2] = ((s ^ (s >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) ^ (s >> np.uint64(31))).sum(dtype=np.uint64)
    return x.tobytes()


def _signs(k: int):
    def run(batches):
        forget()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[i], len(s), _signature(s)) for i, s in sets(batch, k)]
            yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in rows], f.type) for j, f in enumerate(_SIGNS)], schema=_SIGNS)
        release()
    return run


def _class_sets(docs: pa.Table, reps: pa.Table, k: int):
    """(class, set) of the group's class representatives, once each. One doc_id may stand for several classes."""
    names = {(d, g): c for d, g, c in zip(*(reps.column(x).to_pylist() for x in ("doc_id", "sig", "class")), strict=True) if g is not None}
    if docs.num_rows and names:
        ids, wanted = docs.column("doc_id").to_pylist(), {d for d, _ in names}
        keep = [i for i, x in enumerate(ids) if x in wanted]
        for i, s in sets(docs.take(pa.array(keep, pa.int64())), k):
            name = names.pop((ids[keep[i]], _signature(s)), None) if len(s) else None
            if name is not None:
                yield name, s


def _send(k: int, n_buckets: int):
    def run(docs: pa.Table, reps: pa.Table) -> pa.Table:
        release()
        keys = [np.unique(shared.key(s, n_buckets)) for _, s in _class_sets(docs, reps, k)]
        return shared.pack(np.concatenate(keys), reps.column("p")[0].as_py()) if keys else shared.SENT_ARROW.empty_table()
    return run


def _survivors(k: int, n_buckets: int, percent: int):
    def run(docs: pa.Table, reply: pa.Table) -> pa.Table:
        release()
        rows, known = [], shared.Shared(reply)
        for doc, s in _class_sets(docs, reply if len(known.keys) else reply.slice(0, 0), k):
            n, df = len(s), known.count(shared.key(s, n_buckets))
            c = int((df > 1).sum())
            if n - c <= spare(n, percent):
                o = np.lexsort((s, df))[:spare(n, percent) + 1]
                rows.append((doc, n, c, s[o[df[o] > 1]].view(np.int64), s.view(np.int64)))
        return pa.Table.from_arrays([pa.array([x[i] for x in rows], f.type) for i, f in enumerate(_SETS)], schema=_SETS)
    return run


def overlaps(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose partial overlaps add up to the threshold."""
    one = parts.select(F.col("doc_id").alias("a"), "f", F.col("n").alias("n_a"), F.col("part").alias("part_a"))
    two = parts.select(F.col("doc_id").alias("b"), "f", F.col("n").alias("n_b"), F.col("part").alias("part_b"))
    partial = pairs.join(one, "a").join(two, ["b", "f"]).select(
        "a", "b", "n_a", "n_b", F.size(F.array_intersect("part_a", "part_b")).alias("o"))
    total = partial.groupBy("a", "b", "n_a", "n_b").agg(F.sum("o").alias("o"))
    return total.filter(100 * F.col("o") >= percent * (F.col("n_a") + F.col("n_b") - F.col("o"))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): the smallest id reachable over edges (a, b), for every id of an edge.

    Each round, every id takes the smallest label among its neighbours' labels and
    then that label's own label, until no label changes; rounds grow with the
    logarithm of a component's width. Each round is cut in the shared folder.
    """
    both = cut(edges.select(F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))).distinct())
    labels = cut(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("l")).withColumnRenamed("a", "id"))
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "l"), "b").groupBy("a").agg(F.min("l").alias("m"))
        step = labels.join(near.withColumnRenamed("a", "id"), "id").select("id", "l", F.least("l", "m").alias("m"))
        jump = labels.select(F.col("id").alias("m"), F.col("l").alias("far"))
        step = cut(step.join(jump, "m", "left").select("id", F.col("l").alias("old"), F.least("m", F.coalesce("far", "m")).alias("l")))
        labels = step.select("id", "l")
        if step.filter("l < old").isEmpty():
            return labels.withColumnRenamed("l", "comp")


def _labelled(ids: DataFrame, comps: DataFrame) -> DataFrame:
    return ids.join(comps.withColumnRenamed("id", "doc_id"), "doc_id", "left").select("doc_id", F.coalesce("comp", "doc_id").alias("comp"))


def _merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (doc_id, comp) after more links (a, b): rounds run over the components that a link joins, none if none does."""
    for x in ("a", "b"):
        links = links.join(label.select(F.col("doc_id").alias(x), F.col("comp").alias(f"comp_{x}")), x)
    between = cut(links.filter("comp_a <> comp_b").select(F.col("comp_a").alias("a"), F.col("comp_b").alias("b")).distinct())
    if between.isEmpty():
        return label
    more = components(between).select(F.col("id").alias("comp"), F.col("comp").alias("least"))
    return cut(label.join(more, "comp", "left").select("doc_id", F.coalesce("least", "comp").alias("comp")))


def _possible(x, y, percent: int) -> Column:
    """Two sets of n n-grams can reach the threshold if the n-gram they meet at is the first
    that they share. c: n-grams from that one on, of those that aren't the set's own (which
    come first in the order); no more can be common."""
    total = percent * (x["n"] + y["n"])
    return (100 + percent) * F.least(x["c"], y["c"]) >= total


def link(found: DataFrame, percent: int = PERCENT, fragments: int = FRAGMENTS, also: DataFrame | None = None) -> DataFrame:
    """(id, comp) over the documents of ``found`` (doc_id, n, c, prefix, grams) and of the links ``also`` (a, b).

    Components are carried from one step to the next, and what a later step reads again is cut, so the plans that the driver holds stay small."""
    bits = max(1, (fragments - 1).bit_length())
    parts = found.select("doc_id", "n", F.explode(F.sequence(F.lit(0), F.lit((1 << bits) - 1))).alias("f"), "grams").select(
        "doc_id", "n", "f", F.filter("grams", lambda h: F.shiftrightunsigned(h, 64 - bits).cast("int") == F.col("f")).alias("part")
    ).filter(F.size("part") > 0)
    tokens = found.select("doc_id", "n", "c", F.posexplode("prefix").alias("i", "t"))
    tokens = cut(tokens.select("doc_id", "t", F.struct("n", (F.col("c") - F.col("i")).alias("c"), F.col("doc_id").alias("id")).alias("x")))
    # centres of a group: least of its own, smallest id, any
    seeds = [F.min(F.struct(((F.col("x.n") - F.col("x.c")) / F.col("x.n")).alias("k"), "x")), F.min(F.struct(F.col("doc_id").alias("k"), "x")),
             F.min(F.struct(F.xxhash64("doc_id").alias("k"), "x"))]
    centres = tokens.groupBy("t").agg(*[s["x"].alias(f"c{i}") for i, s in enumerate(seeds)], F.count(F.lit(1)).alias("size")).filter("size > 1")
    star = tokens.join(centres.drop("size"), "t").select("doc_id", "x", F.explode(F.array_distinct(F.array("c0", "c1", "c2"))).alias("y")).filter(
        (F.col("y.id") != F.col("doc_id")) & _possible(F.col("x"), F.col("y"), percent))
    star = cut(star.groupBy("doc_id", F.col("y.id").alias("centre")).agg(F.count(F.lit(1)).alias("common")))
    pair = [F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b")]

    best = star.groupBy("doc_id").agg(F.max(F.struct("common", (-F.col("centre")).alias("k"))).alias("m")).select(
        "doc_id", (-F.col("m.k")).alias("centre"))
    tested = cut(best.select(*pair).distinct())
    ids = found.select("doc_id")
    if also is not None:
        ids = ids.union(also.select(F.explode(F.array("a", "b")))).distinct()
    label = cut(_labelled(ids, components(overlaps(tested, parts, percent))))

    rest = star.join(label, "doc_id").join(label.select(F.col("doc_id").alias("centre"), F.col("comp").alias("comp_c")), "centre").filter("comp != comp_c")
    second = cut(rest.select(*pair).distinct().join(tested, ["a", "b"], "left_anti"))
    if not second.isEmpty():
        label = _merged(label, overlaps(second, parts, percent))

    held = tokens.join(label, "doc_id")
    sizes = held.groupBy("t", "comp").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("t").agg(F.max(F.struct("size", "comp"))["comp"].alias("main"), F.count(F.lit(1)).alias("comps")).filter("comps > 1")
    held = cut(held.join(main.select("t", "main"), "t"))
    left = held.filter("comp != main").select("t", "doc_id", "x", F.col("comp").alias("comp_1"))
    right = held.select("t", F.col("x").alias("y"), F.col("comp").alias("comp_2"))
    third = left.join(right, (left["t"] == right["t"]) & (F.col("comp_1") != F.col("comp_2")) & _possible(F.col("x"), F.col("y"), percent))
    third = cut(third.select("doc_id", F.col("y.id").alias("centre")).select(*pair).distinct().join(tested.union(second), ["a", "b"], "left_anti"))
    if not third.isEmpty():
        label = _merged(label, overlaps(third, parts, percent))
    return (label if also is None else _merged(label, also)).withColumnRenamed("doc_id", "id")


def ngram_join(docs: DataFrame, n: int = N, percent: int = PERCENT, group_bytes: int = GROUP_BYTES,
               bucket_values: int = BUCKET_VALUES, fragments: int = FRAGMENTS) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id (smallest doc_id with the same set)."""
    grouped, groups = with_groups(docs.filter("doc_id is not null"), group_bytes)
    buckets = shared.bucket_count(groups, 0.16, bucket_values, group_bytes)
    meta = cut(grouped.select("doc_id", "text").mapInArrow(_signs(n), "doc_id long, n long, sig binary"))
    # an empty set is no class: such documents are their own. Classes have names of their own until the end:
    # one doc_id may be the smallest of several, if its rows have different texts
    classes = cut(meta.filter("n > 0").groupBy("sig").agg(F.min("doc_id").alias("class_id")).withColumn("class", F.monotonically_increasing_id()))
    reps = classes.select(F.col("class_id").alias("doc_id"), group_of("class_id", groups).alias("p"), "sig", "class")
    sent = grouped.groupBy("p").cogroup(reps.groupBy("p")).applyInArrow(_send(n, buckets), shared.SENT)
    reply = shared.answers(sent).unionByName(reps, allowMissingColumns=True)
    found = cut(grouped.groupBy("p").cogroup(reply.groupBy("p")).applyInArrow(_survivors(n, buckets, percent), _SETS_DDL))
    repeated = meta.groupBy("doc_id").agg(F.min("sig").alias("s0"), F.max("sig").alias("s1")).filter("s0 <> s1").select("doc_id")
    several = not repeated.isEmpty()
    also = None
    if several:  # rows of one doc_id are one document: its classes are linked
        own = cut(meta.filter("n > 0").join(repeated, "doc_id", "left_semi").join(classes, "sig").select("doc_id", "class").distinct())
        also = own.join(own.groupBy("doc_id").agg(F.min("class").alias("a")), "doc_id").filter("a <> class").select("a", F.col("class").alias("b"))
    comps = link(found, percent, fragments, also).withColumnRenamed("id", "class")
    named = classes.join(comps, "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    least = named.groupBy("comp").agg(F.min("class_id").alias("component_id"))
    named = named.join(least, "comp").select("sig", "class_id", "component_id")
    out = meta.join(named, "sig", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                                                 F.coalesce("class_id", "doc_id").alias("class_id"))
    if several:  # also its rows without words
        whole = out.groupBy("doc_id").agg(F.min("component_id").alias("_least"))
        out = out.join(whole, "doc_id").withColumn("component_id", F.least("component_id", "_least")).drop("_least")
    return out


def op2(spark, sf_dir: str) -> DataFrame:
    """Contract query: links at 0.8 on 5-word shingles of all documents."""
    return ngram_join(read_table(spark, sf_dir, "documents"))
