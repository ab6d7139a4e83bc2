"""Best-fit packing with a swap-based local search (operator 8).

Documents are encoded and ended by id 0; only those longer than a sequence are
cut. Pieces are dealt by hash into groups of bounded size; a group is packed by
best fit in order of falling length and then improved: documents are moved,
exchanged one for one or two for one between underfull sequences, always
raising the sum of squared fills, until the emptiest is empty, nothing rises any more
or no sequence can be saved (the ids fill the sequences that there are). What
is left loose, the emptiest sequences of each group, is dealt and packed
again over fewer groups, until one group is left.

Defined cases: null or empty text is one piece with the end id alone; rows
with a null ``doc_id`` are packed like others; repeated rows are packed each;
ties go by ``doc_id``, piece and checksum; no rows give no pieces; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, read_table, release
from .tokens import column_texts, encoder, forget, public_path

LENGTH = 2048
TOKENIZER = "word_bpe_49k.json"
END_ID = 0
GROUP_PIECES = 40_000
_PIECES = pa.schema([("doc_id", pa.int64()), ("copy", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
_PIECES_DDL = "doc_id long, copy long, piece int, start long, length long, ids_crc32 long"
_PLACED = pa.schema([*_PIECES, ("g", pa.int32()), ("bin", pa.int32()), ("fill", pa.int64()), ("offset", pa.int64())])
_PLACED_DDL = _PIECES_DDL + ", g int, bin int, fill long, offset long"


def pieces(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Pieces of each document: number, first id, ids, checksum. ``copy`` tells rows with one ``doc_id`` apart."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                    F.monotonically_increasing_id().alias("copy"))

    def run(batches):
        enc = encoder(public_path(tokenizer))
        end = np.array([END_ID], enc.dtype)
        for batch in batches:
            names, copies, rows = batch.column("doc_id").to_pylist(), batch.column("copy").to_pylist(), []
            for first, texts in column_texts(batch.column("text")):
                for k, got in enumerate(enc.encode(texts), first):
                    ids = np.concatenate([got, end]).astype("<u4")
                    for n, a in enumerate(range(0, len(ids), length)):
                        part = ids[a:a + length]
                        rows.append((names[k], copies[k], n, a, len(part), zlib.crc32(part.tobytes())))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_PIECES)], schema=_PIECES)
        release()

    return d.mapInArrow(run, _PIECES_DDL)


# ---------------------------------------------------------------- one group


def best_fit(sizes: list[int], cap: int) -> list[list[int]]:
    """Items in falling size, each into the fullest bin that holds it."""
    bins: list[list[int]] = []
    open_: list[tuple[int, int]] = []  # (room, bin), ascending
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        s = sizes[i]
        at = bisect_left(open_, (s, -1))
        if at < len(open_):
            room, b = open_.pop(at)
            bins[b].append(i)
        else:
            room, b = cap, len(bins)
            bins.append([i])
        if room > s:
            insort(open_, (room - s, b))
    return bins


def _choices(items: list[int], sizes: list[int]):
    """What can leave a bin and what can come back from it: items and their size. The latter
    in rising size, for one item that leaves (none, one or two come back) and for two (one)."""
    one = [((i,), sizes[i]) for i in items]
    two = [((i, j), sizes[i] + sizes[j]) for n, i in enumerate(items) for j in items[:n]]
    back = []
    for choice in ([((), 0), *one, *two], one):
        choice = sorted(choice, key=lambda x: x[1])
        back.append(([r for _, r in choice], choice))
    return one + two, back


def _shift(outs, backs, room: int, least: int):
    """Items to leave a and to come back from b: the largest net size in [least, room], or None.

    Moves (one, none), exchanges (one for one) and two for one, both ways.
    """
    best, found = least - 1, None
    for out, s in outs:
        if s <= best:
            continue
        sizes, choice = backs[len(out) - 1]
        at = bisect_left(sizes, s - room)  # the smallest that leaves no more than the room
        if at < len(sizes) and s - sizes[at] > best:
            best, found = s - sizes[at], (out, choice[at][0])
            if best == room:
                break
    return found


def improve(bins: list[list[int]], sizes: list[int], cap: int) -> list[list[int]]:
    """Local search on the underfull bins; the sum of squared fills rises with each step."""
    total = sum(sizes[i] for b in bins for i in b)
    fill = [sum(sizes[i] for i in b) for b in bins]
    full = [b for b, f in zip(bins, fill, strict=True) if f == cap]
    loose = [list(b) for b, f in zip(bins, fill, strict=True) if f < cap]
    least = -(-total // cap) - len(full)  # no fewer loose bins can hold the rest
    stuck: set[int] = set()
    level = [sum(sizes[i] for i in b) for b in loose]
    known: dict[int, tuple] = {}  # choices of bins that have not changed since
    while sum(1 for b in loose if b) > least:
        order = sorted((k for k, b in enumerate(loose) if b and k not in stuck), key=lambda k: level[k])
        if not order:
            break
        a, moved = order[0], False
        # the fullest first: small gaps take the documents that fit them best
        for b in sorted((k for k, x in enumerate(loose) if x and k != a and level[k] < cap), key=lambda k: -level[k]):
            # the squares rise by 2 d (fill_b - fill_a + d): d over the difference, down to the room that b has
            for k in (a, b):
                if k not in known:
                    known[k] = _choices(loose[k], sizes)
            got = _shift(known[a][0], known[b][1], cap - level[b], max(1, level[a] - level[b] + 1))
            if got:
                del known[a], known[b]
                out, back = got
                loose[a] = [i for i in loose[a] if i not in out] + list(back)
                loose[b] = [i for i in loose[b] if i not in back] + list(out)
                d = sum(sizes[i] for i in out) - sum(sizes[i] for i in back)
                level[a] -= d
                level[b] += d
                moved = True
                stuck.discard(b)
                if not loose[a]:
                    break
        if not moved:
            stuck.add(a)
    return full + [b for b in loose if b]


def _pack(cap: int):
    def run(t: pa.Table) -> pa.Table:
        forget()
        t = t.sort_by([("length", "descending"), ("doc_id", "ascending"), ("copy", "ascending"), ("piece", "ascending")])
        sizes = t.column("length").to_pylist()
        packed = improve(best_fit(sizes, cap), sizes, cap)
        order = [i for b in packed for i in b]
        number = [k for k, b in enumerate(packed) for _ in b]
        fill, offset = [], []
        for b in packed:
            n = 0
            for i in b:
                offset.append(n)
                n += sizes[i]
            fill += [n] * len(b)
        t = t.take(pa.array(order, pa.int64()))
        cols = [t.column(f.name) if f.name in t.column_names else None for f in _PLACED]
        cols[-3:] = [pa.array(number, pa.int32()), pa.array(fill, pa.int64()), pa.array(offset, pa.int64())]
        return pa.Table.from_arrays(cols, schema=_PLACED)
    return run


def pack(items: DataFrame, length: int = LENGTH, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``."""
    rest, done, stage, n = cut(items), None, 0, None
    cols = [f.name for f in _PIECES]
    while True:
        count = rest.count()
        groups = max(1, -(-count // group_pieces))
        if n is not None and groups >= n:  # nothing left that a smaller deal would gather
            groups = n
        placed = cut(rest.select(*cols).withColumn("g", F.pmod(F.xxhash64("doc_id", "copy", "piece", F.lit(stage)), F.lit(groups)).cast("int"))
                     .groupBy("g").applyInArrow(_pack(length), _PLACED_DDL))
        last = groups == 1 or groups == n
        loose = F.lit(False) if last else F.col("fill") < length - length // 64
        key = (F.lit(stage).cast("long") * (1 << 58) + F.col("g").cast("long") * (1 << 31) + F.col("bin")).alias("sequence_id")
        out = placed.filter(~loose).select(*cols, key, "offset")
        done = out if done is None else done.union(out)
        if last:
            return done
        rest, n, stage = placed.filter(loose), groups, stage + 1


def op8(spark, sf_dir: str) -> DataFrame:
    """Contract query: all documents in sequences of 2048 ids."""
    return pack(pieces(read_table(spark, sf_dir, "documents"), TOKENIZER)).drop("copy")
