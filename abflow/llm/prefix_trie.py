"""Conversation prefix trie (operator 11).

Conversations are paths of turns (role and text) from a textless root; equal
prefixes are one node. Distinct paths, sorted, are dealt by range into shards. A
shard writes its part of the trie as balanced parentheses (one pair a node, in
preorder) and reads everything off that code:

* blocks of the running excess keep their least value, block minima form a
  tree, and ``findclose`` climbs it to the end of each node's subtree;
* rank over ``()`` pairs counts the leaves inside, cumulative arrays over the
  preorder give members and savings, a sparse table the least conversation.

Nodes on the paths of a shard's first and last sequence (its spines) may go on
in other shards; all others are whole and final. Spines carry what hangs off
them in this shard and are sorted, sharded and encoded again, ``fan`` shards'
spines at a time, until one shard is left. Names go back down by equi-joins on
(shard, side, depth).

Texts are never shuffled: a turn travels as 16 bytes of SHA-256 over role and
text and 8 bytes of length (equal digests count as equal turns). A conversation's turns meet in one row, 24 bytes each,
and a shard holds about ``shard_turns`` turns and one path at least. Equal paths are counted
in blocks of conversation ids, so that no task collects a path that a third of all conversations take; the hash of
its members' ids is by definition sequential, and streams over the sorted blocks.

Defined cases: null role or text is empty; turns with one number are ordered by their digest;
repeated rows are turns of their own; a null ``conv_id`` is no conversation;
an empty table has no node; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import read_table

SHARD_TURNS = 200_000
FAN = 64  # 4 at least: each shard passes on two spines
ID_BLOCK_BITS = 12
BLOCK = 64  # parentheses in a block
TURN = 24
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_NO = np.iinfo(np.int64).max


# ---------------------------------------------------------------- balanced parentheses


class Parens:
    """Subtree ends in a balanced-parentheses string (+1 opens, -1 closes)."""

    def __init__(self, step: np.ndarray) -> None:
        self.step, n = step, len(step)
        self.excess = np.cumsum(step, dtype=np.int64)
        self.open_at = np.flatnonzero(step > 0)
        self.rank = np.cumsum(step > 0)  # opens up to and with a place
        leaf = np.zeros(n, bool)
        leaf[:-1] = (step[:-1] > 0) & (step[1:] < 0)
        self.leaf_rank = np.concatenate([[0], np.cumsum(leaf)])
        blocks = max(1, -(-n // BLOCK))
        size = 1 << (blocks - 1).bit_length()
        padded = np.full(size * BLOCK, _NO)
        padded[:n] = self.excess
        tree = [padded.reshape(size, BLOCK).min(axis=1)]
        while len(tree[-1]) > 1:
            tree.append(tree[-1].reshape(-1, 2).min(axis=1))
        self.tree, self.padded = tree, padded

    def _in_block(self, at: np.ndarray, start: np.ndarray, goal: np.ndarray, out: np.ndarray) -> np.ndarray:
        """First place from ``start`` on, in its block, where the excess is down to ``goal``; returns who found none."""
        todo, place = np.arange(len(at)), start.copy()
        left = (start // BLOCK + 1) * BLOCK
        lost = []
        while len(todo):
            over = place >= left[todo]
            lost.append(todo[over])
            todo, place = todo[~over], place[~over]
            hit = self.padded[place] <= goal[todo]
            out[at[todo[hit]]] = place[hit]
            todo, place = todo[~hit], place[~hit] + 1
        return np.concatenate(lost) if lost else todo

    def findclose(self) -> np.ndarray:
        """The closing place of every opening one, in preorder."""
        out = np.zeros(len(self.open_at), np.int64)
        goal = self.excess[self.open_at] - 1
        who = self._in_block(np.arange(len(out)), self.open_at + 1, goal, out)
        node, level = self.open_at[who] // BLOCK, np.zeros(len(who), np.int64)
        found, pending = np.zeros(len(who), bool), np.arange(len(who))
        for h in range(len(self.tree)):  # up: the first right sibling whose least excess is low enough
            odd = (node[pending] & 1) == 1
            sibling = np.minimum(node[pending] + 1, len(self.tree[h]) - 1)
            ok = ~odd & (sibling > node[pending]) & (self.tree[h][sibling] <= goal[who[pending]])
            node[pending[ok]], level[pending[ok]], found[pending[ok]] = sibling[ok], h, True
            pending = pending[~ok]
            node[pending] >>= 1
        for h in range(len(self.tree) - 1, 0, -1):  # down: the left child if it is low enough
            x = np.flatnonzero(found & (level == h))
            left = node[x] * 2
            node[x] = np.where(self.tree[h - 1][left] <= goal[who[x]], left, left + 1)
            level[x] = h - 1
        missing = self._in_block(who, node * BLOCK, goal[who], out)
        assert found.all() and not len(missing), "unbalanced parentheses"
        return out

    def leaves(self, close: np.ndarray) -> np.ndarray:
        """Childless nodes in each subtree."""
        return self.leaf_rank[close] - self.leaf_rank[self.open_at]


def range_min(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Least of values[lo:hi] (never empty), by a sparse table."""
    table, width = [values], 1
    while 2 * width <= len(values):
        table.append(np.minimum(table[-1][:-width], table[-1][width:]))
        width *= 2
    k = np.frexp((hi - lo).astype(np.float64))[1] - 1
    out = np.empty(len(lo), values.dtype)
    for j in np.unique(k):
        x = k == j
        out[x] = np.minimum(table[j][lo[x]], table[j][hi[x] - (1 << j)])
    return out


# ---------------------------------------------------------------- a shard

# what a path's node holds besides its own subtree in the shard: members, least member, children, leaves, savings
_SUMS = ("convs", "kids", "leaves", "saved")
PATHS = "key array<binary>, convs array<long>, low array<long>, kids array<long>, leaves array<long>, saved array<long>, ends array<binary>, shard int, side int"
NODES = ("kind int, shard int, side int, at int, depth long, low long, parent long, p_shard int, p_side int, n_convs long, n_children long, n_leaves long, "
         "saved long, ends binary, key array<binary>, convs array<long>, lows array<long>, kids array<long>, leaves array<long>, saveds array<long>, all_ends array<binary>")
_NODES = pa.schema([("kind", pa.int32()), ("shard", pa.int32()), ("side", pa.int32()), ("at", pa.int32())]
                   + [(c, pa.int64()) for c in ("depth", "low", "parent")] + [("p_shard", pa.int32()), ("p_side", pa.int32())]
                   + [(c, pa.int64()) for c in ("n_convs", "n_children", "n_leaves", "saved")] + [("ends", pa.binary()), ("key", pa.list_(pa.binary()))]
                   + [(c, pa.list_(pa.int64())) for c in ("convs", "lows", "kids", "leaves", "saveds")] + [("all_ends", pa.list_(pa.binary()))])
NODE, SPINE, NAME = 0, 1, 2


def _rows(n: int, **cols: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in _NODES], schema=_NODES)


def _common(keys: list[list[bytes]]) -> list[int]:
    """Turns that each path shares with the one before it."""
    out = [-1]
    for a, b in zip(keys, keys[1:]):
        m = min(len(a), len(b))
        n = 0
        while n < m and a[n] == b[n]:
            n += 1
        out.append(n)
    return out


def encode(keys: list[list[bytes]], held: dict[str, list], shard: int, last_round: bool, refs: list[tuple[int, int]] | None) -> Iterator[pa.RecordBatch]:
    """Final nodes, spines and, for the paths of the round before, the names of their nodes.

    ``keys``: distinct paths in order. ``held``: by path, what its nodes hold (``_SUMS``, ``low``, ``ends``), by depth."""
    common, size = _common(keys), [len(k) for k in keys]
    new = np.array(size) - np.array(common)
    n = int(new.sum())
    # preorder: each path opens the nodes below what it shares with the path before it
    depth = np.arange(n) - np.repeat(np.cumsum(new) - new, new) + np.repeat(np.array(common), new) + 1
    closes = np.array([0] + [a - c for a, c in zip(size, common[1:])] + [size[-1] + 1])
    step = np.repeat(np.tile(np.array([-1, 1], np.int8), len(keys) + 1)[:-1], np.stack([closes, np.append(new, 0)], 1).ravel()[:-1])
    own = {c: np.zeros(n, np.int64) for c in _SUMS}
    low, parent, width, ends = np.full(n, _NO), np.full(n, -1), np.zeros(n, np.int64), [None] * n
    trail: list[int] = []  # nodes of the path at hand, by depth
    trails = []
    at = 0
    for i, key in enumerate(keys):
        c = common[i]
        del trail[c + 1:]
        for d in range(c + 1, size[i] + 1):
            if d:
                parent[at], width[at] = trail[d - 1], int.from_bytes(key[d - 1][16:], "big")
            trail.append(at)
            at += 1
        for name in _SUMS:
            np.add.at(own[name], trail, held[name][i])
        np.minimum.at(low, trail, held["low"][i])
        for d, x in enumerate(held["ends"][i]):
            if x is not None:
                ends[trail[d]] = x
        if i in (0, len(keys) - 1) or refs is not None:
            trails.append(list(trail))

    p = Parens(step)
    close = p.findclose()
    lo, hi = np.arange(n), p.rank[close]  # subtree in preorder
    spine = np.zeros(n, bool)
    if not last_round:
        spine[trails[0]] = spine[trails[-1]] = True
    total = lambda v: (s := np.concatenate([[0], np.cumsum(v)]))[hi] - s[lo]
    convs = total(own["convs"])
    least = range_min(low, lo, hi)
    kids = own["kids"] + np.bincount(parent[parent >= 0], minlength=n)
    leaf_here = p.leaves(close)
    hanging = (step[p.open_at + 1] < 0) & (own["kids"] > 0)  # a leaf here, but not in the trie
    leaves = leaf_here + total(own["leaves"] - hanging)
    saved = total(np.where(spine, 0, (convs - 1) * width) + own["saved"])
    names = np.where(spine, _NO, least)

    side_of = np.full(n, -1)
    if not last_round:
        side_of[trails[-1]] = 1
        side_of[trails[0]] = 0
    x = np.flatnonzero(~spine)
    up = parent[x]
    inner = (up >= 0) & ~spine[up]
    on = (up >= 0) & spine[up]
    mask = lambda v, keep: pa.array(v, mask=~keep)
    yield _rows(len(x), kind=np.full(len(x), NODE), depth=depth[x], low=least[x], parent=mask(least[up], inner), p_shard=mask(np.full(len(x), shard, np.int32), on),
                p_side=mask(side_of[up].astype(np.int32), on), n_convs=convs[x], n_children=kids[x], n_leaves=leaves[x], saved=saved[x], ends=[ends[i] for i in x.tolist()])
    if refs is not None:
        for (r_shard, r_side), t in zip(refs, trails, strict=True):
            t = np.array(t)
            here = ~spine[t]
            m = len(t)
            yield _rows(m, kind=np.full(m, NAME), shard=np.full(m, r_shard), side=np.full(m, r_side), at=np.arange(m), low=mask(names[t], here),
                        p_shard=mask(np.full(m, shard, np.int32), ~here), p_side=mask(side_of[t].astype(np.int32), ~here))
    if last_round:
        return
    # spines take over what hangs off them here: whole subtrees whose top has its parent on a spine
    got = {c: own[c].copy() for c in _SUMS}
    got_low = low.copy()
    top = x[on]
    for c, v in (("convs", convs), ("leaves", leaves), ("saved", saved), ("kids", np.ones(n, np.int64))):
        np.add.at(got[c], parent[top], v[top])
    np.minimum.at(got_low, parent[top], least[top])
    for side, t in ((0, trails[0]), (1, trails[-1])) if len(keys) > 1 else ((0, trails[0]),):
        t = np.array(t)
        mine = side_of[t] == side
        zero = lambda v, t=t, mine=mine: [np.where(mine, v[t], 0)]
        yield _rows(1, kind=[SPINE], shard=[shard], side=[side], key=[keys[0] if side == 0 else keys[-1]], convs=zero(got["convs"]), kids=zero(got["kids"]),
                    leaves=zero(got["leaves"]), saveds=zero(got["saved"]), lows=[np.where(mine, got_low[t], _NO)],
                    all_ends=[[ends[i] if m else None for i, m in zip(t.tolist(), mine.tolist(), strict=True)]])


def _shard_of() -> int:
    from pyspark import TaskContext

    return TaskContext.get().partitionId()


def first_round(last_round: bool):
    """Distinct paths (key, n, low, ends) of a sorted shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, low, ends = [], [], [], []
        for b in batches:
            for c, v in zip((keys, n, low, ends), b.columns, strict=True):
                c += v.to_pylist()
        if keys:
            zero = [[0] * (len(k) + 1) for k in keys]
            end = lambda fill, v: [[fill] * len(k) + [x] for k, x in zip(keys, v, strict=True)]
            yield from encode(keys, {"convs": end(0, n), "low": end(_NO, low), "ends": end(None, ends), "kids": zero, "leaves": zero, "saved": zero}, _shard_of(), last_round, None)
    return run


def next_round(last_round: bool):
    """Spines of the round before, sorted."""
    names = ("key", "convs", "low", "kids", "leaves", "saved", "ends", "shard", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: dict[str, list] = {c: [] for c in names}
        for b in batches:
            for c, v in zip(names, b.columns, strict=True):
                cols[c] += v.to_pylist()
        if cols["key"]:
            refs = list(zip(cols.pop("shard"), cols.pop("side"), strict=True))
            yield from encode(cols.pop("key"), cols, _shard_of(), last_round, refs)
    return run


# ---------------------------------------------------------------- conversations


def _turn() -> Column:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    return F.unhex(F.concat(digest, F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0")))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, key): the contract's conversations, the first turns taken from the first of each five."""
    c = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", _turn().alias("d"))
    c = c.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).repartition("base")
    own = c.groupBy("base", "conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "d"))), lambda t: t["d"]).alias("own"))
    from_base = F.max(F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, 8))).over(Window.partitionBy("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    none = F.array().cast("array<binary>")
    rest = F.when(F.size("own") > h, F.slice("own", h + 1, F.size("own"))).otherwise(none)
    return own.withColumn("from_base", F.coalesce(from_base, none)).select("conv_id", F.concat(F.slice("from_base", F.lit(1), h), rest).alias("key"))


def plain(conversations: DataFrame) -> DataFrame:
    """(conv_id, key): conversations as they are."""
    c = conversations.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", _turn().alias("d"))
    return c.groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "d"))), lambda t: t["d"]).alias("key"))


def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (path, key, ids) sorted by path and block: one row per path (key, n, low, hash of the ids)."""
    now, key, n, low, sha = None, None, 0, 0, None
    for b in batches:
        out = []
        for path, k, ids in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if path != now:
                if now is not None:
                    out.append((key, n, low, sha.digest()))
                now, key, n, low, sha = path, k, 0, ids[0], hashlib.sha256()
            sha.update((("," if n else "") + ",".join(map(str, ids))).encode())
            n += len(ids)
        if out:
            yield _paths(out)
    if now is not None:
        yield _paths([(key, n, low, sha.digest())])


def _paths(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.list_(pa.binary()), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["key", "n", "low", "ends"])


def trie(convs: DataFrame, shard_turns: int = SHARD_TURNS, fan: int = FAN) -> DataFrame:
    """Nodes of the trie of (conv_id, key) rows, a row each; columns ``RESULT``."""
    spark = convs.sparkSession
    path = F.md5(F.array_join(F.transform("key", lambda t: F.hex(t)), ""))
    blocks = convs.groupBy(path.alias("path"), F.shiftright("conv_id", ID_BLOCK_BITS).alias("block")).agg(
        F.first("key").alias("key"), F.sort_array(F.collect_list("conv_id")).alias("ids"))
    distinct = blocks.repartition("path").sortWithinPartitions("path", "block").select("path", "key", "ids").mapInArrow(
        members, "key array<binary>, n long, low long, ends binary")
    fan = max(fan, 4)
    base = scratch_path(spark, "prefix-trie")
    distinct.write.parquet(f"{base}/paths")
    paths = spark.read.parquet(f"{base}/paths")
    turns = paths.agg(F.sum(F.size("key") + 1)).first()[0] or 0
    shards, k, tables = max(1, -(-turns // shard_turns)), 0, []
    work = paths
    while True:
        last = shards == 1
        step = (next_round if k else first_round)(last)
        dealt = (work.coalesce(1) if last else work.repartitionByRange(shards, "key")).sortWithinPartitions("key")
        dealt.mapInArrow(step, NODES).write.parquet(f"{base}/{k}")
        tables.append(spark.read.parquet(f"{base}/{k}"))
        if last:
            break
        work = tables[-1].filter(f"kind = {SPINE}").select("key", "convs", F.col("lows").alias("low"), "kids", "leaves", F.col("saveds").alias("saved"), F.col("all_ends").alias("ends"), "shard", "side")
        shards, k = 1 if 2 * shards <= fan else -(-2 * shards // fan), k + 1
    # names of spine nodes, from the last round down
    names = None
    nodes = []
    for t in reversed(tables):
        found = t.filter(f"kind = {NODE}").select("depth", "low", "parent", "p_shard", "p_side", "n_convs", "n_children", "n_leaves", "saved", "ends")
        if names is not None:
            found = _named(found, names, F.col("depth") - 1, "parent")
        nodes.append(found.drop("p_shard", "p_side"))
        own = t.filter(f"kind = {NAME}").select("shard", "side", F.col("at").alias("depth"), F.col("low").alias("name"), "p_shard", "p_side")
        names = _named(own, names, F.col("depth"), "name").drop("p_shard", "p_side") if names is not None else own.drop("p_shard", "p_side")
    out = nodes[0]
    for x in nodes[1:]:
        out = out.unionByName(x)
    empty = hashlib.sha256().hexdigest()
    return out.select(F.col("low").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      F.col("saved").alias("saved_tokens"), F.coalesce(F.lower(F.hex("ends")), F.lit(empty)).alias("ends_sha256"))


def _named(rows: DataFrame, names: DataFrame, depth: Column, into: str) -> DataFrame:
    """Fill ``into`` of rows that point at a spine node (p_shard, p_side, depth) of their round; at
    most a shard's rows point at one node."""
    n = names.select(F.col("shard").alias("p_shard"), F.col("side").alias("p_side"), F.col("depth").alias("_depth"), F.col("name").alias("_name"))
    return rows.withColumn("_depth", depth.cast("int")).join(n, ["p_shard", "p_side", "_depth"], "left").withColumn(into, F.coalesce(into, "_name")).drop("_depth", "_name")


def op11(spark, sf_dir: str) -> DataFrame:
    """Contract query: the trie of all rebuilt conversations."""
    return trie(rebuilt(read_table(spark, sf_dir, "conversations"))).select(*RESULT)
