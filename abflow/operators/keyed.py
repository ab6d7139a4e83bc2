"""Keyed snapshot upsert, the offset ledger and the distinct-value join.

``upsert_by_key`` keeps, per key, the row with the greatest ordering
(later load, then later position within a load). It is an aggregate
(``max_by``) rather than a ranked window, so a hot key is reduced
map-side before the shuffle instead of sorted whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def load_order(df: DataFrame, load: int, position_cols: list[str] | None = None) -> DataFrame:
    """Tag rows of one load with ``_load`` and a within-load position.

    ``position_cols`` names columns that order rows inside the load; for
    text files use (file path, block start, row id) = line order.
    """
    if position_cols is None:
        pos = F.struct(F.col("_metadata.file_path").alias("f"),
                       F.col("_metadata.file_block_start").alias("b"),
                       F.monotonically_increasing_id().alias("r"))
    else:
        pos = F.struct(*[F.col(c) for c in position_cols])
    return df.withColumn("_load", F.lit(load)).withColumn("_pos", pos)


def upsert_by_key(current: DataFrame, incoming: DataFrame, key: str | list[str],
                  order_by: list | None = None) -> DataFrame:
    """Current snapshot updated by an incoming load: per key the later
    write wins. Order: ``order_by`` columns if given, else incoming over
    current; ties broken by the position within the load (``_pos`` when
    present)."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in current.columns if c not in ("_load", "_pos")]
    cur = current if "_load" in current.columns else current.withColumn("_load", F.lit(0))
    inc = incoming if "_load" in incoming.columns else incoming.withColumn("_load", F.lit(1))
    both = cur.unionByName(inc, allowMissingColumns=True)
    parts = [F.col(c) if isinstance(c, str) else c for c in (order_by or [])] + [F.col("_load")]
    if "_pos" in both.columns:
        parts.append(F.col("_pos"))
    order = F.struct(*[p.alias(f"_o{i}") for i, p in enumerate(parts)])
    payload = F.struct(*[F.col(c) for c in cols if c not in keys])
    agg = both.groupBy(*keys).agg(F.max_by(payload, order).alias("_row"))
    return agg.select(*keys, "_row.*").select(*cols)


def offset_ledger(df: DataFrame, topic: str = "topic", partition: str = "partition",
                  offset: str = "offset") -> DataFrame:
    """Per topic: ``partition|untilOffset`` pairs joined by ',' (partition
    order), untilOffset = last consumed offset + 1."""
    per = df.groupBy(topic, partition).agg((F.max(offset) + 1).alias("_until"))
    pair = F.struct(F.col(partition).alias("p"), F.col("_until").alias("u"))
    led = per.groupBy(topic).agg(F.array_sort(F.collect_list(pair)).alias("_ps"))
    text = F.array_join(F.transform("_ps", lambda x: F.concat(x["p"].cast("string"), F.lit("|"),
                                                              x["u"].cast("string"))), ",")
    return led.select(F.col(topic).alias("topic"), text.alias("ledger"))


def ledger_to_offsets(ledger: DataFrame) -> DataFrame:
    """Inverse: (topic, ledger) -> (topic, partition int, offset bigint)."""
    e = ledger.select("topic", F.explode(F.split("ledger", ",")).alias("_e"))
    return e.select("topic", F.split("_e", r"\|").getItem(0).cast("int").alias("partition"),
                    F.split("_e", r"\|").getItem(1).cast("bigint").alias("offset"))


def starting_offsets_json(offsets: DataFrame) -> str:
    """``startingOffsets`` option text for a Kafka source. Reads one row per
    (topic, partition): bounded by the topic layout, not by the data."""
    import json
    res: dict = {}
    for r in offsets.collect():
        res.setdefault(r["topic"], {})[str(r["partition"])] = int(r["offset"])
    return json.dumps(res, sort_keys=True)


def offset_ranges(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Per (topic, partition) and ``by`` (e.g. the batch): first offset, ``until`` (last + 1) and the
    number of distinct offsets. Repeats collapse map-side."""
    keys = [*(by or []), "topic", "partition"]
    return df.select(*keys, "offset").dropDuplicates([*keys, "offset"]).groupBy(*keys).agg(
        F.min("offset").alias("first"), (F.max("offset") + 1).alias("until"), F.count(F.lit(1)).alias("n"))


def offset_audit(ranges: DataFrame, start: DataFrame | None = None) -> DataFrame:
    """What consecutive ranges of a (topic, partition) leave out or hold twice.

    One row per finding: ``gap`` (offsets [low, high) in no range), ``overlap`` (in a range and an earlier
    one), ``hole`` (a range of fewer offsets than it spans, ``n`` of them missing). Ranges are
    ordered by first offset and compared with the furthest end so far. ``start`` (topic, partition, offset): where
    reading should have begun. One window over the ranges of a (topic, partition): rows per batch, not per message."""
    keys = ["topic", "partition"]
    r = ranges.select(*keys, "first", "until", "n")
    if start is not None:
        r = r.unionByName(start.select(*keys, F.col("offset").alias("first"), F.col("offset").alias("until"), F.lit(0).cast("bigint").alias("n")))
    w = Window.partitionBy(*keys).orderBy("first", "until").rowsBetween(Window.unboundedPreceding, -1)
    far = F.max("until").over(w)
    r = r.withColumn("_far", far)

    def row(kind, low, high, n, when):
        return F.when(when, F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"), n.cast("bigint").alias("n")))

    first, until, at = F.col("first"), F.col("until"), F.col("_far")
    end = F.least(until, at)
    found = F.array_compact(F.array(row("gap", at, first, first - at, first > at), row("overlap", first, end, end - first, (first < at) & (until > first)),
                                    row("hole", first, until, until - first - F.col("n"), F.col("n") < until - first)))
    return r.select(*keys, F.explode(found).alias("f")).select(*keys, "f.*")


def join_distinct(df: DataFrame, key: str | list[str], value: str, sep: str = "||",
                  out: str = "joined") -> DataFrame:
    """Distinct values per key joined by ``sep`` (sorted; the analysed
    accumulator's order was arbitrary). Repeats are removed map-side."""
    keys = [key] if isinstance(key, str) else list(key)
    return (df.select(*keys, F.col(value).cast("string").alias("_v")).dropDuplicates([*keys, "_v"])
            .groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_list("_v")), sep).alias(out)))
