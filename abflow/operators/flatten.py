"""Recursive JSON flatten into one key -> text map per message, then the
fixed 45-column event projection.

Per row and built only from variant and higher-order array expressions
(no Python UDF, no explode, no shuffle, no row id), so it runs in a
narrow stage of a batch or a streaming plan and scales with the input.

Semantics (any depth, defined winner):
* scalar value -> ``key -> text``; numbers in Spark's canonical spelling
  (``1.50`` -> ``1.5``, ``1e5`` -> ``100000.0``, and an integer of more than 38 digits
  as a double, which loses digits: send such ids as JSON strings);
  JSON null -> key absent;
* object value -> its keys are flattened into the same (unprefixed) map;
  with ``unwrap_same_key`` an object holding an object under its own
  name flattens only that inner object;
* array whose elements are all objects -> each element flattened; any
  other array -> ``key -> array JSON text``; empty array / object adds
  nothing;
* all levels are flattened, however many there are (an explicit ``depth`` keeps
  deeper objects as text);
* a key repeated in one object: its last value counts, also in nested objects;
* a key seen more than once: the shallowest level wins, then the
  greatest array index, then the smallest path;
* text that is not JSON, or whose root is not an object -> null map
  (a reject).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.timefn import epoch_to_hour
from ..session import ensure_checkpoint_dir

_MAP_T = "map<string,variant>"
_ARR_T = "array<variant>"


def _obj(v: Column) -> Column:
    return F.try_variant_get(v, "$", _MAP_T)


# entry kinds
_SCALAR, _OBJECT, _OBJ_ARRAY, _OTHER_ARRAY, _NULL = 0, 1, 2, 3, 4


def _kind(v: Column) -> Column:
    a = F.try_variant_get(v, "$", _ARR_T)
    return (F.when(_obj(v).isNotNull(), _OBJECT)
            .when(a.isNotNull(), F.when(F.forall(a, lambda x: _obj(x).isNotNull()), _OBJ_ARRAY)
                  .otherwise(_OTHER_ARRAY))
            .when(F.is_variant_null(v), _NULL)
            .otherwise(_SCALAR))


def _entry(k: Column, v: Column, d: Column, i: Column, p: Column) -> Column:
    """One map entry; its kind is worked out once, the value stays a variant."""
    return F.struct(k.alias("k"), v.alias("v"), d.alias("d"), i.alias("i"), p.alias("p"),
                    _kind(v).alias("t"))


def _children(e: Column, level: int, unwrap_same_key: bool) -> Column:
    """Entries of an object value, one level deeper."""
    m = _obj(e["v"])
    if unwrap_same_key:
        inner = _obj(F.try_element_at(m, e["k"]))
        m = F.when(inner.isNotNull(), inner).otherwise(m)
    return F.transform(F.map_entries(m), lambda c: _entry(
        c["key"], c["value"], F.lit(level + 1), e["i"], F.concat(e["p"], F.lit("."), c["key"])))


def _element_children(e: Column, level: int) -> Column:
    """Entries of every object of an all-object array, one level deeper."""
    def per_element(x, j):
        return F.transform(F.map_entries(_obj(x)), lambda c: _entry(
            c["key"], c["value"], F.lit(level + 1), j,
            F.concat(e["p"], F.lit("["), j.cast("string"), F.lit("]."), c["key"])))
    return F.flatten(F.transform(F.try_variant_get(e["v"], "$", _ARR_T), per_element))


def allow_repeated_keys(df: DataFrame) -> None:
    """Session setting that this module's parsing relies on: without it a message
    with a key twice in one nested object is not JSON to Spark."""
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


# levels in one plan; deeper messages alone are cut in the shared folder and go on from there
STEP = 6


def flatten_json(df: DataFrame, col: str = "value", depth: int | None = None, out: str = "fields",
                 unwrap_same_key: bool = False) -> DataFrame:
    """Add ``out``: map<string,string> of the flattened message (null = reject).

    Without ``depth`` levels are added until no object is left, which needs a
    batch frame; a stream flattens within ``foreachBatch``."""
    allow_repeated_keys(df)
    if depth:
        return _flat(df, col, depth, True, unwrap_same_key, out)
    deep = df.withColumn("_depth", level_bound(col))
    most = deep.agg(F.max("_depth")).first()[0] or 1   # an action: one pass over the text
    return flatten_bounded(deep if most > STEP else df.withColumn("_depth", F.lit(0)), "_depth", most, col, out, unwrap_same_key)


def flatten_bounded(df: DataFrame, bound: str, most: int, col: str = "value", out: str = "fields", unwrap_same_key: bool = False) -> DataFrame:
    """:func:`flatten_json` of rows whose :func:`level_bound` is the column ``bound`` (dropped) and ``most`` at most."""
    allow_repeated_keys(df)
    if most <= STEP:
        return _flat(df.drop(bound), col, most, False, unwrap_same_key, out)
    shallow = _flat(df.filter(F.coalesce(bound, F.lit(0)) <= STEP).drop(bound), col, STEP, False, unwrap_same_key, out)
    return shallow.unionByName(_flat(df.filter(F.col(bound) > STEP).drop(bound), col, most, False, unwrap_same_key, out))


def _flat(df: DataFrame, col: str, most: int, cut: bool, unwrap_same_key: bool, out: str) -> DataFrame:
    cur, outs = _levels(df, col, most, cut, unwrap_same_key)
    return _winners(cur, outs, [c for c in cur.columns if c not in df.columns], out)


# a JSON string in either kind of quotes (Spark reads both)
_QUOTED = r"""(?s)"(?:[^"\\]++|\\.)*+"|'(?:[^'\\]++|\\.)*+'"""


def nesting(col: str) -> Column:
    """Levels of objects in a message, null for a reject: the highest running count of open braces outside of strings."""
    text = F.col(col)
    bare = F.regexp_replace(F.regexp_replace(text, _QUOTED, ""), r"[^{}]+", "")
    step = lambda at, c: F.struct((at["now"] + F.when(c == "{", 1).otherwise(-1)).alias("now"),
                                  F.greatest(at["most"], at["now"] + F.when(c == "{", 1).otherwise(-1)).alias("most"))
    most = F.aggregate(F.split(bare, ""), F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step, lambda at: at["most"])
    return F.when(F.from_json(text, _MAP_T).isNotNull(), most)


def level_bound(col: str) -> Column:
    """No fewer than the levels of objects in a message, null for a reject: its open braces if they
    are ``STEP`` or fewer (a count of bytes), else the levels themselves."""
    braces = F.octet_length(col) - F.octet_length(F.replace(F.col(col), F.lit("{"), F.lit("")))
    return F.when(braces > STEP, nesting(col)).when(F.from_json(col, _MAP_T).isNotNull(), braces)


def _levels(df: DataFrame, col: str, most: int, depth: bool, unwrap_same_key: bool) -> tuple[DataFrame, list[Column]]:
    """Columns ``_lvl1``.. with each level's entries, and the candidates that each level gives;
    ``depth``: what nests deeper than ``most`` stays text."""
    lvl, outs, level = "_lvl", [], 1
    cur = df.withColumn("_root", F.from_json(F.col(col), _MAP_T))
    cur = cur.withColumn("_ok", F.col("_root").isNotNull()).withColumn(lvl + "1", F.transform(
        F.map_entries("_root"), lambda c: _entry(c["key"], c["value"], F.lit(1), F.lit(0), c["key"])))
    cur = cur.drop("_root")
    while True:
        E = F.col(f"{lvl}{level}")
        last = level == most

        def emit(e):
            # scalars, arrays not made only of objects, and (at a given depth) any nesting
            if last and depth:
                return e["t"] != _NULL
            return (e["t"] == _SCALAR) | (e["t"] == _OTHER_ARRAY)

        # the value stays a variant until the winner is known
        outs.append(F.transform(F.filter(E, emit), lambda e: F.struct(
            e["k"].alias("k"), e["d"].alias("d"), e["i"].alias("i"), e["p"].alias("p"),
            e["t"].alias("t"), e["v"].alias("v"))))
        if last:
            return cur, outs
        objs = F.flatten(F.transform(F.filter(E, lambda e: e["t"] == _OBJECT),
                                     lambda e: _children(e, level, unwrap_same_key)))
        arrs = F.flatten(F.transform(F.filter(E, lambda e: e["t"] == _OBJ_ARRAY),
                                     lambda e: _element_children(e, level)))
        level += 1
        cur = cur.withColumn(f"{lvl}{level}", F.concat(objs, arrs))
        if level % STEP == 0 and not depth and level < most:
            done = cur.withColumn("_done", F.concat(*outs)).select(*df.columns, "_ok", "_done", f"{lvl}{level}")
            ensure_checkpoint_dir(df.sparkSession)
            cur, outs = done.checkpoint(eager=True), [F.col("_done")]
            if cur.filter(F.size(f"{lvl}{level}") > 0).isEmpty():
                return cur, outs


def _winners(cur: DataFrame, outs: list[Column], added: list[str], out: str) -> DataFrame:
    """One value per key out of all candidates."""
    cur = cur.withColumn("_cand", F.concat(*outs))
    # natural struct order = key, depth, -array index, path, later of a repeated key; nj points back to the candidate
    order = F.array_sort(F.transform("_cand", lambda e, j: F.struct(
        e["k"].alias("k"), e["d"].alias("d"), (-e["i"]).alias("ni"), e["p"].alias("p"), (-j).alias("nj"))))
    cur = cur.withColumn("_all", order)
    firsts = F.filter(F.col("_all"), lambda e, i: (i == 0) | (F.element_at(F.col("_all"), i)["k"] != e["k"]))
    cur = cur.withColumn("_win", F.transform(firsts, lambda e: F.element_at(F.col("_cand"), 1 - e["nj"])))
    text = F.transform("_win", lambda e: F.when(e["t"] == _SCALAR, F.variant_get(e["v"], "$", "string"))
                       .otherwise(F.to_json(e["v"])))
    m = F.map_from_arrays(F.transform("_win", lambda e: e["k"]), text)
    drop = [*added, "_cand", "_all", "_win"]
    return cur.withColumn(out, F.when(F.col("_ok"), m)).drop(*drop)


def ingest_hour(tz: str = S.DEFAULT_TZ) -> Column:
    """Arrival hour ``yyyyMMddHH`` in ``tz`` (zone of the session irrelevant)."""
    return epoch_to_hour(F.unix_timestamp().cast("string"), tz)


def project_event(df: DataFrame, fields: str = "fields", tz: str = S.DEFAULT_TZ,
                  names: list[str] = S.EVENT_FIELDS, arrival: Column | None = None) -> DataFrame:
    """The fixed event columns: missing key -> '', unknown keys dropped;
    ``curr_time`` = a ``curr_time`` key if present, else ``arrival`` (default: the hour now)."""
    hour = ingest_hour(tz) if arrival is None else arrival
    m = F.col(fields)
    cols = []
    for k in names:
        v = F.try_element_at(m, F.lit(k))
        if k == S.INGEST_PARTITION:
            cols.append(F.coalesce(v, hour).alias(k))
        else:
            cols.append(F.coalesce(v, F.lit("")).alias(k))
    return df.select(*cols)

