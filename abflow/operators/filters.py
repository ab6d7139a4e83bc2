"""Row filters of the behaviour log (all plain Column predicates, so
Catalyst pushes what it can to the scan)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.fields import split_java


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def by_scene(df: DataFrame, scene: str, col: str = "scene_id") -> DataFrame:
    """Rows of one scene; null / empty scene never matches."""
    return df.filter(F.col(col) == scene)


def release_cond(ext, version: str, products=S.NEWS_PRODUCTS) -> Column:
    ext = _c(ext)
    return ext.contains(version) & reduce(or_, [ext.contains(p) for p in products])


def by_release(df: DataFrame, version: str, products=S.NEWS_PRODUCTS, col: str = "ext") -> DataFrame:
    """ext contains the version AND any of the product codes."""
    return df.filter(release_cond(col, version, products))


def action_cond(code: str, match: str = "equals", col: str = "action_type") -> Column:
    """Action predicate.

    ``equals``: text equality; ``numeric``: the text read as an integer
    equals ``code`` (what an implicit string-to-int compare does; text
    that is no number never matches); ``contains``: substring (so "13"
    matches "3").
    """
    c = _c(col)
    if match == "equals":
        return c == code
    if match == "numeric":
        return F.trim(c).try_cast("int") == int(code)
    if match == "contains":
        return c.contains(code)
    raise ValueError(match)


def by_action(df: DataFrame, code: str, match: str = "equals", col: str = "action_type") -> DataFrame:
    return df.filter(action_cond(code, match, col))


def in_slots(df: DataFrame, slots: DataFrame, match: str = "whole", pos: str = "rec_pos",
             keys: tuple[str, ...] = ("dt",)) -> DataFrame:
    """Rows whose slot field is in the slot set ``slots`` (keys + ``rec_posi``).

    ``whole``: the entire slot field equals a member (a play row names one
    slot). ``any``: any entry of the ``;`` list is a member: the distinct list
    texts (few) are matched against the set and the rows joined to those,
    so a row needs no key and is kept once. The set is joined, never collected: AQE broadcasts it when
    its measured size is under the threshold and keeps a shuffle join
    (with skew splitting) otherwise.
    """
    s = slots.select(*keys, F.col("rec_posi").alias("_pos")).distinct()
    if match == "whole":
        return df.join(s, [df[k] == s[k] for k in keys] + [df[pos] == s["_pos"]], "left_semi")
    if match == "any":
        texts = df.select(*keys, pos).distinct()
        hit = (texts.select(*keys, pos, F.explode(split_java(pos, ";")).alias("_pos"))
               .join(s, [*keys, "_pos"], "left_semi").select(*keys, pos).distinct())
        return df.join(hit, [*keys, pos], "left_semi")
    raise ValueError(match)

