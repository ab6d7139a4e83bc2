"""A/B membership: both groups and all days in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.groups import ab_group
from .filters import by_release, by_scene


def with_group(df: DataFrame, uid: str = "uid", a: str = "A", b: str = "B") -> DataFrame:
    """Add ``grp`` (A/B bucket of the uid); rows without a bucket drop."""
    return df.withColumn("grp", ab_group(uid, a, b)).filter(F.col("grp").isNotNull())


def distinct_members(df: DataFrame) -> DataFrame:
    """Distinct (grp, dt, uid); partial aggregation removes repeats map-side."""
    return df.select("grp", "dt", "uid").dropDuplicates(["grp", "dt", "uid"])


def members_daily(logs: DataFrame, scene: str = S.SCENE_RELATED, version: str | None = None,
                  products=S.NEWS_PRODUCTS, a: str = "A", b: str = "B",
                  day_col: str = "dt") -> DataFrame:
    """Distinct uids per group and day of a scene (optionally of a release).

    Output (grp, dt, uid) is what :func:`abflow.sinks.files.write_members`
    stores partitioned by (grp, dt); the retention operators read it.
    """
    df = by_scene(logs, scene)
    if version is not None:
        df = by_release(df, version, products)
    df = df.filter(F.col("uid").isNotNull() & (F.length("uid") > 0))
    df = df.select(F.col(day_col).alias("dt"), "uid").withColumn("grp", ab_group("uid", a, b))
    return distinct_members(df)
