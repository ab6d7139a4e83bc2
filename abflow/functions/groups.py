"""A/B bucket of a uid.

The bucket is the UTF-16 code unit of the uid's last character, mod 10:
0-4 -> A, 5-9 -> B. For a character outside the BMP the last code unit
is the low surrogate, so it is derived from the code point. An empty or
null uid has no bucket.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def last_code_unit(uid) -> Column:
    uid = F.col(uid) if isinstance(uid, str) else uid
    cp = F.ascii(F.substring(uid, -1, 1))
    return F.when(cp >= 0x10000, F.lit(0xDC00) + (cp - 0x10000) % 1024).otherwise(cp)


def ab_group(uid, a: str = "A", b: str = "B") -> Column:
    """'A' / 'B' (or the given labels) for a uid column; null for ''/null."""
    uid = F.col(uid) if isinstance(uid, str) else uid
    unit = last_code_unit(uid)
    return (F.when(uid.isNull() | (F.length(uid) == 0), F.lit(None).cast("string"))
            .when(unit % 10 < 5, F.lit(a))
            .otherwise(F.lit(b)))


def label(grp, dt, sep: str = "-") -> Column:
    """Partition label ``<group>-<yyyyMMdd>`` as the analysed tables use."""
    grp = F.col(grp) if isinstance(grp, str) else grp
    dt = F.col(dt) if isinstance(dt, str) else dt
    return F.concat_ws(sep, grp, dt)


def total_key(grp, dt) -> Column:
    """Key of a cumulative-total row: lower-case group letter + day (``a20190413``)."""
    grp = F.col(grp) if isinstance(grp, str) else grp
    dt = F.col(dt) if isinstance(dt, str) else dt
    return F.concat(F.lower(F.substring(grp, -1, 1)), dt)
