"""Time conversions (Column -> Column), independent of the session zone.

Every conversion goes through TIMESTAMP_NTZ wall-clock values and
``convert_timezone`` with an explicit zone, so the result never depends
on ``spark.sql.session.timeZone``. Bad input gives null where the
analysed jobs would have failed (counted as a reject by callers).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DAY_FMT, DEFAULT_TZ, HOUR_FMT, UNKNOWN_TIME

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# seconds of the years 1 to 9999, less a day for zones
_FIRST_SEC, _LAST_SEC = -62135510400, 253402214400


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _missing(text: Column) -> Column:
    return text.isNull() | (text == "") | (text == "null")


def epoch_ntz(seconds: Column, tz: str = DEFAULT_TZ) -> Column:
    """Epoch seconds (bigint) -> wall-clock TIMESTAMP_NTZ in ``tz``."""
    known = F.when(seconds.between(_FIRST_SEC, _LAST_SEC), seconds)   # out of range: null, not a failed job
    utc = F.timestamp_add("SECOND", known, F.expr(_EPOCH_NTZ))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def _epoch_text_to(col, fmt: str, tz: str) -> Column:
    text = _c(col).cast("string")
    secs = F.trim(text).try_cast("bigint")
    return (F.when(_missing(text), F.lit(UNKNOWN_TIME))
            .otherwise(F.date_format(epoch_ntz(secs, tz), fmt)))


def epoch_to_date(col, tz: str = DEFAULT_TZ) -> Column:
    """Epoch seconds text -> ``yyyyMMdd`` in ``tz``; null/""/"null" -> 未知."""
    return _epoch_text_to(col, DAY_FMT, tz)


def epoch_to_hour(col, tz: str = DEFAULT_TZ) -> Column:
    """Epoch seconds text -> ``yyyyMMddHH`` in ``tz``; null/""/"null" -> 未知."""
    return _epoch_text_to(col, HOUR_FMT, tz)


def compact_to_epoch_ms(col, tz: str = DEFAULT_TZ, unit: str = "ms") -> Column:
    """``yyyyMMddHHmmssSSS`` wall time in ``tz`` -> epoch milliseconds text.

    Spark's pattern parser rejects the 17-digit form as one piece, so the
    wall clock is built from its digit groups and the last 3 digits are
    added as milliseconds. Impossible dates (20190231...) give null.
    ``unit='s'`` gives seconds.
    """
    text = _c(col).cast("string")
    ok = text.rlike(r"^[0-9]{17}$")

    def part(a, n):
        return F.substring(text, a, n).cast("int")

    # wall clock built from its digits: no parser, no session zone involved
    wall = F.try_make_timestamp_ntz(part(1, 4), part(5, 2), part(7, 2),
                                    part(9, 2), part(11, 2), part(13, 2))
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), wall)
    secs = F.timestamp_diff("SECOND", F.expr(_EPOCH_NTZ), utc)
    ms = secs * 1000 + F.substring(text, 15, 3).cast("bigint")
    val = ms if unit == "ms" else secs
    return (F.when(_missing(text), F.lit(UNKNOWN_TIME))
            .when(ok & wall.isNotNull(), val.cast("string")))


def time_to_timestamp(col, tz: str = DEFAULT_TZ, unit: str = "ms") -> Column:
    """Same conversion as :func:`compact_to_epoch_ms` (the analysed code
    returns milliseconds although it speaks of seconds); ``unit='s'``."""
    return compact_to_epoch_ms(col, tz, unit)


def day_to_date(col) -> Column:
    """``yyyyMMdd`` text -> DATE (null when not a real day)."""
    return F.try_to_date(_c(col), DAY_FMT)


def date_to_day(col) -> Column:
    return F.date_format(_c(col), DAY_FMT)


def shift_date(col, n) -> Column:
    """``yyyyMMdd`` + n days (n may be a Column)."""
    n = n if isinstance(n, Column) else F.lit(int(n))
    return date_to_day(F.date_add(day_to_date(col), n))


def day_number(col) -> Column:
    """``yyyyMMdd`` -> days since 1970-01-01 (int), for range arithmetic."""
    return F.datediff(day_to_date(col), F.lit("1970-01-01").cast("date"))


def day_from_number(col) -> Column:
    return date_to_day(F.date_add(F.lit("1970-01-01").cast("date"), _c(col).cast("int")))


def window_bounds(col, n: int) -> Column:
    """D, n -> struct(cur_start = D-n+1, prev_start = D-2n+1, prev_end = D-n)."""
    return F.struct(shift_date(col, -(n - 1)).alias("cur_start"),
                    shift_date(col, -(2 * n - 1)).alias("prev_start"),
                    shift_date(col, -n).alias("prev_end"))


def last_two_weeks(col) -> Column:
    """Window bounds with n = 7."""
    return window_bounds(col, 7)


def date_range_days(start: str, end: str) -> Column:
    """Array of ``yyyyMMdd`` days from start to end inclusive (a Column)."""
    seq = F.sequence(day_to_date(F.lit(start)), day_to_date(F.lit(end)), F.expr("INTERVAL 1 DAY"))
    return F.transform(seq, lambda d: F.date_format(d, DAY_FMT))
