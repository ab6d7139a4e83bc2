"""User activity bitmaps: daily, retained, new and cumulative users, and
n-day retention, without the member history.

The table holds one row per (grp, uid): ``bits``, an array of words with a
bit per day since ``base`` (``WORD_DAYS`` days a word, so a word never uses
the sign bit). It is brought up to date with one member day at a time.
Every measure of an end day is then a bit operation on one row: a
window of up to ``WORD_DAYS`` days is cut out of at most two words, and
asked whether it is zero. No window sort, no row per (user, day), no
self-join: a report reads one row per user, however long the history is,
and sends per (group, day) partial sums.

Defined cases: rows with a null group, uid or unreadable day are left out;
repeated rows count once; a day before ``base`` fails (the table
couldn't hold it); a user without a day since ``start`` is never new.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import day_from_number, day_number

WORD_DAYS = 62
KEYS = ["grp", "uid"]


def _day(day: str) -> Column:
    return day_number(F.lit(day))


def _words(members: DataFrame, base: str) -> DataFrame:
    """(grp, uid, i, w): word ``i`` of each user; repeats collapse in the partial aggregate."""
    off = day_number("dt") - _day(base)
    m = members.filter("grp is not null and uid is not null").select("grp", "uid", "dt", off.alias("off")).filter("off is not null")
    off = F.when(F.col("off") >= 0, F.col("off")).otherwise(F.raise_error(F.concat(F.lit("member day before the bitmap's base: "), "dt")).cast("int"))
    m = m.select(*KEYS, off.alias("off"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("off") % WORD_DAYS)
    return m.groupBy(*KEYS, F.floor(F.col("off") / WORD_DAYS).cast("int").alias("i")).agg(F.bit_or(bit).alias("w"))


def _rows(words: DataFrame) -> DataFrame:
    m = words.groupBy(*KEYS).agg(F.map_from_entries(F.collect_list(F.struct("i", "w"))).alias("m"))
    last = F.array_max(F.map_keys("m"))
    return m.select(*KEYS, F.transform(F.sequence(F.lit(0), last), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("bigint"))).alias("bits"))


def bitmaps(members: DataFrame, base: str) -> DataFrame:
    """(grp, uid, bits) of member rows (grp, uid, dt)."""
    return _rows(_words(members, base))


def advance(current: DataFrame, members: DataFrame, base: str) -> DataFrame:
    """The table with the days of ``members`` added (usually one). Adding a day again changes
    nothing. One equi-join on (grp, uid), a row a user on either side."""
    new = bitmaps(members, base).withColumnRenamed("bits", "_new")
    zero = F.lit(0).cast("bigint")
    old, add = (F.coalesce(F.col(c), F.array().cast("array<bigint>")) for c in ("bits", "_new"))
    both = F.zip_with(old, add, lambda a, b: F.coalesce(a, zero).bitwiseOR(F.coalesce(b, zero)))
    return current.select(*KEYS, "bits").join(new, KEYS, "full").select(*KEYS, both.alias("bits"))


def _word(i: Column) -> Column:
    return F.when((i >= 0) & (i < F.size("bits")), F.get("bits", i)).otherwise(F.lit(0).cast("bigint"))


def window_bits(lo: Column, length: int) -> Column:
    """Bits of the days [lo, lo + length) (day offsets), as one number; days before the base have none."""
    if not 0 < length <= WORD_DAYS:
        raise ValueError(f"a window has 1 to {WORD_DAYS} days")
    i = F.floor(lo / WORD_DAYS).cast("int")
    k = lo - i * WORD_DAYS
    low = F.call_function("shiftright", _word(i), k)
    high = F.call_function("shiftleft", _word(i + 1), F.lit(WORD_DAYS) - k)
    return low.bitwiseOR(high).bitwiseAND(F.lit((1 << length) - 1).cast("bigint"))


def first_day(start: Column) -> Column:
    """Offset of the first active day from offset ``start`` on, null without one."""
    s = F.greatest(start, F.lit(0))

    def at(w: Column, i: Column) -> Column:
        skip = F.least(F.greatest(s - i * WORD_DAYS, F.lit(0)), F.lit(WORD_DAYS))
        rest = F.call_function("shiftleft", F.call_function("shiftright", w, skip), skip)
        rest = F.when(skip < WORD_DAYS, rest).otherwise(F.lit(0).cast("bigint"))
        return F.when(rest != 0, i * WORD_DAYS + F.bit_count((rest - 1).bitwiseAND(F.bitwise_not(rest))))
    return F.array_min(F.transform("bits", at))


def last_day() -> Column:
    """Offset of the last active day, null without one."""
    def at(w: Column, i: Column) -> Column:
        return F.when(w != 0, i * WORD_DAYS + F.length(F.bin(w)) - 1)
    return F.array_max(F.transform("bits", at))


def active_days(lo: Column, length: int) -> Column:
    """Number of active days in a window."""
    return F.bit_count(window_bits(lo, length))


def _end_days(table: DataFrame, base: str, d1: str | None, d2: str | None) -> DataFrame:
    """``table`` with one row per user and end day ``D`` (an offset): [d1, d2], by default from
    each group's first to its last day (a row per group, joined on grp)."""
    lo, hi = (_day(d) - _day(base) if d else None for d in (d1, d2))
    if lo is None or hi is None:
        bounds = table.groupBy("grp").agg(F.min(first_day(F.lit(0))).alias("_lo"), F.max(last_day()).alias("_hi"))
        table = table.join(bounds, "grp")
        lo, hi = F.col("_lo") if lo is None else lo, F.col("_hi") if hi is None else hi
    return table.withColumn("D", F.explode(F.when(lo <= hi, F.sequence(lo, hi)))).drop("_lo", "_hi")


def retention(table: DataFrame, n, base: str, start: str, d1: str | None = None, d2: str | None = None) -> DataFrame:
    """The measures of :func:`abflow.operators.retention.retention` from the bitmaps: per group
    and end day, for each window length, active and new users of the previous window and those back in the current one."""
    ns = [n] if isinstance(n, int) else list(n)
    t = table.withColumn("f", first_day(_day(start) - _day(base)))
    t = _end_days(t, base, d1, d2)
    aggs = []
    for x in ns:
        prev = window_bits(F.col("D") - (2 * x - 1), x) != 0
        back = prev & (window_bits(F.col("D") - (x - 1), x) != 0)
        fresh = ~F.coalesce(F.col("f") <= F.col("D") - 2 * x, F.lit(False))
        for name, cond in (("user_new_{n}", prev & fresh), ("user_new_{n}_stay", back & fresh), ("user_active_{n}", prev), ("user_active_{n}_stay", back)):
            aggs.append(F.count_if(cond).cast("bigint").alias(name.format(n=x)))
    return t.groupBy("grp", "D").agg(*aggs).withColumn("dt", day_from_number(F.col("D") + _day(base))).drop("D")


def user_stats(table: DataFrame, base: str, start: str, d1: str | None = None, d2: str | None = None) -> DataFrame:
    """Per group and day since ``start`` with an active user: new, retained and active users, and
    all users so far."""
    s = _day(start) - _day(base)
    t = _end_days(table.withColumn("f", first_day(s)), base, d1, d2)
    on = window_bits(F.col("D"), 1) != 0
    seen = F.col("f") < F.col("D")
    out = t.filter(F.col("D") >= s).groupBy("grp", "D").agg(
        F.count_if(on & ~seen).cast("bigint").alias("user_new"), F.count_if(on & seen).cast("bigint").alias("user_remain"),
        F.count_if(on).cast("bigint").alias("user_active"), F.count_if(F.col("f") <= F.col("D")).cast("bigint").alias("total_users"))
    return out.filter("user_active > 0").withColumn("dt", day_from_number(F.col("D") + _day(base))).drop("D")
