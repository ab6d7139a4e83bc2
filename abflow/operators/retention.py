"""New, retained, active and cumulative users, and n-day retention, for
every day of a range in one plan.

The analysed jobs ran, per end date and group, separate scans of the
membership table followed by RDD ``subtract`` / ``intersection`` (about
a dozen shuffles per date). Here membership rows are made distinct
(repeats collapse map-side) and shuffled once by (grp, uid); a window
gives each row its previous active day and the user's first day since
``start``. Every n-day retention measure is a count of users active in
a day window, and a user is counted for end day D by exactly one of its
rows (its first row inside the window), so each row adds +1 to a
contiguous range of D. Ranges become two delta events, deltas are summed
per (grp, day) with map-side partial aggregation, and a running sum
over days (a few hundred rows per group) yields the counts for all D at
once. Work is O(rows) whatever n is; no per-date loop, no row explosion
by window length, no join. Explicit end days prune the member days
read; a first-seen table (one row per user) replaces the history scan
for daily incremental runs.

Windows for end day D and length n (inclusive, in days):
    current  C = [D-n+1, D]      previous P = [D-2n+1, D-n]
    union    U = [D-2n+1, D]     history  H = [start, D-2n]
    user_active_n       = |P|
    user_active_n_stay  = |P and C| = |P| + |C| - |U|
    user_new_n          = |P minus H|
    user_new_n_stay     = |(P minus H) and C|
A user is in H exactly when their first day since ``start`` is <= D-2n,
so the H-restricted counts are the same ranges with a raised lower end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.groups import total_key
from ..functions.timefn import day_from_number, day_number, shift_date


def _lit_day(day: str) -> Column:
    return day_number(F.lit(day))


def _prepared(members: DataFrame, start: str, first_seen: DataFrame | None = None) -> DataFrame:
    """(grp, uid, day number) with ``prev`` (previous active day) and ``f``
    (first active day >= start): one shuffle on (grp, uid) and a window sort."""
    # distinct first: repeats collapse map-side (a no-op the optimizer removes
    # when the members are already distinct), so no task gets a hot uid's repeats
    m = (members.select("grp", "uid", "dt")
         .filter(F.col("grp").isNotNull() & F.col("uid").isNotNull())
         .dropDuplicates(["grp", "uid", "dt"])
         .withColumn("d", day_number("dt"))
         .filter(F.col("d").isNotNull()))
    w = Window.partitionBy("grp", "uid").orderBy("d")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = _lit_day(start)
    m = m.withColumn("prev", F.lag("d").over(w))
    if first_seen is None:
        return m.withColumn("f", F.min(F.when(F.col("d") >= s, F.col("d"))).over(whole))
    # history from the compact first-seen table: joined on (grp, uid), the
    # key the window already clusters by
    fs = first_seen.select("grp", "uid", day_number("first_dt").alias("f"))
    return m.join(fs, ["grp", "uid"], "left")


def _prune(members: DataFrame, start: str, d1: str | None, d2: str | None, n: int) -> DataFrame:
    """Keep only member days that can matter for end days [d1, d2]: up to d2,
    and from min(start, d1 - 2n + 1). An earlier row lies before every
    window and before ``start``, so it changes no count; on a table
    partitioned by dt these are partition filters."""
    if d2:
        members = members.filter(F.col("dt") <= d2)
    if d1:
        from datetime import date, timedelta
        lo = (date(int(d1[:4]), int(d1[4:6]), int(d1[6:])) - timedelta(days=2 * n - 1)).strftime("%Y%m%d")
        members = members.filter(F.col("dt") >= min(start, lo))
    return members


def retention(members: DataFrame, n, start: str, d1: str | None = None,
              d2: str | None = None, first_seen: DataFrame | None = None) -> DataFrame:
    """n-day retention for every end day D of [d1, d2] (default: each
    group's first to last member day). ``n`` may be a tuple (e.g. (7, 30)):
    all lengths come out of the same single pass.

    Output: grp, dt (= D), and per n: user_new_{n}, user_new_{n}_stay,
    user_active_{n}, user_active_{n}_stay (bigint).

    ``first_seen`` (grp, uid, first_dt since ``start``, see :func:`first_seen`)
    replaces the history scan: with it and d1 given, only member days in
    [d1-2n+1, d2] are read, whatever the length of the history.
    """
    ns = [n] if isinstance(n, int) else list(n)
    if first_seen is not None and d1:
        pruned = _prune(members, "99991231", d1, d2, max(ns))   # no need to keep days from start
    else:
        pruned = _prune(members, start, d1, d2, max(ns))
    m = _prepared(pruned, start, first_seen)
    d, prev, f = F.col("d"), F.col("prev"), F.col("f")

    def ev(cid, day, v, ok=F.lit(True)):
        return F.when(ok, F.struct(F.lit(cid).alias("c"), day.alias("D"), F.lit(v).alias("v")))

    kinds = ["C", "P", "U", "CH", "PH", "UH"]
    names, events = [], []
    for x in ns:
        # (offset, length, history-restricted) of C, P, U and their H-restricted twins
        for kind, (o, length, hist) in zip(kinds, [(0, x, False), (x, x, False), (0, 2 * x, False),
                                                  (0, x, True), (x, x, True), (0, 2 * x, True)]):
            lo = F.greatest(d + o, prev + (o + length), *([f + 2 * x] if hist else []))
            hi = d + (o + length - 1)
            ok = (lo <= hi) & f.isNotNull() if hist else lo <= hi
            cid = len(names)
            names.append(f"{kind}_{x}")
            events += [ev(cid, lo, 1, ok), ev(cid, hi + 1, -1, ok)]
    mark = len(names)
    events.append(ev(mark, d, 0))                       # marks a member day (default bounds)
    for b in (d1, d2):
        if b:
            events.append(ev(mark + 1, _lit_day(b), 0))  # makes an explicit bound a delta day
    deltas = (m.select("grp", F.explode(F.array_compact(F.array(*events))).alias("e"))
              .select("grp", "e.*"))
    # map-side partial aggregation: a handful of rows per (grp, day) leave each task
    per_day = deltas.groupBy("grp", "D").agg(
        *[F.sum(F.when(F.col("c") == i, F.col("v")).otherwise(0)).alias(nm) for i, nm in enumerate(names)],
        F.max(F.col("c") == mark).alias("member_day"))
    # one row per (group, delta day): running sums hold until the next delta day
    w = Window.partitionBy("grp").orderBy("D")
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lo = _lit_day(d1) if d1 else F.min(F.when(F.col("member_day"), F.col("D"))).over(whole)
    hi = _lit_day(d2) if d2 else F.max(F.when(F.col("member_day"), F.col("D"))).over(whole)
    cum = per_day.select("grp", "D", *[F.sum(nm).over(run).alias(nm) for nm in names],
                         F.lead("D").over(w).alias("_next"), lo.alias("_lo"), hi.alias("_hi"))
    days = F.sequence(F.col("D"), F.coalesce(F.col("_next") - 1, F.col("D")))
    keep = (cum.select("*", F.explode(days).alias("_day"))
            .filter(F.col("_day").between(F.col("_lo"), F.col("_hi"))))
    out = ["grp", day_from_number("_day").alias("dt")]
    for x in ns:
        c = {k: F.col(f"{k}_{x}") for k in kinds}
        stay = c["P"] + c["C"] - c["U"]
        stay_h = c["PH"] + c["CH"] - c["UH"]
        out += [(c["P"] - c["PH"]).cast("bigint").alias(f"user_new_{x}"),
                (stay - stay_h).cast("bigint").alias(f"user_new_{x}_stay"),
                c["P"].cast("bigint").alias(f"user_active_{x}"),
                stay.cast("bigint").alias(f"user_active_{x}_stay")]
    return keep.select(*out)


def first_seen(members: DataFrame, start: str) -> DataFrame:
    """(grp, uid, first_dt): each user's first member day since ``start``; one
    row per user and group, reduced map-side."""
    return (members.filter(F.col("dt") >= start).groupBy("grp", "uid")
            .agg(F.min("dt").alias("first_dt")))


def advance_first_seen(current: DataFrame, new_members: DataFrame, start: str) -> DataFrame:
    """Daily upkeep of the first-seen table: keep the earlier first day per user."""
    new = first_seen(new_members, start)
    return (current.select("grp", "uid", "first_dt").unionByName(new)
            .groupBy("grp", "uid").agg(F.min("first_dt").alias("first_dt")))


def retention_rate(ret: DataFrame, n: int) -> DataFrame:
    """Share of the previous window's new users active again in the current one."""
    return ret.withColumn(f"stay_rate_{n}",
                          F.try_divide(F.col(f"user_new_{n}_stay"), F.col(f"user_new_{n}")))


def user_stats_daily(members: DataFrame, start: str, end: str | None = None,
                     first_seen: DataFrame | None = None, begin: str | None = None) -> DataFrame:
    """Per group and day D >= start: ``user_new`` (today's member rows whose
    uid had no day in [start, D-1]; repeats of a row count, as a
    subtract does), ``user_remain`` (distinct uids of today also seen in
    [start, D-1]) and ``user_active`` (today's member rows).

    With ``first_seen`` (see :func:`first_seen`) only days [begin, end] are
    read and the history comes from the table.
    """
    m = members.select("grp", "uid", "dt").filter(F.col("dt") >= (begin if first_seen is not None and begin
                                                                  else start))
    if end is not None:
        m = m.filter(F.col("dt") <= end)
    # repeats of a (grp, uid, day) row collapse map-side before any shuffle,
    # so a uid with very many rows never lands whole in one task; the window
    # then sees at most one row per user and day
    m = m.groupBy("grp", "uid", "dt").agg(F.count(F.lit(1)).alias("c"))
    if first_seen is None:
        w = Window.partitionBy("grp", "uid").orderBy("dt")
        m = m.withColumn("seen", F.lag("dt").over(w).isNotNull())
    else:
        fs = first_seen.select("grp", "uid", "first_dt")
        m = (m.join(fs, ["grp", "uid"], "left")
             .withColumn("seen", F.coalesce(F.col("first_dt") < F.col("dt"), F.lit(False))))
    return m.groupBy("grp", "dt").agg(
        F.sum(F.when(~F.col("seen"), F.col("c")).otherwise(0)).cast("bigint").alias("user_new"),
        F.count_if(F.col("seen")).cast("bigint").alias("user_remain"),
        F.sum("c").cast("bigint").alias("user_active"))


def new_users(members: DataFrame, start: str, end: str | None = None) -> DataFrame:
    return user_stats_daily(members, start, end).select("grp", "dt", "user_new")


def cumulative_users(members: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Running total of new users since ``start`` per group and day, plus the
    (``date`` = ``a20190413``, ``user_num`` text) shape of the totals table."""
    st = user_stats_daily(members, start, end)
    run = Window.partitionBy("grp").orderBy("dt").rowsBetween(Window.unboundedPreceding, 0)
    return (st.select("grp", "dt", "user_new", F.sum("user_new").over(run).cast("bigint").alias("total_users"))
            .withColumn("date", total_key("grp", "dt"))
            .withColumn("user_num", F.col("total_users").cast("string")))


def advance_totals(totals: DataFrame, new_counts: DataFrame) -> DataFrame:
    """Incremental form: today's total = today's new users + yesterday's
    stored total (``date`` key ``a<yyyyMMdd>``). A missing yesterday gives
    a null total instead of failing."""
    prev = totals.select(F.col("date").alias("_pdate"),
                         F.col("user_num").try_cast("bigint").alias("_ptotal"))
    nc = new_counts.withColumn("_pdate", total_key("grp", shift_date("dt", -1)))
    out = nc.join(prev, "_pdate", "left")
    return out.select(total_key("grp", "dt").alias("date"),
                      (F.col("user_new") + F.col("_ptotal")).cast("string").alias("user_num"))


def user_metrics(stats: DataFrame, totals: DataFrame) -> DataFrame:
    """Per group and day: new, retained, active and cumulative users, where the
    total is yesterday's stored one plus today's new. ``state`` is ``missing``
    where yesterday's total isn't stored (the total is null then), else ``ok``."""
    now = advance_totals(totals, stats.select("grp", "dt", "user_new"))
    out = stats.withColumn("date", total_key("grp", "dt")).join(now, "date", "left")
    return out.select("date", "grp", "dt", "user_new", "user_remain", "user_active",
                      F.col("user_num").try_cast("bigint").alias("total_users"), "user_num",
                      F.when(F.col("user_num").isNull(), "missing").otherwise("ok").alias("state"))
