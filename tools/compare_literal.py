"""Time one-pass operators against the literal per-date multi-pass form of
the same computation (the shape of the analysed jobs: a driver loop over
days, each day a set of anti joins / intersections / separate aggregates).

    python tools/compare_literal.py [sf_dir]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from abflow.functions.timefn import shift_date  # noqa: E402
from abflow.operators import retention as R  # noqa: E402
from abflow.operators.filters import by_scene  # noqa: E402
from abflow.operators.funnel import funnel_daily  # noqa: E402
from abflow.plans.catalog import gblog, rel_members  # noqa: E402
from abflow.session import local_session  # noqa: E402


def literal_retention(members, days, n, start):
    out = []
    spark = members.sparkSession
    for D in days:
        sd = lambda k: spark.range(1).select(shift_date(F.lit(D), k)).first()[0]
        for g in ("A", "B"):
            mg = members.filter(F.col("grp") == g)
            prev = mg.filter(F.col("dt").between(sd(-(2 * n - 1)), sd(-n))).select("uid").distinct()
            hist = mg.filter((F.col("dt") >= start) & (F.col("dt") < sd(-(2 * n - 1)))).select("uid").distinct()
            cur = mg.filter(F.col("dt").between(sd(-(n - 1)), D)).select("uid").distinct()
            new = prev.join(hist, "uid", "left_anti")
            out.append((D, g, prev.count(), new.count(), cur.intersect(new).count(), cur.intersect(prev).count()))
    return out


def literal_funnel(logs, days):
    out = []
    for D in days:
        for g in ("A", "B"):
            v = logs.filter((F.col("grp") == g) & (F.col("dt") == D))
            out.append((D, g, v.filter(F.col("action_type") == "1").count(),
                        v.filter(F.col("action_type") == "2").count(),
                        v.select("uid").distinct().count(),
                        v.filter(F.col("action_type") == "6").count()))
    return out


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    days = [r.dt for r in gblog(spark, sf).select("dt").distinct().orderBy("dt").collect()]
    res = {}

    m = rel_members(spark, sf)
    R.retention(m, 7, "20240101").collect()  # warm
    t = time.perf_counter(); one = R.retention(m, 7, "20240101").collect(); res["retention_7_one_pass"] = time.perf_counter() - t
    t = time.perf_counter(); lit = literal_retention(m, days, 7, "20240101"); res["retention_7_literal_per_date"] = time.perf_counter() - t
    got = {(r.dt, r.grp): (r.user_active_7, r.user_new_7, r.user_new_7_stay, r.user_active_7_stay) for r in one}
    assert all(got[(D, g)] == tuple(x) for D, g, *x in lit), "one-pass and literal retention differ"

    logs = by_scene(gblog(spark, sf), "S_REL")
    t = time.perf_counter(); funnel_daily(logs).collect(); res["funnel_one_aggregate"] = time.perf_counter() - t
    t = time.perf_counter(); literal_funnel(logs, days); res["funnel_literal_per_date"] = time.perf_counter() - t
    print(json.dumps({k: round(v, 3) for k, v in res.items()} | {"sf": sf, "days": len(days)}))
    spark.stop()


if __name__ == "__main__":
    main()
