"""Independent DuckDB SQL for every registered query (the correctness
oracle). Written from the semantics, not from the Spark code: literal
anti-joins, intersections, EXISTS and per-date cross-checks where the
Spark plans use one-pass aggregates and range arithmetic."""

from __future__ import annotations

# The behaviour-log view of ``events`` (FIXTURES.md §3), plus the A/B bucket.
BLOG = """
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
blog AS (
  SELECT event_id,
         CAST(user_id AS VARCHAR) || '_' || CAST(event_id % 37 AS VARCHAR) AS uid,
         CASE event_id % 3 WHEN 0 THEN 'S_NEWS' WHEN 1 THEN 'S_REL' ELSE 'S_OTHER' END AS scene_id,
         CASE event_type WHEN 'view' THEN '1' WHEN 'click' THEN '2' WHEN 'signup' THEN '3'
                         WHEN 'purchase' THEN '6' ELSE '9' END AS action_type,
         CAST(floor(epoch(ts)) AS BIGINT) AS action_sec,
         strftime(ts, '%Y%m%d') AS dt,
         CAST(floor(value) AS BIGINT) AS watch_s,
         CAST(k AS BIGINT) AS dur_s,
         CAST(k % 10 + 1 AS VARCHAR) || ';' || CAST((k + 3) % 10 + 1 AS VARCHAR) AS rec_pos,
         CAST(k % 2 + 1 AS VARCHAR) || ';' || CAST((k // 10) % 2 + 1 AS VARCHAR) AS rec_type,
         user_id, event_type, ts, value, k
  FROM ev),
gblog AS (
  SELECT *, CASE WHEN ascii(right(uid, 1)) % 10 < 5 THEN 'A' ELSE 'B' END AS grp FROM blog)
"""


def with_blog(body: str, extra_ctes: str = "") -> str:
    ctes = BLOG.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"


ORACLE: dict[str, str] = {}

ORACLE["funnel_daily_ab"] = with_blog("""
SELECT grp, dt,
       CAST(count_if(action_type = '1') AS BIGINT) AS exposures,
       CAST(count_if(action_type = '2') AS BIGINT) AS clicks,
       CAST(count(DISTINCT uid) AS BIGINT) AS users,
       CAST(count_if(action_type = '6') AS BIGINT) AS orders
FROM gblog WHERE scene_id = 'S_REL' GROUP BY grp, dt
""")

ORACLE["scene_filter"] = with_blog("""
SELECT dt, action_type, count(*) AS n FROM blog WHERE scene_id = 'S_NEWS' GROUP BY dt, action_type
""")

ORACLE["ab_group"] = with_blog("""
SELECT grp, count(*) AS n_rows, count(DISTINCT uid) AS n_uids FROM gblog GROUP BY grp
""")

# members of the related scene: distinct (grp, dt, uid)
MEMBERS = "m AS (SELECT DISTINCT grp, dt, uid FROM gblog WHERE scene_id = 'S_REL')"

ORACLE["members_daily"] = with_blog("SELECT grp, dt, uid FROM m", MEMBERS)

ORACLE["member_range"] = with_blog("""
SELECT grp || '-' || dt AS time, count(*) AS n FROM m
WHERE grp || '-' || dt >= 'B-20240105' AND grp || '-' || dt <= 'B-20240112'
GROUP BY 1
""", MEMBERS)

ORACLE["players_ab"] = with_blog("""
SELECT grp, dt, count(DISTINCT uid) AS players FROM gblog
WHERE scene_id = 'S_REL' AND action_type = '3' GROUP BY grp, dt
""")

ORACLE["play_contains"] = with_blog("""
SELECT grp, dt, CAST(count_if(contains(action_type, '3')) AS BIGINT) AS plays FROM gblog
WHERE scene_id = 'S_REL' GROUP BY grp, dt
""")

# literal form: today's rows minus the history [start, yesterday] (anti join)
_HIST = """
SELECT t.grp, t.dt, t.uid,
       EXISTS (SELECT 1 FROM m h WHERE h.grp = t.grp AND h.uid = t.uid
               AND h.dt >= '20240101' AND h.dt < t.dt) AS seen
FROM m t WHERE t.dt >= '20240101'
"""

ORACLE["new_users_daily"] = with_blog(f"""
SELECT grp, dt, CAST(count_if(NOT seen) AS BIGINT) AS user_new FROM ({_HIST}) GROUP BY grp, dt
""", MEMBERS)

ORACLE["user_stats_daily"] = with_blog(f"""
SELECT grp, dt, CAST(count_if(NOT seen) AS BIGINT) AS user_new,
       CAST(count_if(seen) AS BIGINT) AS user_remain, CAST(count(*) AS BIGINT) AS user_active
FROM ({_HIST}) GROUP BY grp, dt
""", MEMBERS)


def _retention_sql(n: int, rate: bool = False) -> str:
    ctes = MEMBERS + f""",
md AS (SELECT grp, uid, CAST(strptime(dt, '%Y%m%d') AS DATE) AS d FROM m),
gd AS (SELECT grp, min(d) AS lo, max(d) AS hi FROM md GROUP BY grp),
days AS (SELECT grp, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS D FROM gd),
prevu AS (SELECT DISTINCT days.grp, days.D, md.uid FROM days JOIN md ON md.grp = days.grp
          AND md.d BETWEEN days.D - {2 * n - 1} AND days.D - {n}),
curu AS (SELECT DISTINCT days.grp, days.D, md.uid FROM days JOIN md ON md.grp = days.grp
          AND md.d BETWEEN days.D - {n - 1} AND days.D),
histu AS (SELECT DISTINCT days.grp, days.D, md.uid FROM days JOIN md ON md.grp = days.grp
          AND md.d >= DATE '2024-01-01' AND md.d <= days.D - {2 * n}),
agg AS (
  SELECT p.grp, p.D,
         count(*) AS a, count(*) FILTER (WHERE h.uid IS NULL) AS nw,
         count(*) FILTER (WHERE c.uid IS NOT NULL) AS a_s,
         count(*) FILTER (WHERE h.uid IS NULL AND c.uid IS NOT NULL) AS n_s
  FROM prevu p LEFT JOIN histu h ON h.grp = p.grp AND h.D = p.D AND h.uid = p.uid
               LEFT JOIN curu c ON c.grp = p.grp AND c.D = p.D AND c.uid = p.uid
  GROUP BY p.grp, p.D)"""
    rate_col = (f", CASE WHEN coalesce(agg.nw, 0) = 0 THEN NULL ELSE coalesce(agg.n_s, 0) / agg.nw END "
                f"AS stay_rate_{n}") if rate else ""
    return with_blog(f"""
SELECT days.grp, strftime(days.D, '%Y%m%d') AS dt,
       CAST(coalesce(agg.nw, 0) AS BIGINT) AS user_new_{n},
       CAST(coalesce(agg.n_s, 0) AS BIGINT) AS user_new_{n}_stay,
       CAST(coalesce(agg.a, 0) AS BIGINT) AS user_active_{n},
       CAST(coalesce(agg.a_s, 0) AS BIGINT) AS user_active_{n}_stay{rate_col}
FROM days LEFT JOIN agg ON agg.grp = days.grp AND agg.D = days.D
""", ctes)


ORACLE["retention_7"] = _retention_sql(7)
ORACLE["retention_30"] = _retention_sql(30)
ORACLE["retention_rate"] = _retention_sql(7, rate=True)
ORACLE["retention_incremental"] = (f"SELECT * FROM ({_retention_sql(7)}) "
                                   "WHERE dt BETWEEN '20240128' AND '20240130'")

ORACLE["cumulative_users"] = with_blog("""
SELECT t.grp, t.dt,
       CAST((SELECT count(*) FROM m x WHERE x.grp = t.grp AND x.dt = t.dt AND NOT EXISTS (
              SELECT 1 FROM m h WHERE h.grp = x.grp AND h.uid = x.uid AND h.dt >= '20240101' AND h.dt < x.dt))
            AS BIGINT) AS user_new,
       CAST((SELECT count(DISTINCT uid) FROM m y WHERE y.grp = t.grp AND y.dt >= '20240101' AND y.dt <= t.dt)
            AS BIGINT) AS total_users,
       lower(t.grp) || t.dt AS date,
       CAST((SELECT count(DISTINCT uid) FROM m y WHERE y.grp = t.grp AND y.dt >= '20240101' AND y.dt <= t.dt)
            AS VARCHAR) AS user_num
FROM (SELECT DISTINCT grp, dt FROM m WHERE dt >= '20240101') t
""", MEMBERS)

# news scene: exploded (slot, type) pairs, the type list drives
NEWS = """
news AS (SELECT * FROM gblog WHERE scene_id = 'S_NEWS'),
pairs AS (
  SELECT n.*, p.pos AS rec_posi, t.typ AS rec_typei
  FROM news n,
       LATERAL (SELECT unnest(string_split(n.rec_pos, ';')) AS pos, generate_subscripts(string_split(n.rec_pos, ';'), 1) AS i) p,
       LATERAL (SELECT unnest(string_split(n.rec_type, ';')) AS typ, generate_subscripts(string_split(n.rec_type, ';'), 1) AS i) t
  WHERE p.i = t.i),
aiset AS (SELECT DISTINCT dt, rec_posi FROM pairs WHERE grp = 'A' AND action_type = '1' AND rec_typei = '2')
"""

ORACLE["slot_explode"] = with_blog("""
SELECT dt, grp, rec_typei, count(*) AS n, count(DISTINCT rec_posi) AS n_slots FROM pairs GROUP BY dt, grp, rec_typei
""", NEWS)

ORACLE["ai_slots"] = with_blog("SELECT dt, rec_posi FROM aiset", NEWS)

ORACLE["slot_exposure_ab"] = with_blog("""
SELECT d.dt,
  CAST((SELECT count(*) FROM pairs p WHERE p.dt = d.dt AND p.grp = 'A' AND p.action_type = '1' AND p.rec_typei = '2') AS BIGINT) AS a_expose,
  CAST((SELECT count(*) FROM pairs p WHERE p.dt = d.dt AND p.grp = 'B' AND p.action_type = '1'
        AND EXISTS (SELECT 1 FROM aiset s WHERE s.dt = p.dt AND s.rec_posi = p.rec_posi)) AS BIGINT) AS b_expose
FROM (SELECT DISTINCT dt FROM news WHERE action_type = '1') d
""", NEWS)

ORACLE["watch_stats_ab"] = with_blog("""
SELECT grp, dt, count(*) AS plays, count(DISTINCT uid) AS players,
       CAST(coalesce(sum(watch_s) FILTER (WHERE watch_s <= 2 * dur_s), 0) AS BIGINT) AS watch_sum,
       CAST(coalesce(sum(watch_s) FILTER (WHERE watch_s <= 2 * dur_s), 0) // count(DISTINCT uid) AS BIGINT) AS watch_mean
FROM news p
WHERE action_type = '3' AND EXISTS (
  SELECT 1 FROM aiset s WHERE s.dt = p.dt AND list_contains(string_split(p.rec_pos, ';'), s.rec_posi))
GROUP BY grp, dt
""", NEWS)


# odd plays name one slot; the whole field must be a slot of the day's set
ORACLE["watch_stats_whole"] = with_blog("""
SELECT grp, dt, count(*) AS plays, count(DISTINCT uid) AS players,
       CAST(coalesce(sum(watch_s) FILTER (WHERE watch_s <= 2 * dur_s), 0) AS BIGINT) AS watch_sum,
       CAST(coalesce(sum(watch_s) FILTER (WHERE watch_s <= 2 * dur_s), 0) // count(DISTINCT uid) AS BIGINT) AS watch_mean
FROM (SELECT *, CASE WHEN event_id % 2 = 1 THEN split_part(rec_pos, ';', 1) ELSE rec_pos END AS one FROM news WHERE action_type = '3') p
JOIN (SELECT DISTINCT dt AS sdt, rec_posi FROM aiset) s ON s.sdt = p.dt AND s.rec_posi = p.one
GROUP BY grp, dt
""", NEWS)


def _slot_report_sql() -> str:
    cols = []
    for g in ("a", "b"):
        for kind, t in (("ai", "2"), ("man", "1")):
            for metric, code in (("exposure", "1"), ("click", "2"), ("order", "6")):
                cols.append(f"nullif(CAST(count_if(grp = '{g.upper()}' AND rec_typei = '{t}' "
                            f"AND action_type = '{code}') AS BIGINT), 0) AS {metric}_{kind}_{g}")
    return with_blog(f"SELECT dt, rec_posi, {', '.join(cols)} FROM pairs GROUP BY dt, rec_posi", NEWS)


ORACLE["slot_report"] = _slot_report_sql()

# the 4-way left join anchored on click days, literally
# days with a click; per day the distinct users and the rows of each action code, null for none
_FUNNEL_DAYS = """
SELECT days.dt AS action_time,
       (SELECT nullif(count(DISTINCT x.uid), 0) FROM v x WHERE x.dt = days.dt) AS userNum{g},
       (SELECT nullif(count(*), 0) FROM v x WHERE x.dt = days.dt AND x.action_type = '1') AS exposure{g},
       (SELECT count(*) FROM v x WHERE x.dt = days.dt AND x.action_type = '2') AS clickNum{g},
       (SELECT nullif(count(*), 0) FROM v x WHERE x.dt = days.dt AND x.action_type = '6') AS orderNum{g}
FROM (SELECT DISTINCT dt FROM v WHERE action_type = '2') days
"""

for _g in ("A", "B"):
    ORACLE[f"funnel_report_{_g.lower()}"] = with_blog(
        _FUNNEL_DAYS.format(g=_g), f"v AS (SELECT * FROM gblog WHERE scene_id = 'S_REL' AND grp = '{_g}')")
ORACLE["province_report"] = ORACLE["funnel_report_a"]

# ---------------------------------------------------------------- parsing
ORACLE["log_parse"] = with_blog("""
SELECT dt, scene_id, action_type, count(*) AS n, CAST(sum(action_sec) AS BIGINT) AS sum_sec,
       count(DISTINCT uid) AS n_uid, count(*) AS n_same_day
FROM blog GROUP BY dt, scene_id, action_type
""")

ORACLE["log_rejects"] = with_blog("""
SELECT dt, CAST(count_if(action_type <> '9') AS BIGINT) AS valid, CAST(count_if(action_type = '9') AS BIGINT) AS rejects
FROM blog GROUP BY dt
""")

ORACLE["ext_parse"] = with_blog("""
SELECT dt, CAST(sum(watch_s) AS BIGINT) AS watch, CAST(sum(dur_s) AS BIGINT) AS duration,
       CAST(count_if(watch_s <= 2 * dur_s) AS BIGINT) AS plausible
FROM blog GROUP BY dt
""")

ORACLE["release_filter"] = with_blog("""
SELECT dt, scene_id, count(*) AS n FROM blog
WHERE event_id % 2 = 0 AND user_id % 3 IN (0, 1) GROUP BY dt, scene_id
""")

ORACLE["date_spine"] = with_blog("""
SELECT strftime(CAST(x AS DATE), '%Y%m%d') AS dt
FROM (SELECT unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS x FROM events)
""")

ORACLE["time_funcs"] = """
SELECT event_id,
  CASE WHEN event_type = 'error' THEN '未知' WHEN event_id % 11 IN (3, 4, 5) THEN NULL
       ELSE strftime(timezone('Asia/Shanghai', to_timestamp(floor(epoch(ts)))), '%Y%m%d') END AS day,
  CASE WHEN event_type = 'error' THEN '未知' WHEN event_id % 11 IN (3, 4, 5) THEN NULL
       ELSE strftime(timezone('Asia/Shanghai', to_timestamp(floor(epoch(ts)))), '%Y%m%d%H') END AS hour,
  CASE WHEN event_type = 'error' THEN '未知'
       ELSE CAST(epoch_ms(timezone('Asia/Shanghai', date_trunc('millisecond', ts))) AS VARCHAR) END AS ms,
  CASE WHEN event_type = 'error' THEN '未知'
       ELSE CAST(epoch(timezone('Asia/Shanghai', date_trunc('second', ts)))::BIGINT AS VARCHAR) END AS sec
FROM events
"""


def _d(expr: str) -> str:
    return f"strftime(CAST(strptime(dt, '%Y%m%d') AS DATE) + {expr}, '%Y%m%d')"


ORACLE["date_funcs"] = with_blog(f"""
SELECT dt, {_d('1')} AS next_day, {_d('-1')} AS prev_day,
       {_d('-6')} AS w7_cur_start, {_d('-13')} AS w7_prev_start, {_d('-7')} AS w7_prev_end,
       {_d('-29')} AS w30_cur_start, {_d('-59')} AS w30_prev_start, {_d('-30')} AS w30_prev_end
FROM (SELECT DISTINCT dt FROM blog)
""")

# ---------------------------------------------------------------- wide reports
_NEW_FLAG = """
mn AS (SELECT t.grp, t.dt, t.uid,
       NOT EXISTS (SELECT 1 FROM m h WHERE h.grp = t.grp AND h.uid = t.uid
                   AND h.dt >= '20240101' AND h.dt < t.dt) AS is_new
       FROM m t WHERE t.dt >= '20240101')
"""

ORACLE["report_daily_ab"] = with_blog("""
SELECT l.dt AS date, 'S_REL' AS scene_id,
  CAST(count_if(grp = 'A' AND action_type = '1') AS BIGINT) AS a_expose, CAST(count_if(grp = 'A' AND action_type = '2') AS BIGINT) AS a_click,
  count(DISTINCT CASE WHEN grp = 'A' THEN uid END) AS a_user_active, CAST(count_if(grp = 'A' AND action_type = '6') AS BIGINT) AS a_order,
  CAST(coalesce((SELECT count(*) FROM mn WHERE mn.grp = 'A' AND mn.dt = l.dt AND is_new), 0) AS BIGINT) AS a_user_new,
  CAST(count_if(grp = 'A' AND contains(action_type, '3')) AS BIGINT) AS a_play,
  CAST(count_if(grp = 'B' AND action_type = '1') AS BIGINT) AS b_expose, CAST(count_if(grp = 'B' AND action_type = '2') AS BIGINT) AS b_click,
  count(DISTINCT CASE WHEN grp = 'B' THEN uid END) AS b_user_active, CAST(count_if(grp = 'B' AND action_type = '6') AS BIGINT) AS b_order,
  CAST(coalesce((SELECT count(*) FROM mn WHERE mn.grp = 'B' AND mn.dt = l.dt AND is_new), 0) AS BIGINT) AS b_user_new,
  CAST(count_if(grp = 'B' AND contains(action_type, '3')) AS BIGINT) AS b_play
FROM gblog l WHERE scene_id = 'S_REL' GROUP BY l.dt
""", MEMBERS + "," + _NEW_FLAG)


def _ret_report_sql() -> str:
    parts = []
    for n in (7, 30):
        body = _retention_sql(n)
        parts.append(f"r{n} AS ({body})")
    sel = []
    for g in ("A", "B"):
        for n in (7, 30):
            for m in ("user_new_{n}", "user_new_{n}_stay", "user_active_{n}", "user_active_{n}_stay"):
                mm = m.format(n=n)
                sel.append(f"CAST(coalesce(max(CASE WHEN grp = '{g}' THEN {mm} END), 0) AS BIGINT) AS {g.lower()}_{mm}")
    # each retention CTE is a full WITH query; nest them as subqueries
    r7, r30 = _retention_sql(7), _retention_sql(30)
    return f"""
SELECT dt AS date, 'S_REL' AS scene_id, {', '.join(sel)}
FROM (SELECT * FROM ({r7}) a FULL JOIN ({r30}) b USING (grp, dt))
GROUP BY dt
"""


ORACLE["report_retention_ab"] = _ret_report_sql()

ORACLE["join_distinct"] = with_blog("""
SELECT grp, dt, string_agg(DISTINCT action_type, '||' ORDER BY action_type) AS joined
FROM gblog WHERE scene_id = 'S_REL' GROUP BY grp, dt
""")

ORACLE["sql_view_funnel"] = ORACLE["funnel_report_a"]

# ---------------------------------------------------------------- items, ledger
ORACLE["item_parse"] = """
SELECT event_type, count(*) AS n, count(DISTINCT CAST(user_id AS VARCHAR)) AS n_keys
FROM events WHERE event_type <> 'error' GROUP BY event_type
"""

_LATEST = """
SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""

ORACLE["item_upsert"] = _LATEST

ORACLE["item_export"] = f"""
SELECT CAST(user_id AS VARCHAR) || chr(9) || CAST(event_id AS VARCHAR) || chr(9) || event_type || chr(9)
       || ts || chr(9) || CAST(value AS VARCHAR) || chr(9) || 'null' || chr(9) AS line
FROM ({_LATEST})
"""

# each load's last line per key, the second load over the first; lines with a wrong field count are left out
ORACLE["item_job"] = """
SELECT CAST(user_id AS VARCHAR) || chr(9) || CAST(event_id AS VARCHAR) || chr(9) || event_type || chr(9)
       || strftime(ts, '%Y-%m-%d %H:%M:%S.%f') || chr(9) || CAST(value AS VARCHAR) || chr(9) AS line
FROM events WHERE event_type <> 'error'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts >= TIMESTAMP '2024-01-16' DESC, event_id DESC) = 1
"""

ORACLE["offset_ledger"] = """
SELECT topic, string_agg(CAST(p AS VARCHAR) || '|' || CAST(u AS VARCHAR), ',' ORDER BY p) AS ledger
FROM (SELECT 'ev_' || event_type AS topic, CAST(user_id % 4 AS INTEGER) AS p, max(event_id) + 1 AS u
      FROM events GROUP BY 1, 2)
GROUP BY topic
"""

# ---------------------------------------------------------------- JSON ingest
_JSON_PROJ = """
SELECT CAST(event_id AS VARCHAR) AS eventId, event_type AS bizType, CAST(user_id AS VARCHAR) AS userId,
       'm' || CAST(user_id AS VARCHAR) AS mac, CAST(event_id % 7 AS VARCHAR) AS id, '[1,2]' AS ids,
       '{"x":1}' AS name, strftime(ts, '%Y%m%d%H') AS curr_time
FROM events
"""

ORACLE["json_flatten"] = _JSON_PROJ
ORACLE["stream_ingest"] = _JSON_PROJ.replace(
    "strftime(ts, '%Y%m%d%H') AS curr_time",
    "CASE WHEN ts < TIMESTAMP '2024-01-16' THEN '2024011600' ELSE '2024013100' END AS curr_time")
assert ORACLE["stream_ingest"] != _JSON_PROJ


def _event_project_sql() -> str:
    from ..schema import EVENT_FIELDS
    have = {"eventId": "CAST(event_id AS VARCHAR)", "bizType": "event_type",
            "userId": "CAST(user_id AS VARCHAR)", "mac": "'m' || CAST(user_id AS VARCHAR)",
            "id": "CAST(event_id % 7 AS VARCHAR)", "ids": "'[1,2]'", "name": "'{\"x\":1}'",
            "curr_time": "strftime(ts, '%Y%m%d%H')"}
    cols = [f"{have.get(f, chr(39) * 2)} AS \"{f}\"" for f in EVENT_FIELDS]
    return f"SELECT {', '.join(cols)} FROM events"


ORACLE["event_project"] = _event_project_sql()

ORACLE["member_write"] = with_blog("SELECT grp, dt, count(*) AS n FROM m GROUP BY grp, dt", MEMBERS)


# ---------------------------------------------------------------- whole jobs from raw day folders
# lines as they come: a late one lies in the folder of the day before; event day unknown without a usable time
_MIXED = """mixed AS (
  SELECT *, event_id % 10 AS kind,
         CASE WHEN event_id % 10 = 1 THEN strftime(CAST(strptime(dt, '%Y%m%d') AS DATE) - 1, '%Y%m%d') ELSE dt END AS folder_dt,
         CASE WHEN event_id % 10 IN (5, 6) THEN '未知' ELSE dt END AS event_dt,
         CASE event_id % 10 WHEN 2 THEN 7 WHEN 3 THEN 6 WHEN 4 THEN 5 WHEN 7 THEN 3 WHEN 8 THEN 2 ELSE 8 END AS n_fields
  FROM gblog)"""

ORACLE["funnel_from_logs"] = with_blog("""
SELECT grp, folder_dt, event_dt AS dt, count(*) FILTER (action_type = '1') AS exposures, count(*) FILTER (action_type = '2') AS clicks,
       count(DISTINCT uid) AS users, count(*) FILTER (action_type = '6') AS orders
FROM mixed WHERE scene_id = 'S_REL' AND n_fields >= 5 GROUP BY ALL
""", _MIXED)

ORACLE["players_from_logs"] = with_blog("""
SELECT grp, folder_dt, count(DISTINCT uid) FILTER (action_type = '3') AS players, count(DISTINCT uid) AS users
FROM mixed WHERE scene_id = 'S_REL' AND n_fields >= 5 GROUP BY ALL
""", _MIXED)

ORACLE["members_from_logs"] = with_blog("""
SELECT DISTINCT grp, folder_dt AS dt, uid FROM mixed WHERE scene_id = 'S_REL' AND n_fields >= 3
""", _MIXED)

ORACLE["news_members"] = with_blog("""
SELECT DISTINCT grp, folder_dt AS dt, uid FROM mixed
WHERE scene_id = 'S_NEWS' AND event_id % 2 = 0 AND user_id % 3 IN (0, 1) AND n_fields >= 6
""", _MIXED)

ORACLE["mixed_rejects"] = with_blog("""
SELECT folder_dt AS dt, n_fields, count(*) AS n FROM mixed WHERE n_fields < 5 GROUP BY ALL
""", _MIXED)

ORACLE["user_metrics_news"] = with_blog("""
SELECT lower(right(g, 1)) || '20240115' AS date, g AS grp, '20240115' AS dt,
  (SELECT count(*) FROM n WHERE n.g = x.g AND dt = '20240115' AND uid NOT IN (SELECT uid FROM n o WHERE o.g = x.g AND o.dt < '20240115')) AS user_new,
  (SELECT count(*) FROM n WHERE n.g = x.g AND dt = '20240115' AND uid IN (SELECT uid FROM n o WHERE o.g = x.g AND o.dt < '20240115')) AS user_remain,
  (SELECT count(*) FROM n WHERE n.g = x.g AND dt = '20240115') AS user_active,
  CASE WHEN g = 'qianA' THEN (SELECT count(DISTINCT uid) FROM n WHERE n.g = x.g AND dt <= '20240115') END AS total_users,
  CASE WHEN g = 'qianA' THEN 'ok' ELSE 'missing' END AS state
FROM (SELECT DISTINCT g FROM n WHERE dt = '20240115') x
""", "n AS (SELECT DISTINCT 'qian' || grp AS g, dt, uid FROM gblog WHERE scene_id = 'S_NEWS')")

ORACLE["totals_incremental"] = with_blog("""
SELECT lower(grp) || dt AS date,
  CASE WHEN dt > (SELECT min(dt) FROM m o WHERE o.grp = x.grp)
       THEN CAST((SELECT count(DISTINCT uid) FROM m o WHERE o.grp = x.grp AND o.dt <= x.dt) AS VARCHAR) END AS user_num
FROM (SELECT DISTINCT grp, dt FROM m) x
""", MEMBERS)

ORACLE["json_levels"] = """
SELECT event_id, CAST(event_id % 12 AS INTEGER) AS levels, 'm' || CAST(user_id AS VARCHAR) AS mac FROM events
"""

NEWS_RELEASE = NEWS.replace("news AS (SELECT * FROM gblog WHERE scene_id = 'S_NEWS')",
                            "news AS (SELECT * FROM gblog WHERE scene_id = 'S_NEWS' "
                            "AND event_id % 2 = 0 AND user_id % 3 IN (0, 1))")
assert NEWS_RELEASE != NEWS

ORACLE["news_report"] = with_blog("""
SELECT coalesce(ex.dt, w.dt) AS date,
  CAST(coalesce(ex.a_expose, 0) AS BIGINT) AS a_expose,
  CAST(coalesce(w.a_watch_sum, 0) AS BIGINT) AS a_watch_sum, CAST(w.a_watch_mean AS BIGINT) AS a_watch_mean,
  CAST(coalesce(w.a_plays, 0) AS BIGINT) AS a_plays,
  CAST(coalesce(ex.b_expose, 0) AS BIGINT) AS b_expose,
  CAST(coalesce(w.b_watch_sum, 0) AS BIGINT) AS b_watch_sum, CAST(w.b_watch_mean AS BIGINT) AS b_watch_mean,
  CAST(coalesce(w.b_plays, 0) AS BIGINT) AS b_plays
FROM ex FULL JOIN (
  SELECT dt,
    max(CASE WHEN grp = 'A' THEN watch_sum END) AS a_watch_sum, max(CASE WHEN grp = 'A' THEN watch_mean END) AS a_watch_mean,
    max(CASE WHEN grp = 'A' THEN plays END) AS a_plays,
    max(CASE WHEN grp = 'B' THEN watch_sum END) AS b_watch_sum, max(CASE WHEN grp = 'B' THEN watch_mean END) AS b_watch_mean,
    max(CASE WHEN grp = 'B' THEN plays END) AS b_plays
  FROM ws GROUP BY dt) w ON ex.dt = w.dt
""", NEWS_RELEASE + ",\n" + """ex AS (
  SELECT d.dt,
    (SELECT count(*) FROM pairs p WHERE p.dt = d.dt AND p.grp = 'A' AND p.action_type = '1' AND p.rec_typei = '2') AS a_expose,
    (SELECT count(*) FROM pairs p WHERE p.dt = d.dt AND p.grp = 'B' AND p.action_type = '1'
       AND EXISTS (SELECT 1 FROM aiset s WHERE s.dt = p.dt AND s.rec_posi = p.rec_posi)) AS b_expose
  FROM (SELECT DISTINCT dt FROM news WHERE action_type = '1') d),
ws AS (
  SELECT grp, dt, count(*) AS plays,
         coalesce(sum(watch_s) FILTER (WHERE watch_s <= 2 * dur_s), 0) AS watch_sum,
         coalesce(sum(watch_s) FILTER (WHERE watch_s <= 2 * dur_s), 0) // count(DISTINCT uid) AS watch_mean
  FROM news p WHERE action_type = '3' AND EXISTS (
    SELECT 1 FROM aiset s WHERE s.dt = p.dt AND list_contains(string_split(p.rec_pos, ';'), s.rec_posi))
  GROUP BY grp, dt)
""")


# cumulative slot set: slots seen as AI slots of group A on the day or before
_FIRST = "firsts AS (SELECT rec_posi, min(dt) AS first_dt FROM aiset GROUP BY rec_posi)"

ORACLE["slot_exposure_cumulative"] = with_blog("""
SELECT d.dt,
  CAST((SELECT count(*) FROM pairs p WHERE p.dt <= d.dt AND p.grp = 'A' AND p.action_type = '1' AND p.rec_typei = '2') AS BIGINT) AS a_expose,
  CAST((SELECT count(*) FROM pairs p WHERE p.dt <= d.dt AND p.grp = 'B' AND p.action_type = '1'
        AND EXISTS (SELECT 1 FROM firsts f WHERE f.rec_posi = p.rec_posi AND f.first_dt <= p.dt)) AS BIGINT) AS b_expose
FROM (SELECT DISTINCT dt FROM news WHERE action_type = '1') d
""", NEWS + ",\n" + _FIRST)

ORACLE["watch_stats_cumulative"] = with_blog("""
SELECT grp, dt, count(*) AS plays, count(DISTINCT uid) AS players,
       CAST(coalesce(sum(watch_s) FILTER (WHERE watch_s <= 2 * dur_s), 0) AS BIGINT) AS watch_sum,
       CAST(coalesce(sum(watch_s) FILTER (WHERE watch_s <= 2 * dur_s), 0) // count(DISTINCT uid) AS BIGINT) AS watch_mean
FROM news p
WHERE action_type = '3' AND EXISTS (
  SELECT 1 FROM firsts f WHERE f.first_dt <= p.dt AND list_contains(string_split(p.rec_pos, ';'), f.rec_posi))
GROUP BY grp, dt
""", NEWS + ",\n" + _FIRST)
