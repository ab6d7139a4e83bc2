"""Fixed values of the behaviour-log data model.

Codes, field positions, key lists and report layouts below must equal
the ones the analysed logs and reports use; they are stated once here
and used by name everywhere else.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: action type codes (field 3 of a log line) ---
ACTION_EXPOSURE = "1"
ACTION_CLICK = "2"
ACTION_PLAY = "3"
ACTION_ORDER = "6"

# --- fixed values: slot type code of an AI recommendation slot ---
AI_SLOT_TYPE = "2"

# --- fixed values: scenes and products seen in the logs ---
SCENE_NEWS = "QXW_1"
SCENE_RELATED = "171587_4"
NEWS_PRODUCTS = ("SC823", "SC818")
HISTORY_START = "20190413"

# --- fixed values: time handling ---
DEFAULT_TZ = "Asia/Shanghai"
UNKNOWN_TIME = "未知"          # text put for a missing time
DAY_FMT = "yyyyMMdd"
HOUR_FMT = "yyyyMMddHH"

# --- fixed values: watch-time plausibility factor ---
WATCH_FACTOR = 2

# --- fixed values: positions in a tab-separated behaviour-log line ---
F_UID, F_UNUSED, F_SCENE, F_ACTION, F_TIME, F_EXT, F_SLOTS, F_SLOT_TYPES = range(8)
LOG_FIELDS = 8
# items of the ext field (comma list of key:value) holding watch and duration
EXT_WATCH_ITEM = 2
EXT_DURATION_ITEM = 5

# --- fixed values: A/B bucket of the last uid character code mod 10 ---
GROUP_A_DIGITS = "01234"
GROUP_B_DIGITS = "56789"

# --- fixed values: the 45 columns of the flattened event table, in order ---
EVENT_FIELDS = [
    "requestId", "mac", "terminalType", "deviceId", "areaCode", "userId", "ip",
    "hardVer", "softVer", "os", "appVer", "appId", "appProduct", "appChannel",
    "bizType", "eventId", "time", "sp", "upgradeType", "optState", "id", "name",
    "fromId", "fromName", "ids", "resType", "recomType", "recomPos", "sceneId",
    "traceId", "fromPlat", "duration", "process", "errCode", "errInfo", "epgName",
    "epgStartTime", "epgEndTime", "optType", "searchWords", "type", "optStatus",
    "appName", "dataInfo", "curr_time",
]
INGEST_PARTITION = "curr_time"

# --- fixed values: daily report layout (one wide row per day and scene) ---
DAILY_REPORT_METRICS = ["expose", "click", "user_active", "order", "user_new", "play"]
DAILY_REPORT_FIELDS = (["date", "scene_id"]
                       + [f"a_{m}" for m in DAILY_REPORT_METRICS]
                       + [f"b_{m}" for m in DAILY_REPORT_METRICS])

# --- fixed values: retention report layout ---
RETENTION_WINDOWS = (7, 30)
RETENTION_MEASURES = ["user_new_{n}", "user_new_{n}_stay", "user_active_{n}", "user_active_{n}_stay"]
RETENTION_REPORT_FIELDS = (["date", "scene_id"]
                           + [f"{g}_{m.format(n=n)}" for g in ("a", "b")
                              for n in RETENTION_WINDOWS for m in RETENTION_MEASURES])


def event_schema() -> T.StructType:
    """The flattened event table: 45 nullable strings, last is the partition."""
    return T.StructType([T.StructField(f, T.StringType(), True) for f in EVENT_FIELDS])


def report_schema(fields: list[str], metric_type=T.LongType()) -> T.StructType:
    """Report rows: ``date`` and ``scene_id`` strings, then metric columns."""
    return T.StructType([T.StructField(f, T.StringType() if f in ("date", "scene_id") else metric_type, True)
                         for f in fields])
