"""SQL surface: a behaviour-log frame as a temp view and the funnel report
as one grouped statement over it (Catalyst plans it like the DataFrame form)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Output column names are fixed values of the report; a metric without rows is null.
FUNNEL_SQL = """
WITH per_day AS (
  SELECT day,
         count(DISTINCT uid) AS users,
         count_if(code = 1) AS shown,
         count_if(code = 2) AS clicked,
         count_if(code = 6) AS bought
  FROM {log} GROUP BY day)
SELECT day AS action_time, nullif(users, 0) AS userNum{g}, nullif(shown, 0) AS exposure{g},
       clicked AS clickNum{g}, nullif(bought, 0) AS orderNum{g}
FROM per_day WHERE clicked > 0 ORDER BY action_time
"""


def sql_funnel_report(spark: SparkSession, logs: DataFrame, grp: str) -> DataFrame:
    """The click-anchored report of one group as SQL text over one scan.

    The view has a name of its own per call, so callers don't meet; codes
    that are no number match nothing, with ANSI on or off.
    """
    view = f"abflow_log_{uuid.uuid4().hex}"
    (logs.filter(F.col("grp") == grp.upper())
     .select("uid", F.trim("action_type").try_cast("int").alias("code"), F.col("dt").alias("day"))
     .createOrReplaceTempView(view))
    try:
        return spark.sql(FUNNEL_SQL.format(log=view, g=grp.upper()))
    finally:
        spark.catalog.dropTempView(view)
