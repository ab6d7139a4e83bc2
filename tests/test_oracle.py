"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""
import pytest

import __spark_entry__ as E
from abflow.plans.catalog import QUERIES
from tools.oracle_check import duck_conn, rows_key

SF = "/root/testdata/sf0.01"
NAMES = list(QUERIES)   # the training-data queries have tests of their own


@pytest.fixture(scope="module")
def duck():
    return duck_conn(SF)


def test_every_query_has_an_oracle():
    missing = [n for n in NAMES if n not in E.oracle_sql()]
    assert missing == []


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(dcols)
    types = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}
    dtypes = dict(zip(dcols, [str(t) for t in duck.sql(E.oracle_sql()[name]).types]))
    assert {c: types.get(t, t) for c, t in sdf.dtypes} == dtypes
    srows = [tuple(r) for r in sdf.collect()]
    drows = cur.fetchall()
    assert len(srows) == len(drows)
    assert rows_key(sdf.columns, srows) == rows_key(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["grp", "dt", "exposures", "clicks", "users", "orders"]


@pytest.mark.parametrize("name", ["time_funcs", "funnel_from_logs", "date_funcs", "json_flatten"])
def test_independent_of_session_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        sdf = E.queries()[name](spark, SF)
        srows = [tuple(r) for r in sdf.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert rows_key(sdf.columns, srows) == rows_key(dcols, cur.fetchall())


@pytest.mark.parametrize("name", ["time_funcs", "log_parse", "ext_parse", "json_flatten"])
def test_independent_of_ansi_mode(spark, duck, name):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        sdf = E.queries()[name](spark, SF)
        srows = [tuple(r) for r in sdf.collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert rows_key(sdf.columns, srows) == rows_key(dcols, cur.fetchall())
