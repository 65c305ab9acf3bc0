"""Driver contract: every registered query against its DuckDB oracle, and
plan-shape rules that must hold for every query."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import duck_con, run  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402

from ledgermatch.registry import QUERIES  # noqa: E402

KEYS = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_con(SF_SMALL)


def test_entry_smoke(spark):
    df = E.entry(spark)
    r = df.collect()
    assert len(r) == 1 and r[0]["check_name"] == "subscription_by_masthead"


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(E.queries()) and set(KEYS) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_against_oracle(spark, con, key):
    sql = E.oracle_sql().get(key)
    r = run(spark, con, SF_SMALL, key, E.queries()[key], sql)
    assert r["status"] in ("ok", "rows-only"), r


@pytest.mark.parametrize("key", KEYS)
def test_plan_has_no_cartesian_product(spark, key):
    plan = E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("key", ["csv_coerce", "load_base_overlap", "load_movement", "tenure_days", "data_volume"])
def test_session_time_zone_does_not_change_answers(spark, con, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        r = run(spark, con, SF_SMALL, key, E.queries()[key], E.oracle_sql().get(key))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["status"] == "ok", r
