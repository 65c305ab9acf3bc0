"""Each damage case of the published copy trips the check it is aimed at, and
comparing a table with itself passes every check (sf0.001 fixtures)."""

import pytest
from pyspark.sql import functions as F

from ledgermatch import registry as RG
from ledgermatch.functions.scalars import TENURE_GROUPS
from ledgermatch.plans import checks as C
from ledgermatch.plans import compare as CMP
from ledgermatch.plans import suites as Q
from ledgermatch.sources import fixtures as fx
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def tables(spark):
    return RG.new_layer(spark, SF_SMALL), RG.old_layer(spark, SF_SMALL)


def test_dropped_orders_change_counts_and_keys(spark, tables):
    new, old = tables
    rc = C.row_count_check(new, old).first()
    assert rc["passed"] is False and rc["difference"] > 0
    dv = C.dimension_values(new, old, RG.SHARED_DIMS).first()
    assert dv["only_in_new"] > 0 and dv["only_in_old"] > 0


def test_null_masthead_trips_null_rate(spark, tables):
    new, old = tables
    q = {r["column_name"]: r for r in C.quantity_compare(new, old).collect()}
    assert q["masthead"]["null_rate_match"] is False and q["masthead"]["cdl_null_rate"] == 0.0
    assert old.filter(F.dayofmonth("report_date") == 7).filter(F.col("masthead").isNotNull()).count() == 0


def test_acquisition_bump_trips_derived_metrics(spark, tables):
    _, old = tables
    got = {r["check_name"]: r for r in C.derived_metric_check(old, fx.DERIVED_FORMULAS).collect()}
    assert got["TotalAcquisition"]["passed"] is False and got["NetAcquisition"]["passed"] is False
    bumped = old.filter((F.col("masthead") == "BUILDING") & (F.dayofmonth("report_date") == 15)).count()
    assert got["TotalAcquisition"]["mismatched_rows"] == bumped


def test_half_cent_on_a_double_measure_passes_at_tolerance(spark, tables):
    new, _ = tables
    shifted = new.withColumn("ratecard_amount", F.col("ratecard_amount") + F.lit(0.005))
    r = CMP.reconcile_metrics(new, shifted, fx.LAYER_DIMS, ["ratecard_amount"], 0.01).first()
    assert r["passed"] is True and 0.004 < r["max_delta"] < 0.006


def test_schema_damage(spark, tables):
    new, old = tables
    got = {r["check_name"]: r for r in C.schema_checks(spark, new, old).collect()}
    assert got["column_names"]["details"] == {"cdl_only": "sunday_flag", "target_only": "dw_load_batch_id"}
    assert got["data_types"]["details"]["type_mismatches"] == "subscription_count:bigint:int"


def test_negative_count_and_check_bucket(spark, tables):
    _, old = tables
    nn = {r["column_name"]: r["passed"] for r in C.non_negative(old, RG.COUNT_COLUMNS).collect()}
    assert [c for c, ok in nn.items() if not ok] == ["cancellation_count"]
    dom = {r["value"] for r in C.domain_violations(old, "tenure_group", TENURE_GROUPS).collect()}
    assert dom == {"CHECK"}


def test_identity_passes_everything(spark, tables):
    new, _ = tables
    assert all(r["passed"] for r in Q.run_suite(spark, Q.EXAMPLE_SUITE, new, new).collect())
    assert all(r["passed"] for r in CMP.reconcile_metrics(new, new, fx.LAYER_DIMS, fx.LAYER_METRICS).collect())
    assert all(r["passed"] for r in C.schema_checks(spark, new, new).collect())
    q = C.quantity_compare(new, new).collect()
    assert all(r["distinct_match"] and r["null_rate_match"] for r in q)
    assert C.dimension_values(new, new, fx.LAYER_DIMS).first()["passed"] is True
    assert all(r["passed"] for r in C.observed_nulls(new, new).collect())


def test_swapping_sides_swaps_one_sided_counts(spark, tables):
    new, old = tables
    a = C.dimension_values(new, old, RG.SHARED_DIMS).first()
    b = C.dimension_values(old, new, RG.SHARED_DIMS).first()
    assert (a["only_in_new"], a["only_in_old"]) == (b["only_in_old"], b["only_in_new"])
