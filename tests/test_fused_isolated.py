"""Suites from one scan, isolated queries, mismatch samples and the nested report."""

import time

import pytest
from pyspark.sql import functions as F

from ledgermatch.plans import suites as Q
from ledgermatch.plans.fused import FusedChecks, fits, mismatch_samples
from ledgermatch.plans.isolation import Failed, first_rows
from ledgermatch.plans.report import acceptance_document, written_document
from ledgermatch.session import materialize

COLUMNS = "report_date date, masthead string, classification_level_1 string, delivery_medium_type string, offer_category_name string, " \
          "dw_source_system_code string, subscription_count int, acquisition_count bigint, cancellation_count bigint"


@pytest.fixture(scope="module")
def tables(spark):
    row = lambda d, m, n: (d, m, "c", None, "o", "THINK", n, n % 3, 1)
    import datetime as dt

    day = lambda k: dt.date(1998, 1 + k % 3, 1 + k % 20)
    new = [row(day(k), None if k % 7 == 0 else f"m{k % 4}", k) for k in range(60)]
    old = [row(day(k), None if k % 7 == 0 else f"m{k % 4}", k + (k == 9)) for k in range(60) if k != 5]
    return spark.createDataFrame(new, COLUMNS), spark.createDataFrame(old, COLUMNS.replace("subscription_count int", "subscription_count bigint"))


def by_name(df):
    return {r["check_name"]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("suite", [Q.ACCEPTANCE_SUITE, Q.EXAMPLE_SUITE])
def test_shared_scan_gives_the_rows_of_single_queries(spark, tables, suite):
    new, old = tables
    assert all(fits(q, new, old) for q in suite)
    for a, b in ((new, old), (new, new), (new.limit(0), old), (new.limit(0), new.limit(0))):
        fused = FusedChecks(a, b, suite).result_rows()
        alone = [Q.compare_query(spark, q, a, b) for q in suite]
        want = {k: v for df in alone for k, v in by_name(df).items()}
        got = by_name(fused)
        assert {k: {c: v[c] for c in want[k]} for k, v in got.items()} == want
    stored = [materialize(t, "side") for t in tables]
    plan = FusedChecks(*stored, suite).result_rows()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 2


def test_declared_parts_answer_like_the_sql(spark, tables):
    for q in Q.ACCEPTANCE_SUITE + Q.EXAMPLE_SUITE:
        parts = tables[0].groupBy(*[F.expr(g).alias(n) for n, g in q.groups]).agg(*[F.expr(a).alias(n) for n, a in q.aggs])
        assert sorted(map(str, parts.collect())) == sorted(map(str, Q.run_query(spark, q, tables[0]).collect()))


def test_free_sql_and_broken_queries_run_beside_the_shared_scan(spark, tables):
    suite = [Q.ACCEPTANCE_SUITE[2],
             Q.QuerySpec("median", "SELECT masthead, percentile(subscription_count, 0.5) AS p FROM {table} GROUP BY masthead", keys=("masthead",)),
             Q.QuerySpec("gone", "SELECT sum(gone) AS s FROM {table}", keys=(), aggs=(("s", "sum(gone)"),)), Q.ACCEPTANCE_SUITE[0]]
    rows = {r["ordinal"]: r for r in Q.run_suite(spark, suite, *tables).collect()}
    assert [rows[k]["check_name"] for k in (1, 2, 3, 4)] == [q.name for q in suite]
    assert rows[3]["error_message"].startswith("Query execution failed") and not rows[4]["passed"] and rows[4]["total_rows"] is None
    again = {r["ordinal"]: r for r in Q.run_suite(spark, suite, *tables, isolate=True).collect()}
    assert {k: r.asDict() | {"error_message": None} for k, r in again.items()} == {k: r.asDict() | {"error_message": None} for k, r in rows.items()}
    assert Q.run_suite(spark, [], *tables).count() == 0 == Q.run_suite(spark, [], *tables, isolate=True).count()


def test_result_rows_with_nulls_without_arrow(spark, tables):
    arrow, key = spark.conf.get("spark.sql.execution.arrow.pyspark.enabled"), "spark.sql.execution.arrow.pyspark.enabled"
    suite = [Q.ACCEPTANCE_SUITE[0], Q.QuerySpec("late", "SELECT sum(cast(masthead AS int)) AS s FROM {table}")]
    spark.conf.set(key, "false")
    try:
        rows = by_name(Q.run_suite(spark, suite, *tables, isolate=True))
    finally:
        spark.conf.set(key, arrow)
    assert rows["late"]["total_rows"] is None and rows["late"]["max_delta"] is None and rows["late"]["mismatched_rows"] is None
    assert rows["total_subscription_count"]["cdl_value"] == str(sum(range(60))) and rows["total_subscription_count"]["max_delta"] is not None


def test_a_shared_scan_that_fails_is_run_query_by_query(spark, tables):
    suite = [Q.ACCEPTANCE_SUITE[0], Q.QuerySpec("number", "SELECT sum(cast(masthead AS int)) AS s FROM {table}", keys=(), aggs=(("s", "sum(cast(masthead AS int))"),))]
    rows = by_name(Q.run_suite(spark, suite, *tables, isolate=True))
    assert rows["number"]["error_message"].startswith("Query execution failed") and rows["total_subscription_count"]["cdl_value"] == str(sum(range(60)))


def test_a_slow_query_is_stopped_and_others_are_not(spark):
    # two of the four slots, so that the others have room
    slow = lambda: spark.range(0, 10**12, 1, 2).select(F.sum(F.xxhash64("id").cast("double")))
    began = time.monotonic()
    out = first_rows(spark, {"slow": slow, "fast": lambda: spark.range(5).agg(F.count("*")), "bad": lambda: spark.sql("SELECT raise_error('x')")}, limit_sec=6)
    assert out["fast"][0] == 5 and isinstance(out["slow"], Failed) and out["slow"].timed_out and time.monotonic() - began < 60
    assert isinstance(out["bad"], Failed) and not out["bad"].timed_out
    assert spark.range(3).count() == 3


def test_mismatch_samples_and_document(spark, tables):
    checks = FusedChecks(*tables, Q.ACCEPTANCE_SUITE)
    sample = mismatch_samples(checks.entries(), checks.names(), 2).collect()
    per = {}
    for r in sample:
        per.setdefault(r["check_name"], []).append(r)
    assert {k: max(r["sample_rank"] for r in v) for k, v in per.items()} == {k: min(2, v[0]["total_mismatches"]) for k, v in per.items()}
    assert all(a["delta"] is None or b["delta"] is None or a["delta"] >= b["delta"] for v in per.values()
               for a, b in zip(sorted(v, key=lambda r: r["sample_rank"]), sorted(v, key=lambda r: r["sample_rank"])[1:]))
    doc = written_document(acceptance_document(checks, start="1998-01-01")).collect()
    assert len(doc) == 1
    d = doc[0].asDict(recursive=True)
    rows = by_name(checks.result_rows())
    assert not d["migration_accepted"] and d["window"] == {"start": "1998-01-01", "end": None}
    assert {q["name"] for q in d["failed_queries"]} == {k for k, r in rows.items() if not r["passed"]}
    assert all(q["total_mismatches"] == rows[q["name"]]["mismatched_rows"] and len(q["mismatches"]) == min(5, q["total_mismatches"]) for q in d["failed_queries"])
    good = acceptance_document(FusedChecks(tables[0], tables[0], Q.ACCEPTANCE_SUITE)).first()
    assert good["migration_accepted"] and good["failed_queries"] == [] and good["critical_queries"]["pass_rate"] == 100.0


def test_fused_row_count_and_derived(spark, tables):
    new, old = (t.withColumns({"double_up": F.col("acquisition_count") * 2}) for t in tables)
    rows = by_name(FusedChecks(new, old, [], 0.01, row_count=True, derived={"double_up": "acquisition_count + acquisition_count", "acquisition_count": "0"}).result_rows())
    assert rows["row_count"]["cdl_value"] == "60" and rows["row_count"]["target_value"] == "59" and not rows["row_count"]["passed"]
    assert rows["double_up"]["passed"] and rows["double_up"]["total_rows"] == 59 and not rows["acquisition_count"]["passed"]
