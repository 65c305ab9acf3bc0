"""Query suites run on both tables, and the acceptance decision (R7, R20, SK3, SK4).

A suite query is Spark SQL with ``{table}`` standing for the table; it is run
with ``spark.sql(sql, table=df)`` so the table can be any DataFrame, already
narrowed to the date window (PF5: the filter goes on the DataFrame, below
the query, where Catalyst pushes it into the scan).
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.operators.filters import date_window
from ledgermatch.plans.compare import NUMERIC, compare_cells, compare_scalar, summarize_cells


@dataclass(frozen=True)
class QuerySpec:
    name: str
    sql: str
    critical: bool = False
    keys: tuple[str, ...] | None = None   # grouping columns of the answer, if known
    aggs: tuple[tuple[str, str], ...] = ()     # (column, aggregate) of the answer, for a shared scan
    groups: tuple[tuple[str, str], ...] = ()   # (column, expression) of its grouping columns


# ---------------------------------------------------------------------------
# The query suites shipped with the reference, restated in Spark
# SQL (``{table}`` is the table; month truncation is written ``trunc(d,'MM')``).
ACCEPTANCE_SUITE = [
    QuerySpec("total_subscription_count",
              "SELECT SUM(subscription_count) as total_subscriptions FROM {table}", True, ()),
    QuerySpec("total_acquisition_cancellation",
              "SELECT SUM(acquisition_count) as total_acquisitions, SUM(cancellation_count) as total_cancellations "
              "FROM {table}", True, ()),
    QuerySpec("subscription_by_date",
              "SELECT report_date, SUM(subscription_count) as total FROM {table} GROUP BY report_date "
              "ORDER BY report_date", True, ("report_date",)),
    QuerySpec("subscription_by_masthead",
              "SELECT masthead, SUM(subscription_count) as total FROM {table} GROUP BY masthead ORDER BY masthead",
              True, ("masthead",)),
    QuerySpec("row_count_and_date_range",
              "SELECT COUNT(*) as row_count, MIN(report_date) as min_date, MAX(report_date) as max_date, "
              "COUNT(DISTINCT report_date) as distinct_dates FROM {table}", True, ()),
]

EXAMPLE_SUITE = [
    QuerySpec("total_subscription_count", "SELECT SUM(subscription_count) as total FROM {table}", keys=()),
    QuerySpec("total_acquisition_count", "SELECT SUM(acquisition_count) as total FROM {table}", keys=()),
    QuerySpec("total_cancellation_count", "SELECT SUM(cancellation_count) as total FROM {table}", keys=()),
    QuerySpec("subscription_by_masthead",
              "SELECT masthead, SUM(subscription_count) as total_subscriptions FROM {table} GROUP BY masthead "
              "ORDER BY masthead", keys=("masthead",)),
    QuerySpec("subscription_by_date",
              "SELECT report_date, SUM(subscription_count) as total_subscriptions FROM {table} GROUP BY report_date "
              "ORDER BY report_date", keys=("report_date",)),
    QuerySpec("acquisition_by_classification",
              "SELECT classification_level_1, SUM(acquisition_count) as total_acquisitions FROM {table} "
              "GROUP BY classification_level_1 ORDER BY classification_level_1", keys=("classification_level_1",)),
    QuerySpec("subscription_by_delivery_medium",
              "SELECT delivery_medium_type, SUM(subscription_count) as total_subscriptions FROM {table} "
              "GROUP BY delivery_medium_type ORDER BY delivery_medium_type", keys=("delivery_medium_type",)),
    QuerySpec("average_subscription_by_offer_category",
              "SELECT offer_category_name, AVG(subscription_count) as avg_subscriptions FROM {table} "
              "GROUP BY offer_category_name ORDER BY offer_category_name", keys=("offer_category_name",)),
    QuerySpec("total_rows_by_date_range",
              "SELECT trunc(report_date, 'MM') as month, COUNT(*) as row_count FROM {table} GROUP BY month "
              "ORDER BY month", keys=("month",)),
    QuerySpec("subscription_movement_by_source_system",
              "SELECT dw_source_system_code, SUM(subscription_count) as total, SUM(acquisition_count) as acquisitions, "
              "SUM(cancellation_count) as cancellations FROM {table} GROUP BY dw_source_system_code "
              "ORDER BY dw_source_system_code", keys=("dw_source_system_code",)),
]
# The same queries as aggregates and groups, so that a suite can share its scans.
ACCEPTANCE_PARTS = {
    "total_subscription_count": ((("total_subscriptions", "sum(subscription_count)"),), ()),
    "total_acquisition_cancellation": ((("total_acquisitions", "sum(acquisition_count)"), ("total_cancellations", "sum(cancellation_count)")), ()),
    "subscription_by_date": ((("total", "sum(subscription_count)"),), (("report_date", "report_date"),)),
    "subscription_by_masthead": ((("total", "sum(subscription_count)"),), (("masthead", "masthead"),)),
    "row_count_and_date_range": ((("row_count", "count(*)"), ("min_date", "min(report_date)"), ("max_date", "max(report_date)"),
               ("distinct_dates", "count(DISTINCT report_date)")), ()),
}
EXAMPLE_PARTS = {
    "total_subscription_count": ((("total", "sum(subscription_count)"),), ()),
    "total_acquisition_count": ((("total", "sum(acquisition_count)"),), ()),
    "total_cancellation_count": ((("total", "sum(cancellation_count)"),), ()),
    "subscription_by_masthead": ((("total_subscriptions", "sum(subscription_count)"),), (("masthead", "masthead"),)),
    "subscription_by_date": ((("total_subscriptions", "sum(subscription_count)"),), (("report_date", "report_date"),)),
    "acquisition_by_classification": ((("total_acquisitions", "sum(acquisition_count)"),), (("classification_level_1", "classification_level_1"),)),
    "subscription_by_delivery_medium": ((("total_subscriptions", "sum(subscription_count)"),), (("delivery_medium_type", "delivery_medium_type"),)),
    "average_subscription_by_offer_category": ((("avg_subscriptions", "avg(subscription_count)"),), (("offer_category_name", "offer_category_name"),)),
    "total_rows_by_date_range": ((("row_count", "count(*)"),), (("month", "trunc(report_date, 'MM')"),)),
    "subscription_movement_by_source_system": ((("total", "sum(subscription_count)"), ("acquisitions", "sum(acquisition_count)"), ("cancellations", "sum(cancellation_count)")), (("dw_source_system_code", "dw_source_system_code"),)),
}


def _with_parts(suite: list[QuerySpec], parts: dict) -> list[QuerySpec]:
    return [replace(q, aggs=parts[q.name][0], groups=parts[q.name][1]) for q in suite]


ACCEPTANCE_SUITE, EXAMPLE_SUITE = _with_parts(ACCEPTANCE_SUITE, ACCEPTANCE_PARTS), _with_parts(EXAMPLE_SUITE, EXAMPLE_PARTS)
# The built-in default suite is the first seven examples, all treated as critical.
DEFAULT_SUITE = [replace(q, critical=True) for q in EXAMPLE_SUITE[:7]]
# ---------------------------------------------------------------------------


def run_query(spark: SparkSession, spec: QuerySpec, df: DataFrame, start=None, end=None,
              date_col: str = "report_date") -> DataFrame:
    """One suite query on one table, after the optional date window."""
    return spark.sql(spec.sql, table=date_window(df, date_col, start, end))


def _error_row(spark: SparkSession, spec: QuerySpec, exc: Exception) -> DataFrame:
    msg = f"Query execution failed: {type(exc).__name__}: {exc}"
    from ledgermatch.sources.catalog import small_frame
    return small_frame(spark, [("query", spec.name, False, None, None, None, None, None, msg)], RESULT_ROW)


def compare_query(spark: SparkSession, spec: QuerySpec, new: DataFrame, old: DataFrame,
                  tol: float = 0.01, start=None, end=None) -> DataFrame:
    """R8-R10 for one query: a result row (lazy). A query that fails to analyse
    becomes a failed row and the suite goes on (R7)."""
    try:
        a = run_query(spark, spec, new, start, end)
        b = run_query(spark, spec, old, start, end)
        if list(a.columns) != list(b.columns):
            raise ValueError(f"Column mismatch: {a.columns} vs {b.columns}")
        # Without declared keys the columns that are not numbers identify a row.
        keys = (list(spec.keys) if spec.keys is not None
                else [f.name for f in a.schema.fields if not isinstance(f.dataType, NUMERIC)])
        if len(a.columns) == 1 and not keys:
            out = compare_scalar(a, b, tol, spec.name)
        else:
            out = summarize_cells(compare_cells(a, b, keys, tol), spec.name)
            out = out.select("*", F.lit(None).cast("string").alias("cdl_value"),
                             F.lit(None).cast("string").alias("target_value"))
        return out.select(
            "validation_type", "check_name", "passed",
            (F.col("total_rows") if "total_rows" in out.columns else F.lit(None).cast("bigint")).alias("total_rows"),
            (F.col("mismatched_rows") if "mismatched_rows" in out.columns else
             F.when(F.col("passed"), 0).otherwise(1).cast("bigint")).alias("mismatched_rows"),
            "max_delta", "cdl_value", "target_value",
            F.when(F.col("passed"), F.lit(None)).otherwise(F.lit("Results do not match")).alias("error_message"))
    except (PySparkException, ValueError, KeyError, IndexError) as exc:   # the last two: names in braces in the SQL text
        return _error_row(spark, spec, exc)


RESULT_ROW = ("validation_type string, check_name string, passed boolean, total_rows bigint, mismatched_rows bigint, max_delta double, "
              "cdl_value string, target_value string, error_message string")


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESULT_ROW + ", critical boolean, ordinal int")


def run_suite(spark: SparkSession, suite: list[QuerySpec], new: DataFrame, old: DataFrame,
              tol: float = 0.01, start=None, end=None, isolate: bool = False, limit_sec: float | None = None) -> DataFrame:
    """All queries of a suite on both tables: one result row per query, plus
    ``critical`` and the suite position ``ordinal``.

    Queries that name their aggregates share one scan of each table
    (``plans.fused``); the others are compared one by one. With ``isolate`` the
    queries run at once, those on their own at the same time as each other
    (``plans.isolation``): one that fails at run time, or takes longer than
    ``limit_sec`` seconds, is one failed row, and later uses of the rows run
    nothing again. If the shared scan fails, its queries run on their own.
    """
    from ledgermatch.plans.fused import FusedChecks, fits
    from ledgermatch.plans.isolation import Failed, first_rows
    from ledgermatch.plans.results import union_all
    from ledgermatch.sources.catalog import small_frame

    a, b = date_window(new, "report_date", start, end), date_window(old, "report_date", start, end)
    shared = [i for i, q in enumerate(suite) if fits(q, a, b)]
    alone = [i for i in range(len(suite)) if i not in shared]

    def own(i: int) -> DataFrame:
        row = compare_query(spark, suite[i], new, old, tol, start, end)
        return row.select("*", F.lit(bool(suite[i].critical)).alias("critical"), F.lit(i + 1).alias("ordinal"))

    def fused() -> DataFrame:
        places = F.array(*[F.lit(i + 1) for i in shared])
        return FusedChecks(a, b, [suite[i] for i in shared], tol).result_rows().withColumn("ordinal", F.element_at(places, F.col("ordinal")))

    if not isolate:
        parts = ([fused()] if shared else []) + [own(i) for i in alone]
        return union_all(parts) if parts else _empty(spark)
    rows = []
    if shared:
        answer = first_rows(spark, {"suite": fused}, limit_sec, many=True)["suite"]
        if isinstance(answer, Failed):
            alone = list(range(len(suite)))
        else:
            rows += [tuple(r) for r in answer]
    answers = first_rows(spark, {str(i): (lambda i=i: own(i)) for i in alone}, limit_sec)
    for i, answer in ((int(k), v) for k, v in answers.items()):
        if isinstance(answer, Failed):
            rows.append(("query", suite[i].name, False, None, None, None, None, None, f"Query execution failed: {answer.message}",
                         bool(suite[i].critical), i + 1))
        else:
            rows.append(tuple(answer))
    return small_frame(spark, rows, RESULT_ROW + ", critical boolean, ordinal int") if rows else _empty(spark)


def acceptance_rows(results: DataFrame, cdl_table: str = "new", target_table: str = "old") -> DataFrame:
    """SK3: one report row per query; on error the message stands in the CDL value."""
    failed_err = (~F.col("passed")) & F.col("error_message").isNotNull() & F.col("cdl_value").isNull()
    return results.select(
        F.lit(cdl_table).alias("cdl_table"), F.lit(target_table).alias("target_table"),
        F.col("check_name").alias("metric"),
        F.when(failed_err, F.col("error_message")).otherwise(F.col("cdl_value")).alias("cdl_value"),
        F.col("target_value").alias("target_value"),
        F.col("max_delta").alias("variance"),
        F.when(F.col("passed"), "PASS").otherwise("FAIL").alias("result"))


def acceptance_decision(results: DataFrame, tol: float = 0.01) -> DataFrame:
    """R20/SK4 in one aggregate: accepted iff there is at least one critical
    query and every critical query passed (S17: an empty critical set is not
    an acceptance)."""
    crit, ok = F.col("critical"), F.col("passed")
    d = results.agg(
        F.count(F.lit(1)).alias("total_queries"),
        F.count_if(crit).alias("critical_queries"),
        F.count_if(crit & ok).alias("critical_passed"),
        F.count_if(crit & ~ok).alias("critical_failed"),
        F.count_if(~crit).alias("non_critical_queries"),
        F.count_if(~crit & ok).alias("non_critical_passed"),
        F.count_if(~ok).alias("failed_queries"),
        F.sort_array(F.collect_list(F.when(crit & ~ok, F.col("check_name")))).alias("failed_critical"))
    return d.select(
        ((F.col("critical_queries") > 0) & (F.col("critical_failed") == 0)).alias("migration_accepted"),
        (F.col("failed_queries") == 0).alias("all_queries_passed"),
        "total_queries", "critical_queries", "critical_passed", "critical_failed",
        "non_critical_queries", "non_critical_passed",
        F.when(F.col("critical_queries") > 0, F.col("critical_passed") * 100.0 / F.col("critical_queries"))
         .otherwise(F.lit(0.0)).alias("critical_pass_rate"),
        F.lit(float(tol)).alias("tolerance"),
        F.when(F.col("critical_queries") == 0, F.lit("no critical query in the suite"))
         .when(F.col("critical_failed") > 0, F.lit("critical queries failed"))
         .otherwise(F.lit(None)).alias("reason"),
        "failed_critical")
