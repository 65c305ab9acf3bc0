"""The three end-to-end checks, as library calls (E1-E3 of the survey).

* ``migration_acceptance``  suite on both tables -> result rows + decision
* ``table_comparison``      schema + quantity + suite -> result rows + roll-up
* ``source_validation``     rebuild from rules -> per-metric reconciliation,
                            derived metrics, domains, non-negative counts

Each returns lazy DataFrames; ``write_to`` writes them with the result sinks.
Nothing is collected except through the caller's own actions.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.functions.scalars import TENURE_GROUPS, TENURE_GROUPS_FINANCE
from ledgermatch.plans import checks as C
from ledgermatch.plans import results as R
from ledgermatch.plans import suites as Q
from ledgermatch.plans.rebuild import Rebuilder, reconcile_rebuild
from ledgermatch.sources.files import write_results


@dataclass
class RunConfig:
    """Run configuration (F8): tolerances, optional date window, output prefix."""
    tolerance: float = 0.01
    relative_tolerance: float = 0.0001
    date_filter_start: str | None = None
    date_filter_end: str | None = None
    date_column: str = "report_date"
    key_columns: list[str] = field(default_factory=lambda: list(C.QUANTITY_KEY_COLUMNS))
    output: str | None = None
    output_format: str = "parquet"


def load_suite(text_or_path: str, default_critical: bool = False) -> list[Q.QuerySpec]:
    """A query suite from JSON text or a JSON file: ``[{name, sql, critical?, keys?}]``.

    ``{table}`` (optionally back-quoted) stands for the table.
    """
    try:
        items = json.loads(text_or_path)
    except json.JSONDecodeError:
        with open(text_or_path) as fh:
            items = json.load(fh)
    return [Q.QuerySpec(i["name"], i["sql"].replace("`{table}`", "{table}"), bool(i.get("critical", default_critical)),
                        tuple(i["keys"]) if i.get("keys") is not None else None)
            for i in items]


def migration_acceptance(spark: SparkSession, new: DataFrame, old: DataFrame,
                         suite: list[Q.QuerySpec] | None = None, cfg: RunConfig | None = None) -> dict[str, DataFrame]:
    """The suite on both tables (in the date window), result rows and decision.

    Without a suite, the default suite runs with every query critical.
    """
    cfg = cfg or RunConfig()
    suite = suite or Q.DEFAULT_SUITE
    results = Q.run_suite(spark, suite, new, old, cfg.tolerance, cfg.date_filter_start, cfg.date_filter_end,
                          isolate=True)
    out = {"results": results, "rows": Q.acceptance_rows(results),
           "decision": Q.acceptance_decision(results, cfg.tolerance)}
    return write_to(out, cfg)


def table_comparison(spark: SparkSession, new: DataFrame, old: DataFrame,
                     suite: list[Q.QuerySpec] | None = None, cfg: RunConfig | None = None) -> dict[str, DataFrame]:
    """Schema (R1-R3), quantity (R4-R6) and query (R7-R10) checks, one results table."""
    cfg = cfg or RunConfig()
    q = C.quantity_compare(new, old, cfg.key_columns, cfg.tolerance)
    quantity = q.agg(
        F.count_if(~F.col("distinct_match")).alias("dmm"), F.count_if(~F.col("null_rate_match")).alias("nmm"),
        F.count(F.lit(1)).alias("n"))
    quantity_rows = quantity.select(F.explode(F.array(
        F.struct(F.lit("distinct_counts").alias("check_name"), F.col("dmm").alias("mismatched_rows")),
        F.struct(F.lit("null_rates").alias("check_name"), F.col("nmm").alias("mismatched_rows")))).alias("r"), "n") \
        .select(F.lit("quantity").alias("validation_type"), "r.check_name",
                (F.col("r.mismatched_rows") == 0).alias("passed"), F.col("n").alias("total_rows"),
                "r.mismatched_rows")
    results = R.union_results(
        C.schema_checks(spark, new, old),
        C.row_count_check(new, old).select("validation_type", "check_name", "passed",
                                           F.col("cdl_count").cast("string").alias("cdl_value"),
                                           F.col("target_count").cast("string").alias("target_value")),
        quantity_rows,
        Q.run_suite(spark, suite or Q.DEFAULT_SUITE, new, old, cfg.tolerance, cfg.date_filter_start,
                    cfg.date_filter_end, isolate=True))
    return write_to({"results": results, "quantity_detail": q, "summary": R.rollup(results)}, cfg)


def source_validation(spark: SparkSession, rebuilder: Rebuilder, published: DataFrame, keys: list[str],
                      metrics: list[str], derived: dict[str, str] | None = None,
                      cfg: RunConfig | None = None, target: str = "final_select") -> dict[str, DataFrame]:
    """Rebuild ``target`` from the rules and reconcile it with the published table,
    plus derived-metric, domain and non-negative checks on the published table."""
    cfg = cfg or RunConfig()
    parts = [reconcile_rebuild(spark, rebuilder, published, keys, metrics, cfg.tolerance, target)]
    if derived:
        parts.append(C.derived_metric_check(published, derived, cfg.tolerance))
    domain = []
    for col, allowed in (("tenure_group", TENURE_GROUPS), ("tenure_group_finance", TENURE_GROUPS_FINANCE)):
        if col in published.columns:
            v = C.domain_violations(published, col, allowed)
            domain.append(v.agg(F.lit("domain").alias("validation_type"), F.lit(col).alias("check_name"),
                                (F.count(F.lit(1)) == 0).alias("passed"),
                                F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("mismatched_rows")))
    counts = [c for c in published.columns if "count" in c.lower()]
    if counts:
        nn = C.non_negative(published, counts)
        parts.append(nn.select(F.lit("non_negative").alias("validation_type"), F.col("column_name").alias("check_name"),
                               "passed", "total_rows", F.col("negative_rows").alias("mismatched_rows")))
    results = R.union_results(*parts, *domain)
    return write_to({"results": results, "summary": R.rollup(results)}, cfg)


def write_to(frames: dict[str, DataFrame], cfg: RunConfig) -> dict[str, DataFrame]:
    """Write every frame under ``cfg.output`` (one folder each) when an output is set."""
    if cfg.output:
        for name, df in frames.items():
            write_results(df, f"{cfg.output.rstrip('/')}/{name}", cfg.output_format)
    return frames
