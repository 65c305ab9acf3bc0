"""One results table for every check (FIXTURES F9) and its roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_FIELDS = [
    ("validation_type", "string"), ("check_name", "string"), ("passed", "boolean"),
    ("total_rows", "bigint"), ("mismatched_rows", "bigint"), ("max_delta", "double"),
    ("cdl_value", "string"), ("target_value", "string"),
    ("details", "map<string,string>"), ("error_message", "string"),
]
RESULT_COLUMNS = [n for n, _ in RESULT_FIELDS]


def conform(df: DataFrame) -> DataFrame:
    """Project any check output onto the common result schema (missing = null)."""
    cols = []
    for name, typ in RESULT_FIELDS:
        c = F.col(name) if name in df.columns else F.lit(None)
        cols.append(c.cast(typ).alias(name))
    return df.select(*cols)


def union_all(dfs: list[DataFrame]) -> DataFrame:
    """Union by name as a balanced tree: each step analyses a plan of log depth,
    not the ever-growing left-deep chain."""
    dfs = list(dfs)
    while len(dfs) > 1:
        dfs = [dfs[i].unionByName(dfs[i + 1]) if i + 1 < len(dfs) else dfs[i] for i in range(0, len(dfs), 2)]
    return dfs[0]


def union_results(*dfs: DataFrame) -> DataFrame:
    return union_all([conform(d) for d in dfs])


def rollup(results: DataFrame) -> DataFrame:
    """Totals per validation type plus an ``ALL`` row, in one aggregation.

    ``rollup`` computes both grouping levels from one partial aggregate, so the
    results table is read once whatever its size.
    """
    g = results.rollup("validation_type").agg(
        F.grouping("validation_type").alias("__g"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.coalesce(F.col("passed"), F.lit(False))).alias("passed"),
        F.count_if(~F.coalesce(F.col("passed"), F.lit(False))).alias("failed"))
    return g.select(
        F.when(F.col("__g") == 1, F.lit("ALL")).otherwise(F.col("validation_type")).alias("validation_type"),
        "total", "passed", "failed",
        F.when(F.col("total") > 0, F.col("passed") * 100.0 / F.col("total")).otherwise(F.lit(0.0))
         .alias("pass_rate"))
