"""The acceptance report as one nested row (SK2, SK4), written as JSON and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermatch.plans.fused import FusedChecks, mismatch_samples
from ledgermatch.session import materialize, shared_dir
from ledgermatch.sources.files import write_results


def acceptance_document(checks: FusedChecks, new_table: str = "new", old_table: str = "old", start=None, end=None,
                        samples: int = 5) -> DataFrame:
    """One row: decision, tables, window, tolerance, counts, and per failed
    query its name, whether it is critical, its error, how many cells differ
    and the first ``samples`` of them with both values.

    The cells are written once; counts and samples read that table. Only failed
    queries and their samples are gathered, both bounded by the suite.
    """
    cells = materialize(checks.entries(), "cells")
    rows = checks.result_rows(cells)
    sample = mismatch_samples(cells, checks.names(), samples)
    listed = sample.groupBy("check_name").agg(
        F.max("total_mismatches").alias("total_mismatches"),
        F.transform(F.array_sort(F.collect_list(F.struct("sample_rank", "row_key", "column_name", "cdl_value", "target_value", "delta", "status"))),
                    lambda s: s.dropFields("sample_rank")).alias("mismatches"))
    failed = rows.filter(~F.col("passed")).join(F.broadcast(listed), "check_name", "left")      # a row per failed query
    entry = F.struct("ordinal", F.col("check_name").alias("name"), F.col("validation_type").alias("type"), "critical",
                     F.col("error_message").alias("error"), "total_mismatches", "max_delta", "mismatches")
    crit, ok = F.col("critical"), F.col("passed")
    counts = rows.agg(F.count(F.lit(1)).alias("total"), F.count_if(ok).alias("passed"), F.count_if(crit).alias("critical_total"),
                      F.count_if(crit & ok).alias("critical_passed"))
    gathered = failed.agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e.dropFields("ordinal")).alias("failed_queries"))
    rate = lambda p, t: F.when(t > 0, p * 100.0 / t).otherwise(F.lit(0.0))
    section = lambda p, t: F.struct(t.alias("total"), p.alias("passed"), (t - p).alias("failed"), rate(p, t).alias("pass_rate"))
    date = lambda d: F.lit(None if d is None else str(d)).cast("string")
    p, t, cp, ct = (F.col(c) for c in ("passed", "total", "critical_passed", "critical_total"))
    one = counts.withColumn("__k", F.lit(1)).join(gathered.withColumn("__k", F.lit(1)), "__k")
    return one.select(((ct > 0) & (cp == ct)).alias("migration_accepted"), (p == t).alias("all_queries_passed"),
                      F.lit(new_table).alias("cdl_table"), F.lit(old_table).alias("target_table"),
                      F.struct(date(start).alias("start"), date(end).alias("end")).alias("window"), F.lit(float(checks.tol)).alias("tolerance"),
                      section(p, t).alias("queries"), section(cp, ct).alias("critical_queries"), "failed_queries")


def written_document(document: DataFrame, name: str = "acceptance") -> DataFrame:
    """The document written as one JSON line to the shared folder and read back with its schema."""
    path = shared_dir(document.sparkSession, name)
    write_results(document, path, "json")
    return document.sparkSession.read.schema(document.schema).json(path)
