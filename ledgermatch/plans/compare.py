"""Comparison of two tables or two query answers.

Answers are compared as multisets of rows. Metrics are aligned with
``operators.joins.side_by_side`` (tag, union, group by key): one shuffle, null
keys equal, duplicate keys summed, hot keys pre-aggregated map-side. Per-metric summaries are computed as one
global aggregate whose single row is then unpivoted, so no step gathers a
metric's rows into one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.functions.scalars import exceeds_abs_rel
from ledgermatch.operators.joins import side_by_side
from ledgermatch.operators.ordinals import running_total
from ledgermatch.session import materialize

# Rows that are nearly all distinct stay in a task's memory until they are counted:
# a task counts this much of a file or a shuffle.
TASK_BYTES = 16 << 20
FLOATING = (T.FloatType, T.DoubleType)
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _dtype(df: DataFrame, col: str):
    return df.schema[col].dataType


def cell_match(a: Column, b: Column, floating: bool, numeric: bool, tol: float) -> Column:
    """Both null match, one-sided null mismatches; floats within ``tol``
    (equal infinities match, NaN is read as null), all other types exactly."""
    same = a == b
    if numeric and floating:
        same = same | (F.abs(a - b) <= F.lit(tol))
    return (F.when(a.isNull() & b.isNull(), F.lit(True))
            .when(a.isNull() | b.isNull(), F.lit(False))
            .otherwise(same))


def cell_delta(a: Column, b: Column, floating: bool, numeric: bool) -> Column:
    """Absolute difference as DOUBLE, taken in the exact type of the cells."""
    if not numeric:
        return F.lit(None).cast("double")
    if floating:
        return F.when(a == b, F.lit(0.0)).otherwise(F.abs(a.cast("double") - b.cast("double")))
    exact = F.try_subtract(a.cast("decimal(38,0)"), b.cast("decimal(38,0)")) if floating is None else F.try_subtract(a, b)
    return F.abs(F.coalesce(exact.cast("double"), a.cast("double") - b.cast("double")))


def _kind(new: DataFrame, old: DataFrame, col: str) -> tuple[bool | None, bool]:
    """(floating, numeric) of a cell pair; floating is None for whole numbers."""
    types = (_dtype(new, col), _dtype(old, col))
    numeric = all(isinstance(t, NUMERIC) for t in types)
    floating = any(isinstance(t, FLOATING) for t in types)
    whole = numeric and not floating and not any(isinstance(t, T.DecimalType) for t in types)
    return (None if whole else floating), numeric


def _row_counts(new: DataFrame, old: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct rows of both sides with how often each side has them.

    Each side is counted on its own first: copies are combined before any
    shuffle, and Catalyst drops a presentation sort under the count.
    """
    def side(df, name, other):
        values = [F.when(F.isnan(c), None).otherwise(F.col(c)).alias(c) if isinstance(_dtype(df, c), FLOATING) else F.col(c) for c in cols]
        counted = df.select(*values).groupBy(*cols).agg(F.count(F.lit(1)).alias("__n"))
        return counted.select(*cols, F.col("__n").alias(name), F.lit(0).cast("bigint").alias(other))
    both = side(new, "__new", "__old").unionByName(side(old, "__old", "__new"))
    return both.groupBy(*cols).agg(F.sum("__new").alias("__new"), F.sum("__old").alias("__old"))


def _paired(rest: DataFrame, keys: list[str], measures: list[str], new_name: str, old_name: str) -> DataFrame:
    """Rows of repeated keys (or of an answer without keys) paired in the order
    of their measures. A distinct row that occurs n times takes n places of its
    key and side; places come from a running total over range partitions, so
    the rows of one key are never sorted by one task."""
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(n).alias("n")) for n, s in (("__new", new_name), ("__old", old_name))])
    rows = (rest.withColumn("__s", F.explode(sides)).select(*keys, *measures, F.col("__s.side").alias("__side"), F.col("__s.n").alias("__n"))
            .filter(F.col("__n") > 0))
    order = [F.col(c).asc_nulls_last() for c in [*keys, "__side", *measures]]
    rows = running_total(rows, order, {"__end": "__n"})
    group = [*keys, "__side"]
    first = rows.groupBy(*group).agg(F.min(F.col("__end") - F.col("__n")).alias("__first")).withColumnsRenamed({c: f"__g_{c}" for c in group})
    cond = None
    for c in group:
        same = rows[c].eqNullSafe(first[f"__g_{c}"])
        cond = same if cond is None else cond & same
    u = (rows.join(first, cond).withColumn("__ord", F.explode(F.sequence(F.col("__end") - F.col("__n") - F.col("__first") + 1, F.col("__end") - F.col("__first"))))
         .select(*keys, *measures, "__side", "__ord"))
    return u.groupBy(*keys, "__ord").agg(
        *[F.max(F.when(F.col("__side") == s, F.col(m))).alias(f"{m}_{s}") for m in measures for s in (new_name, old_name)],
        *[F.max(F.col("__side") == s).alias(f"in_{s}") for s in (new_name, old_name)])


def _aligned(counts: DataFrame, keys: list[str], measures: list[str], new_name: str, old_name: str) -> DataFrame:
    """Both sides' rows next to each other: (keys, each measure of each side, in_<side>).

    Rows that both sides have are paired with each other first. Of what is
    left, a key's only row of each side is paired directly; keys with more are
    paired by ``_paired``.
    """
    both = F.least("__new", "__old")
    flags = {f"in_{new_name}": F.lit(True), f"in_{old_name}": F.lit(True)}
    out = ([*keys] + [f"{m}_{s}" for m in measures for s in (new_name, old_name)] + [f"in_{new_name}", f"in_{old_name}"])
    equal = (counts.filter(both > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), both)))
             .select(*keys, *[F.col(m).alias(f"{m}_{s}") for m in measures for s in (new_name, old_name)])
             .withColumns(flags).select(*out))
    rest = (counts.withColumns({"__new": F.col("__new") - both, "__old": F.col("__old") - both})
            .filter((F.col("__new") > 0) | (F.col("__old") > 0)))
    if not keys:
        return equal.unionByName(_paired(rest, keys, measures, new_name, old_name).select(*out))
    per_key = rest.groupBy(*keys).agg(
        F.sum("__new").alias("__new"), F.sum("__old").alias("__old"),
        *[F.max(F.when(F.col(n) > 0, F.col(m))).alias(f"{m}_{s}") for m in measures for n, s in (("__new", new_name), ("__old", old_name))])
    single = (F.col("__new") <= 1) & (F.col("__old") <= 1)
    once = (per_key.filter(single).withColumns({f"in_{new_name}": F.col("__new") > 0, f"in_{old_name}": F.col("__old") > 0}).select(*out))
    repeated = per_key.filter(~single).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    if not repeated.limit(1).count():
        return equal.unionByName(once)
    cond = None
    for i, k in enumerate(keys):
        c = rest[k].eqNullSafe(repeated[f"__k{i}"])
        cond = c if cond is None else cond & c
    again = _paired(rest.join(repeated, cond, "left_semi"), keys, measures, new_name, old_name)
    return equal.unionByName(once).unionByName(again.select(*out))


def compare_cells(new: DataFrame, old: DataFrame, keys: list[str] | None, tol: float = 0.01,
                  new_name: str = "new", old_name: str = "old") -> DataFrame:
    """Cell-by-cell comparison of two answers with the same columns.

    Rows are compared as multisets: a row on one side only is reported,
    however often its key or its copies occur. ``keys`` are the answer's
    grouping columns; when unknown (``None``), all non-floating columns act as
    keys. Rows that both sides have cancel out first, as often as both have
    them; what is left of a key that a side has more than once is paired by
    the order of its measures (survey §4.3).

    Not lazy for answers with measures: the distinct rows of both sides are
    written once, and only if a key really repeats is anything ordered.

    Output: keys, ``column_name``, ``<new>_value``, ``<old>_value`` (strings),
    ``delta`` (double, numeric cells), ``status`` in match / mismatch /
    only_<new> / only_<old>. An answer of keys alone has one row per distinct
    key, which matches if both sides have it equally often.
    """
    cols = [c for c in new.columns if c in old.columns]
    if keys is None:
        keys = [c for c in cols if not isinstance(_dtype(new, c), FLOATING) and not isinstance(_dtype(old, c), FLOATING)]
    measures = [c for c in cols if c not in keys]
    counts = _row_counts(new, old, cols)
    if not measures:
        status = (F.when(F.col("__new") == F.col("__old"), "match").when(F.col("__old") == 0, f"only_{new_name}")
                  .when(F.col("__new") == 0, f"only_{old_name}").otherwise("mismatch"))
        none = F.lit(None).cast("string")
        return counts.select(*keys, none.alias("column_name"), none.alias(f"{new_name}_value"), none.alias(f"{old_name}_value"),
                             F.lit(None).cast("double").alias("delta"), status.alias("status"))
    pair = _aligned(materialize(counts, "answer-rows", task_bytes=TASK_BYTES), keys, measures, new_name, old_name)
    inn, ino = F.col(f"in_{new_name}"), F.col(f"in_{old_name}")
    cells = []
    for m in measures:
        floating, numeric = _kind(new, old, m)
        a, b = F.col(f"{m}_{new_name}"), F.col(f"{m}_{old_name}")
        status = (F.when(inn & ~ino, f"only_{new_name}").when(ino & ~inn, f"only_{old_name}")
                  .when(cell_match(a, b, bool(floating), numeric, tol), "match").otherwise("mismatch"))
        cells.append(F.struct(F.lit(m).alias("column_name"), a.cast("string").alias("nv"), b.cast("string").alias("ov"),
                              cell_delta(a, b, floating, numeric).alias("delta"), status.alias("status")))
    exploded = pair.select(*keys, F.explode(F.array(*cells)).alias("c"))
    return exploded.select(*keys, F.col("c.column_name").alias("column_name"),
                           F.col("c.nv").alias(f"{new_name}_value"), F.col("c.ov").alias(f"{old_name}_value"),
                           F.col("c.delta").alias("delta"), F.col("c.status").alias("status"))


def row_count_verdict(new: DataFrame, old: DataFrame, check_name: str = "row_count") -> DataFrame:
    """Both answers' row counts in one row; passes iff they are equal."""
    pair = side_by_side(new.select(F.lit(1).alias("x")), old.select(F.lit(1).alias("x")), [], [])
    a, b = F.col("__rows_new"), F.col("__rows_old")
    return pair.select(F.lit("query").alias("validation_type"), F.lit(check_name).alias("check_name"), (a == b).alias("passed"),
                       a.alias("cdl_rows"), b.alias("target_rows"), F.abs(a - b).alias("row_difference"))


def summarize_cells(cells: DataFrame, check_name: str, validation_type: str = "query") -> DataFrame:
    """One result row from a cell comparison: pass iff every cell matches."""
    bad = F.col("status") != "match"
    return cells.agg(
        F.lit(validation_type).alias("validation_type"), F.lit(check_name).alias("check_name"),
        F.count(F.lit(1)).alias("total_rows"), F.count_if(bad).alias("mismatched_rows"),
        F.max("delta").alias("max_delta")).select(
        "validation_type", "check_name", (F.col("mismatched_rows") == 0).alias("passed"),
        "total_rows", "mismatched_rows", "max_delta")


def compare_scalar(new: DataFrame, old: DataFrame, tol: float = 0.01, check_name: str = "scalar") -> DataFrame:
    """1x1 answers (R9): both null match; floats within ``tol``, integers exactly.

    Returns one row with both values, the absolute difference and the verdict.
    An answer of several rows is compared row by row; its values are not shown.
    """
    (cn,), (co,) = new.columns, old.columns
    cells = compare_cells(new.select(F.col(cn).alias("v")), old.select(F.col(co).alias("v")), [], tol)
    one = F.count(F.lit(1)) == 1
    return cells.agg(
        F.lit("query").alias("validation_type"), F.lit(check_name).alias("check_name"),
        (F.count_if(F.col("status") != "match") == 0).alias("passed"),
        F.when(one, F.max("new_value")).alias("cdl_value"), F.when(one, F.max("old_value")).alias("target_value"),
        F.max("delta").alias("max_delta"))


def _metric_delta(source: DataFrame, target: DataFrame, metric: str, a: Column, b: Column) -> Column:
    """Difference of two sums, a missing one read as 0 (S13), in their own type."""
    a, b = (F.coalesce(x, F.lit(0).cast("double" if _kind(source, target, metric)[0] else "bigint")) for x in (a, b))
    return cell_delta(a, b, *_kind(source, target, metric))


def reconcile_metrics(source: DataFrame, target: DataFrame, keys: list[str], metrics: list[str],
                      tol: float = 0.01, source_name: str = "source", target_name: str = "cdl") -> DataFrame:
    """Per-metric reconciliation on shared dimensions.

    Both sides are summed to the key first (S12); a missing value reads as 0
    (S13) but a key present on one side only fails the metric anyway. One
    shuffle aligns all metrics at once; the summary is one global aggregate.
    """
    pair = side_by_side(source, target, keys, metrics, agg="sum", new_name=source_name, old_name=target_name)
    ins, inc = F.col(f"in_{source_name}"), F.col(f"in_{target_name}")
    aggs = [F.count(F.lit(1)).alias("total_rows"),
            F.count_if(ins & ~inc).alias("only_in_source"),
            F.count_if(inc & ~ins).alias("only_in_cdl")]
    for i, m in enumerate(metrics):
        d = _metric_delta(source, target, m, F.col(f"{m}_{source_name}"), F.col(f"{m}_{target_name}"))
        aggs += [F.count_if(d > F.lit(tol)).alias(f"mm{i}"), F.max(d).alias(f"md{i}")]
    one = pair.agg(*aggs)
    per = F.explode(F.array(*[
        F.struct(F.lit(m).alias("column_name"), F.col(f"mm{i}").alias("mismatched_rows"),
                 F.col(f"md{i}").alias("max_delta")) for i, m in enumerate(metrics)])).alias("r")
    return one.select("total_rows", "only_in_source", "only_in_cdl", per).select(
        F.lit("aggregation").alias("validation_type"), F.col("r.column_name").alias("check_name"),
        ((F.col("r.mismatched_rows") == 0) & (F.col("only_in_source") == 0) & (F.col("only_in_cdl") == 0))
        .alias("passed"),
        "total_rows", F.col("r.mismatched_rows").alias("mismatched_rows"),
        F.coalesce(F.col("r.max_delta"), F.lit(0.0)).alias("max_delta"), "only_in_source", "only_in_cdl")


def metric_deltas(source: DataFrame, target: DataFrame, keys: list[str], metrics: list[str],
                  source_name: str = "source", target_name: str = "cdl", above: float | None = None) -> DataFrame:
    """Row-level view behind ``reconcile_metrics``: one row per (key, metric).

    With ``above`` only differences beyond it become rows: they are filtered
    inside each key's array, before it is exploded.
    """
    pair = side_by_side(source, target, keys, metrics, agg="sum", new_name=source_name, old_name=target_name)
    rows = []
    for m in metrics:
        s, t = F.col(f"{m}_{source_name}"), F.col(f"{m}_{target_name}")
        rows.append(F.struct(F.lit(m).alias("column_name"), s.cast("double").alias("source_value"), t.cast("double").alias("cdl_value"),
                             _metric_delta(source, target, m, s, t).alias("delta")))
    rows = F.array(*rows)
    if above is not None:
        rows = F.filter(rows, lambda r: r["delta"] > F.lit(above))
    return pair.select(*keys, f"in_{source_name}", f"in_{target_name}", F.explode(rows).alias("r")) \
               .select(*keys, f"in_{source_name}", f"in_{target_name}", "r.*")


def mismatch_sample(deltas: DataFrame, keys: list[str], tol: float = 0.01, n: int = 5,
                    by: str = "column_name") -> DataFrame:
    """First ``n`` mismatching rows per metric, largest delta first, then keys.

    ``row_number() <= n`` is planned with a window group limit: every map task
    keeps only its own top ``n`` per metric before the shuffle, so a metric
    with millions of mismatches still ships at most ``n`` rows per task.
    """
    order = [F.col("delta").desc()] + [F.col(k).asc_nulls_first() for k in keys]
    w = Window.partitionBy(by).orderBy(*order)
    return (deltas.filter(F.col("delta") > F.lit(tol))
                  .withColumn("sample_rank", F.row_number().over(w))
                  .filter(F.col("sample_rank") <= n))


def reconcile_abs_rel(new: DataFrame, old: DataFrame, keys: list[str], metrics: list[str],
                      abs_tol: float = 0.01, rel_tol: float = 0.0001) -> DataFrame:
    """A cell mismatches only when both tolerances are exceeded."""
    pair = side_by_side(new, old, keys, metrics, agg="sum")
    inn, ino = F.col("in_new"), F.col("in_old")
    aggs = [F.count(F.lit(1)).alias("total_rows"), F.count_if(inn & ~ino).alias("only_in_new"),
            F.count_if(ino & ~inn).alias("only_in_old")]
    for i, m in enumerate(metrics):
        a = F.coalesce(F.col(f"{m}_new").cast("double"), F.lit(0.0))
        b = F.coalesce(F.col(f"{m}_old").cast("double"), F.lit(0.0))
        aggs += [F.count_if(exceeds_abs_rel(a, b, abs_tol, rel_tol)).alias(f"mm{i}"),
                 F.max(F.abs(a - b)).alias(f"md{i}")]
    one = pair.agg(*aggs)
    per = F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(f"mm{i}").alias("mismatched_rows"),
                 F.col(f"md{i}").alias("max_delta")) for i, m in enumerate(metrics)])).alias("r")
    return one.select("total_rows", "only_in_new", "only_in_old", per).select(
        F.col("r.metric").alias("metric"), "total_rows", "r.mismatched_rows", "only_in_new", "only_in_old",
        F.coalesce(F.col("r.max_delta"), F.lit(0.0)).alias("max_delta"),
        ((F.col("r.mismatched_rows") == 0) & (F.col("only_in_new") == 0) & (F.col("only_in_old") == 0))
        .alias("passed"))
