"""Table-level checks.

Quantity, null and profile checks read each table once: every measure of
every column is one aggregate expression of a single ``agg``; the one-row
answer is unpivoted and the two sides are aligned by column name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.operators.joins import side_by_side
from ledgermatch.sources.catalog import column_catalog, small_frame

# Fixed value: the key columns whose distinct counts and null rates are compared.
QUANTITY_KEY_COLUMNS = ["report_date", "masthead", "classification_level_1", "offer_category_name",
                        "delivery_medium_type", "dw_source_system_code"]


def _stack(one_row: DataFrame, entries: list[tuple[str, dict[str, str]]]) -> DataFrame:
    """Unpivot a one-row aggregate: one output row per entry, fields from columns."""
    structs = [F.struct(F.lit(name).alias("column_name"), *[F.col(src).alias(dst) for dst, src in fields.items()])
               for name, fields in entries]
    return one_row.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


# ----------------------------------------------------------------- schema ----

def schema_compare(spark: SparkSession, new: DataFrame | T.StructType, old: DataFrame | T.StructType) -> DataFrame:
    """Per-column schema comparison (J7): presence, type and nullability on both sides."""
    cat = column_catalog(spark, {"new": new, "old": old})
    pair = side_by_side(cat.filter("table_name = 'new'"), cat.filter("table_name = 'old'"), ["column_name"],
                        ["data_type", "is_nullable", "ordinal_position"], agg="max")
    return pair.select(
        "column_name", F.col("in_new"), F.col("in_old"),
        F.col("ordinal_position_new").alias("new_position"), F.col("ordinal_position_old").alias("old_position"),
        F.col("data_type_new").alias("new_type"), F.col("data_type_old").alias("old_type"),
        F.col("is_nullable_new").alias("new_nullable"), F.col("is_nullable_old").alias("old_nullable"))


def schema_checks(spark: SparkSession, new, old) -> DataFrame:
    """R1-R3 as three result rows: column names, data types, nullability."""
    s = schema_compare(spark, new, old)
    both = F.col("in_new") & F.col("in_old")
    one = s.agg(
        F.count_if(F.col("in_new")).alias("new_columns"), F.count_if(F.col("in_old")).alias("old_columns"),
        F.count_if(both).alias("common"),
        F.count_if(F.col("in_new") & ~F.col("in_old")).alias("new_only"),
        F.count_if(F.col("in_old") & ~F.col("in_new")).alias("old_only"),
        F.count_if(both & (F.col("new_type") != F.col("old_type"))).alias("type_mm"),
        F.count_if(both & (F.col("new_nullable") != F.col("old_nullable"))).alias("null_mm"),
        F.sort_array(F.collect_list(F.when(F.col("in_new") & ~F.col("in_old"), F.col("column_name")))).alias("lnew"),
        F.sort_array(F.collect_list(F.when(F.col("in_old") & ~F.col("in_new"), F.col("column_name")))).alias("lold"),
        F.sort_array(F.collect_list(F.when(both & (F.col("new_type") != F.col("old_type")),
                                           F.concat_ws(":", "column_name", "new_type", "old_type")))).alias("ltype"),
        F.sort_array(F.collect_list(F.when(both & (F.col("new_nullable") != F.col("old_nullable")),
                                           F.col("column_name")))).alias("lnull"))
    rows = [
        ("column_names", (F.col("new_only") + F.col("old_only")), F.col("common"),
         F.create_map(F.lit("cdl_only"), F.concat_ws(",", "lnew"), F.lit("target_only"), F.concat_ws(",", "lold")),
         F.format_string("Column mismatch: %d in CDL only, %d in target only", "new_only", "old_only")),
        ("data_types", F.col("type_mm"), F.col("common"),
         F.create_map(F.lit("type_mismatches"), F.concat_ws(",", "ltype")),
         F.format_string("%d data type mismatches", "type_mm")),
        ("nullability", F.col("null_mm"), F.col("common"),
         F.create_map(F.lit("nullability_mismatches"), F.concat_ws(",", "lnull")),
         F.format_string("%d nullability mismatches", "null_mm")),
    ]
    structs = [F.struct(F.lit(n).alias("check_name"), mm.cast("bigint").alias("mismatched_rows"),
                        tot.cast("bigint").alias("total_rows"), det.alias("details"), msg.alias("msg"))
               for n, mm, tot, det, msg in rows]
    return one.select(F.explode(F.array(*structs)).alias("r")).select(
        F.lit("schema").alias("validation_type"), "r.check_name", (F.col("r.mismatched_rows") == 0).alias("passed"),
        "r.total_rows", "r.mismatched_rows", "r.details",
        F.when(F.col("r.mismatched_rows") > 0, F.col("r.msg")).alias("error_message"))


def narrowed(df: DataFrame, where: str | None) -> DataFrame:
    """The rows a check is asked for: ``where`` is a Spark SQL condition on the
    table's columns, pushed into its scan; None is the whole table."""
    return df if where is None else df.filter(F.expr(where))


def column_fill(df: DataFrame) -> DataFrame:
    """(column_name, populated_rows, null_rows) of every column, one aggregate."""
    one = df.agg(F.count(F.lit(1)).alias("rc"), *[F.count(F.col(c)).alias(f"p{i}") for i, c in enumerate(df.columns)])
    out = _stack(one, [(c, {"row_count": "rc", "populated_rows": f"p{i}"}) for i, c in enumerate(df.columns)])
    return out.select("column_name", "populated_rows", (F.col("row_count") - F.col("populated_rows")).alias("null_rows"))


def schema_checks_on_data(spark: SparkSession, new: DataFrame, old: DataFrame) -> DataFrame:
    """R1-R3 with what is at stake: each check's row also has the number of
    populated cells, on both sides, in the columns that it finds to differ."""
    s = (schema_compare(spark, new, old)
         .join(column_fill(new).select("column_name", F.col("populated_rows").alias("fill_new")), "column_name", "left")
         .join(column_fill(old).select("column_name", F.col("populated_rows").alias("fill_old")), "column_name", "left"))
    both = F.col("in_new") & F.col("in_old")
    cells = F.coalesce("fill_new", F.lit(0)) + F.coalesce("fill_old", F.lit(0))
    differs = {"column_names": ~both, "data_types": both & (F.col("new_type") != F.col("old_type")),
               "nullability": both & (F.col("new_nullable") != F.col("old_nullable"))}
    one = s.agg(*[F.coalesce(F.sum(F.when(c, cells)), F.lit(0)).alias(n) for n, c in differs.items()])
    touched = one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("affected_cells")) for n in differs])).alias("r")).select("r.*")
    return schema_checks(spark, new, old).join(F.broadcast(touched), "check_name")     # three rows


def observed_nulls(new: DataFrame, old: DataFrame, where: str | None = None) -> DataFrame:
    """Observed nullability: does a column hold any null? One scan per side."""
    new, old = narrowed(new, where), narrowed(old, where)

    def side(df):
        one = df.agg(*[F.max(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)])
        return _stack(one, [(c, {"has_null": f"n{i}"}) for i, c in enumerate(df.columns)])
    pair = side_by_side(side(new), side(old), ["column_name"], ["has_null"], agg="max")
    return pair.select("column_name", F.col("has_null_new").alias("new_has_null"),
                       F.col("has_null_old").alias("old_has_null"),
                       (F.col("in_new") & F.col("in_old") & F.col("has_null_new").eqNullSafe(F.col("has_null_old")))
                       .alias("passed"))


# --------------------------------------------------------------- quantity ----

def null_profile(df: DataFrame, columns: Iterable[str], where: str | None = None) -> DataFrame:
    """Rows, null count and null rate of each column (A9): one plain aggregate,
    without the row copies that exact distinct counts cost."""
    cols = [c for c in columns if c in df.columns]
    one = narrowed(df, where).agg(F.count(F.lit(1)).alias("rc"), *[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(cols)])
    out = _stack(one, [(c, {"row_count": "rc", "null_count": f"n{i}"}) for i, c in enumerate(cols)])
    return out.withColumn("null_rate", F.col("null_count") / F.nullif(F.col("row_count"), F.lit(0)))


def _rates_match(rn, ro, tol: float):
    return F.when(rn.isNull() & ro.isNull(), True).when(rn.isNull() | ro.isNull(), False).otherwise(F.abs(rn - ro) <= F.lit(tol))


def null_rate_compare(new: DataFrame, old: DataFrame, columns=QUANTITY_KEY_COLUMNS, tol: float = 0.01, where: str | None = None) -> DataFrame:
    """R6 alone, per column present on both sides."""
    cols = [c for c in columns if c in new.columns and c in old.columns]
    pair = side_by_side(null_profile(new, cols, where), null_profile(old, cols, where), ["column_name"], ["null_rate"], agg="max")
    rn, ro = F.col("null_rate_new"), F.col("null_rate_old")
    return pair.select("column_name", rn.alias("cdl_null_rate"), ro.alias("target_null_rate"),
                       F.abs(rn - ro).alias("null_rate_difference"), _rates_match(rn, ro, tol).alias("null_rate_match"))


def quantity_profile(df: DataFrame, columns: Iterable[str], approx: bool = False, where: str | None = None) -> DataFrame:
    """Rows, exact distinct count and null count of each column in ONE aggregate.

    Output: one row per column (``column_name``, ``row_count``,
    ``distinct_count``, ``null_count``, ``null_rate``). Several exact distinct
    counts plan as Expand + two-level aggregation; every stage is partial.
    ``approx=True`` swaps in HyperLogLog++ (``approx_count_distinct``): one
    pass, fixed memory per column, about 5% error (A8 opt-in).
    """
    df = narrowed(df, where)
    cols = [c for c in columns if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("rc")]
    for i, c in enumerate(cols):
        dc = F.approx_count_distinct(F.col(c)) if approx else F.countDistinct(F.col(c))
        aggs += [dc.alias(f"d{i}"), F.count_if(F.col(c).isNull()).alias(f"n{i}")]
    one = df.agg(*aggs)
    out = _stack(one, [(c, {"row_count": "rc", "distinct_count": f"d{i}", "null_count": f"n{i}"})
                       for i, c in enumerate(cols)])
    # The null rate of an empty table is null, not a division error.
    return out.withColumn("null_rate", F.col("null_count") / F.nullif(F.col("row_count"), F.lit(0)))


def row_count_check(new: DataFrame, old: DataFrame, where: str | None = None) -> DataFrame:
    """Equal row counts; absolute and percent difference (percent of the new side)."""
    new, old = narrowed(new, where), narrowed(old, where)
    pair = side_by_side(new.select(F.lit(1).alias("x")), old.select(F.lit(1).alias("x")), [], ["x"], agg="sum")
    a = F.coalesce(F.col("x_new"), F.lit(0)).cast("bigint")
    b = F.coalesce(F.col("x_old"), F.lit(0)).cast("bigint")
    return pair.select(
        F.lit("quantity").alias("validation_type"), F.lit("row_count").alias("check_name"),
        (a == b).alias("passed"), a.alias("cdl_count"), b.alias("target_count"),
        F.abs(a - b).alias("difference"),
        (F.abs(a - b).cast("double") / F.greatest(a, F.lit(1)) * 100).alias("percent_diff"))


def quantity_compare(new: DataFrame, old: DataFrame, columns=QUANTITY_KEY_COLUMNS, tol: float = 0.01,
                     approx: bool = False, where: str | None = None) -> DataFrame:
    """R5 and R6 per column: distinct counts must be equal, null rates within ``tol``.

    Only columns present on both sides are checked (as the reference does).
    """
    cols = [c for c in columns if c in new.columns and c in old.columns]
    pair = side_by_side(quantity_profile(new, cols, approx, where), quantity_profile(old, cols, approx, where), ["column_name"],
                        ["distinct_count", "null_rate"], agg="max")
    dn, do = F.col("distinct_count_new"), F.col("distinct_count_old")
    rn, ro = F.col("null_rate_new"), F.col("null_rate_old")
    rate_ok = _rates_match(rn, ro, tol)
    return pair.select("column_name", dn.alias("cdl_distinct"), do.alias("target_distinct"),
                       (dn == do).alias("distinct_match"), rn.alias("cdl_null_rate"), ro.alias("target_null_rate"),
                       F.abs(rn - ro).alias("null_rate_difference"), rate_ok.alias("null_rate_match"))


# ----------------------------------------------------- required columns ----

# ``alias.column`` references in rule text
COLUMN_REF = r"\b([A-Za-z_][A-Za-z0-9_]*)\.([A-Za-z_][A-Za-z0-9_]*)\b"


def required_columns(spark: SparkSession, rules: Iterable[Mapping],
                     fields=("source_expression", "join_condition", "filter_expression")) -> DataFrame:
    """PF13: every ``alias.column`` referenced by rule expressions, lower-cased.

    The rule table becomes a DataFrame; extraction is ``regexp_extract_all`` +
    ``explode`` + ``distinct``.
    """
    texts = []
    for r in rules:
        for f in fields:
            v = r.get(f)
            if v is not None and str(v).strip():
                texts.append((str(r.get("cte_name", "")), str(v)))
    df = small_frame(spark, texts, "cte_name string, expr string")
    refs = F.regexp_extract_all(F.regexp_replace("expr", "`", ""), F.lit(COLUMN_REF), 0)
    return (df.select(F.explode(refs).alias("ref"))
              .select(F.lower(F.split("ref", r"\.").getItem(0)).alias("table_alias"),
                      F.lower(F.split("ref", r"\.").getItem(1)).alias("column_name"))
              .distinct())


def missing_columns(required: DataFrame, available: DataFrame) -> DataFrame:
    """Required (alias, column) pairs absent from the available catalog,
    compared case-insensitively. ``available`` has ``table_alias``, ``column_name``."""
    avail = available.select(F.lower("table_alias").alias("table_alias"),
                             F.lower("column_name").alias("column_name")).distinct()
    return required.join(avail, ["table_alias", "column_name"], "left_anti")


# ------------------------------------------------------ value-level checks ----

def domain_violations(df: DataFrame, column: str, allowed: list[str], where: str | None = None) -> DataFrame:
    """Distinct non-null values outside the allowed set, with their row counts."""
    return (narrowed(df, where).filter(F.col(column).isNotNull() & ~F.col(column).isin(allowed))
              .groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))
              .select(F.lit(column).alias("column_name"), "value", "rows"))


def non_negative(df: DataFrame, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """Columns whose name contains ``count`` must not be negative.

    One aggregate for all columns: negatives, min, max, mean and null rate.
    """
    df = narrowed(df, where)
    cols = columns or [c for c in df.columns if "count" in c.lower()]
    aggs = [F.count(F.lit(1)).alias("rc")]
    for i, c in enumerate(cols):
        x = F.col(c).try_cast("double")
        aggs += [F.count_if(x < 0).alias(f"neg{i}"), F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}")]
    one = df.agg(*aggs)
    out = _stack(one, [(c, {"total_rows": "rc", "negative_rows": f"neg{i}", "min_value": f"mn{i}",
                            "max_value": f"mx{i}"}) for i, c in enumerate(cols)])
    return out.withColumn("passed", F.col("negative_rows") == 0)


def numeric_profile(df: DataFrame, columns: list[str], where: str | None = None) -> DataFrame:
    """Min, max, mean and null % after a lenient numeric parse, one aggregate."""
    df = narrowed(df, where)
    aggs = [F.count(F.lit(1)).alias("rc")]
    for i, c in enumerate(columns):
        x = F.col(c).try_cast("double")
        aggs += [F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"), F.avg(x).alias(f"av{i}"),
                 F.count_if(x.isNull()).alias(f"nn{i}")]
    one = df.agg(*aggs)
    out = _stack(one, [(c, {"total_rows": "rc", "min_value": f"mn{i}", "max_value": f"mx{i}",
                            "mean_value": f"av{i}", "null_count": f"nn{i}"}) for i, c in enumerate(columns)])
    return out.withColumn("null_pct", F.col("null_count") * 100.0 / F.nullif(F.col("total_rows"), F.lit(0)))


def column_profile(df: DataFrame, columns: list[str], where: str | None = None) -> DataFrame:
    """Null % and exact distinct values per column (informational, always passes)."""
    prof = quantity_profile(df, columns, where=where)
    return prof.select("column_name", F.col("row_count").alias("total_rows"), "null_count",
                       (F.col("null_count") * 100.0 / F.nullif(F.col("row_count"), F.lit(0))).alias("null_pct"),
                       "distinct_count")


def derived_metric_check(df: DataFrame, formulas: Mapping[str, str], tol: float = 0.01, where: str | None = None) -> DataFrame:
    """Recompute each derived metric within the row and compare.

    A formula whose inputs or target are missing fails with a message (S15);
    a null recomputation against a value counts as a mismatch (S14).
    """
    df = narrowed(df, where)
    ok, broken = [], []
    for name, expr in formulas.items():
        try:   # Catalyst knows functions, cases of names and types
            df.select(F.expr(expr).cast("double"), F.col(name).cast("double")).schema
            ok.append((name, expr, None))
        except PySparkException as exc:
            missing = (exc.getMessageParameters() or {}).get("objectName") if "UNRESOLVED_COLUMN" in str(exc.getCondition()) else None
            broken.append((name, expr, f"Missing dependencies: {missing.replace('`', '')}" if missing else f"Invalid formula: {exc}"))
    aggs = [F.count(F.lit(1)).alias("rc")]
    for i, (name, expr, _) in enumerate(ok):
        calc, actual = F.expr(expr).cast("double"), F.col(name).cast("double")
        d = F.abs(calc - actual)
        bad = F.when(calc.isNull() & actual.isNull(), False).when(calc.isNull() | actual.isNull(), True) \
               .otherwise(d > F.lit(tol))
        aggs += [F.count_if(bad).alias(f"mm{i}"), F.max(d).alias(f"md{i}")]
    one = df.agg(*aggs)
    entries = [F.struct(F.lit(n).alias("check_name"), F.col(f"mm{i}").alias("mismatched_rows"),
                        F.col(f"md{i}").alias("max_delta"), F.lit(None).cast("string").alias("error_message"))
               for i, (n, _, _) in enumerate(ok)]
    entries += [F.struct(F.lit(n).alias("check_name"), F.lit(None).cast("bigint").alias("mismatched_rows"),
                         F.lit(None).cast("double").alias("max_delta"),
                         F.lit(m).alias("error_message"))
                for n, _, m in broken]
    return one.select("rc", F.explode(F.array(*entries)).alias("r")).select(
        F.lit("derived").alias("validation_type"), "r.check_name",
        (F.col("r.error_message").isNull() & (F.col("r.mismatched_rows") == 0)).alias("passed"),
        F.col("rc").alias("total_rows"), "r.mismatched_rows",
        F.coalesce(F.col("r.max_delta"), F.lit(0.0)).alias("max_delta"), "r.error_message")


def dimension_values(new: DataFrame, old: DataFrame, keys: list[str], where: str | None = None) -> DataFrame:
    """R13 (re-aimed at values): distinct dimension tuples on each side and on one side only."""
    pair = side_by_side(narrowed(new, where), narrowed(old, where), keys, [])
    inn, ino = F.col("in_new"), F.col("in_old")
    return pair.agg(F.count_if(inn).alias("new_tuples"), F.count_if(ino).alias("old_tuples"),
                    F.count_if(inn & ino).alias("common_tuples"),
                    F.count_if(inn & ~ino).alias("only_in_new"), F.count_if(ino & ~inn).alias("only_in_old")
                    ).withColumn("passed", (F.col("only_in_new") == 0) & (F.col("only_in_old") == 0))
