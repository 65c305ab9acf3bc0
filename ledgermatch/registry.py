"""Registered queries: one per operator of SURVEY §2 (keys of §7.3).

Every query reads the given test tables (through the fixtures) over whole
tables; each takes ``(spark, sf_dir)`` and returns a lazy DataFrame.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgermatch.functions import scalars as S
from ledgermatch.operators import aggregates as A
from ledgermatch.operators import filters as PF
from ledgermatch.operators import joins as J
from ledgermatch.plans import checks as C
from ledgermatch.plans import compare as CMP
from ledgermatch.plans.fused import FusedChecks, mismatch_samples
from ledgermatch.plans import results as R
from ledgermatch.plans import suites as Q
from ledgermatch.plans.rebuild import Rebuilder, reconcile_rebuild
from ledgermatch.plans.report import acceptance_document, written_document
from ledgermatch.plans.subscription_rules import subscription_rules
from ledgermatch.session import materialize, session_key, shared_dir
from ledgermatch.sources import fixtures as fx
from ledgermatch.sources.catalog import column_catalog
from ledgermatch.sources.files import read_csv_lenient
from ledgermatch.sources.tables import read_table

TOL = 0.01
LO, HI = fx.WINDOW_LO, fx.WINDOW_HI
MONTH_LO, MONTH_HI = dt.date(1998, 2, 1), dt.date(1998, 2, 28)
START_ONLY = dt.date(1998, 3, 1)
START, END = "dw_effective_start_datetime", "dw_effective_end_datetime"
# Dimensions shared by the rebuilt/new table and the published/old one
# (the old copy lacks ``sunday_flag``).
SHARED_DIMS = [d for d in fx.LAYER_DIMS if d != "sunday_flag"]
PROFILE_COLUMNS = ["masthead", "classification_level_1", "offer_category_name", "delivery_medium_type",
                   "tenure_group", "tenure_group_finance"]
COUNT_COLUMNS = ["subscription_count"] + fx.MOVEMENT_METRICS

# The metric spec of the reference's configuration.
SPEC_DIMENSIONS = ["report_date", "offer_category_name", "masthead", "dw_billing_system_code",
                   "frontbook_backbook_group_name"]
SPEC_METRICS = {
    "subscription_count": "COUNT(*)",
    "acquisition_count": "SUM(acquisition_count)",
    "cancellation_count": "SUM(cancellation_count)",
    "TotalAcquisition": "SUM(TotalAcquisition)",
    "NetAcquisition": "SUM(NetAcquisition)",
    "NetCancellation": "SUM(NetCancellation)",
}
SPEC_ABS_TOL, SPEC_REL_TOL = 0.01, 0.0001


def new_layer(spark, sf):
    return fx.at_rest(spark, sf)["layer_new"]


def old_layer(spark, sf):
    return fx.at_rest(spark, sf)["layer_old"]


def sbf(spark, sf):
    return fx.at_rest(spark, sf)["sbf"]


def smf(spark, sf, windowed: bool = False):
    df = fx.at_rest(spark, sf)["smf"]
    return PF.date_window(df, "report_date", LO, HI) if windowed else df


def cal(spark, sf):
    return fx.at_rest(spark, sf)["cal"]


def window_calendar(spark, sf):
    return PF.date_window(cal(spark, sf), "report_date", LO, HI)


def snapshot(spark, sf):
    """The snapshot of the window's days."""
    return J.range_join_calendar(sbf(spark, sf), window_calendar(spark, sf), START, END)


def rebuilder(spark, sf) -> Rebuilder:
    src = {"sbf": sbf(spark, sf), "smf": smf(spark, sf), "cal": cal(spark, sf)}
    return Rebuilder(src, subscription_rules())


def _suite_query(name: str) -> Q.QuerySpec:
    return {q.name: q for q in Q.EXAMPLE_SUITE + Q.ACCEPTANCE_SUITE}[name]


# ------------------------------------------------------------------ sources

def load_base_touching(spark, sf):
    return PF.interval_touching(sbf(spark, sf), START, END, LO, HI)


def load_base_overlap(spark, sf):
    return PF.interval_overlap(sbf(spark, sf), START, END, LO, HI)


def load_movement(spark, sf):
    return smf(spark, sf, windowed=True)


def load_calendar(spark, sf):
    return fx.load_calendar(fx.calendar(spark, sf, LO, HI))


def load_target_window(spark, sf):
    return PF.date_window(new_layer(spark, sf), "report_date", MONTH_LO, MONTH_HI).sortWithinPartitions("report_date")


def column_catalog_q(spark, sf):
    """SC5/SC6: the catalog of the three sources, with what each column holds."""
    tables = {"sbf": sbf(spark, sf), "smf": smf(spark, sf), "cal": cal(spark, sf)}
    fill = R.union_all([C.column_fill(df).withColumn("table_name", F.lit(name)) for name, df in tables.items()])
    return column_catalog(spark, tables).join(F.broadcast(fill), ["table_name", "column_name"]).select(    # a row per column
        "table_name", "ordinal_position", "column_name", "data_type", "is_nullable", "populated_rows", "null_rows")


CSV_SCHEMA = ("masthead string, offer_category_name string, start_text string, end_text string, "
              "subscription_count bigint, ratecard_price decimal(18,2)")


def csv_coerce(spark, sf):
    """Write the interval fact as CSV text (with some unparseable start dates)
    to the shared folder and read it back with a declared schema."""
    base = sbf(spark, sf)
    start_text = F.when(F.dayofmonth(START) == 13, F.concat(F.lit("13/13/"), F.year(START).cast("string"))) \
                  .otherwise(F.date_format(START, "yyyy-MM-dd"))
    path = shared_dir(spark, "csv_coerce") + "/sbf_csv"
    (base.select("masthead", "offer_category_name", start_text.alias("start_text"),
                F.date_format(END, "yyyy-MM-dd").alias("end_text"), "subscription_count", "ratecard_price")
        .write.mode("overwrite").option("header", True).csv(path))
    df = read_csv_lenient(spark, path, CSV_SCHEMA, {"start_text": "yyyy-MM-dd", "end_text": "yyyy-MM-dd"})
    return df.select("masthead", "offer_category_name",
                     F.col("start_text").alias("dw_effective_start_date"),
                     F.col("end_text").alias("dw_effective_end_date"), "subscription_count",
                     F.col("ratecard_price").cast("double").alias("ratecard_price"))


def data_volume(spark, sf):
    """SC9/SC13: rows, columns and date range of the three sources under the same window."""
    b = PF.interval_touching(sbf(spark, sf), START, END, LO, HI)
    m = smf(spark, sf, windowed=True)
    c = PF.date_window(load_calendar(spark, sf), "report_date", LO, HI)

    def prof(df, name, d):
        return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"),
                      F.lit(len(df.columns)).cast("bigint").alias("column_count"),
                      F.min(d).alias("min_date"), F.max(d).alias("max_date"))
    return (prof(b, "sbf", F.to_date(START)).unionByName(prof(m, "smf", F.col("report_date")))
            .unionByName(prof(c, "cal", F.col("report_date"))))


# ------------------------------------------------------------------ filters

def date_window_start_only(spark, sf):
    return Q.run_query(spark, _suite_query("subscription_by_date"), new_layer(spark, sf), start=START_ONLY)


RULE_FILTERS = [
    {"cte_name": "smf", "filter_type": "WHERE", "filter_expression": "subscription_movement_count_type <> 'FreeToPaid'"},
    {"cte_name": "smf", "filter_type": "WHERE", "filter_expression": "report_date >= DATE'1998-01-15'"},
    {"cte_name": "smf", "filter_type": "HAVING", "filter_expression": "count(*) > 1"},
    {"cte_name": "smf", "filter_type": "WHERE", "filter_expression": None},
]


def rule_filter_q(spark, sf):
    df = PF.rule_filter(smf(spark, sf), RULE_FILTERS, cte="smf")
    return df.select("report_date", "masthead", "movement_type_code", "subscription_movement_count_type",
                     "subscription_movement_count_sub_type")


def exclude_codes_q(spark, sf):
    return PF.exclude_codes(sbf(spark, sf)).select(
        "dw_source_system_code", "dw_billing_system_code", "masthead", START, END)


# A rule on a column that its source does not have, and one with other letter case.
EXTRA_RULES = [{"cte_name": "final_select", "column_name": "brand", "transformation_type": "simple", "source_expression": "smf.brand_name"},
               {"cte_name": "final_select", "column_name": "year", "transformation_type": "simple", "source_expression": "CAL.FY_YEAR"}]


def _required(spark, sf):
    """(required (alias, column) pairs of the sources as a DataFrame and as a
    list, the sources). Rules name a few dozen columns."""
    rb = rebuilder(spark, sf)
    rules = [r for t in ("column_mappings", "join_logic", "filter_logic") for r in subscription_rules()[t]] + EXTRA_RULES
    required = C.required_columns(spark, rules).filter(F.col("table_alias").isin(*rb.sources))
    return required, [tuple(r) for r in required.collect()], rb.sources


def missing_columns_q(spark, sf):
    """Columns the rules read from each source, whether the source has
    them, and how many rows hold a value. One aggregate per source, over
    exactly the columns that the rules name."""
    required, pairs, sources = _required(spark, sf)
    parts = []
    for alias, df in sorted(sources.items()):
        have = {c.lower(): c for c in df.columns}
        read = sorted({c for a, c in pairs if a == alias and c in have})
        if read:
            fill = C.column_fill(df.select(*[have[c] for c in read]))
            parts.append(fill.select(F.lit(alias).alias("table_alias"), F.lower("column_name").alias("column_name"), "populated_rows"))
    return (required.join(F.broadcast(R.union_all(parts)), ["table_alias", "column_name"], "left")     # a row per required column
            .select("table_alias", "column_name", F.col("populated_rows").isNotNull().alias("present"), "populated_rows"))


def required_minus_available(spark, sf):
    """The required columns that no source has, and how many rows of the source lack them."""
    required, _, sources = _required(spark, sf)
    available = column_catalog(spark, sources).select(F.col("table_name").alias("table_alias"), "column_name")
    rows = R.union_all([df.agg(F.count(F.lit(1)).alias("source_rows")).withColumn("table_alias", F.lit(a)) for a, df in sources.items()])
    return C.missing_columns(required, available).join(F.broadcast(rows), "table_alias")     # a row per source


# ----------------------------------------------------------- suite, one side

def _suite_one_side(name):
    return lambda spark, sf: Q.run_query(spark, _suite_query(name), new_layer(spark, sf))


def accept_windowed(spark, sf):
    res = Q.run_suite(spark, Q.ACCEPTANCE_SUITE, new_layer(spark, sf), old_layer(spark, sf), TOL,
                      MONTH_LO, MONTH_HI)
    return res.select("check_name", "passed", "total_rows", "mismatched_rows", "max_delta", "cdl_value",
                      "target_value", "critical")


# ------------------------------------------------------------- joins, sets

def range_join_calendar_q(spark, sf):
    return snapshot(spark, sf).groupBy("report_date").agg(
        F.count(F.lit(1)).alias("active_intervals"),
        F.sum("ratecard_price").cast("double").alias("ratecard_total"))


def snapshot_by_day(spark, sf):
    return snapshot(spark, sf).select("report_date", "masthead", START, "subscription_tenure_start_datetime",
                                         "subscription_count", "fy_week_of_year", "last_day_of_week_date")


def movement_calendar_join(spark, sf):
    mv = smf(spark, sf, windowed=True)
    j = J.equi_join(mv, load_calendar(spark, sf), "report_date", "report_date", "inner", "_cal")
    return j.select("report_date", "movement_type_code", "masthead", "fy_year", "fy_year_cal",
                    "fy_week_of_year", "fy_week_of_year_cal", "last_day_of_week_date")


def _one_sided(spark, sf, side):
    p = J.one_sided(new_layer(spark, sf), old_layer(spark, sf), SHARED_DIMS)
    cond = (F.col("in_new") & ~F.col("in_old")) if side == "new" else (F.col("in_old") & ~F.col("in_new"))
    return p.filter(cond).select(*SHARED_DIMS)


def union_base_movement(spark, sf):
    sbm = rebuilder(spark, sf).build("sbm")
    return sbm.withColumn("ratecard_amount", F.col("ratecard_amount").cast("double"))


def distinct_dims(spark, sf):
    rules = [{"column_name": c, "transformation_type": "simple", "source_expression": c}
             for c in ("masthead", "movement_type_code", "subscription_movement_count_sub_type")]
    return A.group_by_rules(smf(spark, sf), rules)


# ------------------------------------------------------------------ scalars

def day_of_week_q(spark, sf):
    return smf(spark, sf).select(
        "report_date", S.day_of_week("report_date").alias("day_of_week")).distinct()


def sunday_flag_q(spark, sf):
    return smf(spark, sf).select(
        "report_date", S.sunday_flag("report_date").alias("sunday_flag")).distinct()


def tenure_days_q(spark, sf):
    return (smf(spark, sf).select(S.tenure_days("report_date", "subscription_tenure_start_datetime").alias("tenure_days"))
               .groupBy("tenure_days").agg(F.count(F.lit(1)).alias("movements")))


def tenure_group_q(spark, sf):
    d = S.tenure_days("report_date", "subscription_tenure_start_datetime")
    return smf(spark, sf).select(
        d.alias("tenure_days"), S.tenure_group(d).alias("tenure_group")).distinct()


def tenure_group_finance_q(spark, sf):
    d = S.tenure_days("report_date", "subscription_tenure_start_datetime")
    return smf(spark, sf).select(
        d.alias("tenure_days"), S.tenure_group_finance(d).alias("tenure_group_finance")).distinct()


# -------------------------------------------------------------- aggregation

def rule_group_agg(spark, sf):
    return rebuilder(spark, sf).build("sma")


def rule_count(spark, sf):
    rules = [{"column_name": "masthead", "transformation_type": "simple", "source_expression": "smf.masthead"},
             {"column_name": "movement_type_code", "transformation_type": "simple",
              "source_expression": "smf.movement_type_code"},
             {"column_name": "movement_rows", "transformation_type": "aggregation", "source_expression": "count(*)"},
             {"column_name": "with_delivery_medium", "transformation_type": "aggregation",
              "source_expression": "count(smf.delivery_medium_type)"}]
    return A.group_by_rules(smf(spark, sf).alias("smf"), rules)


MOVE_CONDITIONS = {
    "acquisition_count": "subscription_movement_count_type = 'Acquisition'",
    "cancellation_count": "subscription_movement_count_type = 'Cancellation'",
    "free_to_paid_conversion_count": "subscription_movement_count_type = 'FreeToPaid'",
    "switch_acquisition_count": ("subscription_movement_count_type = 'Acquisition' "
                                 "AND subscription_movement_count_sub_type = 'switch'"),
    "switch_cancellation_count": ("subscription_movement_count_type = 'Cancellation' "
                                  "AND subscription_movement_count_sub_type = 'switch'"),
    "reactivation_30day_acquisition_count": ("subscription_movement_count_type = 'Acquisition' "
                                             "AND subscription_movement_count_sub_type = 'reactivation_30day'"),
}


def cond_sum_movements(spark, sf):
    return A.conditional_sums(smf(spark, sf), ["report_date"],
                              "subscription_movement_count", MOVE_CONDITIONS)


def metric_spec_agg_q(spark, sf):
    return A.metric_spec_agg(new_layer(spark, sf), SPEC_DIMENSIONS, SPEC_METRICS)


def profile_columns(spark, sf):
    return C.column_profile(new_layer(spark, sf), PROFILE_COLUMNS)


def profile_numeric(spark, sf):
    return C.numeric_profile(old_layer(spark, sf), COUNT_COLUMNS)


# ------------------------------------------------------------ schema checks

def _schema_row(name):
    return lambda spark, sf: C.schema_checks_on_data(spark, new_layer(spark, sf), old_layer(spark, sf)) \
        .filter(F.col("check_name") == name) \
        .select("validation_type", "check_name", "passed", "total_rows", "mismatched_rows", "affected_cells", "error_message")


def observed_nulls_q(spark, sf):
    return C.observed_nulls(new_layer(spark, sf), old_layer(spark, sf))


# ---------------------------------------------------------- quantity checks

def quantity_row_count(spark, sf):
    return C.row_count_check(new_layer(spark, sf), old_layer(spark, sf))


def quantity_distinct(spark, sf):
    return C.quantity_compare(new_layer(spark, sf), old_layer(spark, sf)).select(
        "column_name", "cdl_distinct", "target_distinct", "distinct_match")


def quantity_null_rate(spark, sf):
    return C.null_rate_compare(new_layer(spark, sf), old_layer(spark, sf))


QUANTITY_WHERE = "tenure_group = '0-180' AND dw_source_system_code = 'OTHER'"


def quantity_where(spark, sf):
    """R5, R6 on the rows that a condition asks for (``where=`` on checks)."""
    return C.quantity_compare(new_layer(spark, sf), old_layer(spark, sf), where=QUANTITY_WHERE)


DISTINCT_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey"]


def distinct_by_window(spark, sf):
    """A8 opt-in: distinct counts of any window from daily sketches, next to the
    exact counts of a scan: every year, the whole history and one month."""
    from ledgermatch.plans import sketches as SK

    li = read_table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day"), *DISTINCT_COLUMNS)
    stored = materialize(SK.daily_sketches(li, F.col("day"), DISTINCT_COLUMNS), "sketches")
    years = li.select(F.trunc("day", "year").alias("lo")).distinct().select("lo", F.date_sub(F.add_months("lo", 12), 1).alias("hi"))
    whole = li.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    month = spark.range(1).select(F.lit(MONTH_LO).alias("lo"), F.lit(MONTH_HI).alias("hi"))
    windows = materialize(years.unionByName(whole).unionByName(month), "windows")
    approx = SK.distinct_in_windows(stored, windows)
    days = windows.select("lo", "hi", F.explode(F.sequence("lo", "hi")).alias("day"))
    values = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in DISTINCT_COLUMNS])).alias("v")
    exact = (li.select("day", values).select("day", "v.*").distinct().join(days, "day").groupBy("lo", "hi", "column_name")
             .agg(F.countDistinct("value").alias("exact_distinct")))
    error = F.abs(F.col("distinct") - F.col("exact_distinct")) / F.greatest("exact_distinct", F.lit(1))
    return approx.join(exact, ["lo", "hi", "column_name"]).select("lo", "hi", "column_name", "rows", "exact_distinct",
                                                                  (error <= SK.ERROR_BOUND).alias("within_bound"))


DIGEST_COLUMNS = SHARED_DIMS + COUNT_COLUMNS


def digest_diff_buckets(spark, sf):
    """J6 pre-test: order-free digests of both layers per bucket, on two levels."""
    from ledgermatch.plans import digests as D

    return D.digest_diff(new_layer(spark, sf), old_layer(spark, sf), ["report_date"], SHARED_DIMS, DIGEST_COLUMNS)


def digest_compare_cells(spark, sf):
    """J6, R10 behind the pre-test: the cells that do not match, counted."""
    from ledgermatch.plans import digests as D

    new, old = (t(spark, sf).select(*DIGEST_COLUMNS) for t in (new_layer, old_layer))
    cells = D.compare_cells_by_digest(new, old, SHARED_DIMS, TOL, ["report_date"])
    return cells.filter(F.col("status") != "match").groupBy("column_name", "status").agg(F.count(F.lit(1)).alias("cells"))


def colocated_only_in_new(spark, sf):
    """J4, J5 on tables stored by the hash of the shared keys: no exchange below the comparison."""
    from ledgermatch.sources import colocated as CO

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    a, b = (CO.stored(t(spark, sf).select(*SHARED_DIMS, "subscription_count"), SHARED_DIMS, n, name)
            for t, name in ((new_layer, "layer_new"), (old_layer, "layer_old")))
    return CO.aligned(a, b, SHARED_DIMS, ["subscription_count"]).filter(F.col("in_new") & ~F.col("in_old")).select(
        *SHARED_DIMS, F.col("subscription_count_new").alias("subscription_count"))


def write_observed_q(spark, sf):
    """SC9, SK1: what the writer saw go by, next to an aggregate of what was read back."""
    from ledgermatch.sources.catalog import small_frame
    from ledgermatch.sources.files import write_observed

    cols = ["report_date", "masthead", "delivery_medium_type", "tenure_group", "subscription_count", "cancellation_count"]
    path = shared_dir(spark, "observed")
    seen = write_observed(old_layer(spark, sf).select(*cols), path)
    back = spark.read.parquet(path)
    text = lambda v: None if v is None else str(v)
    observed = small_frame(spark, [(k, text(v)) for k, v in seen.items()], "metric string, observed string")
    aggs = {"rows": F.count(F.lit(1)), **{f"nulls:{c}": F.count_if(F.col(c).isNull()) for c in cols},
            **{f"min:{c}": F.min(c) for c in cols}, **{f"max:{c}": F.max(c) for c in cols}}
    one = back.agg(*[a.cast("string").alias(k) for k, a in aggs.items()])
    read = one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("metric"), F.col(f"`{k}`").alias("read_back")) for k in aggs])).alias("r")).select("r.*")
    return observed.join(read, "metric").select("metric", "observed", "read_back", F.col("observed").eqNullSafe(F.col("read_back")).alias("same"))


CSV_SPECS = {
    "sbf": ("subscription_base.csv", "masthead string, start_text string, end_text string, subscription_count bigint, ratecard_price decimal(18,2)",
            {"start_text": "yyyy-MM-dd", "end_text": "yyyy-MM-dd"}),
    "cal": ("calendar.csv", "calendar_date string, fy_year int", {"calendar_date": "yyyy-MM-dd"}),
    "smf": ("subscription_movement.csv", "report_date string", {"report_date": "yyyy-MM-dd"}),
}


def csv_rejects(spark, sf):
    """SC7: CSV sources with unparseable dates, records that do not fit their
    schema and a file that is not there; what was rejected, per source and column."""
    from ledgermatch.sources.files import read_csv_sources, reject_counts

    folder, day = shared_dir(spark, "csv-sources"), F.dayofmonth(START)
    iso = lambda c: F.date_format(c, "yyyy-MM-dd")
    (sbf(spark, sf).select("masthead", F.when(day == 13, F.lit("13/13/1998")).otherwise(iso(START)).alias("start_text"),
                           F.when(day == 14, F.lit("soon")).otherwise(iso(END)).alias("end_text"), "subscription_count",
                           F.when(day == 21, F.lit("n/a")).otherwise(F.col("ratecard_price").cast("string")).alias("ratecard_price"))
        .write.option("header", True).csv(f"{folder}/{CSV_SPECS['sbf'][0]}"))
    (cal(spark, sf).select(iso("report_date").alias("calendar_date"), "fy_year").write.option("header", True).csv(f"{folder}/{CSV_SPECS['cal'][0]}"))
    sources = read_csv_sources(spark, folder, CSV_SPECS)
    return reject_counts(sources, list(CSV_SPECS))


# ------------------------------------------------------------ reconciliation

def scalar_compare(spark, sf):
    spec = _suite_query("total_subscription_count")
    return CMP.compare_scalar(Q.run_query(spark, spec, new_layer(spark, sf)),
                              Q.run_query(spark, spec, old_layer(spark, sf)), TOL, spec.name)


def grid_compare(spark, sf):
    spec = [q for q in Q.ACCEPTANCE_SUITE if q.name == "subscription_by_date"][0]
    return CMP.compare_cells(Q.run_query(spark, spec, new_layer(spark, sf)),
                             Q.run_query(spark, spec, old_layer(spark, sf)), list(spec.keys), TOL)


LINE_KEYS = ["l_orderkey", "l_linenumber"]


def _lines(spark, sf, published: bool):
    """Line items, whose (l_orderkey, l_linenumber) repeats; the published copy
    lost some and has other quantities for some."""
    li = read_table(spark, sf, "lineitem").select(*LINE_KEYS, "l_quantity", "l_returnflag")
    if not published:
        return li
    return (li.filter(F.col("l_orderkey") % 89 != 0)
            .withColumn("l_quantity", F.col("l_quantity") + F.when(F.col("l_orderkey") % 101 == 0, 1).otherwise(0)))


def grid_compare_duplicates(spark, sf):
    """J6, R10 on keys that repeat: status counts per column."""
    cells = CMP.compare_cells(_lines(spark, sf, False), _lines(spark, sf, True), LINE_KEYS, TOL)
    return cells.groupBy("column_name", "status").agg(F.count(F.lit(1)).alias("cells"))


def grid_compare_no_keys(spark, sf):
    """L2, R10 on answers without keys: rows compare as a multiset."""
    new, old = (_lines(spark, sf, p).select("l_returnflag", "l_linenumber") for p in (False, True))
    return CMP.compare_cells(new, old, None, TOL).select("l_returnflag", "l_linenumber", "status")


def grid_compare_keyless(spark, sf):
    """L2, R10 without any key: rows of measures alone, compared as multisets and
    paired by a distributed ordinal; cells and the sum of differences per column."""
    new, old = (_lines(spark, sf, p).select("l_quantity", (F.col("l_linenumber") / 2).alias("half")) for p in (False, True))
    cells = CMP.compare_cells(new, old, [], TOL)
    return cells.groupBy("column_name", "status").agg(F.count(F.lit(1)).alias("cells"),
                                                      F.sum(F.col("delta").cast("decimal(20,4)")).cast("double").alias("delta_sum"))


def row_count_verdict(spark, sf):
    """Row counts of two answers before their cells."""
    return CMP.row_count_verdict(_lines(spark, sf, False), _lines(spark, sf, True), "lineitem")


RANGE_RULES = {
    "join_logic": [{"cte_name": "shipped", "left_table": "li", "right_table": "sbf", "join_type": "INNER JOIN",
                    "join_condition": "li.l_shipdate between sbf.dw_effective_start_datetime and sbf.dw_effective_end_datetime"}],
    "filter_logic": [{"cte_name": "shipped", "filter_type": "WHERE", "filter_expression": "sbf.is_paying_flag = 'Y'"}],
    "column_mappings": [{"cte_name": "shipped", "column_name": "l_returnflag", "transformation_type": "simple", "source_expression": "li.l_returnflag"},
                        {"cte_name": "shipped", "column_name": "masthead", "transformation_type": "simple", "source_expression": "sbf.masthead"},
                        {"cte_name": "shipped", "column_name": "pairs", "transformation_type": "aggregation", "source_expression": "count(*)"},
                        {"cte_name": "shipped", "column_name": "line_numbers", "transformation_type": "aggregation", "source_expression": "sum(li.l_linenumber)"},
                        {"cte_name": "shipped", "column_name": "ratecard_total", "transformation_type": "aggregation", "source_expression": "sum(sbf.ratecard_price)"}],
    "aggregation_rules": [{"cte_name": "shipped"}],
}


def range_join_timestamps(spark, sf):
    """A BETWEEN rule on timestamps: all shipments within the validity of
    all intervals, counted and priced per return flag and masthead."""
    li = read_table(spark, sf, "lineitem").select("l_shipdate", "l_returnflag", "l_linenumber")
    return Rebuilder({"li": li, "sbf": sbf(spark, sf)}, RANGE_RULES).build("shipped")


def active_intervals_sweep(spark, sf):
    """J1 + A1: active intervals and their price on every day of the history."""
    out = J.active_totals_sweep(sbf(spark, sf), cal(spark, sf), START, END, {"ratecard_total": "ratecard_price"})
    return out.withColumn("ratecard_total", F.col("ratecard_total").cast("double"))


def range_join_instants(spark, sf):
    """J1 on timestamps, the pairs themselves: every interval that is valid at
    noon of the first day of a month of the history."""
    noon = (cal(spark, sf).filter(F.dayofmonth("report_date") == 1)
            .select(F.col("report_date").cast("timestamp_ntz").alias("__d")).select((F.col("__d") + F.expr("INTERVAL 12 HOURS")).alias("instant")))
    return J.range_join_points(noon, sbf(spark, sf).select(START, END, "masthead", "dw_publication_id"), "instant", START, END).select(
        "instant", "masthead", "dw_publication_id", START, END)


TWO_JOIN_RULES = {
    "join_logic": [{"cte_name": "placed", "left_table": "o", "right_table": "c", "join_type": "INNER JOIN",
                    "join_condition": "o.o_custkey = c.c_custkey"},
                   {"cte_name": "placed", "left_table": "c", "right_table": "n", "join_type": "LEFT JOIN",
                    "join_condition": "c.c_nationkey = n.n_nationkey"}],
    "filter_logic": [{"cte_name": "placed", "filter_type": "WHERE", "filter_expression": "c.c_acctbal > 0 AND o.o_orderstatus <> 'P'"}],
    "column_mappings": [{"cte_name": "placed", "column_name": "nation", "transformation_type": "simple", "source_expression": "n.n_name"},
                        {"cte_name": "placed", "column_name": "orders", "transformation_type": "aggregation", "source_expression": "count(o.o_orderkey)"}],
    "aggregation_rules": [{"cte_name": "placed"}],
}


def rebuild_two_joins(spark, sf):
    """Both join rules of a CTE, and its tables' aliases in filters and columns."""
    src = {"o": read_table(spark, sf, "orders"), "c": read_table(spark, sf, "customer"), "n": read_table(spark, sf, "nation")}
    return Rebuilder(src, TWO_JOIN_RULES).build("placed")


def default_suite_rows(spark, sf):
    """The built-in suite on both tables, a result row per query."""
    return Q.run_suite(spark, Q.DEFAULT_SUITE, new_layer(spark, sf), old_layer(spark, sf), TOL).select(
        "check_name", "passed", "total_rows", "mismatched_rows", "max_delta", "cdl_value", "target_value", "critical")


def rebuild_final(spark, sf):
    return rebuilder(spark, sf).build("final_select")


def agg_reconcile(spark, sf):
    """The rules are built (a rule that fails becomes failed rows) and the
    session's rebuilt table is reconciled."""
    rb = rebuilder(spark, sf)
    rb.built["final_select"] = rebuilt(spark, sf)
    return reconcile_rebuild(spark, rb, old_layer(spark, sf), SHARED_DIMS, fx.LAYER_METRICS, TOL)


def abs_rel_tolerance(spark, sf):
    new = A.metric_spec_agg(new_layer(spark, sf), SPEC_DIMENSIONS, SPEC_METRICS)
    old = A.metric_spec_agg(old_layer(spark, sf), SPEC_DIMENSIONS, SPEC_METRICS)
    return CMP.reconcile_abs_rel(new, old, SPEC_DIMENSIONS, list(SPEC_METRICS), SPEC_ABS_TOL, SPEC_REL_TOL)


def mismatch_sample_q(spark, sf):
    d = CMP.metric_deltas(rebuilt(spark, sf), old_layer(spark, sf), SHARED_DIMS, fx.LAYER_METRICS, above=TOL)
    return CMP.mismatch_sample(d, SHARED_DIMS, TOL, 5).select(
        "column_name", "sample_rank", *SHARED_DIMS, "source_value", "cdl_value", "delta")


def derived_metrics(spark, sf):
    return C.derived_metric_check(old_layer(spark, sf), fx.DERIVED_FORMULAS, TOL).select(
        "check_name", "passed", "total_rows", "mismatched_rows", "max_delta")


def domain_tenure(spark, sf):
    old = old_layer(spark, sf)
    return (C.domain_violations(old, "tenure_group", S.TENURE_GROUPS)
            .unionByName(C.domain_violations(old, "tenure_group_finance", S.TENURE_GROUPS_FINANCE)))


def non_negative_q(spark, sf):
    return C.non_negative(old_layer(spark, sf), COUNT_COLUMNS)


_REBUILT: dict[tuple, DataFrame] = {}


def rebuilt(spark, sf) -> DataFrame:
    """The rebuilt table, written once per session: a validation run rebuilds
    it once and puts several checks to it."""
    import os

    key = (session_key(spark), os.path.abspath(sf))
    if key not in _REBUILT:
        _REBUILT[key] = materialize(rebuild_final(spark, sf), "rebuilt")
    return _REBUILT[key]


def dimension_values_q(spark, sf):
    return C.dimension_values(rebuilt(spark, sf), old_layer(spark, sf), SHARED_DIMS)


# ---------------------------------------------------------------- end to end

def _acceptance_results(spark, sf):
    return Q.run_suite(spark, Q.ACCEPTANCE_SUITE, new_layer(spark, sf), old_layer(spark, sf), TOL)


def acceptance_rows_q(spark, sf):
    return Q.acceptance_rows(_acceptance_results(spark, sf))


def acceptance_decision_q(spark, sf):
    d = Q.acceptance_decision(_acceptance_results(spark, sf), TOL)
    return d.withColumn("failed_critical", F.concat_ws(",", "failed_critical"))


def results_rollup(spark, sf):
    """A16 over the union of query, quantity, derived and aggregation results;
    queries, row counts and derived metrics share one scan of each table."""
    new, old = new_layer(spark, sf), old_layer(spark, sf)
    fused = FusedChecks(new, old, Q.EXAMPLE_SUITE, TOL, row_count=True, derived=fx.DERIVED_FORMULAS)
    rows = R.union_results(fused.result_rows(), CMP.reconcile_metrics(rebuilt(spark, sf), old, SHARED_DIMS, fx.LAYER_METRICS, TOL))
    return R.rollup(rows)


def query_mismatch_sample(spark, sf):
    """R23 per suite query: the first 10 mismatching cells with both values."""
    fused = FusedChecks(new_layer(spark, sf), old_layer(spark, sf), Q.EXAMPLE_SUITE, TOL)
    return mismatch_samples(fused.entries(), fused.names(), 10)


def acceptance_document_q(spark, sf):
    """SK2, SK4: the nested report, written as JSON and read back, with its lists as text."""
    fused = FusedChecks(new_layer(spark, sf), old_layer(spark, sf), Q.ACCEPTANCE_SUITE, TOL)
    d = written_document(acceptance_document(fused, samples=5))
    none = lambda c: F.coalesce(c, F.lit("null"))
    cell = lambda m: F.concat_ws("|", m["row_key"], m["column_name"], none(m["cdl_value"]), none(m["target_value"]), m["status"])
    query = lambda q: F.concat_ws(";", q["name"], q["error"], q["total_mismatches"].cast("string"),
                                  F.array_join(F.transform(q["mismatches"], cell), ";"))
    return d.select("migration_accepted", "all_queries_passed", "cdl_table", "target_table", "tolerance", F.col("queries.total").alias("total"),
                    F.col("queries.passed").alias("passed"), F.col("critical_queries.total").alias("critical_total"),
                    F.col("critical_queries.failed").alias("critical_failed"), F.col("critical_queries.pass_rate").alias("critical_pass_rate"),
                    F.array_join(F.transform("failed_queries", query), " / ").alias("failed_queries"))


# Two of these fail: one at run time (a text is no number), one when it is analysed.
ISOLATED_SUITE = [
    Q.QuerySpec("rows_by_masthead", "SELECT masthead, count(*) AS n FROM {table} GROUP BY masthead", True, ("masthead",)),
    Q.QuerySpec("masthead_as_number", "SELECT sum(cast(masthead AS int)) AS total FROM {table}", True, ()),
    Q.QuerySpec("no_such_column", "SELECT sum(no_such_column) AS total FROM {table}", False, ()),
    Q.QuerySpec("days", "SELECT count(DISTINCT report_date) AS days FROM {table}", False, ()),
    [q for q in Q.ACCEPTANCE_SUITE if q.name == "total_subscription_count"][0],
]


def suite_isolated(spark, sf):
    """Queries that run at the same time and fail alone."""
    res = Q.run_suite(spark, ISOLATED_SUITE, new_layer(spark, sf), old_layer(spark, sf), TOL, isolate=True, limit_sec=1800)
    return res.select("ordinal", "check_name", "passed", "total_rows", "mismatched_rows", "cdl_value", "target_value", "critical",
                      F.coalesce(F.col("error_message").startswith("Query execution failed"), F.lit(False)).alias("execution_failed"))


def accept_by_masthead_compare(spark, sf):
    spec = [q for q in Q.ACCEPTANCE_SUITE if q.name == "subscription_by_masthead"][0]
    return Q.compare_query(spark, spec, new_layer(spark, sf), old_layer(spark, sf), TOL)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # sources
    "load_base_touching": load_base_touching,
    "load_base_overlap": load_base_overlap,
    "load_movement": load_movement,
    "load_calendar": load_calendar,
    "load_target_window": load_target_window,
    "column_catalog": column_catalog_q,
    "csv_coerce": csv_coerce,
    "csv_rejects": csv_rejects,
    "write_observed": write_observed_q,
    "data_volume": data_volume,
    # filters
    "date_window_start_only": date_window_start_only,
    "rule_filter": rule_filter_q,
    "exclude_codes": exclude_codes_q,
    "missing_columns": missing_columns_q,
    "required_minus_available": required_minus_available,
    # suite, one side
    "accept_total_subscription": _suite_one_side("total_subscription_count"),
    "accept_total_acq_canc": _suite_one_side("total_acquisition_cancellation"),
    "accept_by_date": _suite_one_side("subscription_by_date"),
    "accept_by_masthead": _suite_one_side("subscription_by_masthead"),
    "accept_rowcount_daterange": _suite_one_side("row_count_and_date_range"),
    "sum_by_classification": _suite_one_side("acquisition_by_classification"),
    "sum_by_delivery_medium": _suite_one_side("subscription_by_delivery_medium"),
    "avg_by_offer": _suite_one_side("average_subscription_by_offer_category"),
    "rows_by_month": _suite_one_side("total_rows_by_date_range"),
    "sums_by_source_system": _suite_one_side("subscription_movement_by_source_system"),
    "accept_windowed": accept_windowed,
    # joins, sets
    "range_join_calendar": range_join_calendar_q,
    "snapshot_by_day": snapshot_by_day,
    "movement_calendar_join": movement_calendar_join,
    "only_in_new": lambda spark, sf: _one_sided(spark, sf, "new"),
    "colocated_only_in_new": colocated_only_in_new,
    "only_in_old": lambda spark, sf: _one_sided(spark, sf, "old"),
    "union_base_movement": union_base_movement,
    "distinct_dims": distinct_dims,
    # scalars
    "day_of_week": day_of_week_q,
    "sunday_flag": sunday_flag_q,
    "tenure_days": tenure_days_q,
    "tenure_group": tenure_group_q,
    "tenure_group_finance": tenure_group_finance_q,
    # aggregation
    "rule_group_agg": rule_group_agg,
    "rule_count": rule_count,
    "cond_sum_movements": cond_sum_movements,
    "metric_spec_agg": metric_spec_agg_q,
    "profile_columns": profile_columns,
    "profile_numeric": profile_numeric,
    # schema checks
    "schema_names": _schema_row("column_names"),
    "schema_types": _schema_row("data_types"),
    "schema_nullability": _schema_row("nullability"),
    "observed_nulls": observed_nulls_q,
    # quantity checks
    "quantity_row_count": quantity_row_count,
    "quantity_distinct": quantity_distinct,
    "quantity_null_rate": quantity_null_rate,
    "quantity_where": quantity_where,
    "distinct_by_window": distinct_by_window,
    # reconciliation
    "scalar_compare": scalar_compare,
    "grid_compare": grid_compare,
    "agg_reconcile": agg_reconcile,
    "abs_rel_tolerance": abs_rel_tolerance,
    "mismatch_sample": mismatch_sample_q,
    "derived_metrics": derived_metrics,
    "domain_tenure": domain_tenure,
    "non_negative": non_negative_q,
    "dimension_values": dimension_values_q,
    # end to end
    "rebuild_final": rebuild_final,
    "rebuild_two_joins": rebuild_two_joins,
    "range_join_timestamps": range_join_timestamps,
    "range_join_instants": range_join_instants,
    "active_intervals_sweep": active_intervals_sweep,
    "default_suite_rows": default_suite_rows,
    "grid_compare_duplicates": grid_compare_duplicates,
    "grid_compare_no_keys": grid_compare_no_keys,
    "grid_compare_keyless": grid_compare_keyless,
    "digest_diff_buckets": digest_diff_buckets,
    "digest_compare_cells": digest_compare_cells,
    "row_count_verdict": row_count_verdict,
    "acceptance_rows": acceptance_rows_q,
    "acceptance_decision": acceptance_decision_q,
    "results_rollup": results_rollup,
    "query_mismatch_sample": query_mismatch_sample,
    "acceptance_document": acceptance_document_q,
    "suite_isolated": suite_isolated,
    "accept_by_masthead_compare": accept_by_masthead_compare,
}
