"""DuckDB oracle SQL per registered query (fixture CTEs come from ``oracle.py``).

Each entry is an independent formulation of the same answer in plain SQL:
outer joins are written as UNION ALL + GROUP BY or FULL OUTER JOIN, ranks as
window functions, tolerances as CASE expressions.
"""

from __future__ import annotations

import re

from ledgermatch.oracle import (_DIMS, EXCLUDE, HI, LO, MOVEMENT_METRICS, TENURE_DAYS, tenure_group_finance_sql,
                                tenure_group_sql, with_fixtures)
from ledgermatch.sources.fixtures import LAYER_DIMS, LAYER_METRICS

MONTH = "DATE '1998-02-01' AND DATE '1998-02-28'"
TOL = 0.01
START, END = "dw_effective_start_datetime", "dw_effective_end_datetime"
SHARED = [d for d in LAYER_DIMS if d != "sunday_flag"]
NEW_COLS = LAYER_DIMS + LAYER_METRICS
OLD_COLS = [c for c in NEW_COLS if c != "sunday_flag"] + ["dw_load_batch_id"]
FLOAT_METRICS = {"ratecard_amount"}
COUNT_COLUMNS = ["subscription_count"] + MOVEMENT_METRICS
PROFILE_COLUMNS = ["masthead", "classification_level_1", "offer_category_name", "delivery_medium_type",
                   "tenure_group", "tenure_group_finance"]
QUANTITY_COLUMNS = ["report_date", "masthead", "classification_level_1", "offer_category_name",
                    "delivery_medium_type", "dw_source_system_code"]
SPEC_DIMS = ["report_date", "offer_category_name", "masthead", "dw_billing_system_code",
             "frontbook_backbook_group_name"]
SPEC_METRICS = ["subscription_count", "acquisition_count", "cancellation_count", "TotalAcquisition",
                "NetAcquisition", "NetCancellation"]
MOVE = {
    "acquisition_count": "subscription_movement_count_type = 'Acquisition'",
    "cancellation_count": "subscription_movement_count_type = 'Cancellation'",
    "free_to_paid_conversion_count": "subscription_movement_count_type = 'FreeToPaid'",
    "switch_acquisition_count": ("subscription_movement_count_type = 'Acquisition' AND "
                                 "subscription_movement_count_sub_type = 'switch'"),
    "switch_cancellation_count": ("subscription_movement_count_type = 'Cancellation' AND "
                                  "subscription_movement_count_sub_type = 'switch'"),
    "reactivation_30day_acquisition_count": ("subscription_movement_count_type = 'Acquisition' AND "
                                             "subscription_movement_count_sub_type = 'reactivation_30day'"),
}
DERIVED = {
    "TotalAcquisition": "acquisition_count + free_to_paid_conversion_count",
    "NetAcquisition": ("acquisition_count + free_to_paid_conversion_count - switch_acquisition_count"
                       " - reactivation_30day_acquisition_count"),
    "NetCancellation": "cancellation_count - switch_cancellation_count - reactivation_30day_acquisition_count",
}
TG_ALLOWED = ["0-180", "181-360", "361-540", "541-720", "721+"]
TGF_ALLOWED = ["0-6months", "6-12months", "1-2years", "2-3years", "3-4years", "4-5years", "5-6years",
               "6-7years", "7years+", "0-182 days", "183-365 days", "366-730 days", "730+ days"]


def _j(cols, sep=", "):
    return sep.join(cols)


def _bsum(c):
    return f"CAST(coalesce(sum({c}), 0) AS BIGINT)"


# ---------------------------------------------------------------- suites ----
# (name, DuckDB body with {t}, keys, [(measure, kind)]) ; kind: int | float | other
ACCEPT = [
    ("total_subscription_count", "SELECT CAST(SUM(subscription_count) AS BIGINT) AS total_subscriptions FROM {t}",
     (), [("total_subscriptions", "int")]),
    ("total_acquisition_cancellation",
     "SELECT CAST(SUM(acquisition_count) AS BIGINT) AS total_acquisitions, "
     "CAST(SUM(cancellation_count) AS BIGINT) AS total_cancellations FROM {t}",
     (), [("total_acquisitions", "int"), ("total_cancellations", "int")]),
    ("subscription_by_date",
     "SELECT report_date, CAST(SUM(subscription_count) AS BIGINT) AS total FROM {t} GROUP BY report_date",
     ("report_date",), [("total", "int")]),
    ("subscription_by_masthead",
     "SELECT masthead, CAST(SUM(subscription_count) AS BIGINT) AS total FROM {t} GROUP BY masthead",
     ("masthead",), [("total", "int")]),
    ("row_count_and_date_range",
     "SELECT COUNT(*) AS row_count, MIN(report_date) AS min_date, MAX(report_date) AS max_date, "
     "COUNT(DISTINCT report_date) AS distinct_dates FROM {t}",
     (), [("row_count", "int"), ("min_date", "other"), ("max_date", "other"), ("distinct_dates", "int")]),
]
EXAMPLES = [
    ("total_subscription_count", "SELECT CAST(SUM(subscription_count) AS BIGINT) AS total FROM {t}", (),
     [("total", "int")]),
    ("total_acquisition_count", "SELECT CAST(SUM(acquisition_count) AS BIGINT) AS total FROM {t}", (),
     [("total", "int")]),
    ("total_cancellation_count", "SELECT CAST(SUM(cancellation_count) AS BIGINT) AS total FROM {t}", (),
     [("total", "int")]),
    ("subscription_by_masthead",
     "SELECT masthead, CAST(SUM(subscription_count) AS BIGINT) AS total_subscriptions FROM {t} GROUP BY masthead",
     ("masthead",), [("total_subscriptions", "int")]),
    ("subscription_by_date",
     "SELECT report_date, CAST(SUM(subscription_count) AS BIGINT) AS total_subscriptions FROM {t} "
     "GROUP BY report_date", ("report_date",), [("total_subscriptions", "int")]),
    ("acquisition_by_classification",
     "SELECT classification_level_1, CAST(SUM(acquisition_count) AS BIGINT) AS total_acquisitions FROM {t} "
     "GROUP BY classification_level_1", ("classification_level_1",), [("total_acquisitions", "int")]),
    ("subscription_by_delivery_medium",
     "SELECT delivery_medium_type, CAST(SUM(subscription_count) AS BIGINT) AS total_subscriptions FROM {t} "
     "GROUP BY delivery_medium_type", ("delivery_medium_type",), [("total_subscriptions", "int")]),
    ("average_subscription_by_offer_category",
     "SELECT offer_category_name, AVG(subscription_count) AS avg_subscriptions FROM {t} "
     "GROUP BY offer_category_name", ("offer_category_name",), [("avg_subscriptions", "float")]),
    ("total_rows_by_date_range",
     "SELECT CAST(date_trunc('month', report_date) AS DATE) AS month, COUNT(*) AS row_count FROM {t} "
     "GROUP BY 1", ("month",), [("row_count", "int")]),
    ("subscription_movement_by_source_system",
     "SELECT dw_source_system_code, CAST(SUM(subscription_count) AS BIGINT) AS total, "
     "CAST(SUM(acquisition_count) AS BIGINT) AS acquisitions, CAST(SUM(cancellation_count) AS BIGINT) "
     "AS cancellations FROM {t} GROUP BY dw_source_system_code", ("dw_source_system_code",),
     [("total", "int"), ("acquisitions", "int"), ("cancellations", "int")]),
]


def _match(a, b, kind):
    if kind == "int":
        cmp = f"{a} = {b}"
    elif kind == "float":
        cmp = f"abs({a} - {b}) <= {TOL}"
    else:
        cmp = f"CAST({a} AS VARCHAR) = CAST({b} AS VARCHAR)"
    return f"(({a} IS NULL AND {b} IS NULL) OR ({a} IS NOT NULL AND {b} IS NOT NULL AND {cmp}))"


def _delta(a, b, kind):
    return f"abs(CAST({a} AS DOUBLE) - CAST({b} AS DOUBLE))" if kind in ("int", "float") else "CAST(NULL AS DOUBLE)"


def _pair(p, keys, measures, agg="max"):
    k = _j(keys)
    sel = [f"{agg}({m}) FILTER (WHERE side = 'n') AS {m}_n, {agg}({m}) FILTER (WHERE side = 'o') AS {m}_o"
           for m, _ in measures]
    grp = f" GROUP BY {k}" if keys else ""
    return (f"SELECT {k + ', ' if keys else ''}{_j(sel)}, bool_or(side = 'n') AS in_n, bool_or(side = 'o') AS in_o "
            f"FROM (SELECT *, 'n' AS side FROM {p}_a UNION ALL SELECT *, 'o' AS side FROM {p}_b) u{grp}")


def _cells(p, keys, measures):
    parts = []
    for m, kind in measures:
        a, b = f"{m}_n", f"{m}_o"
        status = (f"CASE WHEN in_n AND NOT in_o THEN 'only_new' WHEN in_o AND NOT in_n THEN 'only_old' "
                  f"WHEN {_match(a, b, kind)} THEN 'match' ELSE 'mismatch' END")
        parts.append(f"SELECT {_j(keys) + ', ' if keys else ''}'{m}' AS column_name, CAST({a} AS VARCHAR) AS new_value, "
                     f"CAST({b} AS VARCHAR) AS old_value, {_delta(a, b, kind)} AS delta, {status} AS status "
                     f"FROM {p}_pair")
    return " UNION ALL ".join(parts)


def compare_ctes(p, name, body, keys, measures, new_src, old_src, critical):
    """CTEs ending in ``{p}_res``: one result row for one suite query."""
    ctes = [(f"{p}_a", body.format(t=new_src)), (f"{p}_b", body.format(t=old_src)),
            (f"{p}_pair", _pair(p, keys, measures))]
    crit = "true" if critical else "false"
    if not keys and len(measures) == 1:
        m, kind = measures[0]
        a, b = f"{m}_n", f"{m}_o"
        res = (f"SELECT 'query' AS validation_type, '{name}' AS check_name, {_match(a, b, kind)} AS passed, "
               f"CAST(NULL AS BIGINT) AS total_rows, CAST(CASE WHEN {_match(a, b, kind)} THEN 0 ELSE 1 END AS BIGINT) "
               f"AS mismatched_rows, {_delta(a, b, kind)} AS max_delta, CAST({a} AS VARCHAR) AS cdl_value, "
               f"CAST({b} AS VARCHAR) AS target_value, {crit} AS critical FROM {p}_pair")
    else:
        ctes.append((f"{p}_cells", _cells(p, keys, measures)))
        res = (f"SELECT 'query' AS validation_type, '{name}' AS check_name, "
               f"count(*) FILTER (WHERE status <> 'match') = 0 AS passed, count(*) AS total_rows, "
               f"count(*) FILTER (WHERE status <> 'match') AS mismatched_rows, max(delta) AS max_delta, "
               f"CAST(NULL AS VARCHAR) AS cdl_value, CAST(NULL AS VARCHAR) AS target_value, {crit} AS critical "
               f"FROM {p}_cells")
    ctes.append((f"{p}_res", f"SELECT *, CASE WHEN passed THEN NULL ELSE 'Results do not match' END "
                             f"AS error_message FROM ({res}) r"))
    return ctes


def suite_ctes(tag, suite, new_src="layer_new", old_src="layer_old", critical=True):
    ctes, names = [], []
    for i, (name, body, keys, measures) in enumerate(suite):
        p = f"{tag}{i}"
        ctes += compare_ctes(p, name, body, keys, measures, new_src, old_src, critical)
        names.append(f"{p}_res")
    ctes.append((f"{tag}_all", " UNION ALL ".join(f"SELECT * FROM {n}" for n in names)))
    return ctes


# --------------------------------------------------------------- helpers ----

def _tenure_dims(src):
    return (f"SELECT *, {tenure_group_sql('subscription_tenure_days')} AS tenure_group, "
            f"{tenure_group_finance_sql('subscription_tenure_days')} AS tenure_group_finance, "
            f"CASE WHEN dayofweek(report_date) = 0 THEN 'Y' ELSE 'N' END AS sunday_flag FROM {src}")


SBA = (f"SELECT {_j(LAYER_DIMS)}, {_bsum('subscription_count')} AS subscription_count, "
       f"CAST(coalesce(sum(ratecard_price), 0) AS DOUBLE) AS ratecard_amount, "
       + _j(f"CAST(0 AS BIGINT) AS {m}" for m in MOVEMENT_METRICS)
       + f" FROM dsnap_new GROUP BY {_j(LAYER_DIMS)}")
SMA_METRICS = _j(f"{_bsum(f'CASE WHEN {c} THEN subscription_movement_count ELSE 0 END')} AS {m}"
                 for m, c in MOVE.items())
SMA = (f"SELECT {_j(LAYER_DIMS)}, CAST(0 AS BIGINT) AS subscription_count, {SMA_METRICS} "
       f"FROM dmov_new GROUP BY {_j(LAYER_DIMS)}")


def _side_pair(name, keys, metrics, new_src, old_src, float_metrics=frozenset()):
    def val(m):
        return f"CAST({m} AS DECIMAL(38,9))" if m in float_metrics else m

    def out(m, s):
        e = f"sum({m}) FILTER (WHERE side = '{s}')"
        return f"CAST({e} AS DOUBLE)" if m in float_metrics else e
    cols = _j(keys + [f"{val(m)} AS {m}" for m in metrics])
    sel = _j(f"{out(m, 'n')} AS {m}_n, {out(m, 'o')} AS {m}_o" for m in metrics)
    return (name, f"SELECT {_j(keys)}, {sel}, bool_or(side = 'n') AS in_n, bool_or(side = 'o') AS in_o FROM "
                  f"(SELECT {cols}, 'n' AS side FROM {new_src} UNION ALL SELECT {cols}, 'o' AS side FROM {old_src}) u "
                  f"GROUP BY {_j(keys)}")


def _d(m):
    return f"abs(coalesce(CAST({m}_n AS DOUBLE), 0) - coalesce(CAST({m}_o AS DOUBLE), 0))"


def _spec_agg(src):
    return (f"SELECT {_j(SPEC_DIMS)}, count(*) AS subscription_count, "
            + _j(f"{_bsum(m)} AS {m}" for m in SPEC_METRICS[1:]) + f" FROM {src} GROUP BY {_j(SPEC_DIMS)}")


def _profile_union(src, cols, row):
    return " UNION ALL ".join(row(c) for c in cols).replace("{src}", src)


def _agg_reconcile_ctes():
    pair = _side_pair("ar_pair", SHARED, LAYER_METRICS, "layer_new", "layer_old", FLOAT_METRICS)
    aggs = ["count(*) AS total_rows", "count(*) FILTER (WHERE in_n AND NOT in_o) AS only_in_source",
            "count(*) FILTER (WHERE in_o AND NOT in_n) AS only_in_cdl"]
    for i, m in enumerate(LAYER_METRICS):
        aggs += [f"count(*) FILTER (WHERE {_d(m)} > {TOL}) AS mm{i}", f"max({_d(m)}) AS md{i}"]
    one = ("ar_one", f"SELECT {_j(aggs)} FROM ar_pair")
    rows = " UNION ALL ".join(
        f"SELECT 'aggregation' AS validation_type, '{m}' AS check_name, "
        f"(mm{i} = 0 AND only_in_source = 0 AND only_in_cdl = 0) AS passed, total_rows, mm{i} AS mismatched_rows, "
        f"coalesce(md{i}, 0.0) AS max_delta, only_in_source, only_in_cdl FROM ar_one"
        for i, m in enumerate(LAYER_METRICS))
    return [pair, one, ("ar_res", rows)]


def _derived_ctes():
    aggs = ["count(*) AS rc"]
    for i, (m, e) in enumerate(DERIVED.items()):
        calc, act = f"CAST(({e}) AS DOUBLE)", f"CAST({m} AS DOUBLE)"
        bad = (f"(({calc}) IS NULL) <> (({act}) IS NULL) OR abs({calc} - {act}) > {TOL}")
        aggs += [f"count(*) FILTER (WHERE {bad}) AS mm{i}", f"max(abs({calc} - {act})) AS md{i}"]
    one = ("dm_one", f"SELECT {_j(aggs)} FROM layer_old")
    rows = " UNION ALL ".join(
        f"SELECT 'derived' AS validation_type, '{m}' AS check_name, mm{i} = 0 AS passed, rc AS total_rows, "
        f"mm{i} AS mismatched_rows, coalesce(md{i}, 0.0) AS max_delta FROM dm_one"
        for i, m in enumerate(DERIVED))
    return [one, ("dm_res", rows)]


ROWCOUNT = ("SELECT 'quantity' AS validation_type, 'row_count' AS check_name, a = b AS passed, a AS cdl_count, "
            "b AS target_count, abs(a - b) AS difference, CAST(abs(a - b) AS DOUBLE) / greatest(a, 1) * 100 "
            "AS percent_diff FROM (SELECT (SELECT count(*) FROM layer_new) AS a, (SELECT count(*) FROM layer_old) AS b)")


def _quantity_ctes(new="layer_new", old="layer_old"):
    def prof(src, tag):
        return (f"q{tag}", " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS dc, "
            f"count(*) FILTER (WHERE {c} IS NULL) / nullif(count(*), 0) AS nr FROM {src}" for c in QUANTITY_COLUMNS))
    return [prof(new, "n"), prof(old, "o")]


QJOIN = "FROM qn JOIN qo ON qn.column_name = qo.column_name"


def _observed_nulls():
    def side(src, cols):
        return " UNION ALL ".join(f"SELECT '{c}' AS column_name, bool_or({c} IS NULL) AS has_null FROM {src}"
                                  for c in cols)
    return with_fixtures(
        "SELECT coalesce(n.column_name, o.column_name) AS column_name, n.has_null AS new_has_null, "
        "o.has_null AS old_has_null, (n.column_name IS NOT NULL AND o.column_name IS NOT NULL AND "
        "n.has_null IS NOT DISTINCT FROM o.has_null) AS passed FROM obn n FULL OUTER JOIN obo o "
        "ON n.column_name = o.column_name",
        [("obn", side("layer_new", NEW_COLS)), ("obo", side("layer_old", OLD_COLS))])


def _mismatch_sample():
    pair = _side_pair("ms_pair", SHARED, LAYER_METRICS, "layer_new", "layer_old", FLOAT_METRICS)
    rows = " UNION ALL ".join(
        f"SELECT {_j(SHARED)}, '{m}' AS column_name, CAST({m}_n AS DOUBLE) AS source_value, "
        f"CAST({m}_o AS DOUBLE) AS cdl_value, {_d(m)} AS delta FROM ms_pair" for m in LAYER_METRICS)
    order = _j(["delta DESC"] + [f"{k} ASC NULLS FIRST" for k in SHARED])
    return with_fixtures(
        f"SELECT column_name, sample_rank, {_j(SHARED)}, source_value, cdl_value, delta FROM ("
        f"SELECT *, CAST(row_number() OVER (PARTITION BY column_name ORDER BY {order}) AS INTEGER) AS sample_rank "
        f"FROM ms_rows WHERE delta > {TOL}) r WHERE sample_rank <= 5",
        [pair, ("ms_rows", rows)])


def _abs_rel():
    pair = _side_pair("tr_pair", SPEC_DIMS, SPEC_METRICS, "tr_new", "tr_old")
    aggs = ["count(*) AS total_rows", "count(*) FILTER (WHERE in_n AND NOT in_o) AS only_in_new",
            "count(*) FILTER (WHERE in_o AND NOT in_n) AS only_in_old"]
    for i, m in enumerate(SPEC_METRICS):
        a, b = f"coalesce(CAST({m}_n AS DOUBLE), 0)", f"coalesce(CAST({m}_o AS DOUBLE), 0)"
        bad = f"abs({a} - {b}) > 0.01 AND abs({a} - {b}) / greatest(abs({b}), 1) > 0.0001"
        aggs += [f"count(*) FILTER (WHERE {bad}) AS mm{i}", f"max(abs({a} - {b})) AS md{i}"]
    rows = " UNION ALL ".join(
        f"SELECT '{m}' AS metric, total_rows, mm{i} AS mismatched_rows, only_in_new, only_in_old, "
        f"coalesce(md{i}, 0.0) AS max_delta, (mm{i} = 0 AND only_in_new = 0 AND only_in_old = 0) AS passed "
        f"FROM tr_one" for i, m in enumerate(SPEC_METRICS))
    return with_fixtures(rows, [("tr_new", _spec_agg("layer_new")), ("tr_old", _spec_agg("layer_old")), pair,
                                ("tr_one", f"SELECT {_j(aggs)} FROM tr_pair")])


def _decision():
    return with_fixtures("""SELECT (cq > 0 AND cf = 0) AS migration_accepted, nf = 0 AS all_queries_passed,
  tq AS total_queries, cq AS critical_queries, cp AS critical_passed, cf AS critical_failed,
  ncq AS non_critical_queries, ncp AS non_critical_passed,
  CASE WHEN cq > 0 THEN CAST(cp AS DOUBLE) * 100.0 / cq ELSE 0.0 END AS critical_pass_rate,
  CAST(0.01 AS DOUBLE) AS tolerance,
  CASE WHEN cq = 0 THEN 'no critical query in the suite' WHEN cf > 0 THEN 'critical queries failed' END AS reason,
  coalesce(fl, '') AS failed_critical
FROM (SELECT count(*) AS tq, count(*) FILTER (WHERE critical) AS cq,
  count(*) FILTER (WHERE critical AND passed) AS cp, count(*) FILTER (WHERE critical AND NOT passed) AS cf,
  count(*) FILTER (WHERE NOT critical) AS ncq, count(*) FILTER (WHERE NOT critical AND passed) AS ncp,
  count(*) FILTER (WHERE NOT passed) AS nf,
  string_agg(check_name, ',' ORDER BY check_name) FILTER (WHERE critical AND NOT passed) AS fl FROM acc_all) s""",
                         suite_ctes("acc", ACCEPT))


def _rollup():
    parts = [("rq", "SELECT validation_type, passed FROM ex_all"),
             ("rr", ROWCOUNT), ]
    body = """SELECT coalesce(validation_type, 'ALL') AS validation_type, total, passed, failed,
  CASE WHEN total > 0 THEN CAST(passed AS DOUBLE) * 100.0 / total ELSE 0.0 END AS pass_rate
FROM (SELECT CASE WHEN grouping(validation_type) = 1 THEN NULL ELSE validation_type END AS validation_type,
  count(*) AS total, count(*) FILTER (WHERE passed) AS passed, count(*) FILTER (WHERE NOT passed) AS failed
  FROM (SELECT validation_type, passed FROM ex_all UNION ALL SELECT validation_type, passed FROM rr
        UNION ALL SELECT validation_type, passed FROM dm_res UNION ALL SELECT validation_type, passed FROM ar_res) x
  GROUP BY ROLLUP (validation_type)) g"""
    return with_fixtures(body, suite_ctes("ex", EXAMPLES, critical=False) + parts + _derived_ctes()
                         + _agg_reconcile_ctes())


_DIM_NAMES = [c for c in re.findall(r"AS (\w+)", _DIMS) if c != "VARCHAR"]
SOURCE_COLUMNS = {
    "sbf": ("sbf_new", [START, END, "subscription_tenure_start_datetime", "subscription_count", "ratecard_price"] + _DIM_NAMES),
    "smf": ("smf_new", _DIM_NAMES + ["report_date", "movement_datetime", "subscription_tenure_start_datetime", "movement_type_code",
                                     "subscription_movement_count_type", "subscription_movement_count_sub_type", "subscription_movement_count",
                                     "incremental_subscription_movement_count", "fy_year", "fy_month_of_year", "fy_week_of_year"]),
    "cal": ("cal", ["report_date", "last_day_of_week_date", "fy_year", "fy_month_of_year", "fy_week_of_year"]),
}


def _fill(src, cols):
    """(column_name, populated, rows) of every column."""
    one = _j(f"count({c}) AS p{i}" for i, c in enumerate(cols))
    pairs = _j(f"{{'c': '{c}', 'p': p{i}}}" for i, c in enumerate(cols))
    return f"SELECT u.c AS column_name, u.p AS populated, n AS rows FROM (SELECT n, unnest([{pairs}]) AS u FROM (SELECT count(*) AS n, {one} FROM {src}))"


REQUIRED = [("cal", "report_date"), ("cal", "fy_year"), ("sbf", END), ("sbf", START), ("smf", "report_date"), ("smf", "brand_name")]


def _required_ctes():
    fills = [(f"fill_{a}", _fill(src, cols)) for a, (src, cols) in SOURCE_COLUMNS.items()]
    every = " UNION ALL ".join(f"SELECT '{a}' AS table_alias, * FROM fill_{a}" for a in SOURCE_COLUMNS)
    wanted = _j(f"('{a}', '{c}')" for a, c in REQUIRED)
    return [*fills, ("have", every), ("required", f"SELECT * FROM (VALUES {wanted}) v(table_alias, column_name)")]


def _sample_ctes(tag, suite):
    """``{tag}_every``: all cells of a suite with the query's place and name and the row's key text."""
    ctes, parts = [], []
    for i, (name, body, keys, measures) in enumerate(suite):
        p = f"{tag}{i}"
        ctes += [(f"{p}_a", body.format(t="layer_new")), (f"{p}_b", body.format(t="layer_old")), (f"{p}_pair", _pair(p, keys, measures)),
                 (f"{p}_cells", _cells(p, keys, measures))]
        key = " || ', ' || ".join(f"'{k}=' || coalesce(CAST({k} AS VARCHAR), 'null')" for k in keys) or "''"
        parts.append(f"SELECT {i + 1} AS ordinal, '{name}' AS check_name, {key} AS row_key, column_name, new_value, old_value, delta, status FROM {p}_cells")
    ctes.append((f"{tag}_every", " UNION ALL ".join(parts)))
    ctes.append((f"{tag}_bad", f"SELECT *, CAST(row_number() OVER (PARTITION BY ordinal ORDER BY delta DESC NULLS LAST, row_key, column_name) AS INTEGER) "
                               f"AS sample_rank, count(*) OVER (PARTITION BY ordinal) AS total_mismatches FROM {tag}_every WHERE status <> 'match'"))
    return ctes


def _document():
    cell = "concat_ws('|', row_key, column_name, coalesce(new_value, 'null'), coalesce(old_value, 'null'), status)"
    body = f"""SELECT cq > 0 AND cq = cp AS migration_accepted, tq = tp AS all_queries_passed, 'new' AS cdl_table, 'old' AS target_table,
  CAST({TOL} AS DOUBLE) AS tolerance, tq AS total, tp AS passed, cq AS critical_total, cq - cp AS critical_failed,
  CASE WHEN cq > 0 THEN cp * 100.0::DOUBLE / cq ELSE 0.0 END AS critical_pass_rate,
  coalesce((SELECT string_agg(t, ' / ' ORDER BY ordinal) FROM (
    SELECT ordinal, check_name || ';Results do not match;' || any_value(total_mismatches) || ';' || string_agg({cell}, ';' ORDER BY sample_rank) AS t
    FROM doc_bad WHERE sample_rank <= 5 GROUP BY ordinal, check_name)), '') AS failed_queries
FROM (SELECT count(*) AS tq, count(*) FILTER (WHERE bad = 0) AS tp, count(*) AS cq, count(*) FILTER (WHERE bad = 0) AS cp
  FROM (SELECT ordinal, count(*) FILTER (WHERE status <> 'match') AS bad FROM doc_every GROUP BY ordinal))"""
    return with_fixtures(body, _sample_ctes("doc", ACCEPT))


def _isolated():
    by = [("rows_by_masthead", "SELECT masthead, count(*) AS n FROM {t} GROUP BY masthead", ("masthead",), [("n", "int")]),
          ("days", "SELECT count(DISTINCT report_date) AS days FROM {t}", (), [("days", "int")]),
          ACCEPT[0]]
    places = {"rows_by_masthead": 1, "days": 4, "total_subscription_count": 5}
    ctes = [c for i, q in enumerate(by) for c in compare_ctes(f"iso{i}", *q, "layer_new", "layer_old", q[0] != "days")]
    rows = " UNION ALL ".join(
        f"SELECT CAST({places[q[0]]} AS INTEGER) AS ordinal, check_name, passed, total_rows, mismatched_rows, cdl_value, target_value, critical, "
        f"false AS execution_failed FROM iso{i}_res" for i, q in enumerate(by))
    gone = " UNION ALL ".join(f"SELECT {n}, '{name}', false, NULL, NULL, NULL, NULL, {crit}, true"
                              for n, name, crit in ((2, "masthead_as_number", "true"), (3, "no_such_column", "false")))
    return with_fixtures(f"{rows} UNION ALL {gone}", ctes)


def _windows_sql():
    li = "SELECT CAST(l_shipdate AS DATE) AS day, l_orderkey, l_partkey, l_suppkey FROM lineitem"
    cols = " UNION ALL ".join(f"SELECT lo, hi, '{c}' AS column_name, count(*) AS rows, count(DISTINCT {c}) AS exact_distinct, true AS within_bound "
                              f"FROM w JOIN li ON day BETWEEN lo AND hi GROUP BY lo, hi" for c in ("l_orderkey", "l_partkey", "l_suppkey"))
    return (f"WITH li AS ({li}), w AS (SELECT DISTINCT CAST(date_trunc('year', day) AS DATE) AS lo, make_date(year(day), 12, 31) AS hi FROM li "
            f"UNION ALL SELECT min(day), max(day) FROM li UNION ALL SELECT {MONTH.replace(' AND ', ', ')}) {cols}")


def _digest_sql():
    text = lambda c: f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    digest = lambda cols: f"('0x' || substr(md5({' || '.join(map(text, cols))}), 1, 15))::BIGINT"
    side = lambda s: (f"SELECT '{s}' AS side, CAST({digest(['report_date'])} % 64 AS INTEGER) AS level1, CAST({digest(SHARED)} % 64 AS INTEGER) AS level2, "  # noqa: E731
                      f"{digest(SHARED + COUNT_COLUMNS)} AS h FROM layer_{s}")
    per = _j(f"count(*) FILTER (side = '{s}') AS {s}_rows, coalesce(bit_xor(h) FILTER (side = '{s}'), 0)::BIGINT AS {s}_xor, "
             f"coalesce(sum(h::HUGEINT) FILTER (side = '{s}'), 0) AS {s}_t" for s in ("new", "old"))
    return with_fixtures(
        f"SELECT CAST(CASE WHEN level2 IS NULL THEN 1 ELSE 2 END AS INTEGER) AS level, level1, level2, new_rows, old_rows, new_xor, old_xor, "
        f"CAST(new_t AS VARCHAR) AS new_total, CAST(old_t AS VARCHAR) AS old_total, new_rows = old_rows AND new_xor = old_xor AND new_t = old_t AS same "
        f"FROM (SELECT level1, level2, {per} FROM dg GROUP BY GROUPING SETS ((level1), (level1, level2)))",
        [("dg", f"{side('new')} UNION ALL {side('old')}")])


def _observed_sql():
    cols = ["report_date", "masthead", "delivery_medium_type", "tenure_group", "subscription_count", "cancellation_count"]
    values = [("rows", "count(*)")] + [(f"nulls:{c}", f"count(*) FILTER (WHERE {c} IS NULL)") for c in cols] \
        + [(f"{f}:{c}", f"{f}({c})") for f in ("min", "max") for c in cols]
    return with_fixtures("SELECT metric, v AS observed, v AS read_back, true AS same FROM (" + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({e} AS VARCHAR) AS v FROM layer_old" for m, e in values) + ")")


def _csv_rejects_sql():
    day = f"day({START})"
    per = " UNION ALL ".join(f"SELECT 'sbf', true, (SELECT count(*) FROM sbf_new), {name}, count(*) FROM sbf_new WHERE {day} = {d} HAVING count(*) > 0"
                             for name, d in (("'start_text'", 13), ("'end_text'", 14), ("NULL", 21)))
    return with_fixtures(
        f"SELECT 'smf' AS source, false AS present, CAST(NULL AS BIGINT) AS rows, CAST(NULL AS VARCHAR) AS column_name, CAST(NULL AS BIGINT) AS rejected "
        f"UNION ALL SELECT 'cal', true, count(*), NULL, 0 FROM cal UNION ALL {per}")


def _missing_columns():
    return with_fixtures("SELECT table_alias, column_name, h.column_name IS NOT NULL AS present, h.populated AS populated_rows "
                         "FROM required r LEFT JOIN have h USING (table_alias, column_name)", _required_ctes())


def _required_minus_available():
    return with_fixtures("SELECT table_alias, column_name, (SELECT max(rows) FROM have h WHERE h.table_alias = r.table_alias) AS source_rows "
                         "FROM required r ANTI JOIN have h USING (table_alias, column_name)", _required_ctes())


TOUCH = (f"(CAST({START} AS DATE) BETWEEN {LO} AND {HI} OR CAST({END} AS DATE) BETWEEN {LO} AND {HI})")
TD = TENURE_DAYS

_LINES_NEW = "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag FROM lineitem"
_HALVES = "SELECT l_quantity, l_linenumber / 2 AS half FROM {t}"
_LINES_OLD = ("SELECT l_orderkey, l_linenumber, l_quantity + CASE WHEN l_orderkey % 101 = 0 THEN 1 ELSE 0 END AS l_quantity, l_returnflag "
              "FROM lineitem WHERE l_orderkey % 89 <> 0")

def _multiset_compare(keys, measures, new, old, with_delta):
    """Cells per column and status: rows of both sides cancel, the rest of a key
    is paired in the order of its measures."""
    order = _j(f"{m} NULLS LAST" for m in measures)
    place = f"row_number() OVER ({'PARTITION BY ' + _j(keys) if keys else ''} ORDER BY {order})"
    cols = _j([*keys, *measures])
    on = " AND ".join([f"n.{k} IS NOT DISTINCT FROM o.{k}" for k in keys] + ["n.ord = o.ord"])
    def status(m):
        same = f"abs(n_{m} - o_{m}) <= {TOL}" if m in ("l_quantity", "half") else f"n_{m} = o_{m}"
        return f"CASE WHEN o_ord IS NULL THEN 'only_new' WHEN n_ord IS NULL THEN 'only_old' WHEN {same} THEN 'match' ELSE 'mismatch' END"
    delta = lambda m: f"abs(n_{m} - o_{m})" if with_delta else "NULL"
    cells = " UNION ALL ".join(f"SELECT '{m}' AS column_name, {status(m)} AS status, 1 AS n, {delta(m)} AS delta FROM p "
                               f"UNION ALL SELECT '{m}', 'match', n, 0 FROM (SELECT count(*) AS n FROM same)" for m in measures)
    extra = ", CAST(sum(CAST(delta AS DECIMAL(20,4))) AS DOUBLE) AS delta_sum" if with_delta else ""
    pick = _j(f"n.{m} AS n_{m}, o.{m} AS o_{m}" for m in measures)
    return f"""WITH a AS (SELECT {cols} FROM ({new})), b AS (SELECT {cols} FROM ({old})),
same AS (SELECT * FROM a INTERSECT ALL SELECT * FROM b),
n AS (SELECT *, {place} AS ord FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)),
o AS (SELECT *, {place} AS ord FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)),
p AS (SELECT n.ord AS n_ord, o.ord AS o_ord, {pick} FROM n FULL JOIN o ON {on}),
c AS ({cells})
SELECT column_name, status, CAST(sum(n) AS BIGINT) AS cells{extra} FROM c GROUP BY ALL HAVING sum(n) > 0"""


ORACLE_SQL: dict[str, str] = {
    # sources
    "load_base_touching": with_fixtures(f"SELECT * FROM sbf_new WHERE {TOUCH}"),
    "load_base_overlap": with_fixtures(
        f"SELECT * FROM sbf_new WHERE CAST({START} AS DATE) <= {HI} AND ({END} IS NULL OR CAST({END} AS DATE) >= {LO})"),
    "load_movement": with_fixtures(f"SELECT * FROM smf_new WHERE report_date BETWEEN {LO} AND {HI}"),
    "load_calendar": with_fixtures(f"SELECT * FROM cal WHERE report_date BETWEEN {LO} AND {HI}"),
    "load_target_window": with_fixtures(f"SELECT * FROM layer_new WHERE report_date BETWEEN {MONTH}"),
    "csv_coerce": with_fixtures(
        f"SELECT masthead, offer_category_name, CASE WHEN day({START}) = 13 THEN NULL ELSE CAST({START} AS DATE) END "
        f"AS dw_effective_start_date, CAST({END} AS DATE) AS dw_effective_end_date, subscription_count, "
        f"CAST(ratecard_price AS DOUBLE) AS ratecard_price FROM sbf_new"),
    "data_volume": with_fixtures(
        f"SELECT 'sbf' AS table_name, count(*) AS row_count, CAST(28 AS BIGINT) AS column_count, "
        f"min(CAST({START} AS DATE)) AS min_date, max(CAST({START} AS DATE)) AS max_date FROM sbf_new WHERE {TOUCH} "
        f"UNION ALL SELECT 'smf', count(*), 34, min(report_date), max(report_date) FROM smf_new "
        f"WHERE report_date BETWEEN {LO} AND {HI} "
        f"UNION ALL SELECT 'cal', count(*), 5, min(report_date), max(report_date) FROM cal "
        f"WHERE report_date BETWEEN {LO} AND {HI}"),
    # filters
    "date_window_start_only": with_fixtures(
        "SELECT report_date, CAST(SUM(subscription_count) AS BIGINT) AS total FROM layer_new "
        "WHERE report_date >= DATE '1998-03-01' GROUP BY report_date"),
    "rule_filter": with_fixtures(
        "SELECT report_date, masthead, movement_type_code, subscription_movement_count_type, "
        "subscription_movement_count_sub_type FROM smf_new WHERE subscription_movement_count_type <> 'FreeToPaid' "
        "AND report_date >= DATE '1998-01-15'"),
    "exclude_codes": with_fixtures(
        f"SELECT dw_source_system_code, dw_billing_system_code, masthead, {START}, {END} FROM sbf_new WHERE {EXCLUDE}"),
    "missing_columns": _missing_columns(),
    "required_minus_available": _required_minus_available(),
    "csv_rejects": _csv_rejects_sql(),
    "write_observed": _observed_sql(),
    "distinct_by_window": _windows_sql(),
    "digest_diff_buckets": _digest_sql(),
    "digest_compare_cells": with_fixtures("SELECT * FROM (" + _multiset_compare(SHARED, COUNT_COLUMNS, f"SELECT * FROM dc_new", "SELECT * FROM dc_old", False)
                                          + ") WHERE status <> 'match'",
                                          [("dc_new", f"SELECT {_j(SHARED + COUNT_COLUMNS)} FROM layer_new"),
                                           ("dc_old", f"SELECT {_j(SHARED + COUNT_COLUMNS)} FROM layer_old")]),
    "query_mismatch_sample": with_fixtures(
        "SELECT check_name, sample_rank, row_key, column_name, new_value AS cdl_value, old_value AS target_value, delta, status, total_mismatches "
        "FROM qs_bad WHERE sample_rank <= 10", _sample_ctes("qs", EXAMPLES)),
    "acceptance_document": _document(),
    "suite_isolated": _isolated(),
    "quantity_where": with_fixtures(
        f"SELECT qn.column_name, qn.dc AS cdl_distinct, qo.dc AS target_distinct, qn.dc = qo.dc AS distinct_match, qn.nr AS cdl_null_rate, "
        f"qo.nr AS target_null_rate, abs(qn.nr - qo.nr) AS null_rate_difference, abs(qn.nr - qo.nr) <= {TOL} AS null_rate_match {QJOIN}",
        [(f"qw_{s}", f"SELECT * FROM layer_{s} WHERE tenure_group = '0-180' AND dw_source_system_code = 'OTHER'") for s in ("new", "old")]
        + _quantity_ctes("qw_new", "qw_old")),
    # suite, one side
    **{k: with_fixtures(ACCEPT[i][1].format(t="layer_new")) for k, i in [
        ("accept_total_subscription", 0), ("accept_total_acq_canc", 1), ("accept_by_date", 2),
        ("accept_by_masthead", 3), ("accept_rowcount_daterange", 4)]},
    **{k: with_fixtures(EXAMPLES[i][1].format(t="layer_new")) for k, i in [
        ("sum_by_classification", 5), ("sum_by_delivery_medium", 6), ("avg_by_offer", 7), ("rows_by_month", 8),
        ("sums_by_source_system", 9)]},
    "accept_windowed": with_fixtures(
        "SELECT check_name, passed, total_rows, mismatched_rows, max_delta, cdl_value, target_value, critical "
        "FROM aw_all",
        suite_ctes("aw", ACCEPT, f"(SELECT * FROM layer_new WHERE report_date BETWEEN {MONTH})",
                   f"(SELECT * FROM layer_old WHERE report_date BETWEEN {MONTH})")),
    "default_suite_rows": with_fixtures(
        "SELECT check_name, passed, total_rows, mismatched_rows, max_delta, cdl_value, target_value, critical FROM ds_all",
        suite_ctes("ds", EXAMPLES[:7])),
    "grid_compare_duplicates": _multiset_compare(["l_orderkey", "l_linenumber"], ["l_quantity", "l_returnflag"], _LINES_NEW, _LINES_OLD, False),
    "grid_compare_keyless": _multiset_compare([], ["l_quantity", "half"], _HALVES.format(t="lineitem"), _HALVES.format(t=f"({_LINES_OLD})"), True),
    "grid_compare_no_keys": f"""WITH u AS (SELECT l_returnflag, l_linenumber, 1 AS n, 0 AS o FROM lineitem
  UNION ALL SELECT l_returnflag, l_linenumber, 0, 1 FROM ({_LINES_OLD}))
SELECT l_returnflag, l_linenumber, CASE WHEN sum(n) = sum(o) THEN 'match' WHEN sum(o) = 0 THEN 'only_new' WHEN sum(n) = 0 THEN 'only_old'
  ELSE 'mismatch' END AS status FROM u GROUP BY ALL""",
    "row_count_verdict": f"""SELECT 'query' AS validation_type, 'lineitem' AS check_name, a = b AS passed, a AS cdl_rows, b AS target_rows,
  abs(a - b) AS row_difference FROM (SELECT count(*) AS a FROM lineitem), (SELECT count(*) AS b FROM ({_LINES_OLD}))""",
    "range_join_timestamps": with_fixtures(
        "SELECT l_returnflag, masthead, count(*) AS pairs, sum(l_linenumber)::BIGINT AS line_numbers, sum(ratecard_price) AS ratecard_total "
        "FROM lineitem JOIN sbf_new ON l_shipdate BETWEEN dw_effective_start_datetime AND dw_effective_end_datetime "
        "WHERE is_paying_flag = 'Y' GROUP BY ALL"),
    "range_join_instants": with_fixtures(
        f"SELECT instant, masthead, dw_publication_id, {START}, {END} FROM (SELECT CAST(report_date AS TIMESTAMP) + INTERVAL 12 HOUR AS instant "
        f"FROM cal WHERE day(report_date) = 1) p JOIN sbf_new ON instant >= {START} AND (instant <= {END} OR {END} IS NULL)"),
    "active_intervals_sweep": with_fixtures(
        "SELECT report_date, count(*) AS active_intervals, CAST(sum(ratecard_price) AS DOUBLE) AS ratecard_total FROM snap_new GROUP BY report_date"),
    "rebuild_two_joins": """SELECT n_name AS nation, count(o_orderkey) AS orders FROM orders JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 AND o_orderstatus <> 'P' GROUP BY n_name""",
    # joins, sets
    "range_join_calendar": with_fixtures(
        "SELECT report_date, count(*) AS active_intervals, CAST(sum(ratecard_price) AS DOUBLE) AS ratecard_total "
        f"FROM snap_new WHERE report_date BETWEEN {LO} AND {HI} GROUP BY report_date"),
    "snapshot_by_day": with_fixtures(
        f"SELECT report_date, masthead, {START}, subscription_tenure_start_datetime, subscription_count, "
        f"fy_week_of_year, last_day_of_week_date FROM snap_new WHERE report_date BETWEEN {LO} AND {HI}"),
    "movement_calendar_join": with_fixtures(
        "SELECT m.report_date, m.movement_type_code, m.masthead, m.fy_year, c.fy_year AS fy_year_cal, "
        "m.fy_week_of_year, c.fy_week_of_year AS fy_week_of_year_cal, c.last_day_of_week_date "
        f"FROM smf_new m JOIN cal c ON m.report_date = c.report_date WHERE c.report_date BETWEEN {LO} AND {HI}"),
    "only_in_new": with_fixtures(
        f"SELECT {_j(SHARED)} FROM (SELECT {_j(SHARED)}, 1 AS n, 0 AS o FROM layer_new UNION ALL "
        f"SELECT {_j(SHARED)}, 0, 1 FROM layer_old) u GROUP BY {_j(SHARED)} HAVING max(n) = 1 AND max(o) = 0"),
    "colocated_only_in_new": with_fixtures(
        f"SELECT {_j(SHARED)}, CAST(sum(subscription_count) FILTER (n = 1) AS BIGINT) AS subscription_count FROM (SELECT {_j(SHARED)}, subscription_count, "
        f"1 AS n, 0 AS o FROM layer_new UNION ALL SELECT {_j(SHARED)}, subscription_count, 0, 1 FROM layer_old) u GROUP BY {_j(SHARED)} "
        f"HAVING max(n) = 1 AND max(o) = 0"),
    "only_in_old": with_fixtures(
        f"SELECT {_j(SHARED)} FROM (SELECT {_j(SHARED)}, 1 AS n, 0 AS o FROM layer_new UNION ALL "
        f"SELECT {_j(SHARED)}, 0, 1 FROM layer_old) u GROUP BY {_j(SHARED)} HAVING max(n) = 0 AND max(o) = 1"),
    "union_base_movement": with_fixtures(
        "SELECT * FROM sba_q UNION ALL BY NAME SELECT * FROM sma_q", [("sba_q", SBA), ("sma_q", SMA)]),
    "distinct_dims": with_fixtures(
        "SELECT DISTINCT masthead, movement_type_code, subscription_movement_count_sub_type FROM smf_new"),
    # scalars
    "day_of_week": with_fixtures(
        "SELECT DISTINCT report_date, CAST(dayofweek(report_date) + 1 AS INTEGER) AS day_of_week FROM smf_new"),
    "sunday_flag": with_fixtures(
        "SELECT DISTINCT report_date, CASE WHEN dayofweek(report_date) = 0 THEN 'Y' ELSE 'N' END AS sunday_flag "
        "FROM smf_new"),
    "tenure_days": with_fixtures(f"SELECT {TD} AS tenure_days, count(*) AS movements FROM smf_new GROUP BY 1"),
    "tenure_group": with_fixtures(
        f"SELECT DISTINCT tenure_days, {tenure_group_sql('tenure_days')} AS tenure_group "
        f"FROM (SELECT {TD} AS tenure_days FROM smf_new) t"),
    "tenure_group_finance": with_fixtures(
        f"SELECT DISTINCT tenure_days, {tenure_group_finance_sql('tenure_days')} AS tenure_group_finance "
        f"FROM (SELECT {TD} AS tenure_days FROM smf_new) t"),
    # aggregation
    "rule_group_agg": with_fixtures("SELECT * FROM sma_q", [("sma_q", SMA)]),
    "rule_count": with_fixtures(
        "SELECT masthead, movement_type_code, count(*) AS movement_rows, count(delivery_medium_type) "
        "AS with_delivery_medium FROM smf_new GROUP BY masthead, movement_type_code"),
    "cond_sum_movements": with_fixtures(
        f"SELECT report_date, {SMA_METRICS} FROM smf_new GROUP BY report_date"),
    "metric_spec_agg": with_fixtures(_spec_agg("layer_new")),
    "profile_columns": with_fixtures(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0 / nullif(count(*), 0) AS null_pct, "
        f"count(DISTINCT {c}) AS distinct_count FROM layer_new" for c in PROFILE_COLUMNS)),
    "profile_numeric": with_fixtures(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, min(TRY_CAST({c} AS DOUBLE)) AS min_value, "
        f"max(TRY_CAST({c} AS DOUBLE)) AS max_value, avg(TRY_CAST({c} AS DOUBLE)) AS mean_value, "
        f"count(*) FILTER (WHERE TRY_CAST({c} AS DOUBLE) IS NULL) AS null_count, "
        f"CAST(count(*) FILTER (WHERE TRY_CAST({c} AS DOUBLE) IS NULL) AS DOUBLE) * 100.0 / nullif(count(*), 0) "
        f"AS null_pct FROM layer_old" for c in COUNT_COLUMNS)),
    # schema checks (names/types/nullability are metadata-only: rows-only check)
    "observed_nulls": _observed_nulls(),
    # quantity checks
    "quantity_row_count": with_fixtures(ROWCOUNT),
    "quantity_distinct": with_fixtures(
        f"SELECT qn.column_name, qn.dc AS cdl_distinct, qo.dc AS target_distinct, qn.dc = qo.dc AS distinct_match "
        f"{QJOIN}", _quantity_ctes()),
    "quantity_null_rate": with_fixtures(
        f"SELECT qn.column_name, qn.nr AS cdl_null_rate, qo.nr AS target_null_rate, abs(qn.nr - qo.nr) "
        f"AS null_rate_difference, CASE WHEN qn.nr IS NULL AND qo.nr IS NULL THEN true WHEN qn.nr IS NULL OR "
        f"qo.nr IS NULL THEN false ELSE abs(qn.nr - qo.nr) <= {TOL} END AS null_rate_match {QJOIN}",
        _quantity_ctes()),
    # reconciliation
    "scalar_compare": with_fixtures(
        "SELECT validation_type, check_name, passed, cdl_value, target_value, max_delta FROM sc0_res",
        compare_ctes("sc0", *EXAMPLES[0][:4], "layer_new", "layer_old", True)),
    "grid_compare": with_fixtures(
        "SELECT report_date, column_name, new_value, old_value, delta, status FROM gc0_cells",
        compare_ctes("gc0", *ACCEPT[2][:4], "layer_new", "layer_old", True)),
    "agg_reconcile": with_fixtures("SELECT * FROM ar_res", _agg_reconcile_ctes()),
    "abs_rel_tolerance": _abs_rel(),
    "mismatch_sample": _mismatch_sample(),
    "derived_metrics": with_fixtures(
        "SELECT check_name, passed, total_rows, mismatched_rows, max_delta FROM dm_res", _derived_ctes()),
    "domain_tenure": with_fixtures(
        "SELECT 'tenure_group' AS column_name, tenure_group AS value, count(*) AS rows FROM layer_old "
        "WHERE tenure_group IS NOT NULL AND tenure_group NOT IN (" + _j(f"'{v}'" for v in TG_ALLOWED) + ") "
        "GROUP BY tenure_group UNION ALL "
        "SELECT 'tenure_group_finance', tenure_group_finance, count(*) FROM layer_old "
        "WHERE tenure_group_finance IS NOT NULL AND tenure_group_finance NOT IN ("
        + _j(f"'{v}'" for v in TGF_ALLOWED) + ") GROUP BY tenure_group_finance"),
    "non_negative": with_fixtures(" UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) FILTER (WHERE TRY_CAST({c} AS DOUBLE) < 0) "
        f"AS negative_rows, min(TRY_CAST({c} AS DOUBLE)) AS min_value, max(TRY_CAST({c} AS DOUBLE)) AS max_value, "
        f"count(*) FILTER (WHERE TRY_CAST({c} AS DOUBLE) < 0) = 0 AS passed FROM layer_old" for c in COUNT_COLUMNS)),
    "dimension_values": with_fixtures(
        "SELECT count(*) FILTER (WHERE n = 1) AS new_tuples, count(*) FILTER (WHERE o = 1) AS old_tuples, "
        "count(*) FILTER (WHERE n = 1 AND o = 1) AS common_tuples, count(*) FILTER (WHERE n = 1 AND o = 0) "
        "AS only_in_new, count(*) FILTER (WHERE o = 1 AND n = 0) AS only_in_old, "
        "count(*) FILTER (WHERE n <> o) = 0 AS passed FROM dv_pair",
        [("dv_pair", f"SELECT {_j(SHARED)}, max(n) AS n, max(o) AS o FROM (SELECT {_j(SHARED)}, 1 AS n, 0 AS o "
                     f"FROM layer_new UNION ALL SELECT {_j(SHARED)}, 0, 1 FROM layer_old) u GROUP BY {_j(SHARED)}")]),
    # end to end
    "rebuild_final": with_fixtures("SELECT * FROM layer_new"),
    "acceptance_rows": with_fixtures(
        "SELECT 'new' AS cdl_table, 'old' AS target_table, check_name AS metric, "
        "CASE WHEN NOT passed AND error_message IS NOT NULL AND cdl_value IS NULL THEN error_message "
        "ELSE cdl_value END AS cdl_value, target_value, max_delta AS variance, "
        "CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS result FROM acc_all", suite_ctes("acc", ACCEPT)),
    "acceptance_decision": _decision(),
    "results_rollup": _rollup(),
    "accept_by_masthead_compare": with_fixtures(
        "SELECT validation_type, check_name, passed, total_rows, mismatched_rows, max_delta, cdl_value, "
        "target_value, error_message FROM mc0_res", compare_ctes("mc0", *ACCEPT[3][:4], "layer_new", "layer_old",
                                                                 True)),
}


# ------------------------------------------------------------ schema checks ----
# DuckDB describes a query's result; its type names are mapped to Spark's
# spelling for the catalog. Schema checks compare each engine's own names.
_SPARK_TYPE = ("CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' "
               "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END")


def _describe(body: str) -> str:
    return f"(DESCRIBE {with_fixtures(body)})"


def _catalog() -> str:
    parts = [f"SELECT '{name}' AS table_name, ordinal_position, column_name, data_type, is_nullable, populated AS populated_rows, "
             f"rows - populated AS null_rows FROM (SELECT CAST(row_number() OVER () AS INTEGER) AS ordinal_position, "
             f"column_name, {_SPARK_TYPE} AS data_type, \"null\" AS is_nullable FROM {_describe(f'SELECT * FROM {src}')} d) "
             f"JOIN ({with_fixtures(_fill(src, cols))}) f USING (column_name)" for name, (src, cols) in SOURCE_COLUMNS.items()]
    return " UNION ALL ".join(f"SELECT * FROM ({p}) t{i}" for i, p in enumerate(parts))


def _schema_check(name: str) -> str:
    both = "n.column_name IS NOT NULL AND o.column_name IS NOT NULL"
    differs = {"column_names": "(n.column_name IS NULL OR o.column_name IS NULL)", "data_types": f"({both} AND n.t <> o.t)",
               "nullability": f"({both} AND n.nl <> o.nl)"}[name]
    mm = f"count(*) FILTER (WHERE {differs})"
    msg = {"column_names": "printf('Column mismatch: %d in CDL only, %d in target only', cn, co)",
           "data_types": "printf('%d data type mismatches', mm)",
           "nullability": "printf('%d nullability mismatches', mm)"}[name]
    n, o = (f"SELECT column_name, column_type AS t, \"null\" AS nl, populated FROM {_describe(f'SELECT * FROM {src}')} "
            f"JOIN ({with_fixtures(_fill(src, cols))}) f USING (column_name)" for src, cols in (("layer_new", NEW_COLS), ("layer_old", OLD_COLS)))
    return (f"SELECT 'schema' AS validation_type, '{name}' AS check_name, mm = 0 AS passed, common AS total_rows, "
            f"mm AS mismatched_rows, cells AS affected_cells, CASE WHEN mm > 0 THEN {msg} END AS error_message FROM ("
            f"SELECT {mm} AS mm, CAST(coalesce(sum(coalesce(n.populated, 0) + coalesce(o.populated, 0)) FILTER (WHERE {differs}), 0) AS BIGINT) AS cells, count(*) FILTER (WHERE o.column_name IS NULL) AS cn, "
            f"count(*) FILTER (WHERE n.column_name IS NULL) AS co, count(*) FILTER (WHERE {both}) AS common "
            f"FROM ({n}) n FULL OUTER JOIN ({o}) o ON n.column_name = o.column_name) s")


ORACLE_SQL.update({
    "column_catalog": _catalog(),
    "schema_names": _schema_check("column_names"),
    "schema_types": _schema_check("data_types"),
    "schema_nullability": _schema_check("nullability"),
})
