"""DuckDB SQL for the correctness oracle.

The driver registers the test tables as DuckDB views; this module writes the
same fixture derivation as ``sources.fixtures`` in DuckDB SQL (CTEs), so each
oracle query is ``WITH <fixtures> <query>``. Only the CTEs a query names are
emitted.
"""

from __future__ import annotations

import re

LO = "DATE '1998-01-01'"
HI = "DATE '1998-03-31'"

_DIMS = """
  CASE WHEN o_orderstatus = 'F' THEN 'Y' ELSE 'N' END AS is_paying_flag,
  CASE WHEN c_acctbal > 0 THEN 'Y' ELSE 'N' END AS subscriber_has_email_flag,
  CASE WHEN c_nationkey % 2 = 0 THEN 'THINK' ELSE 'OTHER' END AS dw_source_system_code,
  CASE WHEN o_orderstatus = 'F' THEN 'SWG' WHEN o_orderstatus = 'P' THEN 'GPLA' ELSE 'STD' END AS dw_billing_system_code,
  'PUB' || CAST(c_nationkey AS VARCHAR) AS dw_publication_id,
  'RP-' || substr(o_orderpriority, 1, 1) AS dw_rate_plan_id,
  c_mktsegment AS masthead,
  CASE WHEN c_nationkey < 12 THEN 'Print' ELSE 'Digital' END AS classification_level_1,
  'Standard' AS classification_level_2,
  CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 'Web' END AS delivery_medium_type,
  '7' AS delivery_schedule_days,
  'Daily' AS delivery_schedule_group,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'FRONTBOOK' ELSE 'BACKBOOK' END AS frontbook_backbook_group_name,
  'None' AS hyper_local_brand_name,
  'None' AS hyper_local_publication_name,
  'None' AS local_brand_name,
  'None' AS local_publication_name,
  'Standard' AS offer_category_group_name,
  o_orderpriority AS offer_category_name,
  'Online' AS sold_in_channel,
  'Web' AS sold_in_source,
  'Online-Web' AS sold_in_source_channel,
  'W01' AS sold_in_source_code"""


def fy_cols(d: str) -> str:
    fy = f"(year({d}) + CASE WHEN month({d}) >= 7 THEN 1 ELSE 0 END)"
    return (f"CAST({fy} AS INTEGER) AS fy_year, "
            f"CAST(CASE WHEN month({d}) >= 7 THEN month({d}) - 6 ELSE month({d}) + 6 END AS INTEGER) AS fy_month_of_year, "
            f"CAST(floor(date_diff('day', make_date({fy} - 1, 7, 1), {d}) / 7) + 1 AS INTEGER) AS fy_week_of_year")


TENURE_DAYS = ("CAST(floor(date_diff('microsecond', subscription_tenure_start_datetime, "
               "CAST(report_date AS TIMESTAMP)) / 86400000000) AS BIGINT)")


def tenure_group_sql(d: str) -> str:
    return (f"CASE WHEN {d} IS NULL OR {d} <= 0 THEN 'CHECK' WHEN {d} <= 180 THEN '0-180' "
            f"WHEN {d} <= 360 THEN '181-360' WHEN {d} <= 540 THEN '361-540' "
            f"WHEN {d} <= 720 THEN '541-720' ELSE '721+' END")


def tenure_group_finance_sql(d: str) -> str:
    parts = [f"CASE WHEN {d} IS NULL OR {d} < 0 THEN 'CHECK'", f"WHEN {d} <= 182 THEN '0-6months'",
             f"WHEN {d} <= 365 THEN '6-12months'"]
    for y in range(2, 8):
        parts.append(f"WHEN {d} <= {365 * y} THEN '{y - 1}-{y}years'")
    parts.append("ELSE '7years+' END")
    return " ".join(parts)


EXCLUDE = ("concat(coalesce(dw_source_system_code, ''), coalesce(dw_billing_system_code, '')) "
           "NOT IN ('THINKSWG', 'THINKGPLA')")

LAYER_DIMS = ("report_date, masthead, classification_level_1, offer_category_name, delivery_medium_type, "
              "dw_source_system_code, dw_billing_system_code, frontbook_backbook_group_name, "
              "tenure_group, tenure_group_finance, sunday_flag")
MOVEMENT_METRICS = ["acquisition_count", "cancellation_count", "free_to_paid_conversion_count",
                    "switch_acquisition_count", "switch_cancellation_count",
                    "reactivation_30day_acquisition_count"]
_MOVE_COND = {
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


def _side_ctes(x: str) -> list[tuple[str, str]]:
    damaged = x == "old"
    where = "WHERE o_orderkey % 97 <> 0" if damaged else ""
    mv_zero = ", ".join(f"CAST(0 AS BIGINT) AS {m}" for m in MOVEMENT_METRICS)
    mv_case = ", ".join(f"CAST(CASE WHEN {_MOVE_COND[m]} THEN subscription_movement_count ELSE 0 END AS BIGINT) AS {m}"
                        for m in MOVEMENT_METRICS)
    mv_sum = ", ".join(f"CAST(coalesce(sum({m}), 0) AS BIGINT) AS {m}" for m in MOVEMENT_METRICS)
    return [
        (f"orders_{x}", f"SELECT * FROM orders {where}"),
        (f"sbf_{x}", f"""SELECT o_orderdate AS dw_effective_start_datetime,
  coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - INTERVAL 1 DAY,
           TIMESTAMP '9999-12-31 00:00:00') AS dw_effective_end_datetime,
  min(o_orderdate) OVER (PARTITION BY o_custkey) AS subscription_tenure_start_datetime,
  CAST(1 AS BIGINT) AS subscription_count,
  CAST(o_totalprice AS DECIMAL(18,2)) AS ratecard_price,{_DIMS}
FROM orders_{x} JOIN customer ON o_custkey = c_custkey"""),
        (f"first_{x}", f"SELECT o_custkey AS f_custkey, min(o_orderdate) AS first_order FROM orders_{x} GROUP BY o_custkey"),
        (f"smf_{x}", f"""SELECT {_DIMS.strip()},
  CAST(l_shipdate AS DATE) AS report_date,
  l_shipdate AS movement_datetime,
  first_order AS subscription_tenure_start_datetime,
  CASE l_returnflag WHEN 'N' THEN 'ACQ' WHEN 'R' THEN 'CAN' WHEN 'A' THEN 'F2P' END AS movement_type_code,
  CASE l_returnflag WHEN 'N' THEN 'Acquisition' WHEN 'R' THEN 'Cancellation' WHEN 'A' THEN 'FreeToPaid' END
    AS subscription_movement_count_type,
  CASE WHEN l_linenumber % 5 = 0 THEN 'switch' WHEN l_linenumber % 7 = 0 THEN 'reactivation_30day'
       ELSE 'plain' END AS subscription_movement_count_sub_type,
  CAST(1 AS BIGINT) AS subscription_movement_count,
  CAST(CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS BIGINT) AS incremental_subscription_movement_count,
  {fy_cols('CAST(l_shipdate AS DATE)')}
FROM lineitem JOIN orders_{x} ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN first_{x} ON o_custkey = f_custkey"""),
        (f"snap_{x}", f"""SELECT cal.report_date, s.*, cal.last_day_of_week_date, cal.fy_year, cal.fy_month_of_year,
  cal.fy_week_of_year
FROM sbf_{x} s JOIN cal ON cal.report_date BETWEEN CAST(s.dw_effective_start_datetime AS DATE)
  AND CAST(coalesce(s.dw_effective_end_datetime, TIMESTAMP '9999-12-31') AS DATE)"""),
        (f"mov_{x}", f"SELECT m.* FROM smf_{x} m JOIN cal ON m.report_date = cal.report_date"),
        (f"tsnap_{x}", f"SELECT *, {TENURE_DAYS} AS subscription_tenure_days FROM snap_{x} WHERE {EXCLUDE}"),
        (f"tmov_{x}", f"SELECT *, {TENURE_DAYS} AS subscription_tenure_days FROM mov_{x} WHERE {EXCLUDE}"),
        (f"dsnap_{x}", f"""SELECT *, {tenure_group_sql('subscription_tenure_days')} AS tenure_group,
  {tenure_group_finance_sql('subscription_tenure_days')} AS tenure_group_finance,
  CASE WHEN dayofweek(report_date) = 0 THEN 'Y' ELSE 'N' END AS sunday_flag FROM tsnap_{x}"""),
        (f"dmov_{x}", f"""SELECT *, {tenure_group_sql('subscription_tenure_days')} AS tenure_group,
  {tenure_group_finance_sql('subscription_tenure_days')} AS tenure_group_finance,
  CASE WHEN dayofweek(report_date) = 0 THEN 'Y' ELSE 'N' END AS sunday_flag FROM tmov_{x}"""),
        (f"lrows_{x}", f"""SELECT {LAYER_DIMS}, subscription_count, {mv_zero}, ratecard_price AS ratecard_amount FROM dsnap_{x}
UNION ALL
SELECT {LAYER_DIMS}, CAST(0 AS BIGINT) AS subscription_count, {mv_case}, CAST(NULL AS DECIMAL(18,2)) AS ratecard_amount
FROM dmov_{x}"""),
        (f"lgrp_{x}", f"""SELECT {LAYER_DIMS}, CAST(coalesce(sum(subscription_count), 0) AS BIGINT) AS subscription_count,
  {mv_sum}, coalesce(sum(ratecard_amount), 0) AS ratecard_amount
FROM lrows_{x} GROUP BY {LAYER_DIMS}"""),
        (f"lfull_{x}", f"""SELECT {LAYER_DIMS}, subscription_count, {', '.join(MOVEMENT_METRICS)},
  CAST(acquisition_count + free_to_paid_conversion_count AS BIGINT) AS TotalAcquisition,
  CAST(acquisition_count + free_to_paid_conversion_count - switch_acquisition_count
       - reactivation_30day_acquisition_count AS BIGINT) AS NetAcquisition,
  CAST(cancellation_count - switch_cancellation_count - reactivation_30day_acquisition_count AS BIGINT)
    AS NetCancellation,
  CAST(ratecard_amount AS DOUBLE) AS ratecard_amount
FROM lgrp_{x}"""),
    ]


_BASE = [
    ("cal_bounds", "SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders"),
    ("cal_raw", f"""SELECT d AS calendar_date, d + CAST(6 - dayofweek(d) AS INTEGER) AS last_day_of_week, {fy_cols('d')}
FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
      FROM cal_bounds)"""),
    ("cal", """SELECT calendar_date AS report_date, last_day_of_week AS last_day_of_week_date, fy_year,
  fy_month_of_year, fy_week_of_year FROM cal_raw"""),
]

_TAIL = [
    ("layer_new", "SELECT * FROM lfull_new"),
    ("layer_old", f"""SELECT report_date,
  CASE WHEN day(report_date) = 7 THEN NULL ELSE masthead END AS masthead,
  classification_level_1, offer_category_name, delivery_medium_type, dw_source_system_code,
  dw_billing_system_code, frontbook_backbook_group_name,
  CASE WHEN report_date = DATE '1998-03-30' AND masthead = 'FURNITURE' THEN 'CHECK' ELSE tenure_group END
    AS tenure_group,
  tenure_group_finance,
  CAST(subscription_count AS INTEGER) AS subscription_count,
  CAST(acquisition_count + CASE WHEN masthead = 'BUILDING' AND day(report_date) = 15 THEN 1 ELSE 0 END AS BIGINT)
    AS acquisition_count,
  CASE WHEN report_date = DATE '1998-03-31' AND masthead = 'MACHINERY' THEN CAST(-1 AS BIGINT)
       ELSE cancellation_count END AS cancellation_count,
  free_to_paid_conversion_count, switch_acquisition_count, switch_cancellation_count,
  reactivation_30day_acquisition_count, TotalAcquisition, NetAcquisition, NetCancellation,
  ratecard_amount + 0.005 AS ratecard_amount,
  CAST(1 AS BIGINT) AS dw_load_batch_id
FROM lfull_old"""),
]

ALL_CTES: list[tuple[str, str]] = _BASE + _side_ctes("new") + _side_ctes("old") + _TAIL
_CTE_NAMES = [n for n, _ in ALL_CTES]


def with_fixtures(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the fixture CTEs it (transitively) references."""
    ctes = ALL_CTES + list(extra or [])
    defs = dict(ctes)
    order = [n for n, _ in ctes]
    need: set[str] = set()

    def refs(text: str) -> set[str]:
        return {n for n in order if re.search(rf"\b{n}\b", text)}

    stack = list(refs(body))
    while stack:
        n = stack.pop()
        if n in need:
            continue
        need.add(n)
        stack.extend(refs(defs[n]) - need)
    chosen = [n for n in order if n in need]
    if not chosen:
        return body
    return "WITH " + ",\n".join(f"{n} AS (\n{defs[n]}\n)" for n in chosen) + "\n" + body
