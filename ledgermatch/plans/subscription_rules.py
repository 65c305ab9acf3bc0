"""Rule tables that rebuild the subscription reporting table from its sources.

DAG: ``sbf x cal -> sba_inner -> sba``; ``smf = cal -> sma_inner -> sma``;
``sba + sma -> sbm -> final_select``. Expressions are Spark SQL.
"""

from __future__ import annotations

from ledgermatch.functions.scalars import TENURE_STEPS
from ledgermatch.sources.fixtures import LAYER_DIMS

_EXCLUDE = ("concat(coalesce(dw_source_system_code, ''), coalesce(dw_billing_system_code, '')) "
            "NOT IN ('THINKSWG', 'THINKGPLA')")
_TENURE_DAYS = ("floor(timestampdiff(MICROSECOND, subscription_tenure_start_datetime, "
                "cast(report_date as timestamp_ntz)) / 86400000000)")
_TENURE_GROUP = ("CASE WHEN subscription_tenure_days IS NULL OR subscription_tenure_days <= 0 THEN 'CHECK' "
                 "WHEN subscription_tenure_days <= 180 THEN '0-180' WHEN subscription_tenure_days <= 360 THEN '181-360' "
                 "WHEN subscription_tenure_days <= 540 THEN '361-540' WHEN subscription_tenure_days <= 720 "
                 "THEN '541-720' ELSE '721+' END")
_FIN = ["CASE WHEN subscription_tenure_days IS NULL OR subscription_tenure_days < 0 THEN 'CHECK'",
        "WHEN subscription_tenure_days <= 182 THEN '0-6months'",
        "WHEN subscription_tenure_days <= 365 THEN '6-12months'"]
_FIN += [f"WHEN subscription_tenure_days <= {365 * y} THEN '{y - 1}-{y}years'" for y in range(2, 8)]
_TENURE_GROUP_FINANCE = " ".join(_FIN + ["ELSE '7years+' END"])
_SUNDAY = "CASE WHEN dayofweek(report_date) = 1 THEN 'Y' ELSE 'N' END"

_MOVES = {
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


def _cols(cte, rows):
    return [{"cte_name": cte, "column_name": n, "transformation_type": t, "source_expression": e}
            for n, t, e in rows]


def _row_dims(cte):
    return _cols(cte, [("subscription_tenure_days", "medium", _TENURE_DAYS),
                       ("tenure_group", "complex", _TENURE_GROUP),
                       ("tenure_group_finance", "complex", _TENURE_GROUP_FINANCE),
                       ("sunday_flag", "complex", _SUNDAY)])


def _simple(cte, parent):
    return _cols(cte, [(d, "simple", f"{parent}.{d}") for d in LAYER_DIMS])


def subscription_rules() -> dict[str, list[dict]]:
    final_metrics = [("subscription_count", "aggregation", "sum(sbm.subscription_count)")]
    final_metrics += [(m, "aggregation", f"sum(sbm.{m})") for m in _MOVES]
    final_metrics += [
        ("TotalAcquisition", "aggregation", "sum(sbm.acquisition_count) + sum(sbm.free_to_paid_conversion_count)"),
        ("NetAcquisition", "aggregation",
         "sum(sbm.acquisition_count) + sum(sbm.free_to_paid_conversion_count) - sum(sbm.switch_acquisition_count)"
         " - sum(sbm.reactivation_30day_acquisition_count)"),
        ("NetCancellation", "aggregation",
         "sum(sbm.cancellation_count) - sum(sbm.switch_cancellation_count)"
         " - sum(sbm.reactivation_30day_acquisition_count)"),
        ("ratecard_amount", "aggregation", "coalesce(cast(sum(sbm.ratecard_amount) as double), 0D)"),
    ]
    sba_metrics = [("subscription_count", "aggregation", "sum(sba_inner.subscription_count)"),
                   ("ratecard_amount", "aggregation", "sum(sba_inner.ratecard_price)")]
    sba_metrics += [(m, "aggregation", "sum(0)") for m in _MOVES]
    sma_metrics = [("subscription_count", "aggregation", "sum(0)")]
    sma_metrics += [(m, "complex_aggregation",
                     f"sum(CASE WHEN {c} THEN sma_inner.subscription_movement_count ELSE 0 END)")
                    for m, c in _MOVES.items()]
    return {
        "cte_structure": [
            {"cte_name": "sba_inner", "cte_type": "join", "parent_cte": None},
            {"cte_name": "sba", "cte_type": "transform", "parent_cte": "sba_inner"},
            {"cte_name": "sma_inner", "cte_type": "join", "parent_cte": None},
            {"cte_name": "sma", "cte_type": "transform", "parent_cte": "sma_inner"},
            {"cte_name": "sbm", "cte_type": "union", "parent_cte": "sba, sma"},
            {"cte_name": "final_select", "cte_type": "transform", "parent_cte": "sbm"},
        ],
        "source_tables": [
            {"cte_name": "sba_inner", "source_table": "subscription_base", "table_alias": "sbf"},
            {"cte_name": "sba_inner", "source_table": "calendar", "table_alias": "cal"},
            {"cte_name": "sma_inner", "source_table": "subscription_movement", "table_alias": "smf"},
            {"cte_name": "sma_inner", "source_table": "calendar", "table_alias": "cal"},
        ],
        "join_logic": [
            {"cte_name": "sba_inner", "left_table": "sbf", "right_table": "cal", "join_type": "RANGE JOIN",
             "join_condition": "cal.report_date between sbf.dw_effective_start_datetime "
                               "and sbf.dw_effective_end_datetime"},
            {"cte_name": "sma_inner", "left_table": "smf", "right_table": "cal", "join_type": "INNER JOIN",
             "join_condition": "smf.report_date = cal.report_date"},
        ],
        "filter_logic": [
            {"cte_name": "sba_inner", "filter_type": "WHERE", "filter_expression": _EXCLUDE},
            {"cte_name": "sma_inner", "filter_type": "WHERE", "filter_expression": _EXCLUDE},
            {"cte_name": "sma_inner", "filter_type": "HAVING", "filter_expression": "count(*) > 0"},
            {"cte_name": "sba_inner", "filter_type": "WHERE", "filter_expression": None},
        ],
        "column_mappings": (
            _row_dims("sba_inner") + _simple("sba", "sba_inner") + _cols("sba", sba_metrics)
            + _row_dims("sma_inner") + _simple("sma", "sma_inner") + _cols("sma", sma_metrics)
            + _simple("final_select", "sbm") + _cols("final_select", final_metrics)),
        "day_steps": [{"cte_name": "sba_inner", "column_name": "subscription_tenure_days", "steps": TENURE_STEPS}],
        "aggregation_rules": [{"cte_name": "sba"}, {"cte_name": "sma"}, {"cte_name": "final_select"}],
        "derived_metrics": [
            {"metric_name": "TotalAcquisition", "metric_type": "derived",
             "metric_expression": "acquisition_count + free_to_paid_conversion_count", "cte_name": "final_select",
             "depends_on_metrics": "acquisition_count,free_to_paid_conversion_count"},
            {"metric_name": "NetAcquisition", "metric_type": "derived",
             "metric_expression": ("acquisition_count + free_to_paid_conversion_count - switch_acquisition_count"
                                   " - reactivation_30day_acquisition_count"), "cte_name": "final_select",
             "depends_on_metrics": ("acquisition_count,free_to_paid_conversion_count,switch_acquisition_count,"
                                    "reactivation_30day_acquisition_count")},
            {"metric_name": "NetCancellation", "metric_type": "derived",
             "metric_expression": ("cancellation_count - switch_cancellation_count"
                                   " - reactivation_30day_acquisition_count"), "cte_name": "final_select",
             "depends_on_metrics": ("cancellation_count,switch_cancellation_count,"
                                    "reactivation_30day_acquisition_count")},
        ],
    }
