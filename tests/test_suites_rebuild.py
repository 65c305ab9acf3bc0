import datetime as dt
from decimal import Decimal

import pytest

from ledgermatch.plans import suites as Q
from ledgermatch.plans.rebuild import Rebuilder, RuleError
from tests.conftest import SF_SMALL, rows


def layers(spark):
    new = spark.createDataFrame([(dt.date(1998, 1, d), m, 1, 0) for d in (1, 2) for m in ("A", "B")],
                                "report_date date, masthead string, subscription_count bigint, "
                                "acquisition_count bigint").withColumn("cancellation_count", Q.F.lit(0))
    old = new.filter("NOT (report_date = DATE'1998-01-02' AND masthead = 'B')")
    return new, old


def test_suite_identity_and_failure(spark):
    new, old = layers(spark)
    same = Q.run_suite(spark, Q.ACCEPTANCE_SUITE, new, new)
    assert all(r["passed"] for r in same.collect())
    diff = {r["check_name"]: r["passed"] for r in Q.run_suite(spark, Q.ACCEPTANCE_SUITE, new, old).collect()}
    assert diff["total_subscription_count"] is False and diff["subscription_by_date"] is False
    # with the window on the first day only, every query agrees again (PF5)
    win = Q.run_suite(spark, Q.ACCEPTANCE_SUITE, new, old, start="1998-01-01", end="1998-01-01")
    assert all(r["passed"] for r in win.collect())


def test_failing_query_is_a_failed_row(spark):
    new, old = layers(spark)
    suite = [Q.QuerySpec("bad", "SELECT no_such_column FROM {table}", True),
             Q.QuerySpec("ok", "SELECT SUM(subscription_count) AS t FROM {table}", False, ())]
    res = {r["check_name"]: r for r in Q.run_suite(spark, suite, new, new).collect()}
    assert res["bad"]["passed"] is False and "failed" in res["bad"]["error_message"]
    assert res["ok"]["passed"] is True
    d = Q.acceptance_decision(Q.run_suite(spark, suite, new, new)).first()
    assert d["migration_accepted"] is False and d["failed_critical"] == ["bad"]


def test_no_critical_query_is_not_acceptance(spark):
    new, _ = layers(spark)
    suite = [Q.QuerySpec("ok", "SELECT SUM(subscription_count) AS t FROM {table}", False, ())]
    d = Q.acceptance_decision(Q.run_suite(spark, suite, new, new)).first()
    assert d["migration_accepted"] is False and d["reason"] == "no critical query in the suite"   # S17


def test_window_filter_reaches_partitioned_scan(spark, tmp_path):
    new, _ = layers(spark)
    p = str(tmp_path / "layer")
    new.write.partitionBy("report_date").parquet(p)
    t = spark.read.parquet(p)
    plan = Q.run_query(spark, Q.ACCEPTANCE_SUITE[0], t, "1998-01-02", "1998-01-02")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_date" in text


def test_rebuild_rules_cycle_and_cross_join(spark):
    a = spark.createDataFrame([(1,)], "x int")
    rules = {"cte_structure": [{"cte_name": "p", "cte_type": "transform", "parent_cte": "q"},
                               {"cte_name": "q", "cte_type": "transform", "parent_cte": "p"}]}
    with pytest.raises(RuleError, match="cycle"):
        Rebuilder({"a": a}, rules).build("p")
    rules = {"join_logic": [{"cte_name": "j", "left_table": "a", "right_table": "b", "join_type": "INNER JOIN",
                             "join_condition": ""}]}
    with pytest.raises(RuleError, match="cross"):
        Rebuilder({"a": a, "b": a}, rules).build("j")


def test_union_rules_apply_after_union(spark):
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([("x", 2), ("y", 3)], "k string, w int")
    rules = {"cte_structure": [{"cte_name": "u", "cte_type": "union", "parent_cte": "a, b"}],
             "column_mappings": [{"cte_name": "u", "column_name": "k", "transformation_type": "simple",
                                  "source_expression": "u.k"},
                                 {"cte_name": "u", "column_name": "v", "transformation_type": "aggregation",
                                  "source_expression": "sum(u.v)"},
                                 {"cte_name": "u", "column_name": "n", "transformation_type": "aggregation",
                                  "source_expression": "count(*)"}],
             "aggregation_rules": [{"cte_name": "u"}]}
    got = rows(Rebuilder({"a": a, "b": b}, rules).build("u"))
    assert got == [("x", 1, 2), ("y", 0, 1)]      # S22; sum of nulls reads 0, count(*) counts rows (S7)


def test_rebuild_reproduces_reporting_layer(spark):
    from ledgermatch.registry import rebuild_final
    from ledgermatch.sources.fixtures import layer
    a = rebuild_final(spark, SF_SMALL)
    b = layer(spark, SF_SMALL)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_failed_rebuild_is_failed_rows(spark):
    from ledgermatch.plans.rebuild import reconcile_rebuild
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    rules = {"cte_structure": [{"cte_name": "f", "cte_type": "transform", "parent_cte": "a"}],
             "column_mappings": [{"cte_name": "f", "column_name": "k", "transformation_type": "simple",
                                  "source_expression": "a.k"},
                                 {"cte_name": "f", "column_name": "v", "transformation_type": "aggregation",
                                  "source_expression": "sum(a.no_such_column)"}],
             "aggregation_rules": [{"cte_name": "f"}]}
    out = reconcile_rebuild(spark, Rebuilder({"a": a}, rules), a, ["k"], ["v"], name="f").collect()
    assert len(out) == 1 and out[0]["passed"] is False and "no_such_column" in out[0]["error_message"]
    ok = reconcile_rebuild(spark, Rebuilder({"a": a}, {**rules, "column_mappings": [
        rules["column_mappings"][0], {**rules["column_mappings"][1], "source_expression": "sum(a.v)"}]}),
        a, ["k"], ["v"], name="f").collect()
    assert ok[0]["passed"] is True


def test_rules_resolve_case_insensitively(spark):
    # Mixed-case metric names resolve instead of silently becoming 0
    a = spark.createDataFrame([("x", 2), ("x", 3)], "k string, Subscription_Count int")
    rules = {"cte_structure": [{"cte_name": "f", "cte_type": "transform", "parent_cte": "a"}],
             "column_mappings": [{"cte_name": "f", "column_name": "k", "transformation_type": "simple",
                                  "source_expression": "A.K"},
                                 {"cte_name": "f", "column_name": "total", "transformation_type": "aggregation",
                                  "source_expression": "SUM(a.subscription_count)"}],
             "aggregation_rules": [{"cte_name": "f"}]}
    assert rows(Rebuilder({"a": a}, rules).build("f")) == [("x", 5)]


def test_rule_join_type_is_honoured(spark):
    # A LEFT JOIN stays a left join; overlapping right columns get the suffix
    a = spark.createDataFrame([(1, "p"), (2, "q")], "id int, v string")
    b = spark.createDataFrame([(1, "r")], "id int, v string")
    rules = {"join_logic": [{"cte_name": "j", "left_table": "a", "right_table": "b", "join_type": "LEFT JOIN",
                             "join_condition": "a.id = b.id"}]}
    out = Rebuilder({"a": a, "b": b}, rules).build("j")
    assert out.columns == ["id", "v", "id_cal", "v_cal"]
    assert rows(out) == [(1, "p", 1, "r"), (2, "q", None, None)]


def test_comparison_plans_have_no_sort_shuffle(spark):
    new, old = layers(spark)
    spec = Q.ACCEPTANCE_SUITE[3]
    plan = Q.compare_query(spark, spec, new, old)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan    # the ORDER BY is eliminated by Catalyst


def test_runtime_error_is_one_failed_row(spark):
    new = spark.createDataFrame([("a", 1, 0)], "k string, v int, z int")
    suite = [Q.QuerySpec("div", "SELECT 1/z AS r FROM {table}", True, ()), Q.QuerySpec("brace", "SELECT {x} FROM {table}", False, ()),
             Q.QuerySpec("ok", "SELECT sum(v) AS t FROM {table}", True, ())]
    got = {r["check_name"]: r for r in Q.run_suite(spark, suite, new, new, isolate=True).collect()}
    assert got["ok"]["passed"] and not got["div"]["passed"] and not got["brace"]["passed"]
    assert "DIVIDE_BY_ZERO" in got["div"]["error_message"]
    assert Q.run_suite(spark, [], new, new).count() == 0


def test_two_joins_aliases_and_between_forms(spark):
    import datetime as dt

    a = spark.createDataFrame([(1, 10, "p"), (2, 20, "q")], "id int, b int, v string")
    b = spark.createDataFrame([(10, 100, "r"), (20, 200, "s")], "b int, c int, v string")
    c = spark.createDataFrame([(100, "t")], "c int, w string")
    rules = {"join_logic": [{"cte_name": "j", "left_table": "a", "right_table": "b", "join_type": "INNER JOIN", "join_condition": "a.b = b.b"},
                            {"cte_name": "j", "left_table": "b", "right_table": "c", "join_type": "LEFT JOIN", "join_condition": "b.c = c.c"}],
             "filter_logic": [{"cte_name": "j", "filter_type": "WHERE", "filter_expression": "b.v <> 'x' AND a.id > 0"}],
             "column_mappings": [{"cte_name": "j", "column_name": "both", "transformation_type": "medium", "source_expression": "concat(a.v, b.v, coalesce(c.w, '-'))"}]}
    out = Rebuilder({"a": a, "b": b, "c": c}, rules).build("j")
    assert out.columns == ["id", "b", "v", "b_cal", "c", "v_cal", "c_cal", "w", "both"]
    assert sorted(r["both"] for r in out.collect()) == ["prt", "qs-"]
    day = dt.datetime(2024, 2, 5)
    ev = spark.createDataFrame([(1, day + dt.timedelta(hours=9)), (2, day + dt.timedelta(days=1))], "e int, at timestamp")
    sp = spark.createDataFrame([("s", day, day + dt.timedelta(hours=12)), ("o", day, None)], "n string, lo timestamp, hi timestamp")
    cal = spark.createDataFrame([(dt.date(2024, 2, 5),), (dt.date(2030, 1, 1),)], "d date")
    between = lambda lt, rt, cond, how="INNER JOIN": {"join_logic": [{"cte_name": "j", "left_table": lt, "right_table": rt,
                                                                      "join_type": how, "join_condition": cond}]}
    src = {"ev": ev, "sp": sp, "cal": cal}
    assert rows(Rebuilder(src, between("ev", "sp", "ev.at BETWEEN sp.lo AND sp.hi")).build("j"), "e", "n") == [(1, "o"), (1, "s"), (2, "o")]
    got = Rebuilder(src, between("sp", "cal", "cal.d between cast(sp.lo as date) and cast(sp.hi as date)", "RANGE JOIN")).build("j")
    assert sorted(r["n"] + str(r["d"]) for r in got.collect()) == ["o2024-02-05", "o2030-01-01", "s2024-02-05"]
    num = {"x": spark.createDataFrame([(5,)], "p int"), "y": spark.createDataFrame([(1, 9), (6, 9)], "l int, h int")}
    assert rows(Rebuilder(num, between("x", "y", "x.p between y.l and y.h")).build("j")) == [(5, 1, 9)]


def test_formulas_and_timestamp_window(spark):
    import datetime as dt

    from ledgermatch.operators import filters as PF
    from ledgermatch.plans import checks as C

    df = spark.createDataFrame([(1, None, 1), (2, 3, 5)], "a int, b int, total int")
    got = {r["check_name"]: r for r in C.derived_metric_check(df, {"total": "coalesce(A, 0) + coalesce(B, 0)", "b": "a + nope"}).collect()}
    assert got["total"]["passed"] and got["b"]["error_message"] == "Missing dependencies: nope"
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 31, 23, 30),), (dt.datetime(2024, 2, 1),)], "t timestamp")
    assert PF.date_window(ts, "t", "2024-01-01", "2024-01-31").count() == 1 and PF.date_window(ts, "t", None, "2024-02-01").count() == 2


def test_clean_session_and_unknown_scheme(spark, monkeypatch):
    from ledgermatch import session as S

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    assert S.checkpoint_base(Session(spark_checkpoint_dir="viewfs://nn/ck/")) == "viewfs://nn/ck"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.checkpoint_base(Session(spark_master="spark://host:7077"))
    local = S.checkpoint_base(Session(spark_master="local[2]", spark_app_id="one"))
    assert local == S.checkpoint_base(Session(spark_master="local[2]", spark_app_id="one"))


def test_interval_bounds_reach_the_scan(spark):
    from ledgermatch.registry import range_join_calendar_q, rebuild_final

    for query in (range_join_calendar_q, rebuild_final):
        plan = query(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "LessThan(dw_effective_start_datetime" in plan


def test_suite_without_keys_shows_values(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    old = spark.createDataFrame([("a", 1), ("b", 3)], "k string, v int")
    suite = [Q.QuerySpec("total", "SELECT sum(v) AS t FROM {table}"), Q.QuerySpec("by_k", "SELECT k, sum(v) AS t FROM {table} GROUP BY k")]
    got = {r["check_name"]: r for r in Q.run_suite(spark, suite, new, old).collect()}
    assert (got["total"]["cdl_value"], got["total"]["target_value"], got["total"]["max_delta"]) == ("3", "4", 1.0)
    assert (got["by_k"]["total_rows"], got["by_k"]["mismatched_rows"], got["by_k"]["max_delta"]) == (2, 1, 1.0)


def test_calendar_rules_are_grouped_without_a_row_per_interval_and_day(spark):
    from ledgermatch.plans.subscription_rules import subscription_rules
    from ledgermatch.sources.fixtures import LAYER_DIMS

    day = lambda k: dt.datetime(2019, 1, 1) + dt.timedelta(days=k)
    texts = [d for d in LAYER_DIMS if d not in ("report_date", "tenure_group", "tenure_group_finance", "sunday_flag")]
    sbf = [(day(k * 7 % 400), None if k % 5 == 0 else day(k * 7 % 400 + k % 90 - 2), None if k % 13 == 0 else day(-k * 31 % 900) - dt.timedelta(hours=k % 3),
            1 + k % 2, None if k % 4 == 0 else Decimal(k), *[None if (k + i) % 6 == 0 else "ab"[(k >> i) % 2] for i in range(len(texts))]) for k in range(300)]
    sbf = spark.createDataFrame(sbf + sbf[:9], "dw_effective_start_datetime timestamp_ntz, dw_effective_end_datetime timestamp_ntz, "
                                "subscription_tenure_start_datetime timestamp_ntz, subscription_count bigint, ratecard_price decimal(18,2), "
                                + ", ".join(f"{t} string" for t in texts))
    cal = spark.range(400).selectExpr("date_add(DATE'2019-02-01', cast(id as int)) AS report_date", "1 AS fy_year").filter("dayofmonth(report_date) <> 9")
    cal = cal.unionByName(cal.limit(3))
    rules = subscription_rules()
    swept = Rebuilder({"sbf": sbf, "cal": cal}, rules).build("sba")
    joined = Rebuilder({"sbf": sbf, "cal": cal}, {k: v for k, v in rules.items() if k != "day_steps"}).build("sba")
    assert swept.schema.simpleString() == joined.schema.simpleString()
    assert sorted(map(str, swept.collect())) == sorted(map(str, joined.collect())) and joined.count() > 5000
    # the days are made from totals, after the last window, not from intervals
    plan = swept._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and plan.index("explode(sequence(") < plan.index("Window")
    assert "Window" not in joined._jdf.queryExecution().optimizedPlan().toString()
    # a calendar column of the parent, a count and other rules
    for extra in ({"cte_name": "sba", "column_name": "fy_year", "transformation_type": "simple", "source_expression": "sba_inner.fy_year"},
                  {"cte_name": "sba", "column_name": "n", "transformation_type": "aggregation", "source_expression": "count(*)"},
                  {"cte_name": "sba", "column_name": "days", "transformation_type": "aggregation", "source_expression": "sum(sba_inner.subscription_tenure_days)"}):
        more = {**rules, "column_mappings": [*rules["column_mappings"], extra]}
        a, b = (Rebuilder({"sbf": sbf, "cal": cal}, {k: v for k, v in more.items() if k != "day_steps" or steps}).build("sba") for steps in (True, False))
        assert a.schema.simpleString() == b.schema.simpleString() and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
