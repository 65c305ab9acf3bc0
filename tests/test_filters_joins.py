import datetime as dt
import random

from pyspark.sql import functions as F

from ledgermatch.operators import filters as PF
from ledgermatch.operators import joins as J
from tests.conftest import rows

D = dt.date
TS = dt.datetime
LO, HI = D(1998, 1, 1), D(1998, 1, 31)
SCH = "id int, s timestamp_ntz, e timestamp_ntz"


def intervals(spark):
    return spark.createDataFrame([
        (1, TS(1997, 12, 1), TS(1998, 3, 1)),     # spans the whole window
        (2, TS(1998, 1, 5), TS(1998, 1, 7)),      # inside
        (3, TS(1997, 12, 1), TS(1998, 1, 1)),     # ends on the first day
        (4, TS(1998, 1, 31, 18), None),           # open end
        (5, TS(1998, 1, 10), TS(1998, 1, 9)),     # inverted
        (6, TS(1998, 2, 1), TS(9999, 12, 31)),    # after the window
    ], SCH)


def test_touching_misses_spanning_interval(spark):
    df = intervals(spark)
    touching = {r[0] for r in PF.interval_touching(df, "s", "e", LO, HI).collect()}
    overlap = {r[0] for r in PF.interval_overlap(df, "s", "e", LO, HI).collect()}
    assert touching == {2, 3, 4, 5}
    assert overlap == {1, 2, 3, 4, 5}     # S9: the spanning interval 1 is found; null end is open (S8)


def test_filters_push_down(spark, tmp_path):
    p = str(tmp_path / "iv")
    intervals(spark).write.parquet(p)
    plan = PF.interval_overlap(spark.read.parquet(p), "s", "e", LO, HI)._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(s," in plan and "GreaterThanOrEqual(e," in plan


def test_date_window_optional_ends(spark):
    df = spark.createDataFrame([(D(1998, 1, d),) for d in (1, 15, 31)], "d date")
    assert len(PF.date_window(df, "d", start=D(1998, 1, 15)).collect()) == 2
    assert len(PF.date_window(df, "d", end="1998-01-15").collect()) == 2
    assert len(PF.date_window(df, "d").collect()) == 3


def test_exclude_codes_and_rule_filter(spark):
    df = spark.createDataFrame([("THINK", "SWG"), ("THINK", "GPLA"), ("THINK", None), (None, "SWG"),
                                ("OTHER", "SWG")], "a string, b string")
    kept = rows(PF.exclude_codes(df, ("a", "b")))
    assert kept == sorted([("THINK", None), (None, "SWG"), ("OTHER", "SWG")], key=lambda t: tuple(map(str, t)))
    rules = [{"filter_type": "WHERE", "filter_expression": "a = 'THINK'"},
             {"filter_type": "HAVING", "filter_expression": "count(*) > 1"},
             {"filter_type": "WHERE", "filter_expression": None},
             {"filter_type": "where", "filter_expression": "b IS NOT NULL"}]
    assert len(PF.rule_filter(df, rules).collect()) == 2


def test_expand_intervals_semantics(spark):
    out = J.expand_intervals(intervals(spark), "s", "e", LO, HI)
    per = {k: v for k, v in out.groupBy("id").agg(F.count("*")).collect()}
    assert per == {1: 31, 2: 3, 3: 1, 4: 1}   # inclusive ends, inverted -> none, open end clipped


def test_range_join_equals_brute_force(spark):
    rnd = random.Random(7)
    data = []
    for i in range(300):
        s = D(1997, 11, 1) + dt.timedelta(days=rnd.randint(0, 150))
        e = s + dt.timedelta(days=rnd.randint(-3, 60))
        data.append((i, TS.combine(s, dt.time(rnd.choice([0, 18]))), TS.combine(e, dt.time())))
    iv = spark.createDataFrame(data, SCH)
    cal = spark.createDataFrame([(LO + dt.timedelta(days=k), k) for k in range(31)], "report_date date, k int")
    got = rows(J.range_join_calendar(iv, cal, "s", "e"), "id", "report_date")
    want = rows(iv.join(cal, F.col("report_date").between(F.to_date("s"), F.to_date("e"))), "id", "report_date")
    assert got == want and len(got) > 1000
    plan = J.range_join_calendar(iv, cal, "s", "e")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_equi_join_suffix(spark):
    a = spark.createDataFrame([(D(1998, 1, 1), 1, "x")], "report_date date, fy_year int, v string")
    b = spark.createDataFrame([(D(1998, 1, 1), 2, D(1998, 1, 3))], "report_date date, fy_year int, w date")
    out = J.equi_join(a, b, "report_date", "report_date")
    assert out.columns == ["report_date", "fy_year", "v", "fy_year_cal", "w"]


def test_side_by_side_null_keys_and_duplicates(spark):
    new = spark.createDataFrame([(None, 1), (None, 2), ("a", 5)], "k string, m int")
    old = spark.createDataFrame([(None, 3), ("b", 1)], "k string, m int")
    got = {r["k"]: (r["m_new"], r["m_old"], r["in_new"], r["in_old"])
           for r in J.side_by_side(new, old, ["k"], ["m"]).collect()}
    assert got[None] == (3, 3, True, True)       # null keys match, duplicates summed (S6, S12)
    assert got["a"] == (5, None, True, False)
    assert got["b"] == (None, 1, False, True)
    anti = rows(J.anti_join(new, old, ["k"]), "k")
    assert anti == [("a",)]


def test_sums_inside_a_formula_read_zero(spark):
    from ledgermatch.operators import aggregates as A

    df = spark.createDataFrame([("x", 5, None), ("x", None, None), ("y", None, 2)], "k string, a int, b int")
    rules = [{"column_name": "k", "transformation_type": "simple", "source_expression": "k"},
             {"column_name": "t", "transformation_type": "aggregation", "source_expression": "SUM(a) + sum( b )"},
             {"column_name": "f", "transformation_type": "aggregation", "source_expression": "sum(a) FILTER (WHERE b > 0) + 1"},
             {"column_name": "s", "transformation_type": "aggregation", "source_expression": "concat(max('sum(x'), sum(abs(a)))"}]
    got = {r["k"]: (r["t"], r["f"], r["s"]) for r in A.group_by_rules(df, rules).collect()}
    assert got == {"x": (5, 1, "sum(x5"), "y": (2, 3 - 2, "sum(x0")}
