from pyspark.sql import types as T

from ledgermatch.plans import checks as C
from ledgermatch.plans import results as R


def test_quantity_profile_empty_table(spark):
    df = spark.createDataFrame([], "a string, b int")
    r = {x["column_name"]: x for x in C.quantity_profile(df, ["a", "b"]).collect()}
    assert r["a"]["row_count"] == 0 and r["a"]["null_rate"] is None     # S20


def test_quantity_compare_and_row_count(spark):
    new = spark.createDataFrame([("x", 1), ("y", None)], "a string, b int")
    old = spark.createDataFrame([("x", 1), (None, 2), ("z", 3)], "a string, b int")
    q = {r["column_name"]: r for r in C.quantity_compare(new, old, ["a", "b", "missing"]).collect()}
    assert set(q) == {"a", "b"}
    assert q["a"]["cdl_distinct"] == 2 and q["a"]["target_distinct"] == 2 and q["a"]["distinct_match"]
    assert q["b"]["null_rate_match"] is False
    rc = C.row_count_check(new, old).first()
    assert (rc["cdl_count"], rc["target_count"], rc["difference"], rc["percent_diff"]) == (2, 3, 1, 50.0)


def test_schema_checks_declared(spark):
    new = T.StructType([T.StructField("a", T.LongType(), False), T.StructField("b", T.StringType())])
    old = T.StructType([T.StructField("a", T.IntegerType(), True), T.StructField("c", T.StringType())])
    got = {r["check_name"]: r for r in C.schema_checks(spark, new, old).collect()}
    assert got["column_names"]["passed"] is False and got["column_names"]["details"]["cdl_only"] == "b"
    assert got["data_types"]["details"]["type_mismatches"] == "a:bigint:int"
    assert got["nullability"]["mismatched_rows"] == 1
    same = C.schema_checks(spark, new, new).collect()
    assert all(r["passed"] for r in same)


def test_required_and_missing_columns(spark):
    rules = [{"cte_name": "x", "source_expression": "sum(SBF.Subscription_Count) + `sbf`.other"},
             {"cte_name": "x", "join_condition": "smf.report_date = cal.report_date"}]
    req = C.required_columns(spark, rules)
    got = sorted(tuple(r) for r in req.collect())
    assert got == [("cal", "report_date"), ("sbf", "other"), ("sbf", "subscription_count"), ("smf", "report_date")]
    avail = spark.createDataFrame([("SBF", "SUBSCRIPTION_COUNT"), ("smf", "report_date"), ("cal", "report_date")],
                                  "table_alias string, column_name string")
    assert [tuple(r) for r in C.missing_columns(req, avail).collect()] == [("sbf", "other")]


def test_derived_metric_checks(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3), (1, 1, 5)], "a bigint, b bigint, t bigint")
    got = {r["check_name"]: r for r in C.derived_metric_check(df, {"t": "a + b", "u": "a + zz"}).collect()}
    assert got["t"]["mismatched_rows"] == 2          # a null recomputation against a value counts (S14)
    assert got["t"]["max_delta"] == 3.0
    assert got["u"]["passed"] is False and "zz" in got["u"]["error_message"]     # S15


def test_domain_and_non_negative(spark):
    df = spark.createDataFrame([("0-180", 1), ("CHECK", -1), (None, 0), ("CHECK", 2)], "g string, x_count bigint")
    dv = [tuple(r) for r in C.domain_violations(df, "g", ["0-180"]).collect()]
    assert dv == [("g", "CHECK", 2)]
    nn = C.non_negative(df).first()
    assert nn["column_name"] == "x_count" and nn["negative_rows"] == 1 and nn["passed"] is False


def test_rollup(spark):
    res = R.union_results(
        spark.createDataFrame([("query", "q1", True), ("query", "q2", False), ("schema", "s", True)],
                              "validation_type string, check_name string, passed boolean"))
    got = {r["validation_type"]: (r["total"], r["passed"], r["failed"]) for r in R.rollup(res).collect()}
    assert got == {"query": (2, 1, 1), "schema": (1, 1, 0), "ALL": (3, 2, 1)}


def test_approx_distinct_opt_in(spark):
    df = spark.range(0, 5000).selectExpr("id % 1000 AS a")
    exact = C.quantity_profile(df, ["a"]).first()["distinct_count"]
    approx = C.quantity_profile(df, ["a"], approx=True).first()["distinct_count"]
    assert exact == 1000 and abs(approx - 1000) < 100


def test_results_sink_writes_maps_as_json(spark, tmp_path):
    from ledgermatch.sources.files import write_results
    res = C.schema_checks(spark, T.StructType([T.StructField("a", T.LongType())]),
                          T.StructType([T.StructField("b", T.LongType())]))
    out = str(tmp_path / "res")
    write_results(R.conform(res), out, "csv")
    back = spark.read.option("header", True).csv(out)
    assert back.count() == 3 and '"cdl_only":"a"' in back.filter("check_name = 'column_names'").first()["details"]
