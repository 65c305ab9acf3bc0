import datetime as dt

from pyspark.sql import functions as F

from ledgermatch.functions import scalars as S


def one(spark, expr, schema, *vals):
    df = spark.createDataFrame([vals], schema)
    return df.select(expr.alias("x")).first()["x"]


def test_tenure_days_floor_semantics(spark):
    # 18:00 to the next midnight is 0 days; to the previous midnight -1
    sch = "d timestamp_ntz, s timestamp_ntz"
    assert one(spark, S.tenure_days("d", "s"), sch, dt.datetime(1998, 1, 2), dt.datetime(1998, 1, 1, 18)) == 0
    assert one(spark, S.tenure_days("d", "s"), sch, dt.datetime(1998, 1, 1), dt.datetime(1998, 1, 1, 18)) == -1
    assert one(spark, S.tenure_days("d", "s"), sch, dt.datetime(1998, 1, 11), dt.datetime(1998, 1, 1)) == 10


def test_tenure_days_from_date(spark):
    sch = "d date, s timestamp_ntz"
    assert one(spark, S.tenure_days("d", "s"), sch, dt.date(1998, 3, 1), dt.datetime(1998, 2, 1)) == 28


def test_tenure_group_edges(spark):
    df = spark.createDataFrame([(v,) for v in [None, -5, 0, 1, 180, 181, 360, 361, 540, 541, 720, 721]], "d bigint")
    got = dict((r[0], r[1]) for r in df.select("d", S.tenure_group("d")).collect())
    assert got[None] == "CHECK" and got[-5] == "CHECK" and got[0] == "CHECK"     # right-closed at 0 (S3)
    assert got[1] == "0-180" and got[180] == "0-180" and got[181] == "181-360"
    assert got[360] == "181-360" and got[361] == "361-540" and got[540] == "361-540"
    assert got[541] == "541-720" and got[720] == "541-720" and got[721] == "721+"


def test_tenure_group_finance_edges(spark):
    vals = [None, -1, 0, 182, 183, 365, 366, 730, 731, 1095, 2555, 2556]
    df = spark.createDataFrame([(v,) for v in vals], "d bigint")
    got = dict((r[0], r[1]) for r in df.select("d", S.tenure_group_finance("d")).collect())
    assert got[None] == "CHECK" and got[-1] == "CHECK"
    assert got[0] == "0-6months" and got[182] == "0-6months" and got[183] == "6-12months"
    assert got[365] == "6-12months" and got[366] == "1-2years" and got[730] == "1-2years"
    assert got[731] == "2-3years" and got[1095] == "2-3years" and got[2555] == "6-7years"
    assert got[2556] == "7years+"


def test_day_of_week_and_sunday(spark):
    df = spark.createDataFrame([(dt.date(1998, 1, 4),), (dt.date(1998, 1, 10),)], "d date")  # Sun, Sat
    got = sorted(tuple(r) for r in df.select("d", S.day_of_week("d"), S.sunday_flag("d")).collect())
    assert got == [(dt.date(1998, 1, 4), 1, "Y"), (dt.date(1998, 1, 10), 7, "N")]


def test_fiscal_columns(spark):
    df = spark.createDataFrame([(dt.date(1998, 7, 1),), (dt.date(1998, 6, 30),), (dt.date(1998, 7, 8),)], "d date")
    got = {r[0]: tuple(r[1:]) for r in df.select("d", S.fiscal_year("d"), S.fiscal_month("d"),
                                                 S.fiscal_week("d"), S.week_ending_saturday("d")).collect()}
    assert got[dt.date(1998, 7, 1)] == (1999, 1, 1, dt.date(1998, 7, 4))
    assert got[dt.date(1998, 6, 30)] == (1998, 12, 53, dt.date(1998, 7, 4))
    assert got[dt.date(1998, 7, 8)][2] == 2


def test_tolerances(spark):
    df = spark.createDataFrame([(1.0, 1.005), (None, None), (1.0, None), (100.0, 100.5), (10000.0, 10000.5)],
                               "a double, b double")
    got = [tuple(r) for r in df.select(S.within_tolerance("a", "b", 0.01),
                                       S.exceeds_abs_rel("a", "b", 0.01, 0.0001)).collect()]
    assert got[0] == (True, False)
    assert got[1][0] is True          # both null match
    assert got[2][0] is False         # one-sided null is a mismatch (S4)
    assert got[3] == (False, True)    # 0.5 over both tolerances
    assert got[4] == (False, False)   # 0.5/10000 under the relative tolerance


def test_percent_diff_divides_by_new(spark):
    df = spark.createDataFrame([(0, 5), (200, 100)], "a bigint, b bigint")
    got = [r[0] for r in df.select(S.percent_diff("a", "b")).collect()]
    assert got == [500.0, 50.0]


def test_concat_codes_null_as_empty(spark):
    df = spark.createDataFrame([("THINK", None)], "a string, b string")
    assert df.select(S.concat_codes("a", "b")).first()[0] == "THINK"


def test_lenient_parse(spark):
    df = spark.createDataFrame([("1998-01-05",), ("13/13/1998",), ("x",)], "t string")
    got = [r[0] for r in df.select(F.to_date(S.lenient_timestamp("t", "yyyy-MM-dd"))).collect()]
    assert got == [dt.date(1998, 1, 5), None, None]
    df = spark.createDataFrame([("1.5",), ("abc",)], "t string")
    assert [r[0] for r in df.select(S.lenient_number("t")).collect()] == [1.5, None]
