"""CSV reject channel, observed writes, bucket digests, sketches, co-located tables, conditions on checks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgermatch.plans import checks as C
from ledgermatch.plans import digests as D
from ledgermatch.plans import sketches as SK
from ledgermatch.plans.compare import compare_cells
from ledgermatch.sources import colocated as CO
from ledgermatch.sources.files import read_csv_sources, reject_counts, write_observed


def test_csv_channel_keeps_what_it_cannot_parse(spark, tmp_path):
    (tmp_path / "a.csv").write_text("d,n,x\n1998-01-02,1,a\n02/01/1998,2,b\n,3,c\n1998-01-04,many,d\n1998-13-01,5,e\n")
    (tmp_path / "cal.csv").write_text("calendar_date\n1998-01-02\n")
    specs = {"a": ("a.csv", "d string, n int, x string", {"d": "yyyy-MM-dd"}), "cal": ("cal.csv", "calendar_date string", {"calendar_date": "yyyy-MM-dd"}),
             "gone": ("gone.csv", "d string", {})}
    got = read_csv_sources(spark, str(tmp_path), specs)
    assert set(got) == {"a", "cal"} and got["cal"].rows.columns == ["report_date"] and got["cal"].rows.first()[0] == dt.date(1998, 1, 2)
    rows = sorted(map(tuple, got["a"].rows.collect()), key=lambda r: r[2])
    assert rows == [(dt.date(1998, 1, 2), 1, "a"), (None, 2, "b"), (None, 3, "c"), (dt.date(1998, 1, 4), None, "d"), (None, 5, "e")]
    rejects = sorted((r["column_name"] or "", r["value"]) for r in got["a"].rejects.collect())
    assert rejects == [("", "1998-01-04,many,d"), ("d", "02/01/1998"), ("d", "1998-13-01")]
    assert all(r["file"].endswith("a.csv") for r in got["a"].rejects.collect())
    counts = {(r["source"], r["column_name"]): (r["present"], r["rows"], r["rejected"]) for r in reject_counts(got, list(specs)).collect()}
    assert counts == {("a", "d"): (True, 5, 2), ("a", None): (True, 5, 1), ("cal", None): (True, 1, 0), ("gone", None): (False, None, None)}
    assert reject_counts({}, ["gone"]).count() == 1


@pytest.mark.parametrize("fmt", ["parquet", "json", "csv"])
def test_metrics_are_observed_while_writing(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, "b"), (5, None), (None, "a"), (None, None)], "n int, s string")
    seen = write_observed(df, str(tmp_path / fmt), fmt)
    assert seen == {"rows": 4, "nulls:n": 2, "nulls:s": 2, "min:n": 1, "max:n": 5, "min:s": "a", "max:s": "b"}
    assert spark.read.format(fmt).option("header", True).load(str(tmp_path / fmt)).count() == 4
    assert write_observed(df.limit(0), str(tmp_path / f"{fmt}0"), fmt)["rows"] == 0


@pytest.fixture(scope="module")
def sides(spark):
    rnd = random.Random(6)
    rows = [(f"k{k % 150}", k % 9, rnd.choice([None, k % 5]), rnd.random()) for k in range(600)]
    other = [r for k, r in enumerate(rows) if k != 17]
    other[40] = (*other[40][:3], other[40][3] + 1)
    other += [rows[3], rows[3]]
    schema = "k string, d int, v int, x double"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(other, schema).repartition(7)


def test_digests_find_the_buckets_that_differ(spark, sides):
    new, old = sides
    cols = new.columns
    diff = D.digest_diff(new, old, ["d"], ["k", "d"], cols, 8, 16).collect()
    both = [D.with_buckets(t, ["d"], ["k", "d"], 8, 16).collect() for t in sides]
    for r in diff:
        here = [sorted(str(x[:4]) for x in t if x["level1"] == r["level1"] and r["level2"] in (None, x["level2"])) for t in both]
        assert (len(here[0]), len(here[1])) == (r["new_rows"], r["old_rows"]) and r["same"] == (here[0] == here[1])
    assert 1 <= sum(not r["same"] for r in diff if r["level"] == 2) <= 3
    same = D.digest_diff(new, new.repartition(3), ["d"], ["k", "d"], cols, 8, 16)
    assert same.filter("NOT same").count() == 0


def test_cells_behind_the_digests_are_the_same(spark, sides):
    new, old = sides
    a, b = D.rows_that_may_differ(new, old, ["d"], ["k", "d"], new.columns, 8, 16)
    assert a.count() < new.count() / 4
    key = lambda df: sorted(str(tuple(r)) for r in df.filter("status <> 'match'").collect())
    assert key(D.compare_cells_by_digest(new, old, ["k", "d"], 0.01, ["d"], 8, 16)) == key(compare_cells(new, old, ["k", "d"], 0.01))


def test_texts_that_join_alike_have_different_digests(spark):
    a, b = (spark.createDataFrame([r], "p string, q string") for r in (("a:1", "b"), ("a", "1:b")))
    assert a.select(D.row_hash(a, ["p", "q"])).first() != b.select(D.row_hash(b, ["p", "q"])).first()
    n, e = (spark.createDataFrame([r], "p string, q string") for r in ((None, "-"), ("-", None)))
    assert n.select(D.row_hash(n, ["p", "q"])).first() != e.select(D.row_hash(e, ["p", "q"])).first()


def test_sketches_answer_windows_within_their_bound(spark):
    rnd = random.Random(9)
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randrange(30)), rnd.randrange(30000), None if rnd.random() < 0.3 else f"s{rnd.randrange(40)}") for _ in range(40000)]
    df = spark.createDataFrame(rows, "day date, big int, small string")
    windows = [(dt.date(2020, 1, 1), dt.date(2020, 1, 30)), (dt.date(2020, 1, 5), dt.date(2020, 1, 5)), (dt.date(2020, 1, 10), dt.date(2020, 2, 20))]
    got = SK.distinct_in_windows(SK.daily_sketches(df, F.col("day"), ["big", "small"]), spark.createDataFrame(windows, "lo date, hi date")).collect()
    assert len(got) == 6
    for r in got:
        inside = [x for x in rows if r["lo"] <= x[0] <= r["hi"]]
        exact = len({x[1 if r["column_name"] == "big" else 2] for x in inside} - {None})
        assert r["rows"] == len(inside) and abs(r["distinct"] - exact) <= max(1, SK.ERROR_BOUND * exact)


def test_co_located_tables_meet_without_an_exchange(spark, sides):
    new, old = (t.withColumn("k", F.when(F.col("k") != "k3", F.col("k"))) for t in sides)
    keys = ["k", "d"]
    out = CO.aligned(CO.stored(new, keys, 4, "a"), CO.stored(old, keys, 4, "b"), keys, ["v"])
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    total = lambda df: {(r["k"], r["d"]): r["s"] for r in df.groupBy(*keys).agg(F.sum("v").alias("s")).collect()}
    a, b = total(new), total(old)
    got = {(r["k"], r["d"]): (r["v_new"], r["v_old"], r["in_new"], r["in_old"]) for r in out.collect()}
    assert got == {k: (a.get(k), b.get(k), k in a, k in b) for k in a.keys() | b.keys()}


def test_conditions_narrow_every_check(spark, sides):
    new, old = sides
    where = "d < 4 AND k <> 'k1'"
    a, b = new.filter(where), old.filter(where)
    same = lambda x, y: sorted(map(str, x.collect())) == sorted(map(str, y.collect()))
    assert same(C.row_count_check(new, old, where), C.row_count_check(a, b))
    assert same(C.quantity_compare(new, old, ["k", "v"], where=where), C.quantity_compare(a, b, ["k", "v"]))
    assert same(C.null_rate_compare(new, old, ["k", "v"], where=where), C.quantity_compare(a, b, ["k", "v"]).select(C.null_rate_compare(a, b, ["k", "v"]).columns))
    assert same(C.observed_nulls(new, old, where), C.observed_nulls(a, b))
    assert same(C.domain_violations(new, "k", ["k2"], where), C.domain_violations(a, "k", ["k2"]))
    assert same(C.non_negative(new, ["v"], where), C.non_negative(a, ["v"])) and same(C.numeric_profile(new, ["v"], where), C.numeric_profile(a, ["v"]))
    assert same(C.column_profile(new, ["v"], where), C.column_profile(a, ["v"]))
    assert same(C.derived_metric_check(new, {"v": "d"}, where=where), C.derived_metric_check(a, {"v": "d"}))
    assert same(C.dimension_values(new, old, ["k", "d"], where), C.dimension_values(a, b, ["k", "d"]))


def test_null_rates_need_no_row_copies(spark, sides):
    plan = C.null_rate_compare(*sides, ["k", "v"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
