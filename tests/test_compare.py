
from pyspark.sql import functions as F

from ledgermatch.plans import compare as CMP
from tests.conftest import rows


def test_scalar_integers_exact_floats_tolerant(spark):
    a = spark.createDataFrame([(10,)], "v bigint")
    b = spark.createDataFrame([(11,)], "v bigint")
    r = CMP.compare_scalar(a, b, tol=5.0).first()
    assert r["passed"] is False and r["cdl_value"] == "10" and r["max_delta"] == 1.0   # S1: integers exact
    fa = spark.createDataFrame([(1.0,)], "v double")
    fb = spark.createDataFrame([(1.005,)], "v double")
    assert CMP.compare_scalar(fa, fb, tol=0.01).first()["passed"] is True
    na = spark.createDataFrame([(None,)], "v double")
    assert CMP.compare_scalar(na, na).first()["passed"] is True                        # both null match
    assert CMP.compare_scalar(na, fb).first()["passed"] is False                       # S4


def test_cells_identity_and_swap(spark):
    a = spark.createDataFrame([("x", 1, 1.0), ("y", 2, 2.0)], "k string, n bigint, f double")
    b = spark.createDataFrame([("x", 1, 1.001), ("z", 3, 3.0)], "k string, n bigint, f double")
    same = CMP.compare_cells(a, a, ["k"])
    assert {r["status"] for r in same.collect()} == {"match"}
    ab = {(r["k"], r["column_name"]): r["status"] for r in CMP.compare_cells(a, b, ["k"]).collect()}
    ba = {(r["k"], r["column_name"]): r["status"] for r in CMP.compare_cells(b, a, ["k"]).collect()}
    assert ab[("x", "f")] == "match" and ab[("y", "n")] == "only_new" and ab[("z", "n")] == "only_old"
    assert ba[("y", "n")] == "only_old" and ba[("z", "n")] == "only_new"


def test_cells_without_keys_pair_duplicates_by_order(spark):
    # one extra row on one side must not shift the pairing of all later rows
    a = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("y", 5.0)], "k string, f double")
    b = spark.createDataFrame([("x", 1.0), ("x", 2.0), ("w", 0.0), ("y", 5.0)], "k string, f double")
    st = [(r["k"], r["status"]) for r in CMP.compare_cells(a, b, None).collect()]
    assert sorted(st) == [("w", "only_old"), ("x", "match"), ("x", "match"), ("y", "match")]


def test_reconcile_metrics(spark):
    src = spark.createDataFrame([(None, 1, 2), ("a", 1, 1), ("a", 1, 1), ("b", 5, 0)], "k string, m1 int, m2 int")
    cdl = spark.createDataFrame([(None, 1, 2), ("a", 2, 3), ("c", 1, 1)], "k string, m1 int, m2 int")
    got = {r["check_name"]: r for r in CMP.reconcile_metrics(src, cdl, ["k"], ["m1", "m2"], 0.01).collect()}
    assert got["m1"]["total_rows"] == 4                       # None, a, b, c: duplicates grouped (S12)
    assert got["m1"]["mismatched_rows"] == 2                  # b: 5 vs 0, c: 0 vs 1 (missing reads 0, S13)
    assert got["m2"]["mismatched_rows"] == 2 and got["m2"]["max_delta"] == 1.0
    assert got["m1"]["only_in_source"] == 1 and got["m1"]["only_in_cdl"] == 1
    assert got["m1"]["passed"] is False
    ok = CMP.reconcile_metrics(src, src, ["k"], ["m1", "m2"]).collect()
    assert all(r["passed"] for r in ok)


def test_mismatch_sample_top_n_is_bounded_per_task(spark):
    df = spark.range(0, 2000).select((F.col("id") % 2).cast("string").alias("column_name"),
                                     F.col("id").alias("k"), (F.col("id") % 37).cast("double").alias("delta"))
    out = CMP.mismatch_sample(df, ["k"], 0.01, 3)
    got = rows(out, "column_name", "k", "delta", "sample_rank")
    assert len(got) == 6
    assert {r[2] for r in got} == {36.0}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan        # per-task top-n before the shuffle


def test_abs_rel(spark):
    new = spark.createDataFrame([("a", 10000.0), ("b", 10.0)], "k string, m double")
    old = spark.createDataFrame([("a", 10000.5), ("b", 10.5)], "k string, m double")
    r = CMP.reconcile_abs_rel(new, old, ["k"], ["m"], 0.01, 0.0001).first()
    assert r["mismatched_rows"] == 1 and r["passed"] is False


def test_keyless_float_answers(spark):
    a = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    b = spark.createDataFrame([(1.001, 2.5)], "x double, y double")
    st = {r["column_name"]: r["status"] for r in CMP.compare_cells(a, b, None).collect()}
    assert st == {"x": "match", "y": "mismatch"}
    two = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0)], "x double, y double")
    assert sorted(r["status"] for r in CMP.compare_cells(two, a, None).collect()) == ["match", "match", "only_new", "only_new"]
    assert {r["status"] for r in CMP.compare_cells(two, two, None).collect()} == {"match"}
    empty = spark.createDataFrame([], "x double, y double")
    assert CMP.compare_cells(empty, empty, None).count() == 0


def _cells(spark, new, old, schema, keys, tol=0.01):
    return CMP.compare_cells(spark.createDataFrame(new, schema), spark.createDataFrame(old, schema), keys, tol)


def _passes(spark, new, old, schema, keys, tol=0.01):
    return CMP.summarize_cells(_cells(spark, new, old, schema, keys, tol), "q").first()["passed"]


def test_repeated_rows_never_collapse(spark):
    kv = "k string, v int"
    assert not _passes(spark, [("a", 1), ("a", 2)], [("a", 2)], kv, ["k"])
    assert not _passes(spark, [("a", 1), ("a", 2)], [("a", 2), ("a", 2)], kv, ["k"])
    assert _passes(spark, [("a", 1), ("a", 2)], [("a", 2), ("a", 1)], kv, ["k"])
    assert not _passes(spark, [("x",), ("x",)], [("x",)], "k string", None)
    assert _passes(spark, [("x",), ("x",)], [("x",), ("x",)], "k string", None)
    one, two = (spark.createDataFrame([(v,) for v in x], "v bigint") for x in ([5], [1, 5]))
    assert CMP.compare_scalar(two, one).first()["passed"] is False
    assert CMP.compare_scalar(two, two).first()["passed"] is True


def test_identity_on_floats_and_nan(spark):
    nan, inf = float("nan"), float("inf")
    rows_ = [(1.0,), (1.0,), (2.5,), (nan,), (None,), (inf,), (-inf,)]
    assert _passes(spark, rows_, rows_, "v double", None)
    st = {r["column_name"]: r["status"] for r in _cells(spark, [("a", nan)], [("a", None)], "k string, v double", ["k"]).collect()}
    assert st == {"v": "match"}
    assert not _passes(spark, [("a", inf)], [("a", -inf)], "k string, v double", ["k"])
    dup = [("a", 1.0), ("a", 2.0), (None, nan), (None, 3.0)]
    assert _passes(spark, dup, dup[::-1], "k string, v double", ["k"])


def test_swap_on_repeated_rows(spark):
    new, old, schema = [("a", 1.0), ("a", 2.0), ("b", nan := float("nan"))], [("a", 2.0), ("b", nan), ("b", 1.0), ("c", 0.0)], "k string, v double"
    flip = {"only_new": "only_old", "only_old": "only_new"}
    ab = sorted((r["k"], r["status"]) for r in _cells(spark, new, old, schema, ["k"]).collect())
    ba = sorted((r["k"], flip.get(r["status"], r["status"])) for r in _cells(spark, old, new, schema, ["k"]).collect())
    assert ab == ba and {s for _, s in ab} > {"only_new", "only_old"}


def test_exact_types_stay_exact(spark):
    from decimal import Decimal as D

    assert not _passes(spark, [("a", D("1.1E-11"))], [("a", D("1.2E-11"))], "k string, v decimal(38,20)", ["k"])
    big = D("12345678901234567890123456789012345")
    assert _passes(spark, [("a", big)], [("a", big)], "k string, v decimal(38,0)", ["k"])
    assert not _passes(spark, [("a", big)], [("a", big + 1)], "k string, v decimal(38,0)", ["k"])
    a, b = (spark.createDataFrame([("a", v)], "k string, m bigint") for v in (2 ** 53 + 1, 2 ** 53))
    got = CMP.reconcile_metrics(a, b, ["k"], ["m"]).first()
    assert got["passed"] is False and got["max_delta"] == 1.0
    huge, less = (spark.createDataFrame([("a", v)], "k string, m double") for v in (1e30, 0.5e30))
    assert CMP.reconcile_metrics(huge, huge, ["k"], ["m"]).first()["passed"] is True
    assert CMP.reconcile_metrics(huge, less, ["k"], ["m"]).first()["max_delta"] == 0.5e30


def test_many_copies_of_a_row(spark):
    a = [("hot", float(i % 50)) for i in range(3000)] + [("cold", 1.0), ("cold", 0.5), (None, 2.0)]
    got = _cells(spark, a, a[:-1] + [("hot", 7.0)], "k string, f double", ["k"]).groupBy("k", "status").count().collect()
    got = {(r["k"], r["status"]): r["count"] for r in got}
    assert got[("cold", "match")] == 2 and got[(None, "only_new")] == 1 and got[("hot", "only_old")] == 1


def test_row_count_verdict(spark):
    r = CMP.row_count_verdict(spark.range(5), spark.range(3)).first()
    assert (r["passed"], r["cdl_rows"], r["target_rows"], r["row_difference"]) == (False, 5, 3, 2)
    assert CMP.row_count_verdict(spark.range(0), spark.range(0)).first()["passed"] is True


def test_reconciliation_is_one_shuffle(spark, tmp_path):
    a = spark.createDataFrame([(k % 7, k % 3, float(k)) for k in range(200)], "k1 int, k2 int, m double")
    a.write.parquet(str(tmp_path / "a"))
    a.write.parquet(str(tmp_path / "b"))
    new, old = spark.read.parquet(str(tmp_path / "a")), spark.read.parquet(str(tmp_path / "b"))
    plan = CMP.reconcile_metrics(new, old, ["k1", "k2"], ["m"])._jdf.queryExecution().executedPlan().toString()
    exchanges = [ln for ln in plan.splitlines() if "Exchange" in ln]
    assert len(exchanges) == 2, plan
    assert sum("hashpartitioning(k1" in ln for ln in exchanges) == 1
    assert sum("SinglePartition" in ln for ln in exchanges) == 1
    assert "Join" not in plan


def test_equal_rows_cancel_before_rows_are_paired(spark):
    new = spark.createDataFrame([("k", 1.0), ("k", 5.0), ("q", 1.0), ("q", 5.0), ("q", 9.0)], "k string, v double")
    old = spark.createDataFrame([("k", 5.0), ("q", 0.0), ("q", 1.0), ("q", 5.0)], "k string, v double")
    got = sorted((r["k"], r["status"], r["new_value"], r["old_value"]) for r in CMP.compare_cells(new, old, ["k"], 0.01).collect())
    assert got == [("k", "match", "5.0", "5.0"), ("k", "only_new", "1.0", None), ("q", "match", "1.0", "1.0"), ("q", "match", "5.0", "5.0"),
                   ("q", "mismatch", "9.0", "0.0")]


def test_pairing_with_a_hot_key_and_without_keys(spark):
    import random

    rnd = random.Random(2)
    rows = [("hot" if k % 2 else f"k{k % 60}", round(rnd.random() * 50, 1), k % 4) for k in range(3000)]
    other = [(a, v + (0.5 if k % 97 == 0 else 0.0), n) for k, (a, v, n) in enumerate(rows) if k % 71]
    schema = "k string, v double, n int"
    new, old = spark.createDataFrame(rows, schema).repartition(5), spark.createDataFrame(other, schema).repartition(3)

    def expected(keys, pick):
        groups = {}
        for side, data in enumerate((rows, other)):
            for r in data:
                groups.setdefault(tuple(r[i] for i in keys), ([], []))[side].append(tuple(r[i] for i in pick))
        out = {}
        for a, b in groups.values():
            rest_a, rest_b = list(a), list(b)
            for x in a:
                if x in rest_b:
                    rest_a.remove(x)
                    rest_b.remove(x)
            same = len(a) - len(rest_a)
            out["match"] = out.get("match", 0) + same * len(pick)
            rest_a.sort(), rest_b.sort()
            for x, y in zip(rest_a, rest_b):
                for p, q in zip(x, y):
                    s = "match" if abs(p - q) <= 0.01 else "mismatch"
                    out[s] = out.get(s, 0) + 1
            for s, n in (("only_new", len(rest_a) - len(rest_b)), ("only_old", len(rest_b) - len(rest_a))):
                if n > 0:
                    out[s] = out.get(s, 0) + n * len(pick)
        return {s: n for s, n in out.items() if n}

    count = lambda df: {r["status"]: r["count"] for r in df.groupBy("status").count().collect()}
    assert count(CMP.compare_cells(new, old, ["k"], 0.01)) == expected([0], [1, 2])
    assert count(CMP.compare_cells(new.select("v", "n"), old.select("v", "n"), [], 0.01)) == expected([], [1, 2])


def test_rows_are_counted_in_small_tasks(spark, tmp_path, monkeypatch):
    """What one task holds does not grow with the answer: files and shuffles are
    read in pieces of a bounded size, and the session's settings come back."""
    from pyspark.sql import DataFrameWriter

    from ledgermatch.session import TASK_SIZES, materialize, size_bytes

    assert [size_bytes(t) for t in ("64MB", "16m", "67108864b", "100", "2gb")] == [64 << 20, 16 << 20, 64 << 20, 100, 2 << 30]
    before = {k: spark.conf.get(k) for k in TASK_SIZES}
    spark.range(0, 200_000, 1, 1).selectExpr("id k", "id * 2 v").write.option("parquet.block.size", 1 << 16).parquet(str(tmp_path / "t"))
    new = spark.read.parquet(str(tmp_path / "t"))
    old = new.filter("k % 1000 <> 0").withColumn("v", F.col("v") + F.when(F.col("k") % 700 == 1, 1).otherwise(0))
    tasks = lambda df: len(df.inputFiles())
    assert tasks(materialize(new, "t", task_bytes=1 << 16)) >= 4 * tasks(materialize(new, "t"))
    seen, write = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (seen.append([spark.conf.get(k) for k in TASK_SIZES]), write(self, *a, **b))[1])
    cells = CMP.compare_cells(new, old, ["k"])
    assert all(size_bytes(v) <= 16 << 20 for v in seen[0])
    assert rows(cells.groupBy("status").count()) == [("match", 200_000 - 200 - 286), ("mismatch", 286), ("only_new", 200)]
    spark.conf.set(TASK_SIZES[0], "4k")         # a smaller setting stays
    try:
        CMP.compare_cells(new, old, ["k"])
        assert seen[-1][0] == "4k"
    finally:
        spark.conf.set(TASK_SIZES[0], before[TASK_SIZES[0]])
    assert {k: spark.conf.get(k) for k in TASK_SIZES} == before
