"""Distributed ordinals, dyadic range joins, sweeps and pair-free range aggregates against plain Python."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgermatch.operators import joins as J
from ledgermatch.operators.ordinals import running_total, with_ordinal
from ledgermatch.plans.rebuild import Rebuilder

BASE = dt.datetime(2020, 1, 1)
FAR = dt.datetime(9999, 12, 31)


@pytest.fixture(scope="module")
def spans(spark):
    rnd = random.Random(3)
    at = lambda: BASE + dt.timedelta(days=rnd.randrange(60), hours=rnd.choice([0, 0, 5, 13]))
    points = [(i, rnd.choice([None] + [at()] * 9), rnd.choice("ab")) for i in range(250)]
    intervals = []
    for i in range(180):
        s = at()
        e = rnd.choice([None, s, s + dt.timedelta(days=rnd.randrange(-2, 40), hours=rnd.choice([0, 3])), FAR])
        intervals.append((i, rnd.choice([s] * 9 + [None]), e, rnd.choice("xyz"), rnd.randrange(9)))
    return (points, intervals, spark.createDataFrame(points, "pid int, at timestamp_ntz, f string"),
            spark.createDataFrame(intervals, "iid int, s timestamp_ntz, e timestamp_ntz, g string, v int"))


def pairs(points, intervals):
    return [(p, i) for p in points for i in intervals if p[1] and i[1] and i[1] <= p[1] and (i[2] is None or p[1] <= i[2])]


def test_range_join_points_by_blocks(spans):
    points, intervals, p, i = spans
    got = J.range_join_points(p, i, "at", "s", "e").select("pid", "iid").collect()
    assert sorted(map(tuple, got)) == sorted((a[0], b[0]) for a, b in pairs(points, intervals))


@pytest.mark.parametrize("levels", [1, 4, 7, 12])
def test_blocks_are_disjoint_cover_the_interval_and_are_few(spark, levels):
    lo, n = dt.date(2020, 1, 1), 1 << levels
    rnd = random.Random(levels)
    rows = [(k, lo + dt.timedelta(days=a), lo + dt.timedelta(days=b)) for k, (a, b) in enumerate((rnd.randrange(-5, n), rnd.randrange(-5, n + 9)) for _ in range(120))]
    got = {}
    for r in J.dyadic_cover(spark.createDataFrame(rows, "k int, s date, e date"), "s", "e", lo, levels).collect():
        got.setdefault(r["k"], []).append((r["__level"], r["__block"]))
    for k, s, e in rows:
        want = list(range(max(0, (s - lo).days), min(n - 1, (e - lo).days) + 1))
        days = [d for level, block in got.get(k, []) for d in range(block << level, (block + 1) << level)]
        assert sorted(days) == want and len(got.get(k, [])) <= 2 * max(1, len(want)).bit_length()


def test_range_aggregate_without_pairs(spans):
    points, intervals, p, i = spans
    want = Counter()
    for a, b in pairs(points, intervals):
        want[a[2], b[3], "n"] += 1
        want[a[2], b[3], "v"] += b[4]
        want[a[2], b[3], "p"] += a[0]
    out = J.range_join_aggregate(p, i, "at", "s", "e", {"f": F.col("f")}, {"g": F.col("g")},
                                 {"n": ("count", None), "v": ("intervals", F.col("v")), "p": ("points", F.col("pid"))})
    got = {(r["f"], r["g"], m): r[m] for r in out.collect() for m in "nvp"}
    assert got == {k: want[k] for k in got} and {k for k in want if want[k]} <= set(got)


@pytest.mark.parametrize("filters", [[], ["i.v > 3", "p.f = 'a'"], ["i.v + p.pid > 10"]])
def test_rules_group_a_range_join_the_same_either_way(spark, spans, filters):
    points, intervals, p, i = spans
    keep = {"i.v > 3": lambda a, b: b[4] > 3, "p.f = 'a'": lambda a, b: a[2] == "a", "i.v + p.pid > 10": lambda a, b: b[4] + a[0] > 10}
    chosen = [(a, b) for a, b in pairs(points, intervals) if all(keep[f](a, b) for f in filters)]
    column = lambda name, kind, text: {"cte_name": "x", "column_name": name, "transformation_type": kind, "source_expression": text}
    rules = {"join_logic": [{"cte_name": "x", "left_table": "p", "right_table": "i", "join_type": "INNER JOIN", "join_condition": "p.at between i.s and i.e"}],
             "filter_logic": [{"cte_name": "x", "filter_type": "WHERE", "filter_expression": f} for f in filters],
             "column_mappings": [column("g", "simple", "i.g"), column("n", "aggregation", "count(*)"), column("v", "aggregation", "sum(i.v)")],
             "aggregation_rules": [{"cte_name": "x"}]}
    df = Rebuilder({"p": p, "i": i}, rules).build("x")
    want = Counter(b[3] for _, b in chosen)
    sums = Counter()
    for _, b in chosen:
        sums[b[3]] += b[4]
    assert {r["g"]: (r["n"], r["v"]) for r in df.collect()} == {g: (n, sums[g]) for g, n in want.items()}


def test_sweep_equals_the_expansion(spark, spans):
    _, _, _, i = spans
    days = spark.sql("SELECT explode(sequence(date'2020-01-05', date'2020-03-20')) AS report_date").where("day(report_date) <> 9")
    got = J.active_totals_sweep(i, days, "s", "e", {"total": "v"})
    want = J.range_join_calendar(i, days, "s", "e").groupBy("report_date").agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("total"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
    assert J.active_totals_sweep(i.limit(0), days, "s", "e", {"total": "v"}).count() == 0


def test_ordinals_over_a_key_with_half_of_all_rows(spark):
    rnd = random.Random(8)
    rows = [("hot" if rnd.random() < 0.5 else f"k{rnd.randrange(40)}", rnd.choice([None, rnd.randrange(900)]), k) for k in range(4000)]
    df = spark.createDataFrame(rows, "k string, v int, id int").repartition(6)
    order = [F.col("k").asc_nulls_last(), F.col("v").asc_nulls_last(), F.col("id").asc()]
    got = {r["id"]: r["ordinal"] for r in with_ordinal(df, order).collect()}
    want = sorted(rows, key=lambda r: (r[0], r[1] is None, r[1] or 0, r[2]))
    assert got == {r[2]: n for n, r in enumerate(want, 1)}
    plan = with_ordinal(df, order)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "windowspecdefinition(k" not in plan
    total = running_total(df.withColumn("w", F.lit(2)), order, {"t": "w"}).agg(F.max("t")).first()[0]
    assert total == 2 * len(rows)


def test_day_totals_equal_the_expanded_calendar_join(spark, spans):
    from ledgermatch.functions import scalars as S

    _, _, _, i = spans
    i = (i.withColumn("since", F.when(F.col("iid") % 11 == 0, None).otherwise(F.expr("s - make_dt_interval(iid * 17 % 900 - 20, iid % 3 * 7)")))
          .withColumn("v", F.when(F.col("iid") % 5 == 0, None).otherwise(F.col("v").cast("decimal(18,2)")))
          .withColumn("g", F.when(F.col("g") == "z", None).otherwise(F.col("g"))))
    i = i.unionByName(i.limit(20))
    # a calendar with gaps and one day twice
    cal = spark.range(400).select(F.date_add(F.lit("2020-01-10").cast("date"), F.col("id").cast("int")).alias("report_date")).filter("dayofmonth(report_date) <> 20")
    cal = cal.unionByName(cal.filter("report_date = DATE'2020-02-03'"))
    tenure = S.tenure_days("report_date", "since")

    def keyed(df):
        d = S.tenure_days("report_date", "since")
        return df.withColumns({"t": S.tenure_group(d), "f": S.tenure_group_finance(d)})
    pairs_ = keyed(J.range_join_calendar(i, cal, "s", "e"))
    want = pairs_.groupBy("report_date", "g", "t", "f").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v"))
    got = J.day_totals(keyed(J.split_at_steps(i, cal, "s", "e", tenure, S.TENURE_STEPS)), cal, ["g", "t", "f"], {"v": F.col("v")}, count_col="n")
    got = got.groupBy("report_date", "g", "t", "f").agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
    rows_ = lambda df: sorted(map(str, df.select("report_date", "g", "t", "f", "n", F.col("v").cast("decimal(38,2)")).collect()))
    assert rows_(got) == rows_(want) and len(rows_(want)) > 500
    plain = J.day_totals(J.split_at_steps(i, cal, "s", "e"), cal, ["g"], {}, count_col="n").groupBy("report_date", "g").agg(F.sum("n").alias("n"))
    assert sorted(map(str, plain.collect())) == sorted(map(str, pairs_.groupBy("report_date", "g").agg(F.count(F.lit(1)).alias("n")).collect()))
    assert J.day_totals(J.split_at_steps(i.limit(0), cal, "s", "e"), cal, ["g"], {}).count() == 0


def test_tenure_steps_are_all_days_on_which_a_bucket_begins(spark):
    from ledgermatch.functions import scalars as S

    days = spark.range(-30, 3000).select("id", S.tenure_group("id").alias("t"), S.tenure_group_finance("id").alias("f")).orderBy("id").collect()
    assert {b["id"] for a, b in zip(days, days[1:]) if (a["t"], a["f"]) != (b["t"], b["f"])} == set(S.TENURE_STEPS)


def test_layer_makes_no_row_per_interval_and_day(spark, tmp_path):
    """500 open intervals of one group over 1000 days: 1000 rows, and no step has more than a few rows per interval or day."""
    from ledgermatch.sources import fixtures as fx

    n, days = 500, 1000
    day = lambda k: f"timestampadd(DAY, {k}, timestamp_ntz'1995-01-01 00:00:00')"
    spark.range(n).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"), F.lit(2.5).alias("o_totalprice"),
                          F.when(F.col("id") == 1, F.expr(day(days - 1))).otherwise(F.expr(day(0))).alias("o_orderdate"),
                          F.lit("5-LOW").alias("o_orderpriority")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(n).select(F.col("id").alias("c_custkey"), F.lit(3).alias("c_nationkey"), F.lit(1.0).alias("c_acctbal"),
                          F.lit("BUILDING").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1).select(F.lit(-1).cast("bigint").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit("N").alias("l_returnflag"),
                          F.expr(day(0)).alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    df = fx.layer(spark, str(tmp_path))
    sums = df.groupBy("report_date").agg(F.sum("subscription_count").alias("n"), F.sum("ratecard_amount").alias("r")).collect()
    assert len(sums) == days and all(r["r"] == 2.5 * r["n"] and r["n"] in (n - 1, n) for r in sums)
    out = df._jdf.queryExecution()
    out.toRdd().count()

    def nodes(p):
        yield p
        kids = ([p.executedPlan()] if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else
                [p.plan()] if "QueryStageExec" in p.getClass().getSimpleName() else [])
        for k in [*kids, *[p.children().apply(i) for i in range(p.children().size())]]:
            yield from nodes(k)
    made = [p.metrics().apply("numOutputRows").value() for p in nodes(out.executedPlan()) if p.metrics().contains("numOutputRows")]
    assert made and max(made) < 20 * (n + days)


def _made(df, node):
    """Rows that the nodes of this kind gave in one run."""
    out = df._jdf.queryExecution()
    out.toRdd().count()

    def nodes(p):
        yield p
        kids = ([p.executedPlan()] if p.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else
                [p.plan()] if "QueryStageExec" in p.getClass().getSimpleName() else [])
        for k in [*kids, *[p.children().apply(i) for i in range(p.children().size())]]:
            yield from nodes(k)
    return sum(p.metrics().apply("numOutputRows").value() for p in nodes(out.executedPlan()) if p.getClass().getSimpleName() == node)


def test_split_makes_only_the_stretches(spark):
    """200 intervals of 30 days and one open one: no row for a bucket that an interval does not meet."""
    day = lambda k: f"timestampadd(DAY, {k}, timestamp_ntz'2020-01-01 00:00:00')"
    i = spark.range(201).select(F.expr(day("id")).alias("s"), F.when(F.col("id") < 200, F.expr(day("id + 29"))).alias("e"),
                                F.when(F.col("id") != 7, F.expr(day("-100"))).alias("since"))
    cal = spark.range(900).select(F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("report_date"))
    out = J.split_at_steps(i, cal, "s", "e", F.datediff("report_date", "since").cast("bigint"), [200, 0, 500])
    got = out.select("report_date", "__last", F.datediff("report_date", "since").alias("a"), F.datediff("__last", "since").alias("z")).collect()
    assert all(r["a"] is None or sum(r["a"] >= x for x in (0, 200, 500)) == sum(r["z"] >= x for x in (0, 200, 500)) for r in got)
    assert sum((r["__last"] - r["report_date"]).days + 1 for r in got) == 200 * 30 + 700
    # Those that reach day 200 have two stretches, the open one has two as well.
    assert len(got) == 201 + sum(k + 100 < 200 <= k + 129 for k in range(200) if k != 7) + 1
    assert _made(out, "GenerateExec") == len(got)


def test_tenure_step_stands_for_both_buckets(spark):
    from ledgermatch.functions import scalars as S

    days = spark.range(-30, 3000).select("id").union(spark.createDataFrame([(None,)], "id long"))
    both = lambda c: [S.tenure_group(c).alias(f"t_{c}"), S.tenure_group_finance(c).alias(f"f_{c}")]
    rows_ = days.withColumn("step", S.tenure_step("id")).select("step", *both("id"), *both("step")).collect()
    assert all((r["t_id"], r["f_id"]) == (r["t_step"], r["f_step"]) for r in rows_) and len(rows_) == 3031
    assert len({r["step"] for r in rows_}) == len({(r["t_id"], r["f_id"]) for r in rows_}) == len(S.TENURE_STEPS) + 1


def test_tenure_days_from_midnights_and_other_instants(spark):
    from datetime import date, datetime, timedelta

    from ledgermatch.functions import scalars as S

    starts = [datetime(2020, 3, 1, h, m) for h, m in ((0, 0), (18, 0), (0, 1), (23, 59))] + [datetime(1969, 12, 31), datetime(1960, 5, 5, 6), None]
    rows_ = [(date(2020, 2, 27) + timedelta(days=k), s, datetime(2020, 2, 27, 12) + timedelta(days=k)) for s in starts for k in range(8)]
    got = spark.createDataFrame(rows_, "d date, s timestamp_ntz, t timestamp_ntz").select(
        "d", "s", "t", S.tenure_days("d", "s").alias("n"), S.tenure_days("t", "s").alias("m")).collect()
    want = lambda a, s: None if s is None else (a - s) // timedelta(days=1)
    assert len(got) == 56 and all(r["n"] == want(datetime.combine(r["d"], datetime.min.time()), r["s"]) and r["m"] == want(r["t"], r["s"]) for r in got)


def test_day_totals_with_events_equal_the_union_of_both(spark, spans):
    _, _, _, i = spans
    g = lambda c: F.when(F.col(c) % 4 == 0, None).otherwise(F.concat(F.lit("g"), (F.col(c) % 9).cast("string")))
    i = i.withColumn("v", F.when(F.col("iid") % 5 == 0, None).otherwise(F.col("iid") - 30)).withColumn("g", g("iid"))
    day = lambda k: F.date_add(F.lit("2019-12-01").cast("date"), k.cast("int"))
    cal = spark.range(200).select(day(F.col("id") + 60).alias("report_date")).filter("dayofmonth(report_date) <> 20")
    # on days before, in, in a gap of and after the calendar, some without a span of their key, twice and without a day
    ev = spark.range(700).select(g("id").alias("g"), F.when(F.col("id") % 50 != 0, day(F.col("id") * 7 % 300)).alias("report_date"), "id")
    ev = ev.unionByName(ev.limit(30)).unionByName(ev.limit(10).withColumn("g", F.lit("alone")))
    got = J.day_totals(J.split_at_steps(i, cal, "s", "e"), cal, ["g"], {"v": F.col("v")}, count_col="n",
                       events=ev, event_measures={"k": F.lit(1), "x": F.col("id")})
    zero = F.lit(0).cast("bigint")
    pairs_ = J.range_join_calendar(i, cal, "s", "e").select("report_date", "g", F.lit(1).alias("n"), "v", zero.alias("k"), zero.alias("x"))
    both = pairs_.unionByName(ev.join(cal, "report_date").select("report_date", "g", zero.alias("n"), zero.alias("v"), F.lit(1).alias("k"), F.col("id").alias("x")))
    want = both.groupBy("report_date", "g").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "v", "k", "x")])
    rows_ = lambda df: sorted(str(tuple(r)) for r in df.select("report_date", "g", "n", "v", "k", "x").collect())
    assert rows_(got) == rows_(want) and len(rows_(want)) > 500
    assert got.filter("n = 0 AND k > 0").count() and got.filter("g = 'alone'").count()


def test_layer_groups_once_by_narrow_keys(spark):
    """Two shuffles of groups, per key and day and per key, and none by the dimensions that follow from others."""
    from ledgermatch.sources import fixtures as fx

    plan = fx.layer(spark, "/root/testdata/sf0.001", damaged=True)._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "hashpartitioning(" in line and "offer_category_name" in line]
    assert len(keys) == 2 and not [k for k in keys if "classification_level_1" in k or "dw_" in k]


def test_coded_dimensions_come_back(spark):
    import itertools

    from ledgermatch.sources import fixtures as fx

    combos = list(itertools.product(*fx.CODED_DIMS.values()))
    df = spark.createDataFrame(combos, ", ".join(f"{d} string" for d in fx.CODED_DIMS)).withColumns(
        {"report_date": F.lit("2020-03-01").cast("date"), fx.TENURE_KEY: F.lit(0)})
    coded = fx.with_dim_code(df).drop(*fx.CODED_DIMS)
    assert coded.distinct().count() == len(combos)
    assert sorted(map(str, fx.with_layer_dims(coded).select(*fx.CODED_DIMS).collect())) == sorted(map(str, df.select(*fx.CODED_DIMS).collect()))


def test_layer_sums_prices_exactly(spark, tmp_path):
    """Prices of either sign whose cents do not fit a whole number of 64 bits together."""
    from decimal import Decimal

    from ledgermatch.sources import fixtures as fx

    prices = [9e15] * 150 + [-12.34, 0.01, -0.99]
    rows_ = [(k, k, "O", p, "5-LOW") for k, p in enumerate(prices)]
    spark.createDataFrame(rows_, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string").withColumn(
        "o_orderdate", F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(len(prices)).select(F.col("id").alias("c_custkey"), F.lit(3).alias("c_nationkey"), F.lit(1.0).alias("c_acctbal"),
                                    F.lit("BUILDING").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(1).select(F.lit(-1).cast("bigint").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit("N").alias("l_returnflag"),
                          F.lit("1995-01-01 00:00:00").cast("timestamp_ntz").alias("l_shipdate")).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r["delivery_medium_type"]: r for r in fx.layer(spark, str(tmp_path)).collect()}
    for medium, mine in ((None, prices[::3]), ("Web", [p for k, p in enumerate(prices) if k % 3])):
        assert got[medium]["ratecard_amount"] == float(sum(Decimal(str(p)) for p in mine)) and got[medium]["subscription_count"] == len(mine)
