"""Joins (J1-J8).

The range join of an interval fact against a calendar is planned as clip to its
range + ``explode(sequence)`` + equi join, so its cost is the number of matching
(interval, day) pairs and never intervals x days. Where only totals per day are
wanted, ``active_totals_sweep`` needs no row per day; against timestamps,
intervals become dyadic blocks of days, and grouped counts over the pairs
(``range_join_aggregate``) are made without the pairs.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.functions.scalars import col_of, steps_reached
from ledgermatch.operators.filters import interval_overlap
from ledgermatch.operators.ordinals import running_total

# Floating measures are summed as this decimal (then returned as DOUBLE), so a
# reconciliation gives the same answer however the rows are partitioned. A sum
# with a value or a total that the decimal cannot hold is the plain DOUBLE sum.
EXACT_SUM_TYPE = "decimal(38,15)"


def exact_sum(col: Column) -> Column:
    dec = col.try_cast(EXACT_SUM_TYPE)
    whole = F.count(col) == F.count(dec)
    return F.when(whole, F.try_sum(dec).cast("double")).otherwise(F.sum(col.cast("double")))


def _d(v):
    return F.lit(v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v)))


def expand_intervals(df: DataFrame, start_col: str, end_col: str, lo, hi,
                     out_col: str = "report_date") -> DataFrame:
    """One row per day an interval is valid, restricted to ``[lo, hi]``.

    Intervals are inclusive at both ends by date; a null end is open; inverted
    intervals produce nothing. Clipping before ``sequence`` bounds every row's
    fan-out by the window length, so a year-9999 end never explodes.
    """
    s = F.greatest(F.to_date(col_of(start_col)), _d(lo))
    e = F.least(F.coalesce(F.to_date(col_of(end_col)), _d(hi)), _d(hi))
    return (df.withColumn("__s", s).withColumn("__e", e)
              .filter(F.col("__s") <= F.col("__e"))
              .withColumn(out_col, F.explode(F.sequence(F.col("__s"), F.col("__e"))))
              .drop("__s", "__e"))


def _interval_days(points: DataFrame, intervals: DataFrame, point: str, start_col: str, end_col: str) -> DataFrame:
    """The intervals that touch the points' own date range, one row per day of
    it in ``__day``. The range is a one-row aggregate of the points; as a
    literal it reaches the scan of the intervals."""
    r = points.agg(F.min(F.to_date(point)).alias("lo"), F.max(F.to_date(point)).alias("hi")).first()
    lo, hi = (r["lo"], r["hi"]) if r["lo"] else (_dt.date(1970, 1, 1), _dt.date(1970, 1, 1))
    return expand_intervals(interval_overlap(intervals, start_col, end_col, lo, hi), start_col, end_col, lo, hi, out_col="__day")


def range_join_calendar(df: DataFrame, cal: DataFrame, start_col: str, end_col: str,
                        date_col: str = "report_date") -> DataFrame:
    """``cal.date BETWEEN to_date(start) AND to_date(end)`` as an equi join.

    The bounds are the calendar's own, so none of its rows is lost. A fact
    column of the calendar's date name is kept with the suffix ``_fact``.
    """
    days = _interval_days(cal, df, date_col, start_col, end_col)
    if date_col in df.columns:
        days = days.withColumnRenamed(date_col, f"{date_col}_fact")
    return cal.join(days, cal[date_col] == days["__day"]).drop("__day")


def split_at_steps(df: DataFrame, cal: DataFrame, start_col: str, end_col: str, rising: Column | None = None, steps=(),
                   date_col: str = "report_date", last_col: str = "__last", reached_col: str | None = None) -> DataFrame:
    """The intervals that touch the calendar's range, clipped to it: a row per
    stretch of days, from ``date_col`` to ``last_col``.

    ``rising`` is a whole number that grows by one with each ``date_col``; a new
    stretch begins where it reaches one of ``steps``, so a bucket of it is the
    same on all days of a stretch. Where it is null there is one stretch.
    ``reached_col`` names a column for how many of the steps a stretch has reached.
    Intervals include both ends by date; a null end is open; inverted ones have
    no row. Rows grow with intervals times steps, not with days.
    """
    r = cal.agg(F.min(F.to_date(date_col)).alias("lo"), F.max(F.to_date(date_col)).alias("hi")).first()
    lo, hi = (r["lo"], r["hi"]) if r["lo"] else (_dt.date(1970, 1, 1), _dt.date(1970, 1, 1))
    days = interval_overlap(df, start_col, end_col, lo, hi)
    days = days.withColumns({date_col: F.greatest(F.to_date(col_of(start_col)), _d(lo)),
                             last_col: F.least(F.coalesce(F.to_date(col_of(end_col)), _d(hi)), _d(hi))})
    days = days.filter(F.col(date_col) <= F.col(last_col))
    if rising is None or not steps:
        return days.withColumn(reached_col, F.lit(0)) if reached_col else days
    # One row per bucket that the interval meets, and no other; an outer bucket has no bound on that side.
    steps = sorted(set(steps))
    bound = lambda values: F.array(*[F.lit(v).cast("bigint") for v in values])
    day = lambda value: F.date_add(date_col, (value - F.col("__value")).cast("int"))
    rest = [c for c in days.columns if c not in (date_col, last_col)]
    spans = days.withColumn("__value", rising)
    spans = spans.withColumns({"__from": steps_reached(F.col("__value"), steps),
                               "__to": steps_reached(F.col("__value") + F.datediff(last_col, date_col), steps)})
    spans = spans.withColumn("__bucket", F.explode(F.sequence("__from", "__to")))
    return spans.select(*rest, F.greatest(F.col(date_col), day(F.get(bound([None, *steps]), F.col("__bucket")))).alias(date_col),
                        F.least(F.col(last_col), day(F.get(bound([*steps, None]), F.col("__bucket")) - 1)).alias(last_col),
                        *([F.col("__bucket").alias(reached_col)] if reached_col else []))


def day_totals(spans: DataFrame, cal: DataFrame, keys: list[str], measures: dict[str, Column],
               date_col: str = "report_date", last_col: str = "__last", count_col: str = "__n",
               events: DataFrame | None = None, event_measures: dict[str, Column] | None = None) -> DataFrame:
    """The rows of ``cal`` with the number of spans per ``keys`` that hold its
    day and the sums of ``measures`` (exact types; nulls read as 0) over them.

    A span adds its values on its first day and takes them back after its last.
    The differences are summed per key and day, map-side first; a running total
    per key, at most one row per day, is kept until the key's next change. Rows
    grow with spans plus the result, never with the days of all spans.

    ``events`` have the keys and one day each, in ``date_col``: the sums of
    ``event_measures`` (whole numbers, not null) over those of the day are
    added; a key with events only has rows too, with 0 for the spans.
    """
    last_day = cal.agg(F.max(F.to_date(date_col)).alias("hi")).first()["hi"] or _dt.date(1970, 1, 1)
    ms = [f"__m{i}" for i in range(len(measures))]
    ends = F.array(*[F.struct(day.alias("day"), F.lit(sign).cast("bigint").alias("sign"))
                     for day, sign in ((F.col(date_col), 1), (F.date_add(last_col, 1), -1))])
    edges = spans.select(*keys, *[F.coalesce(c, F.lit(0)).alias(m) for m, c in zip(ms, measures.values())], F.explode(ends).alias("__x"))
    edges = edges.filter((F.col("__x.sign") > 0) | (F.col("__x.day") <= _d(last_day)))
    edges = edges.select(*keys, F.col("__x.day").alias("__day"), F.col("__x.sign").alias("__n"),
                         *[F.when(F.col("__x.sign") > 0, F.col(m)).otherwise(-F.col(m)).alias(m) for m in ms])
    es = []
    if events is not None:
        es = ["__e", *[f"__e{i}" for i in range(len(event_measures))]]
        zeros = lambda names: [F.lit(0).cast("bigint").alias(n) for n in names]
        single = events.filter(F.col(date_col) <= _d(last_day)).select(
            *keys, F.col(date_col).alias("__day"), F.lit(0).cast("bigint").alias("__n"),
            *[F.lit(0).cast(edges.schema[m].dataType).alias(m) for m in ms],
            F.lit(1).cast("bigint").alias("__e"), *[c.alias(e) for e, c in zip(es[1:], event_measures.values())])
        edges = edges.select("*", *zeros(es)).unionByName(single)
    changes = edges.groupBy(*keys, "__day").agg(*[F.sum(c).alias(c) for c in ["__n", *ms, *es]])
    by_key = Window.partitionBy(*keys).orderBy("__day")
    so_far = by_key.rowsBetween(Window.unboundedPreceding, 0)
    held = changes.select(*keys, F.col("__day").alias("__since"), F.lead("__day").over(by_key).alias("__next"),
                          *[F.sum(c).over(so_far).alias(c) for c in ["__n", *ms]], *es)
    active, until = F.col("__n") > 0, F.coalesce(F.date_sub("__next", 1), _d(last_day))
    if es:      # a day of events without a span stands alone
        active, until = active | (F.col("__e") > 0), F.when(active, until).otherwise(F.col("__since"))
    days = held.filter(active).withColumn("__day", F.explode(F.sequence("__since", until)))
    first = F.col("__day") == F.col("__since")
    return cal.join(days, cal[date_col] == days["__day"]).select(
        *cal.columns, *keys, F.col("__n").alias(count_col), *[F.col(m).alias(n) for m, n in zip(ms, measures)],
        *[F.when(first, F.col(e)).otherwise(F.lit(0)).alias(n) for e, n in zip(es[1:], event_measures or ())])


def _bounds(points: DataFrame, point: str) -> tuple[_dt.date, int]:
    """(first day, number of tree levels above the days) of the points."""
    r = points.agg(F.min(F.to_date(point)).alias("lo"), F.max(F.to_date(point)).alias("hi")).first()
    lo, hi = (r["lo"], r["hi"]) if r["lo"] else (_dt.date(1970, 1, 1), _dt.date(1970, 1, 1))
    return lo, ((hi - lo).days + 1).bit_length()


def _day_number(col, lo: _dt.date) -> Column:
    return F.datediff(F.to_date(col_of(col)), _d(lo))


def dyadic_cover(df: DataFrame, start_col: str, end_col: str, lo: _dt.date, levels: int) -> DataFrame:
    """``df`` with a row per power-of-two block of days that make up its
    interval: ``__level`` and ``__block``, the days from ``lo`` on with
    ``day >> level = block``.

    The blocks of an interval are disjoint and at most two on each level, so an
    interval of n days has at most 2 log2(n) rows where one row per day would be
    n. Intervals are clipped to the ``2^levels`` days from ``lo`` on; a null
    end is open; inverted intervals have no block.
    """
    s = F.greatest(_day_number(start_col, lo), F.lit(0))
    e = F.least(F.coalesce(_day_number(end_col, lo), F.lit((1 << levels) - 1)), F.lit((1 << levels) - 1)) + 1
    # On level k the part that is left goes from low to high - 1; an odd end of it is a block of its own.
    low, high = "shiftright(__s + shiftleft(1, k) - 1, k)", "shiftright(__e, k)"
    taken = F.expr(f"""flatten(transform(sequence(0, {levels}), k -> CASE WHEN {low} >= {high} THEN array() ELSE filter(array(
        CASE WHEN {low} % 2 = 1 THEN struct(k AS level, {low} AS block) END,
        CASE WHEN {high} % 2 = 1 THEN struct(k AS level, {high} - 1 AS block) END), b -> b IS NOT NULL) END))""")
    return (df.withColumn("__s", s).withColumn("__e", e).filter(F.col("__s") < F.col("__e"))
              .withColumn("__b", F.explode(taken))
              .withColumn("__level", F.col("__b.level")).withColumn("__block", F.col("__b.block")).drop("__s", "__e", "__b"))


def dyadic_ancestors(df: DataFrame, point: str, lo: _dt.date, levels: int) -> DataFrame:
    """``df`` with a row per block that holds the point's day, one on each level."""
    return (df.withColumn("__day", _day_number(point, lo)).filter(F.col("__day").isNotNull())
              .withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
              .withColumn("__block", F.expr("shiftright(__day, __level)")).drop("__day"))


def _inside(point: str, start_col: str, end_col: str) -> Column:
    return (F.col(point) >= F.col(start_col)) & (F.col(end_col).isNull() | (F.col(point) <= F.col(end_col)))


def range_join_points(points: DataFrame, intervals: DataFrame, point: str, start_col: str, end_col: str) -> DataFrame:
    """``point BETWEEN start AND end`` for timestamps: intervals as dyadic
    blocks of days, points as the blocks above them, an equi join on the block
    (each pair meets in exactly one), then the exact condition. A null end is
    open; clashing interval columns must be renamed before."""
    lo, levels = _bounds(points, point)
    spans = dyadic_cover(intervals, start_col, end_col, lo, levels)
    joined = dyadic_ancestors(points, point, lo, levels).join(spans, ["__level", "__block"])
    return joined.filter(_inside(point, start_col, end_col)).drop("__level", "__block")


def range_join_aggregate(points: DataFrame, intervals: DataFrame, point: str, start_col: str, end_col: str,
                         point_keys: dict[str, Column], interval_keys: dict[str, Column], measures: dict[str, tuple[str, Column | None]]) -> DataFrame:
    """Grouped counts and sums over the pairs of a range join, without the pairs.

    ``measures`` maps a name to ``("count", None)``, ``("points", column)`` or
    ``("intervals", column)``: the number of pairs, or the sum of a column of
    one side over all pairs. Both sides are summed first: points per block and
    point key, intervals per block and interval key; a block with p points and
    i intervals stands for p * i pairs. Only the first and last day of an
    interval need single instants: they are joined by day on (instant, key)
    totals. The rows joined grow with days, instants and keys, never with pairs.
    """
    lo, levels = _bounds(points, point)
    pk, ik = {f"__p{i}": c for i, c in enumerate(point_keys.values())}, {f"__i{i}": c for i, c in enumerate(interval_keys.values())}
    sums = {side: [(f"__{side}{i}", c) for i, (s, c) in enumerate(measures.values()) if s == side] for side in ("points", "intervals")}

    def totals(df, keys, side):
        return df.groupBy(*keys).agg(F.sum("__n").alias("__n"), *[F.sum(n).alias(n) for n, _ in sums[side]])

    at = points.select(F.col(point).alias("__at"), *[c.alias(n) for n, c in pk.items()], F.lit(1).cast("bigint").alias("__n"),
                       *[c.alias(n) for n, c in sums["points"]])
    at = totals(at.filter(F.col("__at").isNotNull()), ["__at", *pk], "points")
    span = intervals.select(F.col(start_col).alias("__from"), F.col(end_col).alias("__to"), *[c.alias(n) for n, c in ik.items()],
                            F.lit(1).cast("bigint").alias("__n"), *[c.alias(n) for n, c in sums["intervals"]])
    span = totals(span.filter(F.col("__from").isNotNull() & (F.col("__to").isNull() | (F.col("__from") <= F.col("__to")))),
                  ["__from", "__to", *ik], "intervals")
    day = lambda c: F.to_date(c)
    # Whole days between the first and the last one, as blocks.
    inner = span.withColumn("__a", F.date_add(day("__from"), 1)).withColumn("__z", F.date_sub(day("__to"), 1))
    inner = totals(dyadic_cover(inner, "__a", "__z", lo, levels), ["__level", "__block", *ik], "intervals")
    per_day = totals(at.withColumn("__day", day("__at")), ["__day", *pk], "points")
    above = totals(dyadic_ancestors(per_day, "__day", lo, levels), ["__level", "__block", *pk], "points")
    # The first and the last day, by instants.
    ends = span.withColumn("__day", F.explode(F.array_distinct(F.array_compact(F.array(day("__from"), day("__to"))))))
    edge = at.withColumn("__day", day("__at")).withColumnRenamed("__n", "__pn").join(ends.withColumnRenamed("__n", "__in"), "__day")
    edge = edge.filter((F.col("__at") >= F.col("__from")) & (F.col("__to").isNull() | (F.col("__at") <= F.col("__to"))))
    whole = above.withColumnRenamed("__n", "__pn").join(inner.withColumnRenamed("__n", "__in"), ["__level", "__block"])

    def product(df):
        out = []
        for i, (name, (side, _)) in enumerate(measures.items()):
            value = (F.col("__pn") * F.col("__in") if side == "count" else F.col(f"__points{i}") * F.col("__in") if side == "points"
                     else F.col("__pn") * F.col(f"__intervals{i}"))
            out.append(F.sum(value).alias(name))
        return df.groupBy(*pk, *ik).agg(*out)

    both = product(whole).unionByName(product(edge))
    return both.groupBy(*[F.col(n).alias(k) for n, k in zip(pk, point_keys)], *[F.col(n).alias(k) for n, k in zip(ik, interval_keys)]).agg(
        *[F.sum(m).alias(m) for m in measures])


def active_totals_sweep(df: DataFrame, days: DataFrame, start_col: str, end_col: str, measures: dict[str, str],
                        date_col: str = "report_date", count_col: str = "active_intervals") -> DataFrame:
    """How many intervals are active on each day of ``days`` and the sums of
    ``measures`` (new name -> column) over them, by a sweep (J1 + A1).

    An interval adds its values on its first day and takes them back on the day
    after its last one. The differences are summed per day, map-side first, and
    a running total over the days gives the totals. Rows grow with intervals
    plus days, never with their product. Intervals include both ends by date; a
    null end never closes; inverted intervals do not count; a day without an
    active interval has no row, as in the join.
    """
    first, after = F.to_date(col_of(start_col)), F.date_add(F.to_date(col_of(end_col)), 1)
    spans = df.select(first.alias("__a"), after.alias("__z"), *[F.col(c).alias(f"__m{i}") for i, c in enumerate(measures.values())])
    spans = spans.filter(F.col("__a").isNotNull() & (F.col("__z").isNull() | (F.col("__a") < F.col("__z"))))
    ms = [f"__m{i}" for i in range(len(measures))]
    zero = [F.lit(0).cast(spans.schema[m].dataType).alias(m) for m in ms]
    opened = spans.select(F.col("__a").alias("__day"), F.lit(1).cast("bigint").alias("__n"), *[F.coalesce(F.col(m), F.lit(0)).alias(m) for m in ms])
    closed = spans.filter(F.col("__z").isNotNull()).select(F.col("__z").alias("__day"), F.lit(-1).cast("bigint").alias("__n"),
                                                           *[(-F.coalesce(F.col(m), F.lit(0))).alias(m) for m in ms])
    wanted = days.select(F.col(date_col).alias("__day"), F.lit(0).cast("bigint").alias("__n"), *zero).distinct()
    flagged = [d.withColumn("__wanted", F.lit(w)) for d, w in ((opened, False), (closed, False), (wanted, True))]
    per_day = flagged[0].unionByName(flagged[1]).unionByName(flagged[2]).groupBy("__day").agg(
        F.sum("__n").alias("__n"), *[F.sum(m).alias(m) for m in ms], F.max("__wanted").alias("__wanted"))
    names = {count_col: "__n", **dict(zip(measures, ms))}
    total = running_total(per_day, [F.col("__day").asc()], {f"__t{i}": c for i, c in enumerate(names.values())})
    return (total.filter(F.col("__wanted") & (F.col("__t0") > 0))
            .select(F.col("__day").alias(date_col), *[F.col(f"__t{i}").alias(n) for i, n in enumerate(names)]))


def equi_join(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
              how: str = "inner", suffix: str = "_cal") -> DataFrame:
    """Single-pair equi join; right columns that clash with left ones get ``suffix``.

    When the key names are equal the key appears once.
    """
    lcols = set(left.columns)
    r = right
    for c in right.columns:
        if c in lcols and not (c == right_col and left_col == right_col):
            r = r.withColumnRenamed(c, c + suffix)
    rkey = right_col if right_col not in lcols or left_col == right_col else right_col + suffix
    if left_col == right_col:
        return left.join(r, on=left_col, how=how)
    return left.join(r, left[left_col] == r[rkey], how=how)


def null_safe_condition(left: DataFrame, right: DataFrame, keys) -> Column:
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(right[k])
        cond = c if cond is None else cond & c
    return cond


def anti_join(left: DataFrame, right: DataFrame, keys) -> DataFrame:
    """Rows of ``left`` whose key tuple is absent from ``right``; null keys match."""
    r = right.select(*keys).distinct()
    return left.join(r, null_safe_condition(left, r, keys), "left_anti")


def side_by_side(new: DataFrame, old: DataFrame, keys, measures, agg: str = "sum",
                 new_name: str = "new", old_name: str = "old") -> DataFrame:
    """Align two tables on ``keys`` with one shuffle (J4, re-expressed).

    Instead of a full outer join, both sides are tagged, unioned and grouped by
    the key tuple. Grouping treats null keys as equal (the reference's merge
    does the same), duplicate keys on a side are summed first (S12), and a hot
    key is collapsed by partial aggregation before the shuffle, so skew does not
    concentrate rows in one task.

    Output: keys, ``<m>_<new_name>``, ``<m>_<old_name>`` per measure,
    ``in_<new_name>`` / ``in_<old_name>`` presence flags and ``__rows_<side>`` row
    counts per key.
    """
    fn = {"sum": F.sum, "max": F.max, "min": F.min}[agg]
    floating = {m for m in measures for df in (new, old)
                if m in df.columns and isinstance(df.schema[m].dataType, (T.FloatType, T.DoubleType))}
    tagged = []
    for df, side in ((new, new_name), (old, old_name)):
        cols = [F.col(k) for k in keys]
        for m in measures:
            c = F.col(m) if m in df.columns else F.lit(None)
            cols.append(c.alias(m))
        tagged.append(df.select(*cols, F.lit(side).alias("__side")))
    u = tagged[0].unionByName(tagged[1])
    aggs = []
    for m in measures:
        for side in (new_name, old_name):
            value = F.when(F.col("__side") == side, F.col(m))
            a = exact_sum(value) if agg == "sum" and m in floating else fn(value)
            aggs.append(a.alias(f"{m}_{side}"))
    for side in (new_name, old_name):
        aggs.append(F.max(F.col("__side") == side).alias(f"in_{side}"))
        aggs.append(F.count_if(F.col("__side") == side).alias(f"__rows_{side}"))
    if keys:
        return u.groupBy(*keys).agg(*aggs)
    return u.agg(*aggs)


def one_sided(new: DataFrame, old: DataFrame, keys, new_name: str = "new", old_name: str = "old") -> DataFrame:
    """Distinct key tuples with presence flags for both sides, in one shuffle."""
    return side_by_side(new, old, keys, [], new_name=new_name, old_name=old_name)
