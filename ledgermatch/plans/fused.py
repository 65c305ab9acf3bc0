"""All checks of a suite from one scan of each table (R7, SC1, A1-A6).

A suite query that names its grouping columns and aggregates (``groups`` and
``aggs`` of its spec) can share a scan: the grouping sets of all such queries
become one ``groupingSets`` aggregate per table, whose ``grouping_id`` tells
the answers apart. Both tables' answers are put side by side by (grouping id,
group values) and compared cell by cell; cells, samples and result rows of all
queries come out of one plan. Row counts and derived-metric checks are global
aggregates and ride along. Queries in free SQL are compared on their own.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.plans.compare import FLOATING, NUMERIC, cell_delta, cell_match


@dataclass
class _Scan:
    """The aggregates wanted of one table."""
    table: DataFrame
    groups: list[str]
    aggs: dict[str, Column] = field(default_factory=dict)
    sets: set = field(default_factory=lambda: {()})

    def answers(self, side: str) -> DataFrame:
        """(gid, g0, g1, ..., <side>): a row per grouping set and group; the
        aggregates are in the struct <side>. The global set has a row even for
        an empty table."""
        names = [f"g{i}" for i in range(len(self.groups))]
        df = self.table.select("*", *[F.expr(g).alias(f"__{n}") for n, g in zip(names, self.groups)])
        aggs = [a.alias(n) for n, a in self.aggs.items()]
        none = df.limit(0).agg(*aggs) if aggs else df.limit(0).agg(F.lit(None).alias("none"))
        struct = lambda rank: F.struct(F.lit(rank).alias("rank"), *[F.col(n) for n in self.aggs])
        whole = (1 << len(names)) - 1
        if names:
            sets = [[f"__{names[i]}" for i in s] for s in sorted(self.sets)]
            out = df.groupingSets(sets, *[f"__{n}" for n in names]).agg(F.grouping_id().cast("long").alias("gid"), *aggs)
            out = out.select("gid", *[F.col(f"__{n}").alias(n) for n in names], struct(1).alias(side))
        else:
            out = df.agg(*aggs).select(F.lit(whole).cast("long").alias("gid"), struct(1).alias(side))
        # The answer of the global set for an empty table, outranked by a real one.
        seed = none.select(F.lit(whole).cast("long").alias("gid"), *[F.lit(None).cast(out.schema[n].dataType).alias(n) for n in names], struct(0).alias(side))
        return out.unionByName(seed).groupBy("gid", *names).agg(F.max(side).alias(side))


def _gid(groups: list[int], total: int) -> int:
    return sum(1 << (total - 1 - i) for i in range(total) if i not in groups)


def fits(spec, new: DataFrame, old: DataFrame) -> bool:
    """Whether a query can share the scans: it names its aggregates, its
    groups are its keys, and both tables can evaluate it."""
    from pyspark.errors import PySparkException

    if not spec.aggs or (spec.keys is not None and tuple(spec.keys) != tuple(n for n, _ in spec.groups)):
        return False
    try:
        for df in (new, old):
            df.groupBy(*[F.expr(g).alias(n) for n, g in spec.groups]).agg(*[F.expr(a).alias(n) for n, a in spec.aggs]).schema
    except PySparkException:
        return False
    return True


class FusedChecks:
    """One aggregate per table for the given queries and extra checks."""

    def __init__(self, new: DataFrame, old: DataFrame, suite, tol: float = 0.01, row_count: bool = False,
                 derived: Mapping[str, str] | None = None):
        self.spark: SparkSession = new.sparkSession
        self.tol, self.suite = tol, list(suite)
        self.groups = list(dict.fromkeys(g for q in self.suite for _, g in q.groups))
        self.scans = {"new": _Scan(new, self.groups), "old": _Scan(old, self.groups)}
        self.measures = []      # per query: (query, grouping id, [(column, aggregate's name)], [(key, group's name)])
        seen: dict[str, str] = {}
        for q in self.suite:
            at = [self.groups.index(g) for _, g in q.groups]
            for s in self.scans.values():
                s.sets.add(tuple(sorted(at)))
                for _, a in q.aggs:
                    s.aggs[seen.setdefault(a, f"a{len(seen)}")] = F.expr(a)
            self.measures.append((q, _gid(at, len(self.groups)), [(n, seen[a]) for n, a in q.aggs], [(n, f"g{i}") for (n, _), i in zip(q.groups, at)]))
        self.row_count, self.derived = row_count, dict(derived or {})
        if row_count:
            for s in self.scans.values():
                s.aggs["rows"] = F.count(F.lit(1))
        if self.derived:
            old_aggs = self.scans["old"].aggs
            old_aggs["derived_rows"] = F.count(F.lit(1))
            for i, (name, text) in enumerate(self.derived.items()):
                calc, actual = F.expr(text).cast("double"), F.col(name).cast("double")
                bad = F.when(calc.isNull() & actual.isNull(), False).when(calc.isNull() | actual.isNull(), True) \
                       .otherwise(F.abs(calc - actual) > F.lit(tol))
                old_aggs[f"bad{i}"], old_aggs[f"far{i}"] = F.count_if(bad), F.max(F.abs(calc - actual))

    def _sides(self) -> DataFrame:
        parts = [s.answers(side) for side, s in self.scans.items()]
        keys = ["gid", *[f"g{i}" for i in range(len(self.groups))]]
        return parts[0].unionByName(parts[1], allowMissingColumns=True).groupBy(*keys).agg(F.max("new").alias("new"), F.max("old").alias("old"))

    def _entry(self, ordinal: int, **values) -> Column:
        """One array element: a cell, or a check already summed up."""
        kinds = {"ordinal": "int", "row_key": "string", "column_name": "string", "new_value": "string", "old_value": "string",
                 "delta": "double", "status": "string", "total": "bigint", "bad": "bigint"}
        values["ordinal"] = F.lit(ordinal)
        return F.struct(*[values.get(n, F.lit(None)).cast(t).alias(n) for n, t in kinds.items()])

    def entries(self) -> DataFrame:
        """(ordinal, row_key, column_name, new_value, old_value, delta, status,
        total, bad): the cells of all queries, numbered by their place in the
        suite; extra checks have ordinals after them and no row_key."""
        sides = self._sides()
        kind = {side: {f.name: f.dataType for f in sides.schema[side].dataType.fields} for side in ("new", "old")}
        has_new, has_old = F.col("new").isNotNull(), F.col("old").isNotNull()
        out = []
        for k, (q, gid, columns, keys) in enumerate(self.measures, 1):
            key = (F.concat_ws(", ", *[F.concat(F.lit(f"{n}="), F.coalesce(F.col(g).cast("string"), F.lit("null"))) for n, g in keys])
                   if keys else F.lit(""))
            for column, name in columns:
                types = (kind["new"][name], kind["old"][name])
                numeric = all(isinstance(t, NUMERIC) for t in types)
                floating = any(isinstance(t, FLOATING) for t in types)
                whole = numeric and not floating and not any(isinstance(t, T.DecimalType) for t in types)
                a, b = F.col(f"new.{name}"), F.col(f"old.{name}")
                if floating:   # NaN reads as null
                    a, b = F.nullif(a, F.lit(float("nan"))), F.nullif(b, F.lit(float("nan")))
                status = (F.when(~has_old, "only_new").when(~has_new, "only_old")
                          .when(cell_match(a, b, floating, numeric, self.tol), "match").otherwise("mismatch"))
                cell = self._entry(k, row_key=key, column_name=F.lit(column), new_value=a.cast("string"), old_value=b.cast("string"),
                                   delta=cell_delta(a, b, None if whole else floating, numeric), status=status, total=F.lit(1),
                                   bad=F.when(status == "match", 0).otherwise(1))
                out.append(F.when(F.col("gid") == gid, cell))
        top, n = F.col("gid") == (1 << len(self.groups)) - 1, len(self.measures)
        if self.row_count:
            a, b = F.col("new.rows"), F.col("old.rows")
            out.append(F.when(top, self._entry(n + 1, new_value=a.cast("string"), old_value=b.cast("string"), total=a,
                                               delta=F.abs(a - b).cast("double"), bad=F.when(a == b, 0).otherwise(1))))
        for i in range(len(self.derived)):
            out.append(F.when(top, self._entry(n + 2 + i, delta=F.coalesce(F.col(f"old.far{i}"), F.lit(0.0)), total=F.col("old.derived_rows"),
                                               bad=F.col(f"old.bad{i}"))))
        return sides.select(F.explode(F.array_compact(F.array(*out))).alias("e")).select("e.*")

    def names(self) -> DataFrame:
        """(ordinal, validation_type, check_name, critical, scalar) of every check, also of one without cells."""
        from ledgermatch.sources.catalog import small_frame

        rows = [(k, "query", q.name, bool(q.critical), not keys and len(columns) == 1) for k, (q, _, columns, keys) in enumerate(self.measures, 1)]
        n = len(rows)
        rows += [(n + 1, "quantity", "row_count", False, False)] if self.row_count else []
        rows += [(n + 2 + i, "derived", m, False, False) for i, m in enumerate(self.derived)]
        return small_frame(self.spark, rows, "ordinal int, validation_type string, check_name string, critical boolean, scalar boolean")

    def result_rows(self, entries: DataFrame | None = None) -> DataFrame:
        """One row per check, as ``plans.suites.run_suite`` gives it."""
        e = self.entries() if entries is None else entries
        one = e.groupBy("ordinal").agg(F.sum("total").alias("total"), F.sum("bad").alias("bad"), F.max("delta").alias("max_delta"),
                                       F.max("new_value").alias("nv"), F.max("old_value").alias("ov"))
        bad = F.coalesce(F.col("bad"), F.lit(0)).cast("bigint")
        scalar, query = F.col("scalar"), F.col("validation_type") == "query"
        shown = scalar | (F.col("check_name") == "row_count") & ~query
        return self.names().join(F.broadcast(one), "ordinal", "left").select(     # a row per check of the suite
            "validation_type", "check_name", (bad == 0).alias("passed"),
            F.when(~scalar, F.coalesce(F.col("total"), F.lit(0)).cast("bigint")).alias("total_rows"),
            bad.alias("mismatched_rows"), "max_delta",
            F.when(shown, F.col("nv")).alias("cdl_value"), F.when(shown, F.col("ov")).alias("target_value"),
            F.when(query & (bad > 0), F.lit("Results do not match")).alias("error_message"), "critical", "ordinal")


def mismatch_samples(entries: DataFrame, names: DataFrame, n: int = 10) -> DataFrame:
    """R23 per suite query: its first ``n`` mismatching cells, largest difference
    first, then by row and column, with both values and how many there are.

    ``row_number() <= n`` keeps at most n rows per query and task before the
    shuffle; the counts are a grouped aggregate.
    """
    from pyspark.sql import Window

    bad = entries.filter(F.col("status") != "match")
    w = Window.partitionBy("ordinal").orderBy(F.col("delta").desc_nulls_last(), "row_key", "column_name")
    first = bad.withColumn("sample_rank", F.row_number().over(w)).filter(F.col("sample_rank") <= n)
    counts = bad.groupBy("ordinal").agg(F.count(F.lit(1)).alias("total_mismatches"))
    return (first.join(F.broadcast(counts), "ordinal").join(F.broadcast(names), "ordinal")    # both: a row per check
            .select("check_name", "sample_rank", "row_key", "column_name", F.col("new_value").alias("cdl_value"),
                    F.col("old_value").alias("target_value"), "delta", "status", "total_mismatches"))
