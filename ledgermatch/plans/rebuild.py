"""Rebuild a reporting table from its sources by rule tables.

Rule tables (FIXTURES F6) are small configuration, given as lists of dicts:

* ``cte_structure``  cte_name, cte_type (base | join | transform | union), parent_cte
* ``column_mappings`` cte_name, column_name, transformation_type, source_expression
* ``join_logic``     cte_name, left_table, right_table, join_type, join_condition
* ``filter_logic``   cte_name, filter_type, filter_expression
* ``aggregation_rules`` cte_name
* ``day_steps`` (optional) cte_name, column_name, steps: a column of a range join
  with a calendar that grows by one with each day, and the values at which
  columns computed from it change

``Rebuilder.build(name)`` folds them into one lazy DataFrame DAG (memoised,
cycle-checked). Each CTE's input carries the CTE name as its alias, so rule
text like ``sba.subscription_count`` resolves. Per CTE: join or union or
parent, then WHERE filters, then medium/complex columns, then the rule
group-by if the CTE is listed in ``aggregation_rules``. A union CTE applies its
own rules after the union (S22).

Joins: the rules of a CTE are folded in order. ``d BETWEEN start AND end`` on
dates or timestamps (casts to date allowed) uses the range joins of
``operators.joins`` (no nested-loop join); a CTE that only counts or sums over
such pairs, directly or of its parent, is grouped without making them; any other condition is a Spark SQL
boolean over the aliases, so equi conditions plan as hash or sort-merge joins.
Filters and columns of the CTE may use the aliases of its tables. A condition is required: an empty one is
an error, never a silent cross product (S10).
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.operators.aggregates import DIMENSION_TYPES, METRIC_TYPES, group_by_rules, metric_expr
from ledgermatch.operators.filters import rule_filter
from ledgermatch.operators.joins import day_totals, range_join_aggregate, range_join_calendar, range_join_points, split_at_steps

_OPERAND = r"(?:cast\(\s*)?(?:(\w+)\.)?(\w+)(?:\s+as\s+date\s*\))?"
_BETWEEN = re.compile(rf"^\s*{_OPERAND}\s+between\s+{_OPERAND}\s+and\s+{_OPERAND}\s*$", re.IGNORECASE)
_HOW = {"INNER JOIN": "inner", "LEFT JOIN": "left", "LEFT OUTER JOIN": "left", "RIGHT JOIN": "right",
        "FULL JOIN": "full_outer", "FULL OUTER JOIN": "full_outer", "RANGE JOIN": "inner"}


# ``alias.column`` outside quotes; a quoted text matches without an alias
_REFERENCE = re.compile(r"'(?:[^'\\]|\\.)*'|\"[^\"]*\"|(?<![\w.`])`?(?P<alias>\w+)`?\.`?(?P<column>\w+)`?")
_COUNT_ALL = re.compile(r"^count\(\s*(?:\*|1)\s*\)$", re.IGNORECASE)
_SUM_OF = re.compile(r"^sum\((?P<of>[^()]*(?:\([^()]*\)[^()]*)*)\)$", re.IGNORECASE)


class RuleError(ValueError):
    pass


def _resolve(text: str, aliases: Mapping[str, Mapping[str, str]], prefix: str = "") -> str:
    """``text`` with ``alias.column`` of a joined table (outside quotes) written
    as the column's name in the joined result."""
    def name(m):
        column = aliases.get((m["alias"] or "").lower(), {}).get((m["column"] or "").lower())
        return f"{prefix}`{column}`" if column else m.group()
    return _REFERENCE.sub(name, text)


class Rebuilder:
    def __init__(self, sources: Mapping[str, DataFrame], rules: Mapping[str, list], suffix: str = "_cal"):
        self.sources = dict(sources)
        self.rules = {k: list(v) for k, v in rules.items()}
        self.suffix = suffix
        self.built: dict[str, DataFrame] = {}
        self._stack: list[str] = []

    def _rows(self, table: str, cte: str) -> list[Mapping]:
        return [r for r in self.rules.get(table, []) if r.get("cte_name") == cte]

    def build(self, name: str) -> DataFrame:
        if name in self.built:
            return self.built[name]
        if name in self._stack:
            raise RuleError(f"cycle in rule tables: {' -> '.join(self._stack + [name])}")
        self._stack.append(name)
        try:
            df = self._build(name)
        finally:
            self._stack.pop()
        self.built[name] = df
        return df

    def _build(self, name: str) -> DataFrame:
        if name in self.sources:
            return self.sources[name]
        struct = self._rows("cte_structure", name)
        kind = str(struct[0].get("cte_type", "transform")).lower() if struct else "transform"
        joins = self._rows("join_logic", name)
        if len(joins) == 1 and kind != "union":
            grouped = self._range_aggregate(name, joins[0])
            if grouped is not None:
                return grouped
        if kind == "transform" and struct and struct[0].get("parent_cte"):
            grouped = self._calendar_aggregate(name, str(struct[0]["parent_cte"]).strip())
            if grouped is not None:
                return grouped
        names: dict[str, dict[str, str]] = {}     # table alias -> its columns' names in the joined result
        if kind == "union":
            parents = [p.strip() for p in str(struct[0]["parent_cte"]).split(",") if p.strip()]
            df = self.build(parents[0])
            for p in parents[1:]:
                df = df.unionByName(self.build(p), allowMissingColumns=True)
        elif joins:
            df = None
            for j in joins:
                df = self._join(df, j, names)
        elif struct and struct[0].get("parent_cte"):
            df = self.build(str(struct[0]["parent_cte"]).strip())
        else:
            raise RuleError(f"no source, join or parent for {name}")
        return self._transform(df, name, struct[0].get("parent_cte") if struct and kind != "union" else None, names)

    def _join(self, left: DataFrame | None, j: Mapping, aliases: dict[str, dict[str, str]]) -> DataFrame:
        """``left`` (what the CTE's joins gave so far, at first the left table)
        joined with the rule's right table.

        The result has each column once by its plain name; a clashing right
        column gets the suffix. ``aliases`` remembers what each table's columns
        are called, for later conditions and the CTE's own rules.
        """
        lt, rt = str(j["left_table"]).strip(), str(j["right_table"]).strip()
        how_text = str(j.get("join_type") or "INNER JOIN").strip().upper()
        if how_text not in _HOW:
            raise RuleError(f"unknown join type {how_text!r}")
        how = _HOW[how_text]
        cond = str(j.get("join_condition") or "").strip()
        if not cond:
            raise RuleError(f"join {lt} x {rt} has no condition; cross products are not built")
        first = left is None
        left, right = self.build(lt) if first else left, self.build(rt)
        taken = list(left.columns)
        names = {}
        for c in right.columns:
            new = next(n for n in (c, c + self.suffix, f"{c}_{rt}") if n not in taken)
            names[c] = new
            taken.append(new)
        if first:
            aliases[lt.lower()] = {c.lower(): c for c in left.columns}
        known = dict(aliases)
        aliases[rt.lower()] = {c.lower(): n for c, n in names.items()}
        m = _BETWEEN.match(cond)
        if how_text == "RANGE JOIN" and not m:
            raise RuleError(f"range join needs 'd BETWEEN start AND end', got {cond!r}")
        out = None
        if m and how == "inner":
            out = self._range_join(left, right.withColumnsRenamed(names), names, rt, *m.groups())
        if out is None:
            l = left.alias(lt if first else "__left")
            joined = l.join(right.alias(rt), F.expr(cond if first else _resolve(cond, known, "__left.")), how)
            out = joined.select(*[F.col(f"{lt if first else '__left'}.{c}") for c in left.columns],
                                *[F.col(f"{rt}.{c}").alias(n) for c, n in names.items()])
        return out

    def _range_join(self, left, right, names, rt, p_alias, p, s_alias, s, e_alias, e) -> DataFrame | None:
        """A BETWEEN condition on dates or timestamps by days; None for other types."""
        fact_right = s_alias.lower() == rt.lower() if s_alias else s not in left.columns
        spans, points = (right, left) if fact_right else (left, right)
        new = {k.lower(): v for k, v in names.items()}
        s, e = (new.get(s.lower(), s), new.get(e.lower(), e)) if fact_right else (s, e)
        p = p if fact_right else new.get(p.lower(), p)
        kind = {f.name.lower(): f.dataType for f in points.schema.fields}.get(p.lower())
        if isinstance(kind, T.DateType):
            return range_join_calendar(spans, points, s, e, date_col=p).select(*left.columns, *right.columns)
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return range_join_points(points, spans, p, s, e).select(*left.columns, *right.columns)
        return None

    def _range_aggregate(self, name: str, j: Mapping) -> DataFrame | None:
        """A CTE that only groups the pairs of one range join on timestamps, by
        columns and filters of one table each, with counts and sums: computed
        without the pairs. None for any other CTE."""
        m = _BETWEEN.match(str(j.get("join_condition") or ""))
        how = _HOW.get(str(j.get("join_type") or "INNER JOIN").strip().upper())
        if not m or how != "inner" or not self._rows("aggregation_rules", name):
            return None
        lt, rt = str(j["left_table"]).strip(), str(j["right_table"]).strip()
        p_alias, p, s_alias, s, e_alias, e = m.groups()
        sides = {lt.lower(): self.build(lt).alias(lt), rt.lower(): self.build(rt).alias(rt)}
        if len(sides) < 2 or not (p_alias and s_alias and e_alias) or s_alias.lower() != e_alias.lower() \
                or {p_alias.lower(), s_alias.lower()} != set(sides):
            return None
        point, span = p_alias.lower(), s_alias.lower()
        kind = {f.name.lower(): f.dataType for f in sides[point].schema.fields}.get(p.lower())
        if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)) or re.search(r"\bcast\b", str(j["join_condition"]), re.I):
            return None

        def home(text: str) -> tuple[str, T.DataType] | None:
            """The one table whose alias all of the text's columns carry, and its type there."""
            named = {m["alias"].lower() for m in _REFERENCE.finditer(text) if m["alias"]}
            side = next(iter(named)) if len(named) == 1 else None
            try:
                return (side, sides[side].select(F.expr(text).alias("x")).schema["x"].dataType) if side in sides else None
            except PySparkException:   # a column without an alias that only the other table has
                return None

        for r in self._rows("filter_logic", name):
            text = str(r.get("filter_expression") or "").strip()
            if str(r.get("filter_type", "")).upper() != "WHERE" or not text:
                continue
            side = home(text)
            if side is None:
                return None
            sides[side[0]] = sides[side[0]].filter(F.expr(text))
        keys, measures = {point: {}, span: {}}, {}
        for r in self._rows("column_mappings", name):
            kind, column = str(r.get("transformation_type", "")).lower(), r["column_name"]
            text = str(r.get("source_expression") or column).strip()
            if kind in DIMENSION_TYPES:
                side = home(text)
                if side is None:
                    return None
                keys[side[0]][column] = F.expr(text)
            elif kind in METRIC_TYPES:
                total = _SUM_OF.match(text)
                side = home(total["of"]) if total else None
                if _COUNT_ALL.match(text):
                    measures[column] = ("count", None)
                elif side and isinstance(side[1], (T.IntegralType, T.DecimalType)):
                    measures[column] = ("points" if side[0] == point else "intervals", F.expr(total["of"]))
                else:
                    return None
        if not measures:
            return None
        out = range_join_aggregate(sides[point], sides[span], p, s, e, keys[point], keys[span], measures)
        return out.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c, (side, _) in measures.items() if side != "count"})

    def _calendar_aggregate(self, name: str, parent: str) -> DataFrame | None:
        """A CTE that only counts and sums over its parent, a range join of
        intervals with a calendar of dates: computed without a row per interval
        and day. The parent's columns may depend on the interval alone, on the
        calendar alone, or on both through its ``day_steps`` column. None for
        any other CTE."""
        joins, steps = self._rows("join_logic", parent), self._rows("day_steps", parent)
        wheres = lambda cte: [str(r["filter_expression"]) for r in self._rows("filter_logic", cte)     # noqa: E731
                              if str(r.get("filter_type", "")).upper() == "WHERE" and str(r.get("filter_expression") or "").strip()]
        struct = self._rows("cte_structure", parent)
        m = _BETWEEN.match(str(joins[0].get("join_condition") or "")) if len(joins) == 1 else None
        if (not m or _HOW.get(str(joins[0].get("join_type") or "INNER JOIN").strip().upper()) != "inner" or not self._rows("aggregation_rules", name)
                or wheres(name) or parent in self.sources or self._rows("aggregation_rules", parent) or len(steps) > 1
                or not struct or str(struct[0].get("cte_type", "")).lower() != "join" or struct[0].get("parent_cte")):
            return None
        p_alias, p, s_alias, s, e_alias, e = m.groups()
        tables = {str(joins[0][t]).strip().lower(): str(joins[0][t]).strip() for t in ("left_table", "right_table")}
        if not (p_alias and s_alias and e_alias) or s_alias.lower() != e_alias.lower() or {p_alias.lower(), s_alias.lower()} != set(tables):
            return None
        spans, cal = self.build(tables[s_alias.lower()]), self.build(tables[p_alias.lower()])
        names = [c.lower() for c in spans.columns + cal.columns]
        date = next((f.name for f in cal.schema.fields if f.name.lower() == p.lower() and isinstance(f.dataType, T.DateType)), None)
        if date is None or len(set(names)) < len(names):
            return None
        aliases = {a: {c.lower(): c for c in df.columns} for a, df in ((s_alias.lower(), spans), (p_alias.lower(), cal))}

        def type_in(df: DataFrame, text: str) -> T.DataType | None:
            try:
                return df.alias(parent).select(F.expr(text).alias("x")).schema["x"].dataType
            except PySparkException:     # a column that only the other table has
                return None

        for text in (_resolve(t, aliases) for t in wheres(parent)):
            if type_in(spans, text) is None:
                return None
            spans = spans.alias(parent).filter(F.expr(text))
        rising, stepped = None, []     # columns of both tables: the one that grows with the day, and those computed from it
        whole = spans                  # what is the same on all days of a stretch
        for r in self._rows("column_mappings", parent):
            column, text = r["column_name"], _resolve(str(r.get("source_expression") or r["column_name"]), aliases)
            if str(r.get("transformation_type", "")).lower() not in ("medium", "complex"):
                continue
            if column.lower() in [c.lower() for c in whole.columns + cal.columns] or rising and column.lower() == rising[0].lower():
                return None
            with_rising = whole.withColumn(rising[0], F.lit(None).cast(rising[2])) if rising else whole
            if type_in(whole, text) and not stepped:
                spans = spans.alias(parent).withColumn(column, F.expr(text))
                whole = spans
            elif type_in(cal, text):
                cal = cal.alias(parent).withColumn(column, F.expr(text))
            elif steps and steps[0]["column_name"] == column:
                kind = type_in(whole.withColumn(date, F.lit(None).cast("date")), text)
                if not isinstance(kind, T.IntegralType) or stepped:
                    return None
                rising = (column, text, kind)
            elif rising and type_in(with_rising, text):
                stepped.append((column, text))
                whole = whole.withColumn(column, F.lit(None).cast(type_in(with_rising, text)))
            else:
                return None
        of_span, of_day, measures, dims = [], [], {}, []
        for r in self._rows("column_mappings", name):
            kind, column = str(r.get("transformation_type", "")).lower(), r["column_name"]
            text = str(r.get("source_expression") or column).strip()
            if kind == "simple":
                side = of_span if type_in(whole, text) else of_day if type_in(cal, text) else None
                if side is None:
                    return None
                side.append((column, text))
                dims.append(column)
            elif kind in METRIC_TYPES:
                total = _SUM_OF.match(text)
                if not _COUNT_ALL.match(text) and not (total and isinstance(type_in(whole, total["of"]), (T.IntegralType, T.DecimalType))):
                    return None
                measures[column] = None if total is None else total["of"]
            else:
                return None
        if not measures:
            return None
        kinds = whole.alias(parent).agg(*[metric_expr("count(*)" if of is None else f"sum({of})", c) for c, of in measures.items()]).schema
        rise = F.expr(rising[1]) if rising else None
        spans = split_at_steps(spans.alias(parent), cal, s, e, rise, steps[0]["steps"] if rising else (), date)
        for column, text in ([rising[:2]] if rising else []) + stepped:
            spans = spans.alias(parent).withColumn(column, F.expr(text))
        sums = list(dict.fromkeys(of for of in measures.values() if of is not None))
        spans = spans.alias(parent).select(F.col(date).alias("__first"), F.col("__last"), *[F.expr(t).alias(f"__k{i}") for i, (_, t) in enumerate(of_span)],
                                           *[F.expr(of).alias(f"__v{i}") for i, of in enumerate(sums)])
        days = cal.alias(parent).select(F.col(date).alias("__first"), *[F.expr(t).alias(f"__d{i}") for i, (_, t) in enumerate(of_day)])
        totals = day_totals(spans, days, [f"__k{i}" for i in range(len(of_span))], {f"__t{i}": F.col(f"__v{i}") for i in range(len(sums))}, "__first")
        keys = [F.col(f"__{x}{i}").alias(c) for x, side in (("k", of_span), ("d", of_day)) for i, (c, _) in enumerate(side)]
        return totals.groupBy(*keys).agg(*[
            F.coalesce(F.sum("__n" if of is None else f"__t{sums.index(of)}"), F.lit(0)).cast(kinds[c].dataType).alias(c)
            for c, of in measures.items()]).select(*dims, *measures)

    def _transform(self, df: DataFrame, name: str, parent, aliases: Mapping[str, Mapping[str, str]]) -> DataFrame:
        alias = str(parent).strip() if parent else name

        def resolved(rule, field):
            return {**rule, field: _resolve(str(rule[field]), aliases)} if rule.get(field) else rule
        df = rule_filter(df.alias(alias), [resolved(r, "filter_expression") for r in self._rows("filter_logic", name)])
        cols = [resolved(r, "source_expression") for r in self._rows("column_mappings", name)]
        needs_agg = any(True for _ in self._rows("aggregation_rules", name))
        for r in cols:
            t = str(r.get("transformation_type", "")).lower()
            if t in ("medium", "complex") and (needs_agg is False or r["column_name"] not in df.columns):
                df = df.withColumn(r["column_name"], F.expr(str(r["source_expression"])))
        if not needs_agg:
            return df
        df = df.alias(alias)
        group_rules = []
        for r in cols:
            t = str(r.get("transformation_type", "")).lower()
            if t in ("medium", "complex"):
                group_rules.append({**r, "transformation_type": "simple", "source_expression": r["column_name"]})
            elif t in DIMENSION_TYPES or t.endswith("aggregation"):
                group_rules.append(r)
        return group_by_rules(df, group_rules)


def reconcile_rebuild(spark, rebuilder: Rebuilder, target: DataFrame, keys: list[str], metrics: list[str],
                      tol: float = 0.01, name: str = "final_select") -> DataFrame:
    """R14 end to end: rebuild ``name`` and reconcile it against ``target``.

    If the rules cannot be built or analysed (a missing column, a bad
    expression), every metric becomes a failed result row carrying the error
    (S23) instead of aborting the run.
    """
    from ledgermatch.plans.compare import reconcile_metrics
    from ledgermatch.sources.catalog import small_frame

    try:
        built = rebuilder.build(name)
        shared = [k for k in keys if k in built.columns and k in target.columns]
        out = reconcile_metrics(built, target, shared, metrics, tol)
        out.schema  # force analysis here, where the error can still be reported per metric
        return out
    except (PySparkException, RuleError) as exc:
        msg = f"Failed to rebuild {name}: {exc}"
        return small_frame(spark, [("aggregation", m, False, None, None, None, None, None, msg) for m in metrics],
                           "validation_type string, check_name string, passed boolean, total_rows bigint, "
                           "mismatched_rows bigint, max_delta double, only_in_source bigint, only_in_cdl bigint, "
                           "error_message string")
