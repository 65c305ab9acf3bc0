"""Grouped aggregation driven by rules or metric specs.

Rule and spec texts are Spark SQL aggregate expressions handed to
``F.expr``; Spark resolves them (case-insensitively) against the input, so
there is no expression parser here.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIMENSION_TYPES = ("simple", "medium", "complex")
METRIC_TYPES = ("aggregation", "complex_aggregation")


def metric_expr(text: str, name: str) -> Column:
    """An aggregate rule as a column; each SUM over no rows or only nulls reads
    0 (A11, S7), also inside a larger expression such as ``sum(a) + sum(b)``."""
    return F.expr(_zero_sums(text)).alias(name)


def _zero_sums(text: str) -> str:
    """``text`` with every ``sum(...)`` outside quotes wrapped in coalesce(..., 0)."""
    out, at = [], 0
    while m := _SUM.search(text, at):
        out.append(text[at:m.start()])
        at = m.end()
        if not m["sum"]:
            out.append(m.group())
            continue
        end = _closing(text, at)
        inner = _zero_sums(text[at:end - 1])
        at = end
        while tail := _TAIL.match(text, at):     # sum(x) FILTER (WHERE ...), OVER (...)
            at = _closing(text, tail.end())
        out.append(f"coalesce({m['sum']}{inner}){text[end:at]}, 0)")
    return "".join(out) + text[at:]


def _closing(text: str, at: int) -> int:
    """Position after the bracket that closes the one opened before ``at``."""
    depth = 1
    while at < len(text) and depth:
        q = _QUOTED.match(text, at)
        depth += 0 if q else {"(": 1, ")": -1}.get(text[at], 0)
        at = q.end() if q else at + 1
    return at


_QUOTED = re.compile(r"'(?:[^'\\]|\\.)*'|`[^`]*`|\"[^\"]*\"")
_TAIL = re.compile(r"\s*(?:filter|over)\s*\(", re.I)
_SUM = re.compile(_QUOTED.pattern + r"|(?P<sum>\bsum\s*\()", re.I)


def group_by_rules(df: DataFrame, column_rules: Iterable[Mapping]) -> DataFrame:
    """A10: dimensions are the simple/medium/complex rules, metrics the aggregation rules.

    Dimension rules are grouping expressions (``alias.col`` or any SQL); with
    no metric rule the result is the distinct dimension rows (A13).
    """
    dims, metrics = [], []
    for r in column_rules:
        t = str(r.get("transformation_type", "")).lower()
        name, src = r["column_name"], r.get("source_expression") or r["column_name"]
        if t in DIMENSION_TYPES:
            dims.append(F.expr(str(src)).alias(name))
        elif t in METRIC_TYPES:
            metrics.append(metric_expr(str(src), name))
    if not metrics:
        return df.select(*dims).distinct()
    return df.groupBy(*dims).agg(*metrics)


def metric_spec_agg(df: DataFrame, dimensions: list[str], metrics: Mapping[str, str]) -> DataFrame:
    """``dimensions`` x {name: 'COUNT(*)' | 'SUM(col)' | 'COUNT(DISTINCT col)' ...}.

    Only dimensions present in the table are used (the spec is shared by both
    sides of a comparison); a metric whose input is missing fails analysis.
    """
    dims = [d for d in dimensions if d in df.columns]
    return df.groupBy(*dims).agg(*[metric_expr(e, n) for n, e in metrics.items()])


def conditional_sums(df: DataFrame, keys: list[str], value: str,
                     conditions: Mapping[str, str]) -> DataFrame:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)`` per named condition."""
    return df.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.expr(c), F.col(value)).otherwise(F.lit(0))), F.lit(0)).cast("bigint").alias(n)
        for n, c in conditions.items()])
