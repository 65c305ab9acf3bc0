"""Row filters (PF1-PF13). All are plain predicates, so Catalyst pushes the
date bounds into the Parquet scan (``PushedFilters``)."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgermatch.functions.scalars import EXCLUDED_CODES, col_of, concat_codes

DateLike = _dt.date | str | None


def _date(v: DateLike) -> Column | None:
    if v is None:
        return None
    return F.lit(v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v)))


def window_predicate(col, start: DateLike = None, end: DateLike = None) -> Column | None:
    """``start <= col <= end``; either end may be omitted (PF3/PF4)."""
    c = col_of(col)
    preds = []
    if start is not None:
        preds.append(c >= _date(start))
    if end is not None:
        preds.append(c <= _date(end))
    if not preds:
        return None
    out = preds[0]
    for p in preds[1:]:
        out = out & p
    return out


def date_window(df: DataFrame, col: str, start: DateLike = None, end: DateLike = None) -> DataFrame:
    """Filter a table to a date window before any query runs on it (PF5).

    On a timestamp column the end day counts to its last instant.
    """
    if start is None and end is None:
        return df
    if isinstance(df.schema[col].dataType, (T.TimestampType, T.TimestampNTZType)):
        lo, hi = _day_bounds(df, col, start or end, end or start)
        preds = [p for p, given in ((lo, start), (hi, end)) if given is not None]
        for p in preds:
            df = df.filter(p)
        return df
    return df.filter(window_predicate(col, start, end))


def _day_bounds(df: DataFrame, col: str, lo: DateLike, hi: DateLike):
    """Predicates ``to_date(col) >= lo`` and ``to_date(col) <= hi`` in a form
    the Parquet reader can push down: on a timestamp column they compare the
    raw column with midnight bounds (``col >= lo``, ``col < hi + 1 day``)."""
    c = F.col(col)
    typ = df.schema[col].dataType
    if isinstance(typ, (T.TimestampType, T.TimestampNTZType)):
        tname = "timestamp_ntz" if isinstance(typ, T.TimestampNTZType) else "timestamp"
        lo_d = lo if isinstance(lo, _dt.date) else _dt.date.fromisoformat(str(lo))
        hi_d = hi if isinstance(hi, _dt.date) else _dt.date.fromisoformat(str(hi))
        # string -> timestamp casts read the wall clock in the session time zone,
        # exactly as to_date() does, so both forms agree in every zone
        lo_ts = F.lit(f"{lo_d.isoformat()} 00:00:00").cast(tname)
        hi_ts = F.lit(f"{(hi_d + _dt.timedelta(days=1)).isoformat()} 00:00:00").cast(tname)
        return c >= lo_ts, c < hi_ts
    d = F.to_date(c)
    return d >= _date(lo), d <= _date(hi)


def interval_touching(df: DataFrame, start_col: str, end_col: str, lo: DateLike, hi: DateLike) -> DataFrame:
    """Start date in the window OR end date in the window (the reference's test).

    Misses intervals that span the whole window; kept for parity (S9).
    """
    s_ge, s_le = _day_bounds(df, start_col, lo, hi)
    e_ge, e_le = _day_bounds(df, end_col, lo, hi)
    return df.filter((s_ge & s_le) | (e_ge & e_le))


def interval_overlap(df: DataFrame, start_col: str, end_col: str, lo: DateLike, hi: DateLike) -> DataFrame:
    """True overlap ``start <= hi AND end >= lo``; a null end is open."""
    _, s_le = _day_bounds(df, start_col, lo, hi)
    e_ge, _ = _day_bounds(df, end_col, lo, hi)
    return df.filter(s_le & (F.col(end_col).isNull() | e_ge))


def rule_filter(df: DataFrame, rules: Iterable[Mapping], cte: str | None = None) -> DataFrame:
    """Apply rule-table WHERE filters (PF7).

    Only rules of ``filter_type == 'WHERE'`` with a non-empty expression apply;
    each expression is Spark SQL, folded with AND. Rule tables are small
    configuration (tens of rows) handed in as dicts.
    """
    for r in rules:
        if cte is not None and r.get("cte_name") != cte:
            continue
        if str(r.get("filter_type", "")).upper() != "WHERE":
            continue
        expr = r.get("filter_expression")
        if expr is None or not str(expr).strip():
            continue
        df = df.filter(F.expr(str(expr)))
    return df


def exclude_codes(df: DataFrame, cols=("dw_source_system_code", "dw_billing_system_code"),
                  codes=tuple(EXCLUDED_CODES)) -> DataFrame:
    """Drop rows whose concatenated codes are in the excluded set (PF8).

    Null codes read as '' so a null never silently removes or keeps a row.
    """
    return df.filter(~concat_codes(*cols).isin(list(codes)))
