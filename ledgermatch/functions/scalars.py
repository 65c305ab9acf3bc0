"""Scalar column expressions. All are native Catalyst expressions (no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "day_of_week", "sunday_flag", "tenure_days", "tenure_step", "steps_reached", "tenure_group",
    "tenure_group_finance", "fiscal_year", "fiscal_month", "fiscal_week",
    "week_ending_saturday", "percent_diff", "abs_diff", "within_tolerance",
    "exceeds_abs_rel", "concat_codes", "lenient_timestamp", "lenient_number",
    "TENURE_GROUPS", "TENURE_GROUPS_FINANCE", "TENURE_STEPS", "EXCLUDED_CODES",
]

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# Tenure bucket labels (right-closed day bins 0/180/360/540/720; CHECK below):
TENURE_GROUPS = ["0-180", "181-360", "361-540", "541-720", "721+"]
# Finance tenure labels (bins at 182 days, 365 days, then whole years to 7),
# followed by the day-range labels the domain check also accepts:
TENURE_GROUPS_FINANCE = [
    "0-6months", "6-12months", "1-2years", "2-3years", "3-4years",
    "4-5years", "5-6years", "6-7years", "7years+",
    "0-182 days", "183-365 days", "366-730 days", "730+ days",
]
# Source+billing code pairs removed by the exclusion filter:
EXCLUDED_CODES = ["THINKSWG", "THINKGPLA"]
# ---------------------------------------------------------------------------

MICROS_PER_DAY = 86_400_000_000


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of_week(d) -> Column:
    """1 = Sunday ... 7 = Saturday (same numbering as the reference)."""
    return F.dayofweek(col_of(d))


def sunday_flag(d) -> Column:
    return F.when(F.dayofweek(col_of(d)) == 1, F.lit("Y")).otherwise(F.lit("N"))


def tenure_days(report_date, tenure_start) -> Column:
    """Whole days, floor of the exact time difference.

    18:00 to the next midnight is 0 days, to the previous midnight -1.
    Works on DATE, TIMESTAMP and TIMESTAMP_NTZ inputs alike.
    """
    a = col_of(report_date).cast("timestamp_ntz")
    b = col_of(tenure_start).cast("timestamp_ntz")
    micros = F.timestamp_diff("MICROSECOND", b, a)
    # From a midnight on, whole days are calendar days, which cost far less.
    return (F.when(b == F.to_date(b).cast("timestamp_ntz"), F.datediff(col_of(report_date), b))
            .otherwise(F.floor(micros / F.lit(MICROS_PER_DAY)))).cast("bigint")


# First day of each bucket of the two functions below.
TENURE_STEPS = [0, 1, 181, 361, 541, 721, 183] + [365 * years + 1 for years in range(1, 8)]


def steps_reached(value, steps) -> Column:
    """How many of the rising ``steps`` are at or below ``value``; 0 for null."""
    v, reached = col_of(value), F
    for n in range(len(steps), 0, -1):
        reached = reached.when(v >= steps[n - 1], n)
    return reached.otherwise(0)


def tenure_step(days) -> Column:
    """The last of ``TENURE_STEPS`` at or below; -1 below the first and for null.

    One small number for both buckets: ``tenure_group`` and
    ``tenure_group_finance`` of it are those of ``days``, and two steps never
    share both.
    """
    d, step = col_of(days), F
    for first in sorted(TENURE_STEPS, reverse=True):
        step = step.when(d >= first, first)
    return step.otherwise(-1)


def tenure_group(days) -> Column:
    """Right-closed bins; 0 and below, and null, are CHECK (S3)."""
    d = col_of(days)
    return (F.when(d.isNull() | (d <= 0), "CHECK")
            .when(d <= 180, TENURE_GROUPS[0])
            .when(d <= 360, TENURE_GROUPS[1])
            .when(d <= 540, TENURE_GROUPS[2])
            .when(d <= 720, TENURE_GROUPS[3])
            .otherwise(TENURE_GROUPS[4]))


def tenure_group_finance(days) -> Column:
    """0 falls into the first bucket; negative or null is CHECK."""
    d = col_of(days)
    expr = F.when(d.isNull() | (d < 0), "CHECK").when(d <= 182, TENURE_GROUPS_FINANCE[0])
    expr = expr.when(d <= 365, TENURE_GROUPS_FINANCE[1])
    for years in range(2, 8):
        expr = expr.when(d <= 365 * years, TENURE_GROUPS_FINANCE[years])
    return expr.otherwise(TENURE_GROUPS_FINANCE[8])


def fiscal_year(d) -> Column:
    """July-June fiscal year, named by the calendar year it ends in."""
    d = col_of(d)
    return (F.year(d) + F.when(F.month(d) >= 7, 1).otherwise(0)).cast("int")


def fiscal_month(d) -> Column:
    d = col_of(d)
    return F.when(F.month(d) >= 7, F.month(d) - 6).otherwise(F.month(d) + 6).cast("int")


def fiscal_week(d) -> Column:
    d = col_of(d)
    start = F.make_date(fiscal_year(d) - 1, F.lit(7), F.lit(1))
    return (F.floor(F.datediff(d, start) / 7) + 1).cast("int")


def week_ending_saturday(d) -> Column:
    d = col_of(d)
    return F.date_add(d, (F.lit(7) - F.dayofweek(d)).cast("int"))


def abs_diff(a, b) -> Column:
    return F.abs(col_of(a) - col_of(b))


def percent_diff(new, old) -> Column:
    """abs(new - old) / max(new, 1) * 100 (divides by the new side only, S21)."""
    return abs_diff(new, old).cast("double") / F.greatest(col_of(new), F.lit(1)) * 100


def within_tolerance(a, b, tol: float) -> Column:
    """Both null = match; one-sided null = mismatch (S4); else |a-b| <= tol."""
    a, b = col_of(a), col_of(b)
    return (F.when(a.isNull() & b.isNull(), F.lit(True))
            .when(a.isNull() | b.isNull(), F.lit(False))
            .otherwise(F.abs(a - b) <= F.lit(tol)))


def exceeds_abs_rel(new, old, abs_tol: float, rel_tol: float) -> Column:
    """Mismatch only when both the absolute and the relative tolerance are exceeded."""
    new, old = col_of(new), col_of(old)
    d = F.abs(new - old)
    return (d > F.lit(abs_tol)) & (d / F.greatest(F.abs(old), F.lit(1)) > F.lit(rel_tol))


def concat_codes(*cols) -> Column:
    """Concatenate codes with null read as '' (S11)."""
    return F.concat(*[F.coalesce(col_of(c).cast("string"), F.lit("")) for c in cols])


def lenient_timestamp(c, fmt: str | None = None) -> Column:
    """Unparseable text becomes null instead of failing the job (ANSI-safe)."""
    c = col_of(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def lenient_number(c, to: str = "double") -> Column:
    return col_of(c).try_cast(to)
