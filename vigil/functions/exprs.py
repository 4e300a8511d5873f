"""Small column helpers: time bounds, exact ratios, labels, masking, naming."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

# Run states counted as failures.
FAILED_STATES = ("FAILED", "TIMEDOUT", "CANCELED")

# Severities from most to least urgent.
SEVERITIES = ("critical", "high", "medium", "low")


def ts_lit(moment: datetime) -> Column:
    """Zone-less timestamp literal; folds, so comparisons with it reach the scan."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def day_lit(day: date) -> Column:
    return F.lit(day.isoformat()).cast("date")


def as_day(as_of: date | datetime) -> date:
    return as_of.date() if isinstance(as_of, datetime) else as_of


def since(ts: str, as_of: datetime, *, days: int = 0, hours: int = 0) -> Column:
    """Rows of a timestamp column inside the lookback that ends at ``as_of``."""
    start = as_of - timedelta(days=days, hours=hours)
    return (F.col(ts) >= ts_lit(start)) & (F.col(ts) <= ts_lit(as_of))


def since_day(day: str, as_of: date | datetime, days: int) -> Column:
    """Rows of a date column inside the lookback that ends on the day of ``as_of``."""
    end = as_day(as_of)
    return (F.col(day) >= day_lit(end - timedelta(days=days))) & (F.col(day) <= day_lit(end))


def on_day(ts: str, day: date) -> Column:
    """Timestamp falls on ``day``, as a half-open range so that the scan can prune."""
    start = datetime(day.year, day.month, day.day)
    return (F.col(ts) >= ts_lit(start)) & (F.col(ts) < ts_lit(start + timedelta(days=1)))


def month_start(as_of: date | datetime) -> date:
    return as_day(as_of).replace(day=1)


def money(col: Column | str, scale: int = 2) -> Column:
    """Exact decimal, so that sums do not depend on row order."""
    return (F.col(col) if isinstance(col, str) else col).cast(f"decimal(18,{scale})")


def ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """Exact quotient rounded half up; NULL when the divisor is 0."""
    return F.round(F.try_divide(num.cast("decimal(38,6)"), den.cast("decimal(20,4)")), digits).cast(
        "double"
    )


def percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole`` with two digits; NULL when nothing was counted."""
    return ratio(part.cast("decimal(28,4)") * F.lit(100), whole)


def mean(total: Column, n: Column) -> Column:
    """Average from an exact sum and a count."""
    return F.try_divide(total.cast("double"), n.cast("double"))


def holds(condition: str | Column) -> Column:
    """A rule holds only when its predicate is true: NULL counts as a violation."""
    predicate = F.expr(condition) if isinstance(condition, str) else condition
    return F.coalesce(predicate, F.lit(False))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_timestamp(end) - F.unix_timestamp(start)


def hours_since(ts: Column | str, as_of: datetime) -> Column:
    """Whole elapsed hours from ``ts`` to ``as_of``."""
    return F.timestamp_diff("HOUR", ts if isinstance(ts, Column) else F.col(ts), ts_lit(as_of))


def is_failure(state: str = "result_state") -> Column:
    return F.col(state).isin(*FAILED_STATES)


def severity_rank(col: str = "severity") -> Column:
    """1 for the most urgent severity; unknown names sort last."""
    rank = F.lit(len(SEVERITIES) + 1)
    for position, name in reversed(list(enumerate(SEVERITIES, start=1))):
        rank = F.when(F.col(col) == name, F.lit(position)).otherwise(rank)
    return rank


def email_domain(col: str = "email") -> Column:
    return F.get(F.split(F.col(col), "@"), 1)


def name_part(full_name: Column | str, index: int) -> Column:
    """Part of a dotted table name (0 catalog, 1 schema, 2 table), NULL when missing."""
    col = F.col(full_name) if isinstance(full_name, str) else full_name
    return F.get(F.split(col, r"\."), index)


def safe_name(col: Column | str) -> Column:
    """Keep letters, digits and underscores of a name; the rest becomes ``_``."""
    return F.regexp_replace(col, "[^A-Za-z0-9_]", "_")


def preview(col: str, chars: int) -> Column:
    return F.substring(col, 1, chars)


def masked(col: str) -> Column:
    """Show the shape of a personal value, not its characters."""
    return F.mask(F.col(col))


def pseudonym(col: str) -> Column:
    """Stable digest of a personal value, usable as a join key."""
    return F.sha2(F.col(col), 256)
