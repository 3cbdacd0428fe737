"""Column-level rules of the silver and gold layers.

Each function returns a ``Column`` built from Spark built-ins; none evaluates
Python per row.  Arguments accept a column name or a ``Column``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for the same results.
ABSENT_STATUSES = ("Absent", "Leave")
EXCESS_HOURS_LIMIT = 14
MONEY_TYPE = "decimal(18,2)"
LABEL_ABSENT_HAS_TIMES = "warn:absent_has_times"
LABEL_EXCESS_HOURS = "warn:excess_hours"
LABEL_PROCESSED_EARLY = "warn:processed_before_period_end"
LABEL_NEGATIVE_HOURS = "warn:negative_hours"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed_timestamp(value, ts_type: str = "timestamp_ntz") -> Column:
    """A timestamp literal that does not depend on the Python or session time zone.

    ``value`` is an ISO string, a ``datetime`` or a ``date``; it is rendered as
    text and cast, so ``2026-05-21 00:00:00`` means that wall-clock time.
    """
    if isinstance(value, Column):
        return value.cast(ts_type)
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat() + " 00:00:00"
    return F.lit(str(value)).cast(ts_type)


def work_hours(check_in: str | Column, check_out: str | Column) -> Column:
    """Hours between two timestamps from whole epoch seconds.

    NULL when either side is NULL; negative when check-out precedes check-in
    (an overnight shift on one date), as in the reference.
    """
    return (F.unix_timestamp(as_column(check_out)) - F.unix_timestamp(as_column(check_in))) / F.lit(3600.0)


def flag(condition: Column, label: str) -> Column:
    """``label`` when ``condition`` is true, else NULL.  The row is always kept."""
    return F.when(condition, F.lit(label)).otherwise(F.lit(None).cast("string"))


def absent_with_times(
    status: str | Column, check_in: str | Column, statuses: Sequence[str] = ABSENT_STATUSES
) -> Column:
    """Status says the person was away, yet a check-in time is present."""
    return as_column(status).isin(list(statuses)) & as_column(check_in).isNotNull()


def excess_hours(hours: str | Column, limit: float = EXCESS_HOURS_LIMIT) -> Column:
    """Strictly more than ``limit`` hours."""
    return as_column(hours) > F.lit(limit)


def net_pay_corrected(
    basic: str | Column, bonus: str | Column, deduction: str | Column, money_type: str = MONEY_TYPE
) -> Column:
    """basic + bonus - deduction, cast back to the money type; NULL if any part is NULL."""
    return (
        as_column(basic).cast(money_type) + as_column(bonus).cast(money_type) - as_column(deduction).cast(money_type)
    ).cast(money_type)


def net_pay_variance(raw: str | Column, corrected: str | Column) -> Column:
    """raw - corrected; Spark widens decimal(18,2) - decimal(18,2) to decimal(19,2)."""
    return as_column(raw) - as_column(corrected)


def days_after_period_end(processed: str | Column, period: str | Column) -> Column:
    """Days from the last day of the pay period to the processing date (negative = early)."""
    return F.datediff(F.to_date(as_column(processed)), F.last_day(as_column(period)))


def month_start(d: str | Column) -> Column:
    """First day of the month of a date or timestamp, as a date."""
    return F.trunc(F.to_date(as_column(d)), "month")


def month_label(d: str | Column) -> Column:
    """``yyyy-MM`` text of a date or timestamp."""
    return F.date_format(as_column(d), "yyyy-MM")


def month_index(d: str | Column) -> Column:
    """Months since year 0: year * 12 + month - 1 (integer, orderable)."""
    c = as_column(d)
    return F.year(c) * 12 + F.month(c) - 1


def month_label_from_index(idx: str | Column) -> Column:
    c = as_column(idx)
    return F.format_string("%04d-%02d", F.floor(c / 12).cast("int"), (c % 12 + 1).cast("int"))


def month_end_midnight(label: str | Column) -> Column:
    """Last day of a ``yyyy-MM`` month as a date; compared with a timestamp it means midnight."""
    return F.last_day(F.to_date(F.concat(as_column(label), F.lit("-01"))))


def change_predicate(
    tracked: Iterable[str], left: str = "c", right: str = "s", null_safe: bool = False
) -> Column:
    """True when any tracked column differs between the two aliased sides.

    Parity mode ORs ``left.x <> right.x``: a NULL on either side is not a
    change.  ``null_safe`` uses ``NOT (left.x <=> right.x)`` so NULL <-> value
    counts as a change.  The result is never NULL.
    """
    parts = []
    for c in tracked:
        lc, rc = F.col(f"{left}.{c}"), F.col(f"{right}.{c}")
        parts.append(~lc.eqNullSafe(rc) if null_safe else (lc != rc))
    if not parts:
        return F.lit(False)
    out = parts[0]
    for p in parts[1:]:
        out = out | p
    return F.coalesce(out, F.lit(False))
