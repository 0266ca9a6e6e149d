"""Month arithmetic as Column expressions (all JVM-side, codegen friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(as_of: str | _dt.date | None) -> Column:
    """Run date as a Column: a literal date, or ``current_date()`` when None."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def month_key(d: Column) -> Column:
    """'YYYY-MM' of a date (F1)."""
    return F.date_format(d, "yyyy-MM")


def month_start(d: Column) -> Column:
    """First day of the month (F2)."""
    return F.trunc(d, "month")


def months_back(d: Column, n: int) -> Column:
    """Month start of ``d`` minus ``n`` months."""
    return F.trunc(F.add_months(d, -n), "month")


def month_index(month_yyyy_mm: Column) -> Column:
    """Absolute month number year*12 + month of a 'YYYY-MM' string."""
    return (F.substring(month_yyyy_mm, 1, 4).cast("int") * 12
            + F.substring(month_yyyy_mm, 6, 2).cast("int"))


def month_diff(later: Column, earlier: Column) -> Column:
    """Whole months between two 'YYYY-MM' strings, same month = 0."""
    return month_index(later) - month_index(earlier)


def month_to_date(month_yyyy_mm: Column) -> Column:
    """'YYYY-MM' -> month-start date."""
    return F.to_date(F.concat(month_yyyy_mm, F.lit("-01")))


def month_last_day(month_yyyy_mm: Column) -> Column:
    """'YYYY-MM' -> last day of that month (F8)."""
    return F.last_day(month_to_date(month_yyyy_mm))


def last_closed_month(as_of: str | _dt.date | None) -> Column:
    """'YYYY-MM' of the month before the run date."""
    return month_key(F.add_months(as_date(as_of), -1))


def month_sequence(first: Column, last: Column) -> Column:
    """Array of month-start dates from ``first`` to ``last`` inclusive."""
    return F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))
