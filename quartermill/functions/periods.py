"""Period labels and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_of_month(year: Column, month: Column) -> Column:
    """First day of (year, month); NULL when either part is missing or out of range."""
    ok = year.between(1, 9999) & month.between(1, 12)
    return F.when(ok, F.make_date(year, month, F.lit(1)))


def period_year_month(period: Column) -> Column:
    """``'YYYY.MM'`` to the first of that month; a bare year means December.

    The part after the point is a month number, so ``'1995.1'`` is January: the column has to be
    read as text, never as a number.
    """
    parts = F.split(F.trim(period), r"\.")
    year = parts.getItem(0).try_cast("int")
    month = F.when(F.size(parts) > 1, F.get(parts, F.lit(1)).try_cast("int")).otherwise(F.lit(12))
    return first_of_month(year, month)


def period_mixed(period: Column) -> Column:
    """Decimal ``1995.09`` (hundredths are the month) or ``'2023 Q3'`` (quarter's last month).

    Read as a number, ``1995.1`` is October, unlike :func:`period_year_month`.
    """
    number = F.trim(period).try_cast("double")
    year = F.floor(number).cast("int")
    from_number = first_of_month(year, F.round((number - year) * 100).cast("int"))
    pattern = r"^\s*(\d{4})\s+Q([1-4])"
    q_year = F.regexp_extract(period, pattern, 1).try_cast("int")
    q_no = F.regexp_extract(period, pattern, 2).try_cast("int")
    return F.coalesce(from_number, first_of_month(q_year, q_no * 3))


def quarter_label(date: Column) -> Column:
    """First day of the last month of the quarter holding ``date``."""
    return F.add_months(F.trunc(date, "quarter"), 2)


def month_label(date: Column) -> Column:
    return F.trunc(date, "month")
