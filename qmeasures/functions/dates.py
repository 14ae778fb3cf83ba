"""Date helpers: completed age, day/month shifts, literals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def D(value) -> Column:
    """A DATE literal from a ``datetime.date`` (or a Column passed through)."""
    if isinstance(value, Column):
        return value
    if value is None:
        return F.lit(None).cast("date")
    return F.lit(value).cast("date") if isinstance(value, dt.date) else F.to_date(F.lit(value))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else D(x)


def age_years(dob, at) -> Column:
    """Completed years between ``dob`` and ``at`` (birthday reached counts as a year).

    Exact for month-end births, unlike ``months_between``.
    """
    dob, at = _c(dob), _c(at)
    before_birthday = (F.date_format(at, "MMdd") < F.date_format(dob, "MMdd")).cast("int")
    return (F.year(at) - F.year(dob) - before_birthday).cast("int")


def in_range(x, lo, hi) -> Column:
    """Inclusive ``lo <= x <= hi`` that is never NULL (for projections)."""
    x = _c(x)
    return F.coalesce((x >= _c(lo)) & (x <= _c(hi)), F.lit(False))


def within(x, lo, hi) -> Column:
    """Inclusive ``lo <= x <= hi`` for filters: plain comparisons, so the range is pushed
    to the file scan (partition pruning / row-group statistics); NULL rows drop out."""
    x = _c(x)
    return (x >= _c(lo)) & (x <= _c(hi))


def shift_date(d: dt.date, days: int = 0, months: int = 0, years: int = 0) -> dt.date:
    """Driver-side constant folding of parameter dates (``same`` alignment)."""
    if months or years:
        total = d.month - 1 + months + 12 * years
        y, m = divmod(total, 12)
        y += d.year
        m += 1
        last = (dt.date(y + (m == 12), m % 12 + 1, 1) - dt.timedelta(days=1)).day
        d = dt.date(y, m, min(d.day, last))
    return d + dt.timedelta(days=days)
