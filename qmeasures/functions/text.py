"""Text formats used in member comments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def mmddyyyy(d) -> Column:
    """``MM/DD/YYYY`` rendering of a date."""
    d = F.col(d) if isinstance(d, str) else d
    return F.date_format(d, "MM/dd/yyyy")


def percent0(p) -> Column:
    """Whole percent with a ``%`` sign, half away from zero (0.125 -> ``13%``)."""
    p = F.col(p) if isinstance(p, str) else p
    return F.concat(F.round(p * 100, 0).cast("long").cast("string"), F.lit("%"))
