"""Empirical eligibility end (A6): the last enrollment end shared by enough members."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from qmeasures.functions.dates import D


def elig_end_frequency(spans: DataFrame, end_col: str = "date_end") -> DataFrame:
    """``elig_date_end, memcnt``: how many members have their last span end on each date."""
    last = spans.groupBy("member_id").agg(F.max(end_col).alias("elig_date_end"))
    return last.groupBy("elig_date_end").agg(F.count(F.lit(1)).alias("memcnt"))


def empirical_elig_end(spans: DataFrame, measure_end: dt.date, min_member_count: int = 42,
                       override: dt.date | None = None) -> Column:
    """The latest end date shared by ``>= min_member_count`` members, capped at ``measure_end``.

    With no qualifying date the measure end is used.  ``override`` (a fixed date from
    the run parameters) skips the data pass but is still capped.  The result is a scalar
    subquery: it is evaluated within the job that uses it, and planning runs no job.
    """
    if override is not None:
        return D(min(override, measure_end))
    found = (elig_end_frequency(spans)
             .filter(F.col("memcnt") >= min_member_count)
             .agg(F.max("elig_date_end").alias("d")).scalar())
    return F.coalesce(F.least(found, D(measure_end)), D(measure_end))
