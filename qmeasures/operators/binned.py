"""Interval joins on (key, time bin), so one key's rows spread over many tasks.

Days fall into bins of ``width`` days.  A window takes one row for each bin it touches, an
event lies in exactly one, and the two meet by equality on key and bin; the exact dates
are tested within the join.  Before the join events shrink to one row per key and day and
windows to the distinct ones, so a key that repeats costs its calendar, not its rows.

Rows with a NULL key or date, and windows that end before they start, meet nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

WIDTH = 32
BIN = "_bin"


def day_bin(day: str | Column, width: int = WIDTH) -> Column:
    day = F.col(day) if isinstance(day, str) else day
    return F.floor(F.unix_date(day) / F.lit(width))


def bin_windows(windows: DataFrame, start: str, end: str, width: int = WIDTH) -> DataFrame:
    """``windows`` with one row for each bin that ``[start, end]`` touches."""
    return (windows.filter(F.col(start) <= F.col(end))
            .withColumn(BIN, F.explode(F.sequence(day_bin(start, width), day_bin(end, width)))))


def events_in_windows(events: DataFrame, windows: DataFrame, key: str, day: str, start: str, end: str,
                      maxes: Sequence[str] = (), sums: Sequence[str] = (), width: int = WIDTH) -> DataFrame:
    """``key, start, end`` of every distinct window with an event inside, ``[start, end]`` inclusive.

    ``maxes`` and ``sums`` name event columns to fold over those events.
    """
    daily = (events.groupBy(key, day)
             .agg(F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in maxes], *[F.sum(c).alias(c) for c in sums])
             .withColumn(BIN, day_bin(day, width)))
    binned = bin_windows(windows.select(key, start, end).distinct(), start, end, width)
    return (binned.join(daily, [key, BIN])
            .filter(F.col(day).between(F.col(start), F.col(end)))
            .groupBy(key, start, end)
            .agg(F.sum("_n").alias("events"), *[F.max(c).alias(c) for c in maxes], *[F.sum(c).alias(c) for c in sums]))


def latest_window_at(events: DataFrame, windows: DataFrame, key: str, day: str, start: str, end: str,
                     carry: Sequence[str] = (), width: int = WIDTH) -> DataFrame:
    """Per distinct ``key, day`` the window open on that day that starts last.

    Ties take the greater ``end``, then the greater ``carry`` columns.  Days without an open
    window give no row.  Output: ``key, day, start, end, *carry``.
    """
    columns = [start, end, *carry]
    days = events.select(key, day).distinct().withColumn(BIN, day_bin(day, width))
    binned = bin_windows(windows.select(key, *columns).distinct(), start, end, width)
    return (days.join(binned, [key, BIN])
            .filter(F.col(day).between(F.col(start), F.col(end)))
            .groupBy(key, day).agg(F.max(F.struct(*columns)).alias("_w"))
            .select(key, day, *[F.col("_w")[c].alias(c) for c in columns]))


def overlapping_pairs(left: DataFrame, right: DataFrame, key: str, left_span: tuple[str, str],
                      right_span: tuple[str, str], width: int = WIDTH) -> DataFrame:
    """All pairs of one key whose inclusive spans overlap, each pair once.

    Two spans may share several bins; the pair counts in the bin where the later one starts.
    """
    (ls, le), (rs, re) = left_span, right_span
    return (bin_windows(left, ls, le, width).join(bin_windows(right, rs, re, width), [key, BIN])
            .filter((F.col(ls) <= F.col(re)) & (F.col(rs) <= F.col(le))
                    & (F.col(BIN) == day_bin(F.greatest(ls, rs), width)))
            .drop(BIN))
