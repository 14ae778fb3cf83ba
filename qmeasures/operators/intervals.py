"""Interval operators over enrollment spans and claim dates.

* :func:`eligibility_gaps`  – uncovered runs and days inside a window (W1).
* :func:`contiguous_runs`   – run ids over ordered spans: adjacent spans continue a run,
  anything else starts a new one (coverage islands W2, enrollment segments W3,
  inpatient transfer chains W4).
* :func:`anchored_groups`   – groups that open at an anchor row and take every later row
  up to the first one beyond ``anchor + window`` (deliveries W5).

All spans are inclusive ``[start, end]`` DATE pairs.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from qmeasures.functions.dates import D
from qmeasures.operators.reuse import materialize


def _as_col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return D(x)


def eligibility_gaps(spans: DataFrame, keys, window_start, window_end,
                     global_end=None, span_start: str = "date_start",
                     span_end: str = "date_end") -> DataFrame:
    """Gap count and uncovered days per key group inside ``[window_start, window_end]``.

    ``window_start`` / ``window_end`` are dates, column names or Columns (constant within
    a key group); ``global_end`` further clips the window end.  Spans are clipped to the
    window, adjacent spans (next start = previous end + 1) are contiguous and overlaps
    merge.  Leading and trailing uncovered runs count.  A key group whose rows carry no
    span inside the window (e.g. NULL spans from an outer join) has one gap covering
    the whole window; an empty window (start after end) has no gap.

    Plan: clip -> ``groupBy(keys, start).max(end)`` (map-side combined, so one member's
    rows never travel as a whole and the rows per member are bounded by the window
    length) -> running ``max(end)`` of earlier starts -> ``groupBy(keys)``.
    Output: ``keys + [gap_cnt, gap_days]`` (bigint).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ws = _as_col(window_start)
    we = _as_col(window_end)
    if global_end is not None:
        we = F.least(we, _as_col(global_end))
    # greatest/least skip NULLs, so a missing span must be tested explicitly
    has_span = F.col(span_start).isNotNull() & F.col(span_end).isNotNull()
    cs = F.greatest(F.col(span_start), F.col("_ws"))
    ce = F.least(F.col(span_end), F.col("_we"))
    valid = has_span & (cs <= ce)
    clipped = (spans
               .select(*keys, ws.alias("_ws"), we.alias("_we"), span_start, span_end)
               .select(*keys, "_ws", "_we",
                       F.when(valid, cs).alias("_cs"),
                       F.when(valid, ce).alias("_ce")))
    starts = (clipped.groupBy(*keys, "_cs")
              .agg(F.max("_ce").alias("_ce"), F.min("_ws").alias("_ws"), F.min("_we").alias("_we")))
    w = Window.partitionBy(*keys).orderBy(F.col("_cs").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    prev_end = F.coalesce(F.max("_ce").over(w), F.date_sub(F.col("_ws"), 1))
    gap_before = F.when(F.col("_cs").isNotNull(),
                        F.greatest(F.lit(0), F.datediff(F.col("_cs"), prev_end) - 1)).otherwise(0)
    per_start = starts.select(*keys, "_ws", "_we", "_ce", gap_before.alias("_gap"))
    agg = per_start.groupBy(*keys).agg(
        F.sum(F.when(F.col("_gap") > 0, 1).otherwise(0)).alias("_n"),
        F.sum("_gap").alias("_d"),
        F.max("_ce").alias("_max_end"),
        F.min("_ws").alias("_ws"),
        F.min("_we").alias("_we"))
    tail = F.greatest(F.lit(0), F.datediff(F.col("_we"),
                                           F.coalesce(F.col("_max_end"), F.date_sub(F.col("_ws"), 1))))
    return agg.select(*keys,
                      (F.col("_n") + (tail > 0).cast("long")).cast("long").alias("gap_cnt"),
                      (F.col("_d") + tail).cast("long").alias("gap_days"))


def contiguous_runs(df: DataFrame, keys, start: str, end: str, order=None,
                    allow_overlap: bool = False, run_col: str = "run_id",
                    first_id: int = 1) -> DataFrame:
    """Number runs of rows ordered by ``order`` (default ``start, end``) within ``keys``.

    A row continues the run of the previous row when ``start - previous end == 1``
    (``allow_overlap=False``: overlaps and duplicates open a new run) or when
    ``start - previous end <= 1`` (``allow_overlap=True``).  The comparison is with the
    previous row's end, not a running maximum.  Run ids start at ``first_id``.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = order or [start, end]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c) if isinstance(c, str) else c for c in order])
    prev_end = F.lag(F.col(end)).over(w)
    step = F.datediff(F.col(start), prev_end)
    cont = (step <= 1) if allow_overlap else (step == 1)
    new_run = F.when(prev_end.isNull() | ~F.coalesce(cont, F.lit(False)), 1).otherwise(0)
    return (df.withColumn("_new", new_run)
            .withColumn(run_col, (F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
                                  + (first_id - 1)).cast("long"))
            .drop("_new"))


def coverage_islands(spans: DataFrame, keys, lo: dt.date | None, hi: dt.date | None,
                     start: str = "date_start", end: str = "date_end") -> DataFrame:
    """Contiguous coverage islands clipped to ``[lo, hi]`` with their day totals.

    ``lo`` / ``hi`` = None: no clipping on that side (enrollment segments).

    Spans overlapping the period are clipped; ordering uses the original span dates;
    a new island starts unless the clipped start is exactly one day after the previous
    clipped end (so overlaps and duplicates start new islands).  Returns
    ``keys + [island_id, island_start, island_end, days]``.

    Plan: identical spans are first counted per ``(keys, start, end)`` (map-side
    combined), so the ordered window sees at most one row per distinct span: bounded
    by the calendar, not by how many rows one member has.  ``k`` identical spans act
    as: the first may continue the previous island, copies 2..k each open an island
    (the last of which later spans may continue); the extra islands are generated
    from the count.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    inside = spans.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    if lo is not None:
        inside = inside.filter(F.col(end) >= D(lo))
    if hi is not None:
        inside = inside.filter(F.col(start) <= D(hi))
    pairs = (inside.groupBy(*keys, F.col(start).alias("_os"), F.col(end).alias("_oe"))
             .agg(F.count(F.lit(1)).alias("_k"))
             .withColumn("_cs", F.greatest(F.col("_os"), D(lo)) if lo is not None else F.col("_os"))
             .withColumn("_ce", F.least(F.col("_oe"), D(hi)) if hi is not None else F.col("_oe")))
    w = Window.partitionBy(*keys).orderBy("_os", "_oe")
    prev_ce = F.lag("_ce").over(w)
    new_first = F.when(prev_ce.isNull() | (F.datediff("_cs", prev_ce) != 1), 1).otherwise(0)
    opened = pairs.withColumn("_open", new_first + F.col("_k") - 1)
    last_id = F.sum("_open").over(w.rowsBetween(Window.unboundedPreceding, 0))
    ids = opened.withColumn("_last", last_id).withColumn("_first", F.col("_last") - F.col("_k") + 1)
    # copy 1 -> island _first; copies 2..k -> islands _first+1 .. _last
    island = F.explode(F.sequence(F.col("_first"), F.col("_last")))
    rows = ids.select(*keys, "_cs", "_ce", island.alias("island_id"))
    return (rows.groupBy(*keys, "island_id")
            .agg(F.min("_cs").alias("island_start"), F.max("_ce").alias("island_end"),
                 F.sum(F.datediff("_ce", "_cs") + 1).cast("long").alias("days")))


def anchored_groups(df: DataFrame, keys, order, date_col: str, window_days: int,
                    group_col: str = "group_id", max_groups: int | None = None) -> DataFrame:
    """Anchored grouping: the first row opens a group that ends at ``date + window_days``.

    Rows are taken in ``order``; a row whose ``date_col`` lies after the open group's
    window end opens the next group (and becomes its anchor).  The window is fixed by
    the anchor, not sliding, so this is not a session window.

    Plan: with ``max_groups`` (a bound that follows from the dates, e.g. period length
    over window length) the passes are a chain of windows over one partitioning and one
    order, so there is one shuffle and no action; a row still without a group after the
    last pass raises an error when the plan runs.  Without a bound, the rows left over
    by each pass are written to the shared folder and the passes go on until none is
    left.  No key group is ever collected into one array.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(*[F.col(c) if isinstance(c, str) else c for c in order])
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    if max_groups is not None:
        out = df.withColumn(group_col, F.lit(None).cast("long"))
        for ordinal in range(max_groups):
            out = _anchor_pass(out, group_col, date_col, window_days, ordinal, whole, upto)
        left_over = F.raise_error(F.lit(f"rows beyond {max_groups} anchored groups")).cast("long")
        return out.withColumn(group_col, F.coalesce(F.col(group_col), left_over))
    pending, done, ordinal = df.withColumn(group_col, F.lit(None).cast("long")), [], 0
    while True:
        marked = materialize(_anchor_pass(pending, group_col, date_col, window_days, ordinal, whole, upto))
        done.append(marked.filter(F.col(group_col).isNotNull()))
        pending = marked.filter(F.col(group_col).isNull())
        ordinal += 1
        if pending.isEmpty():
            return reduce(DataFrame.unionByName, done)


def _anchor_pass(df: DataFrame, group_col: str, date_col: str, window_days: int, ordinal: int, whole, upto) -> DataFrame:
    """Give group ``ordinal`` to the open rows up to the first one beyond the first open row's window."""
    is_open = F.col(group_col).isNull()
    # rows without a date never end a window, and a group they open has none
    first = F.first(F.when(is_open, F.struct(F.col(date_col).alias("d"))), ignorenulls=True).over(whole)
    anchored = df.withColumn("_end", F.date_add(first["d"], window_days))
    beyond = F.coalesce(is_open & (F.col(date_col) > F.col("_end")), F.lit(False)).cast("int")
    cut = anchored.withColumn("_cut", F.max(beyond).over(upto))
    return cut.withColumn(group_col, F.when(is_open & (F.col("_cut") == 0), F.lit(ordinal).cast("long"))
                          .otherwise(F.col(group_col))).drop("_end", "_cut")
