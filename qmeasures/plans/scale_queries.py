"""Queries for the steps that must hold for hot keys and whole-table orders, with SQL oracles.

One member owns every third order and its lines, so a third of all rows share one key.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from qmeasures.measures import ed_visits, well_child
from qmeasures.operators.binned import events_in_windows, latest_window_at
from qmeasures.operators.ordinal import file_ordinal, write_sorted
from qmeasures.operators.reuse import stage_path
from qmeasures.plans import oracle_sql as S
from qmeasures.plans.combine import stack_results
from qmeasures.plans.publish import discover, publish, violations, write_run
from qmeasures.sources.adapter import DRIVER_PARAMS as P, load_inputs

WINDOW_DAYS = 13
HOT_EVERY = 3
SORTED = ["l_shipdate", "l_extendedprice", "l_orderkey", "l_linenumber", "l_quantity"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _owned(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Windows that open at each order, and ship days of the lines, both by member."""
    o = _table(spark, sf_dir, "orders")
    member = F.when(F.col("o_orderkey") % HOT_EVERY == 0, F.lit(0)).otherwise(F.col("o_custkey") + 1).cast("long")
    owner = o.select(F.col("o_orderkey").alias("l_orderkey"), member.alias("member"))
    opened = F.col("o_orderdate").cast("date")
    windows = o.select(member.alias("member"), opened.alias("opened"), F.date_add(opened, WINDOW_DAYS).alias("closed"))
    lines = (_table(spark, sf_dir, "lineitem").join(owner, "l_orderkey")
             .select("member", F.col("l_shipdate").cast("date").alias("shipped"),
                     F.col("l_quantity").cast("long").alias("most"), F.col("l_quantity").cast("long").alias("units")))
    return windows, lines


_OWNED_SQL = f"""WITH owner AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS opened,
    CAST(CASE WHEN o_orderkey % {HOT_EVERY} = 0 THEN 0 ELSE o_custkey + 1 END AS BIGINT) AS member FROM orders),
win AS (SELECT DISTINCT member, opened, opened + {WINDOW_DAYS} AS closed FROM owner),
daily AS (SELECT member, CAST(l_shipdate AS DATE) AS shipped, count(*) AS n,
    max(CAST(l_quantity AS BIGINT)) AS most, sum(CAST(l_quantity AS BIGINT)) AS units
    FROM lineitem JOIN owner ON l_orderkey = o_orderkey GROUP BY ALL)"""


def hot_member_windows(spark, sf_dir) -> DataFrame:
    """J5 with a hot member: lines shipped within two weeks of any order, folded per window."""
    windows, lines = _owned(spark, sf_dir)
    return events_in_windows(lines, windows, "member", "shipped", "opened", "closed", maxes=["most"], sums=["units"])


def hot_member_windows_sql() -> str:
    return _OWNED_SQL + """
SELECT w.member, opened, closed, CAST(sum(n) AS BIGINT) AS events, max(most) AS most, CAST(sum(units) AS BIGINT) AS units
FROM win w JOIN daily d ON w.member = d.member AND shipped BETWEEN opened AND closed GROUP BY ALL"""


def hot_member_open_window(spark, sf_dir) -> DataFrame:
    """J6 with a hot member: the last opened window that is open on each ship day."""
    windows, lines = _owned(spark, sf_dir)
    return latest_window_at(lines, windows, "member", "shipped", "opened", "closed")


def hot_member_open_window_sql() -> str:
    return _OWNED_SQL + """
SELECT d.member, shipped, max(opened) AS opened, max(closed) AS closed
FROM daily d JOIN win w ON w.member = d.member AND shipped BETWEEN opened AND closed GROUP BY ALL"""


def file_ordinals(spark, sf_dir) -> DataFrame:
    """W10: every order with its place in file order."""
    return file_ordinal(_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "ordinal")


def file_ordinals_sql() -> str:
    # the given files hold the orders by key
    return "SELECT o_orderkey, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS ordinal FROM orders"


def sorted_positions(spark, sf_dir) -> DataFrame:
    """O1: claim lines written in one order of mixed directions, then read with their places."""
    path = stage_path(spark, f"sorted-{uuid.uuid4().hex}")
    lines = _table(spark, sf_dir, "lineitem").select(*SORTED)
    write_sorted(lines, [("l_shipdate", "asc"), ("l_extendedprice", "desc")], path)
    return file_ordinal(spark.read.parquet(path), "position")


def sorted_positions_sql() -> str:
    return f"""SELECT {', '.join(SORTED)}, row_number() OVER (ORDER BY l_shipdate NULLS LAST,
    l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber, l_quantity) - 1 AS position FROM lineitem"""


def published_stack(spark, sf_dir) -> DataFrame:
    """S12 / O5: two results written and published, then found by their manifest and stacked.

    A later run that wrote its tables but was not published stays unseen.
    """
    inp = load_inputs(spark, sf_dir)
    out = stage_path(spark, f"published-{uuid.uuid4().hex}")
    child = well_child.well_child_visits(inp, P)
    publish(spark, write_run({"ED_Visits_MI": ed_visits.ed_visits_mi(inp, P), "well_child_visits": child}, out), out)
    write_run({"well_child_visits": child.limit(0)}, out)
    return stack_results(discover(spark, out))


def published_stack_sql() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {S._RESULT_SELECT}, '{name}' AS Measure_Abbreviation FROM ({sql})"
        for name, sql in (("ED_VISITS_MI", S.ed_mi_sql()), ("WELL_CHILD_VISITS", S.well_child_sql())))


OBSERVED = ["member_id", "numerator", "comments", "comp_quality_date_actionable"]


def observed_violations(spark, sf_dir) -> DataFrame:
    """Q7: rows that break each publication rule, counted by the job that writes the result."""
    out = stage_path(spark, f"observed-{uuid.uuid4().hex}")
    res = ed_visits.ed_visits_all(load_inputs(spark, sf_dir), P)
    return violations(spark, write_run({"ed_visits": res}, out, required=OBSERVED), broken_only=False)


def observed_violations_sql() -> str:
    nulls = "\nUNION ALL\n".join(f"SELECT 'ed_visits' AS result, 'no_nulls' AS rule, '{c}' AS key, "
                                  f"count(*) FILTER ({c} IS NULL) AS violations FROM r" for c in OBSERVED)
    return f"""WITH r AS ({S.ed_all_sql()}) {nulls}
UNION ALL SELECT 'ed_visits', 'comment_fits', 'comments', count(*) FILTER (length(comments) > 128) FROM r"""


QUERIES = {
    "hot_member_windows": hot_member_windows,
    "hot_member_open_window": hot_member_open_window,
    "file_ordinals": file_ordinals,
    "sorted_positions": sorted_positions,
    "published_stack": published_stack,
    "observed_violations": observed_violations,
}


def oracles() -> dict:
    return {
        "hot_member_windows": hot_member_windows_sql(),
        "hot_member_open_window": hot_member_open_window_sql(),
        "file_ordinals": file_ordinals_sql(),
        "sorted_positions": sorted_positions_sql(),
        "published_stack": published_stack_sql(),
        "observed_violations": observed_violations_sql(),
    }
