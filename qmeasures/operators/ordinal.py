"""Positions over a whole table without one task that sees it: file ordinals and global sorts.

* :func:`file_ordinal`  – position of each row in file order (path, then place in the file).
* :func:`write_sorted`  – a table written in one global order, equal keys spread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from qmeasures.operators.reuse import materialize

RANGES = 64


def prefix_sums(counts: DataFrame, order: list[str], n: str, total_col: str = "offset",
                ranges: int = RANGES) -> DataFrame:
    """``counts`` with the sum of ``n`` over all rows earlier in ``order``.

    Rows are dealt into ``ranges`` ordered ranges; each sums its own rows, and the totals
    of the earlier ranges, at most ``ranges`` numbers, are added to it.
    """
    dealt = materialize(counts.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("_range").agg(F.sum(n).alias("_total"))
    before = (totals.filter(F.col("_range") < ranges - 1)
              .select(F.explode(F.sequence(F.col("_range") + 1, F.lit(ranges - 1))).alias("_range"), "_total")
              .groupBy("_range").agg(F.sum("_total").alias("_before")))
    here = F.coalesce(F.sum(n).over(within), F.lit(0)) + F.coalesce("_before", F.lit(0))
    return (dealt.join(before, "_range", "left").withColumn(total_col, here.cast("long"))
            .drop("_range", "_before"))


def file_ordinal(df: DataFrame, ordinal_col: str = "_ordinal") -> DataFrame:
    """``df``, read straight from files, with each row's 0-based position in file order.

    Order: file path, then place in the file.  A first pass counts the rows of each input
    split, the counts are summed over the earlier splits, and a row's position in its split
    is added.  ``df`` must be a scan (columns may be selected, rows not filtered or moved),
    as positions come from the scan's own row numbering.
    """
    placed = df.select("*", F.col("_metadata.file_path").alias("_path"),
                       F.col("_metadata.file_block_start").alias("_block"),
                       F.monotonically_increasing_id().alias("_row"))
    splits = placed.groupBy("_path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    offsets = prefix_sums(splits, ["_path", "_block"], "_n", "_offset").drop("_n")
    return (placed.join(offsets, ["_path", "_block"])
            .withColumn(ordinal_col, (F.col("_offset") + F.col("_row") - F.col("_first")).cast("long"))
            .select(*df.columns, ordinal_col))


def sort_columns(order) -> list[Column]:
    """Sort expressions of ``[(column, 'asc' | 'desc'), ...]``; NULLs last either way."""
    return [F.col(c).asc_nulls_last() if way == "asc" else F.col(c).desc_nulls_last() for c, way in order]


def write_sorted(df: DataFrame, order, path: str) -> None:
    """Write ``df`` so that the files, read by name, are in the global ``order``.

    Spark samples range bounds over the sort columns.  A value held by many rows would
    fill one range, so the remaining sortable columns and the row's number end the key:
    equal keys, identical rows too, spread over as many ranges as they need.  Rows that
    differ in a sortable column fall in the same order each run.
    """
    named = {c for c, _ in order}
    rest = [(f.name, "asc") for f in df.schema.fields
            if f.name not in named and f.dataType.typeName() not in ("map", "variant")]
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    numbered.orderBy(*sort_columns([*order, *rest]), "_row").drop("_row").write.mode("overwrite").parquet(path)
