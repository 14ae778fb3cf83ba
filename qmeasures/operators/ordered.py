"""Order-dependent picks: first / last row per key and top-k per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DateType, TimestampType


def _sort_key(df: DataFrame, col: str, direction: str) -> Column:
    """A value whose ascending order equals ``col`` in ``direction`` (NULLs last)."""
    dtype = df.schema[col].dataType
    c = F.col(col)
    if direction == "asc":
        return c
    if isinstance(dtype, (DateType, TimestampType)):
        return -F.unix_date(c.cast("date"))
    return -c


def first_row(df: DataFrame, keys, order, columns=None) -> DataFrame:
    """One row per key: the first in ``order`` = [(col, 'asc'|'desc'), ...].

    Implemented as ``groupBy(keys).agg(min_by(struct(row), struct(order)))`` so the pick
    is partially aggregated map-side: a hot key never lands whole in one task.
    Descending keys must be numeric or dates.  Ties are broken by the remaining
    payload columns (struct order), so the result is deterministic.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = columns or [c for c in df.columns if c not in keys]
    order_struct = F.struct(*[_sort_key(df, c, d).alias(f"_o{i}") for i, (c, d) in enumerate(order)],
                            *[F.col(c).alias(f"_p{i}") for i, c in enumerate(columns)])
    payload = F.struct(*[F.col(c) for c in columns])
    picked = df.groupBy(*keys).agg(F.min_by(payload, order_struct).alias("_row"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in columns])


def top_k(df: DataFrame, keys, order, k: int, rank_col: str = "rk") -> DataFrame:
    """Rows ranked ``<= k`` per key (``row_number`` + filter; Spark inserts a partial
    window-group limit before the shuffle, so each key ships at most ``k`` rows per task)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = [F.col(c).desc() if d == "desc" else F.col(c).asc() for c, d in order]
    w = Window.partitionBy(*keys).orderBy(*cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)
