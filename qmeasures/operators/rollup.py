"""Flag projection and roll-ups (line -> claim -> date -> member)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from qmeasures.functions.codes import claims_filter


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """All numeric columns except ``exclude`` (case-insensitive)."""
    skip = {c.lower() for c in exclude}
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name.lower() not in skip]


def flag_columns(df: DataFrame, codes: DataFrame, measure: str, components, keep=None) -> DataFrame:
    """Data-driven flag projection: ``keep`` columns plus one 0/1 column per component.

    The component list usually comes from the mapping files
    (``ClaimsInputs.component_list``), so the set of flag columns is dynamic.
    """
    keep = keep if keep is not None else df.columns
    return df.select(*[F.col(c) for c in keep],
                     *[claims_filter(codes, measure, comp, df).cast("int").alias(comp) for comp in components])


def max_rollup(df: DataFrame, keys, flags=None) -> DataFrame:
    """``max`` of every flag per key (partial aggregation happens map-side)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    flags = flags if flags is not None else numeric_columns(df, exclude=keys)
    return df.groupBy(*keys).agg(*[F.max(c).alias(c) for c in flags])


def measure_rate(results: DataFrame, group_cols=()) -> DataFrame:
    """Rate summary: sums and ``round(sum num / sum den, 4)``; 0 when the denominator is 0."""
    # sums are reported at 6 decimals: member contributions are whole numbers or
    # thousandths, so this is exact and independent of the summation order
    agg = results.groupBy(*group_cols).agg(F.round(F.sum("numerator"), 6).alias("sum_numerator"),
                                           F.round(F.sum("denominator"), 6).alias("sum_denominator"))
    rate = F.when(F.col("sum_denominator") > 0,
                  F.round(F.coalesce(F.col("sum_numerator"), F.lit(0.0)) / F.col("sum_denominator"), 4)
                  ).otherwise(F.lit(0.0))
    return agg.withColumn("measure_rate", rate.cast("double"))
