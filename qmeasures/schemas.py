"""Fixed schemas: member-level result, code tables, reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("member_id", T.StringType()),
    T.StructField("denominator", T.DoubleType()),
    T.StructField("numerator", T.DoubleType()),
    T.StructField("comments", T.StringType()),
    T.StructField("comp_quality_date_actionable", T.DateType()),
])

CODE_TABLE_SCHEMA = T.StructType([
    T.StructField("measure", T.StringType(), False),
    T.StructField("component", T.StringType(), False),
    T.StructField("codesystem", T.StringType(), False),
    T.StructField("code", T.StringType(), False),
    T.StructField("grouping_id", T.StringType(), True),
    T.StructField("diag_type", T.StringType(), True),
])

ABBREVIATION_SCHEMA = T.StructType([
    T.StructField("measure_abbreviation", T.StringType(), False),
    T.StructField("measure_name", T.StringType(), False),
    T.StructField("measure_format", T.StringType(), False),
    T.StructField("measure_calculation_type", T.StringType(), False),
])

TARGETS_SCHEMA = T.StructType([
    T.StructField("measure_name_short", T.StringType()),
    T.StructField("measure_target_value", T.DoubleType()),
    T.StructField("measure_direction", T.StringType()),
])

MAPPING_SCHEMA = T.StructType([
    T.StructField("measure", T.StringType()),
    T.StructField("value_set_name", T.StringType()),
    T.StructField("component", T.StringType()),
])

# the published column holds this many characters; longer comments are reported
# (validate.comment_length_checks), never cut
COMMENT_LENGTH = 128


def to_result(df: DataFrame, comments_col: str = "comments") -> DataFrame:
    """Project a measure frame onto ``RESULT_SCHEMA`` (types cast)."""
    cols = set(df.columns)
    comments = F.col(comments_col) if comments_col in cols else F.lit(None)
    actionable = (F.col("comp_quality_date_actionable") if "comp_quality_date_actionable" in cols
                  else F.lit(None))
    return df.select(
        F.col("member_id").cast("string").alias("member_id"),
        F.col("denominator").cast("double").alias("denominator"),
        F.col("numerator").cast("double").alias("numerator"),
        comments.cast("string").alias("comments"),
        actionable.cast("date").alias("comp_quality_date_actionable"),
    )


def empty_result(spark) -> DataFrame:
    return spark.createDataFrame([], RESULT_SCHEMA)
