"""Combine member-level results into the published tables, and rate summaries.

* :func:`stack_results`   – all result tables stacked with their measure tag (raw stack).
* :func:`combine_results` – validate references/targets, stack, keep roster members,
  decorate and project onto the published member-level schema.
* :func:`measure_reference` – one row per abbreviation with ordinal, target, format.
* :func:`rate_summary`    – sums and ``round(num / den, 4)`` per measure.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from qmeasures.operators.rollup import measure_rate
from qmeasures.plans.validate import raise_violations, target_checks
from qmeasures.schemas import RESULT_SCHEMA
from qmeasures.sources import refdata

CATEGORY = "CCO Incentive Measures"
PUBLISHED_COLUMNS = ["member_id", "Measure_Abbreviation", "comp_quality_denominator", "comp_quality_numerator",
                     "comp_quality_comments", "comp_quality_date_actionable", "mem_report_hier_1",
                     "comp_quality_short", "comp_quality_date_last"]
REFERENCE_COLUMNS = ["comp_quality_short", "comp_quality_dual", "comp_quality", "comp_quality_category",
                     "comp_quality_direction", "comp_quality_target_value", "comp_quality_format_code",
                     "comp_quality_calculation_type"]


class CombineError(ValueError):
    pass


def abbreviations_frame(spark: SparkSession) -> DataFrame:
    """The shipped abbreviation table with its file-order ordinal (``comp_quality_dual``)."""
    rows = [(*r, i + 1) for i, r in enumerate(refdata.ABBREVIATIONS)]
    return spark.createDataFrame(rows, "measure_abbreviation string, measure_name string, measure_format string, "
                                       "measure_calculation_type string, comp_quality_dual long")


def with_ordinal(abbreviations: DataFrame, order_col: str | None = None) -> DataFrame:
    """Add ``comp_quality_dual`` (1-based position in file order) when it is missing.

    ``order_col`` is an explicit ingest ordinal; the abbreviation table is a few dozen
    rows, so the global row_number is a single small task.
    """
    if "comp_quality_dual" in abbreviations.columns:
        return abbreviations
    if order_col is None and "_ordinal" in abbreviations.columns:  # kept by the reference sink
        order_col = "_ordinal"
    order = F.col(order_col) if order_col else F.monotonically_increasing_id()
    return abbreviations.withColumn("comp_quality_dual", F.row_number().over(Window.orderBy(order)).cast("long"))


def stack_results(results: dict) -> DataFrame:
    """Stack result tables (by name) with ``Measure_Abbreviation`` = upper-cased name."""
    parts = []
    for name, df in results.items():
        cols = [f.name for f in RESULT_SCHEMA.fields]
        parts.append(df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in cols])
                     .withColumn("Measure_Abbreviation", F.lit(name.upper())))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def validate_references(results: dict, abbreviations: DataFrame, targets: DataFrame) -> None:
    """Raise when targets name unknown measures, or results lack a reference or a target."""
    abbr = abbreviations.select(F.upper("measure_abbreviation").alias("_k"))
    bad_targets = targets.join(abbr, F.upper("measure_name_short") == F.col("_k"), "left_anti")
    if not bad_targets.isEmpty():
        raise CombineError("Targets were provided for measures which are not reported: "
                           + str([r[0] for r in bad_targets.select("measure_name_short").collect()]))
    known = {r["_k"] for r in abbr.collect()}
    unknown = [n for n in results if n.upper() not in known]
    if unknown:
        raise CombineError(f"Results tables were found that did not have matching reference data: {unknown}")
    with_target = {r[0].upper() for r in targets.filter(F.col("measure_target_value").isNotNull())
                   .select("measure_name_short").collect()}
    missing = [n for n in results if n.upper() not in with_target]
    if missing:
        raise CombineError(f"Targets were not found for matching results tables: {missing}")


def combine_results(results: dict, abbreviations: DataFrame, targets: DataFrame, roster: DataFrame,
                    validate: bool = True) -> DataFrame:
    """The published member-level table (:data:`PUBLISHED_COLUMNS`)."""
    if validate:
        validate_references(results, abbreviations, targets)
    stacked = stack_results(results)
    ref = with_ordinal(abbreviations).select(F.upper("measure_abbreviation").alias("_k"),
                                             F.col("measure_abbreviation").alias("comp_quality_short"))
    # one row per member, so a member listed twice is not published twice; members listed
    # with different hierarchies are reported by validate.roster_checks
    roster = roster.groupBy("member_id").agg(F.min("mem_report_hier_1").alias("mem_report_hier_1"))
    decorated = (stacked.join(roster, "member_id")
                 .join(ref, F.upper(F.col("Measure_Abbreviation")) == F.col("_k"), "left"))
    return decorated.select(
        "member_id", "Measure_Abbreviation",
        F.col("denominator").alias("comp_quality_denominator"),
        F.col("numerator").alias("comp_quality_numerator"),
        F.col("comments").alias("comp_quality_comments"),
        "comp_quality_date_actionable", "mem_report_hier_1", "comp_quality_short",
        F.lit(None).cast("date").alias("comp_quality_date_last"))


def measure_reference(abbreviations: DataFrame, targets: DataFrame) -> DataFrame:
    ab = with_ordinal(abbreviations)
    raise_violations(target_checks(targets))  # a repeated target would repeat the measure
    t = targets.select(F.upper("measure_name_short").alias("_k"), "measure_direction", "measure_target_value")
    j = ab.join(t, F.upper("measure_abbreviation") == F.col("_k"), "left")
    return j.select(
        F.col("measure_abbreviation").alias("comp_quality_short"), "comp_quality_dual",
        F.col("measure_name").alias("comp_quality"), F.lit(CATEGORY).alias("comp_quality_category"),
        F.col("measure_direction").alias("comp_quality_direction"),
        F.col("measure_target_value").alias("comp_quality_target_value"),
        F.col("measure_format").alias("comp_quality_format_code"),
        F.col("measure_calculation_type").alias("comp_quality_calculation_type")).orderBy("comp_quality_dual")


def rate_summary(results: dict) -> DataFrame:
    """One row per measure: sum_numerator, sum_denominator, measure_rate."""
    stacked = stack_results(results)
    return measure_rate(stacked, ["Measure_Abbreviation"])
