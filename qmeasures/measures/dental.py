"""Preventive dental services by age bucket (long form; two published measures)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from qmeasures.functions.codes import claims_filter
from qmeasures.functions.dates import D, age_years
from qmeasures.inputs import ClaimsInputs
from qmeasures.operators.intervals import coverage_islands
from qmeasures.params import MeasureParams
from qmeasures.schemas import to_result, empty_result

MEASURE = "dental_services"
MIN_CONTINUOUS_DAYS = 180
PUBLISHED = ("prev_dental_1_to_5", "prev_dental_6_to_14")
# category column -> short name used in the measure label
CATEGORIES = [("any_dental", "any_dental"), ("diagnostic_dental", "diag_dental"),
              ("preventive_dental", "prev_dental"), ("dental_treatment", "treat_dental")]


def age_bucket(age) -> F.Column:
    return (F.when(age < 1, "0-1").when(age.between(1, 5), "1_to_5").when(age.between(6, 14), "6_to_14")
            .when(age.between(15, 17), "15_to_17").when(age.between(18, 25), "18_to_25")
            .when(age.between(26, 65), "26_to_65").otherwise("65+"))


def min_island_days(p: MeasureParams) -> int:
    return min((p.round_elig_date - p.measure_start).days, MIN_CONTINUOUS_DAYS)


def denominator_members(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    buckets = inp.members().select("member_id", age_bucket(age_years("dob", p.measure_end)).alias("age_bucket"))
    spans = inp.member_time.join(buckets, "member_id")
    islands = coverage_islands(spans, ["member_id", "age_bucket"], p.measure_start, p.measure_end)
    return (islands.filter(F.col("days") >= min_island_days(p))
            .select("member_id", "age_bucket").distinct())


def member_dental_flags(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """Per member: max of the three dental flags over claims of allow-listed providers."""
    dental = inp.inpdental
    flags = {c: claims_filter(inp.oha_codes, MEASURE, c, dental).cast("int")
             for c in ("diagnostic_dental", "preventive_dental", "dental_treatment")}
    lines = (dental.filter(F.col("fromdate").between(D(p.measure_start), D(p.measure_end)))
             .join(inp.providers.select(F.col("prv_id").alias("providerid"), "prv_taxonomy_cd"),
                   "providerid", "left")
             .select("member_id", "prv_taxonomy_cd", *[v.alias(k) for k, v in flags.items()]))
    lines = lines.withColumn("any_dental", F.greatest(*flags.keys()))
    names = ["any_dental", *flags.keys()]
    per_tax = lines.groupBy("member_id", "prv_taxonomy_cd").agg(*[F.max(c).alias(c) for c in names])
    # the allow-list is a reference dimension (tens of codes); Spark broadcasts it by size
    allowed = per_tax.join(inp.dental_taxonomy.select(F.col("taxonomy_code").alias("prv_taxonomy_cd")).distinct(),
                           "prv_taxonomy_cd", "left_semi")
    return allowed.groupBy("member_id").agg(*[F.max(c).alias(c) for c in names])


def dental_long(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """All measure x bucket combinations: member_id, age_bucket, measure, numerator, denominator, ..."""
    denom = denominator_members(inp, p)
    flags = member_dental_flags(inp, p)
    wide = denom.join(flags, "member_id", "left").select(
        "member_id", "age_bucket", F.lit(1).alias("denominator"),
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c, _ in CATEGORIES])
    long = wide.unpivot(["member_id", "age_bucket", "denominator"], [c for c, _ in CATEGORIES],
                        "category", "numerator")
    short = F.create_map(*[F.lit(x) for pair in CATEGORIES for x in pair])[F.col("category")]
    return long.select(
        "member_id", "age_bucket", "denominator", "category", "numerator",
        short.alias("short_measure_category"),
        F.concat_ws("_", short, F.col("age_bucket")).alias("measure"),
        F.lit(None).cast("string").alias("comments"),
        F.when(F.col("numerator") == 0, D(p.measure_end)).alias("comp_quality_date_actionable"))


def prev_dental(inp: ClaimsInputs, p: MeasureParams, measure: str) -> DataFrame:
    if inp.inpdental is None:
        return empty_result(inp.member.sparkSession)
    return to_result(dental_long(inp, p).filter(F.col("measure") == measure))


def prev_dental_1_to_5(inp, p):
    return prev_dental(inp, p, "prev_dental_1_to_5")


def prev_dental_6_to_14(inp, p):
    return prev_dental(inp, p, "prev_dental_6_to_14")
