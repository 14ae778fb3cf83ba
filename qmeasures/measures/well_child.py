"""Well-child visits (children aged 3-6 at the end of the year)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from qmeasures.functions.dates import D, age_years, in_range, within
from qmeasures.functions.text import mmddyyyy
from qmeasures.inputs import ClaimsInputs
from qmeasures.operators.empirical import empirical_elig_end
from qmeasures.operators.flagged import FlagRequest
from qmeasures.operators.intervals import eligibility_gaps
from qmeasures.operators.reuse import materialize
from qmeasures.params import MeasureParams
from qmeasures.schemas import to_result

MEASURE = "well_child_visits"
AGE_LOW, AGE_HIGH = 3, 6
MAX_GAPS, MAX_GAP_DAYS = 1, 45


def requests(inp: ClaimsInputs) -> list[FlagRequest]:
    """Claim line flags of the measure."""
    return [inp.request("hedis", MEASURE, x) for x in ("hospice_encounter", "hospice_intervention", "well_care",
                                                       "telehealth_modifier", "telehealth_pos")]


def denominator_members(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """member_id, dob, denom_excluded_yn for members passing age and continuity."""
    excluded = (relevant_lines(inp, p).filter(F.col("is_hospice") == 1)
                .select("member_id").distinct().withColumn("_excl", F.lit(1)))
    members = inp.members().filter(age_years("dob", p.measure_end).between(AGE_LOW, AGE_HIGH))
    prep = inp.member_time.select("member_id", "date_start", "date_end").join(members, "member_id")
    elig_end = empirical_elig_end(prep, p.measure_end, p.min_member_count, p.empirical_elig_date_end)
    gaps = eligibility_gaps(prep, "member_id", p.measure_start, p.measure_end, global_end=elig_end)
    any_elig = (prep.filter((F.col("date_start") <= D(p.measure_end)) & (F.col("date_end") >= D(p.measure_start)))
                .select("member_id", "dob").distinct())
    return (gaps.filter((F.col("gap_cnt") <= MAX_GAPS) & (F.col("gap_days") <= MAX_GAP_DAYS))
            .join(any_elig, "member_id")
            .join(excluded, "member_id", "left")
            .select("member_id", "dob",
                    F.when(F.col("_excl").isNotNull(), "Y").otherwise("N").alias("denom_excluded_yn")))


def relevant_lines(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """Hospice lines of the year and qualifying visits, written once for both branches."""
    return inp.memo(("well_child_lines", p.key()), lambda: materialize(_relevant(inp, p)))


def _relevant(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    on = lambda component: F.col(f"`{inp.request('hedis', MEASURE, component).name}`")
    hospice = (within("fromdate", p.measure_start, p.measure_end)
               & (on("hospice_encounter") | on("hospice_intervention")))
    visit = on("well_care") & ~on("telehealth_modifier") & ~on("telehealth_pos")
    return inp.flagged_lines(requests(inp)).filter(hospice | visit).select(
        "member_id", "fromdate", F.coalesce(hospice, F.lit(False)).cast("int").alias("is_hospice"),
        visit.cast("int").alias("is_visit"))


def qualifying_visits(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    return (relevant_lines(inp, p).filter(F.col("is_visit") == 1).groupBy("member_id")
            .agg(F.max("fromdate").alias("most_recent_visit"),
                 F.max(in_range("fromdate", p.measure_start, p.measure_end).cast("int")).alias("numerator")))


def well_child_visits(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    denom = denominator_members(inp, p)
    visits = qualifying_visits(inp, p)
    j = denom.join(visits, "member_id", "left")
    excluded = F.col("denom_excluded_yn") == "Y"
    numerator = F.coalesce(F.col("numerator"), F.lit(0))
    in_year = in_range("most_recent_visit", p.measure_start, p.measure_end)
    comments = (F.when(excluded, F.lit("Excluded due to hospice status"))
                .when(F.col("most_recent_visit").isNotNull(),
                      F.concat(F.lit("Most recent visit performed "), mmddyyyy("most_recent_visit"),
                               F.when(~in_year, F.lit(" (not in performance year)")).otherwise(F.lit(""))))
                .otherwise(F.lit("No qualifying visit")))
    out = j.select(
        "member_id",
        F.when(excluded, 0).otherwise(1).alias("denominator"),
        numerator.alias("numerator"),
        comments.alias("comments"),
        F.when(numerator == 0, D(p.measure_end)).alias("comp_quality_date_actionable"))
    return to_result(out)
