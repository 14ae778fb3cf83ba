"""Assessments within 60 days for children entering custody (one row per member x
notification outcome)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from qmeasures.functions.codes import claims_filter
from qmeasures.functions.dates import D, age_years, shift_date
from qmeasures.functions.text import mmddyyyy
from qmeasures.inputs import ClaimsInputs
from qmeasures.operators.empirical import empirical_elig_end
from qmeasures.operators.flagged import FlagRequest
from qmeasures.operators.intervals import eligibility_gaps
from qmeasures.operators.reuse import materialize
from qmeasures.params import MeasureParams
from qmeasures.schemas import to_result, empty_result

MEASURE = "DHS_assessments"
MAX_AGE = 17
# FIXED VALUES — branch codes that mark adoption / guardianship changes (excluded).
EXCLUDED_BRANCHES = ["6050", "0060"]
DAYS_BEFORE = 30
DAYS_AFTER = 60


def notification_window(p: MeasureParams):
    """Nov 1 of the prior year .. Oct 31 of the measurement year."""
    start = shift_date(p.measure_start.replace(day=1), months=-2)
    end = shift_date(shift_date(p.measure_end.replace(day=1), months=-1), days=-1)
    return start, end


def denominator_rows(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """One row per (member, report_date) kept for the measure, with gap counts."""
    elig_end = empirical_elig_end(inp.member_time.select("member_id", "date_end"), p.measure_end,
                                  p.min_member_count, p.empirical_elig_date_end)
    lo, hi = notification_window(p)
    n = inp.foster_care
    plus60 = F.least(F.date_add("report_date", DAYS_AFTER), elig_end)
    notes = (n.filter(F.col("report_date").between(D(lo), D(hi))
                      & (age_years("dob", "report_date") <= MAX_AGE)
                      & F.coalesce(~F.col("branch_code").isin(EXCLUDED_BRANCHES), F.lit(True)))
             .select("member_id", "report_date", "eligibility_effective_date",
                     F.date_sub("report_date", DAYS_BEFORE).alias("report_date_minus_30"),
                     plus60.alias("report_date_plus_7"),  # literal: this "delayed start" is report + 60
                     plus60.alias("report_date_plus_60"),
                     age_years("dob", "report_date").alias("report_date_age")))
    spans = notes.join(inp.member_time.select("member_id", "date_start", "date_end"), "member_id", "left")
    keys = ["member_id", "report_date"]
    gaps = eligibility_gaps(spans, keys, "report_date", "report_date_plus_60", global_end=hi)
    delayed = (eligibility_gaps(spans, keys, "report_date_plus_7", "report_date_plus_60", global_end=hi)
               .withColumnRenamed("gap_cnt", "delayed_start_gap_cnt")
               .withColumnRenamed("gap_days", "delayed_start_gap_days"))
    members = notes.dropDuplicates(["member_id", "report_date", "eligibility_effective_date",
                                    "report_date_minus_30", "report_date_plus_60", "report_date_age"])
    return (members.join(gaps, keys, "left").join(delayed, keys, "left")
            .filter((F.col("delayed_start_gap_cnt") == 0)
                    & (F.col("eligibility_effective_date") >= F.col("report_date_minus_30")))
            .select("member_id", "report_date_age", "report_date", "report_date_minus_30",
                    "report_date_plus_60", "gap_cnt", "gap_days", "delayed_start_gap_cnt"))


def requests(inp: ClaimsInputs) -> list[FlagRequest]:
    """Claim line flags of the measure; the combined rule needs a procedure and a versioned diagnosis."""
    return [*(inp.request("oha", MEASURE, f"numerator_{x}") for x in ("physical", "mental", "dental", "prts")),
            inp.request("oha", MEASURE, "numerator_physment", systems=("CPT",)),
            inp.request("oha", MEASURE, "numerator_physment", versioned=True)]


def assessment_flags(inp: ClaimsInputs, p: MeasureParams, denom: DataFrame) -> DataFrame:
    """max physical / mental / dental assessment flags per (member, report_date, age)."""
    codes = inp.oha_codes
    phys, ment, dent, prts, combined, mental_diag = (F.col(f"`{r.name}`") for r in requests(inp))
    lines = (inp.flagged_lines(requests(inp)).filter(F.col("prm_fromdate").between(D(p.measure_start), D(p.measure_end))
                      & (phys | ment | dent | prts))
             .select("member_id", "prm_fromdate",
                     phys.alias("_phys"), ment.alias("_ment"), dent.alias("_dent"), prts.alias("_prts"),
                     (combined & mental_diag).alias("_physment"))
             .distinct())  # bounded by the calendar before the join with the notifications
    j = lines.join(denom.select("member_id", "report_date", "report_date_age",
                                "report_date_minus_30", "report_date_plus_60"), "member_id")
    in_win = F.col("prm_fromdate").between(F.col("report_date_minus_30"), F.col("report_date_plus_60"))
    physical = (in_win & (F.col("_phys") | F.col("_prts"))).cast("int")
    mental = (in_win & (F.col("_ment") | F.col("_prts"))).cast("int")
    dental = (in_win & F.col("_dent")).cast("int")
    has_dental_table = inp.inpdental is not None
    if has_dental_table:
        # the combined code + mental-diagnosis rule applies regardless of the window
        physical = F.when(F.col("_physment"), 1).otherwise(physical)
        mental = F.when(F.col("_physment"), 1).otherwise(mental)
    flagged = j.select("member_id", "report_date", "report_date_age",
                       physical.alias("physical_assessment"), mental.alias("mental_assessment"),
                       dental.alias("dental_assessment"))
    if has_dental_table:
        dt_ = inp.inpdental
        ddent = claims_filter(codes, MEASURE, "numerator_dental", dt_)
        dlines = (dt_.filter(F.col("fromdate").between(D(p.measure_start), D(p.measure_end)) & ddent)
                  .select("member_id", F.col("fromdate").alias("prm_fromdate")).distinct())
        dj = dlines.join(denom.select("member_id", "report_date", "report_date_age",
                                      "report_date_minus_30", "report_date_plus_60"), "member_id")
        flagged = flagged.unionByName(dj.select(
            "member_id", "report_date", "report_date_age",
            F.lit(0).alias("physical_assessment"), F.lit(0).alias("mental_assessment"),
            F.col("prm_fromdate").between(F.col("report_date_minus_30"), F.col("report_date_plus_60"))
            .cast("int").alias("dental_assessment")))
    return (flagged.groupBy("member_id", "report_date", "report_date_age")
            .agg(F.max("physical_assessment").alias("physical_assessment"),
                 F.max("mental_assessment").alias("mental_assessment"),
                 F.max("dental_assessment").alias("dental_assessment")))


def dhs_assessments(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    if inp.foster_care is None:
        return empty_result(inp.member.sparkSession)
    # one row per kept notification, joined with claims, dental lines and the result
    denom = materialize(denominator_rows(inp, p))
    flags = assessment_flags(inp, p, denom)
    m = denom.join(flags.drop("report_date_age"), ["member_id", "report_date"], "left")
    age = F.col("report_date_age")
    ph, me, de = (F.col("physical_assessment") == 1), (F.col("mental_assessment") == 1), (F.col("dental_assessment") == 1)
    numerator = F.coalesce(((age >= 4) & ph & me & de) | ((age >= 1) & (age < 4) & ph & de) | ((age < 1) & ph),
                           F.lit(False)).cast("int")
    cutoff = F.date_add("report_date", DAYS_AFTER)
    late = cutoff > D(p.date_latestpaid)
    comments = F.concat(F.lit("DHS Notification Date: "), mmddyyyy("report_date"), F.lit("; "),
                        F.when(~late, F.lit("Assessment period ended"))
                        .otherwise(F.concat(F.lit("Assessment period ends "), mmddyyyy(cutoff))))
    denominator = F.when(F.col("gap_cnt") == 0, 1).otherwise(0)
    rows = m.select("member_id", numerator.alias("numerator"),
                    # delayed-start override: a compliant member counts in the denominator
                    F.when((F.col("delayed_start_gap_cnt") == 0) & (numerator == 1), 1)
                    .otherwise(denominator).alias("denominator"),
                    F.when((numerator == 0) & late, cutoff).alias("comp_quality_date_actionable"),
                    comments.alias("comments"))
    out = (rows.groupBy("member_id", "comp_quality_date_actionable", "comments")
           .agg(F.sum("denominator").alias("denominator"), F.sum("numerator").alias("numerator")))
    return to_result(out)
