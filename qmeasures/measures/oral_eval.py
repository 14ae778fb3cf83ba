"""Oral evaluation for adults with diabetes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from qmeasures.functions.codes import claims_filter
from qmeasures.functions.dates import D, age_years, shift_date
from qmeasures.inputs import ClaimsInputs
from qmeasures.operators.flagged import FlagRequest
from qmeasures.operators.intervals import eligibility_gaps
from qmeasures.operators.reuse import materialize
from qmeasures.operators.rollup import max_rollup
from qmeasures.params import MeasureParams
from qmeasures.schemas import to_result, empty_result

MEASURE = "diabetes_oral_eval"
MIN_AGE = 18
FRAIL_AGE = 66
MAX_GAP_DAYS = 45
MAX_GAPS = 1


def _or(*cols):
    return reduce(lambda a, b: a | b, [F.coalesce(F.col(c) != 0, F.lit(False)) for c in cols])


def _on(c):
    return F.coalesce(F.col(c) != 0, F.lit(False))


def requests(inp: ClaimsInputs) -> list[FlagRequest]:
    """Claim line flags of the measure."""
    return [inp.request("hedis", MEASURE, c) for c, _ in inp.component_list(MEASURE, source="hedis")]


def _two_years(p: MeasureParams) -> Column:
    return F.col("prm_fromdate").between(D(shift_date(p.measure_start, years=-1)), D(p.measure_end))


def _period(p: MeasureParams) -> Column:
    prior_start, prior_end = shift_date(p.measure_start, years=-1), shift_date(p.measure_end, years=-1)
    return (F.when(F.col("prm_fromdate").between(D(p.measure_start), D(p.measure_end)), "current_year")
            .when(F.col("prm_fromdate").between(D(prior_start), D(prior_end)), "prior_year"))


def claim_flags(inp: ClaimsInputs, p: MeasureParams, adults: DataFrame, every_claim: bool = False) -> DataFrame:
    """Component flags per claim (max over lines) with derived flags and time period.

    Claims without any flag are left out unless ``every_claim`` is set: all their flags are 0.
    """
    wanted = requests(inp)
    comps = [r.component for r in wanted]
    keys = ["member_id", "prm_fromdate", "claimid"]
    lines = (inp.flagged_lines(wanted, _two_years(p)).filter(_two_years(p)).join(adults.select("member_id"), "member_id", "left_semi")
             .select(*keys, *[F.col(f"`{r.name}`").cast("int").alias(r.component) for r in wanted]))
    if every_claim:
        others = (inp.outclaims.filter(_two_years(p)).join(adults.select("member_id"), "member_id", "left_semi")
                  .select(*keys, *[F.lit(0).alias(c) for c in comps]))
        lines = lines.unionByName(others)
    else:
        lines = lines.filter(F.greatest(*[F.col(c) for c in comps], F.lit(0), F.lit(0)) > 0)
    per_claim = max_rollup(lines, keys, comps)
    tele = _or("telehealth_modifier", "telehealth_pos")
    op = _or("outpatient", "observation", "ed")
    diab = _on("diabetes")
    adv = _on("advanced_illness")
    derived = {
        "acute_ip_diabetes": _on("acute_inpatient") & diab & ~tele,
        "nonacute_ip_diabetes": _on("nonacute_inpatient") & diab & ~tele,
        "other_outpatient_non_tele": op & diab & ~tele,
        "other_outpatient_tele": op & diab & tele,
        "telephone_diabetes": _on("telephone_visits") & diab,
        "online_assessments_diabetes": _on("online_assessments") & diab,
        "acute_ip_advanced_illness": _on("acute_inpatient") & adv,
        "any_outpatient_advanced_illness": (op | _on("nonacute_inpatient")) & adv,
    }
    out = per_claim.select("*", *[v.cast("int").alias(k) for k, v in derived.items()])
    out = out.withColumn("two_visits_non_tele", F.greatest("nonacute_ip_diabetes", "other_outpatient_non_tele"))
    out = out.withColumn("two_visits_tele", F.greatest("other_outpatient_tele", "telephone_diabetes",
                                                       "online_assessments_diabetes"))
    return out.withColumn("time_period", _period(p))


def period_rows(inp: ClaimsInputs, p: MeasureParams, adults: DataFrame) -> DataFrame:
    """Sums of every flag per member x time period, for each period in which the member has any claim.

    The flags come from the flagged claims; that a period has a claim at all, which the number of
    period rows depends on, from a scan of two columns.
    """
    flags = claim_flags(inp, p, adults)
    present = (inp.outclaims.filter(_two_years(p)).select("member_id", _period(p).alias("time_period")).distinct()
               .join(adults.select("member_id"), "member_id", "left_semi"))
    nothing = [F.lit(0).cast(f.dataType).alias(f.name) for f in flags.schema.fields
               if f.name not in ("member_id", "prm_fromdate", "claimid", "time_period")]
    rows = flags.drop("prm_fromdate", "claimid").unionByName(present.select("member_id", "time_period", *nothing))
    return period_sums(rows.filter(F.col("time_period").isNotNull()))


def period_sums(flags: DataFrame) -> DataFrame:
    """Sum of every flag per member x time period (claims are counted, not dates)."""
    nums = [c for c in flags.columns if c not in ("member_id", "prm_fromdate", "claimid", "time_period")]
    return flags.groupBy("member_id", "time_period").agg(*[F.sum(c).alias(c) for c in nums])


def oral_eval(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    if inp.inpdental is None:
        return empty_result(inp.member.sparkSession)
    members, adults, periods, med_members, rx, rx_excl = denominator_inputs(inp, p)
    denom_members = med_members.union(rx.select("member_id")).distinct()

    excluded = (exclusion_flags(periods, adults, rx_excl).filter(F.col("excluded") == 1)
                .select("member_id").withColumn("denom_excl", F.lit(1)))

    spans = inp.member_time.join(denom_members, "member_id")
    gaps = eligibility_gaps(spans, "member_id", p.measure_start, p.measure_end, global_end=p.round_elig_date)
    denom = (gaps.join(excluded, "member_id", "left")
             .select("member_id",
                     F.when(F.col("gap_days") > MAX_GAP_DAYS, 0).when(F.col("gap_cnt") > MAX_GAPS, 0)
                     .when(F.col("denom_excl").isNotNull(), 0).otherwise(1).alias("denom_flag")))
    dental = inp.inpdental
    numer = (dental.filter(F.col("fromdate").between(D(p.measure_start), D(p.measure_end)))
             .groupBy("member_id")
             .agg(F.max(claims_filter(inp.oha_codes, MEASURE, "numerator", dental).cast("int")).alias("numer_flag")))
    out = (members.select("member_id").join(denom.filter(F.col("denom_flag") == 1), "member_id")
           .join(numer, "member_id", "left")
           .select("member_id", F.when(F.col("numer_flag") == 1, 1).otherwise(0).alias("numerator"),
                   F.lit(1).alias("denominator")))
    return to_result(out)


def exclusion_flags(periods: DataFrame, adults: DataFrame, rx_excl: DataFrame) -> DataFrame:
    """Per member: running totals over the prior / current period rows and the exclusion flag.

    Prior sorts before current, so the totals at the current row are the sums over both
    rows.  The diabetes-exclusion counter is only carried when the member has a single
    period row (the published program does not retain it across rows).
    """
    current = F.col("time_period") == "current_year"
    ex = (periods.join(adults, "member_id", "left").join(rx_excl, "member_id", "left")
          .groupBy("member_id")
          .agg(F.max(current & _or("hospice_encounter", "hospice_intervention")).cast("int").alias("hospice"),
               F.max(current & _or("frailty_device", "frailty_diagnosis", "frailty_encounter",
                                   "frailty_symptom")).cast("int").alias("frail_now"),
               F.sum("acute_ip_advanced_illness").alias("acute_adv"),
               F.sum("any_outpatient_advanced_illness").alias("op_adv"),
               F.sum("diabetes").alias("diab_total"),
               F.sum("diabetes_exclusions").alias("diab_excl"),
               F.count(F.lit(1)).alias("n_periods"),
               F.max("age").alias("age"),
               F.max("denom_rx_excl_flag").alias("rx_excl")))
    frailty = ((F.col("age") >= FRAIL_AGE) & (F.col("frail_now") == 1)
               & ((F.col("acute_adv") >= 1) | (F.col("op_adv") >= 2) | F.coalesce(F.col("rx_excl") != 0, F.lit(False))))
    diab_only_excl = (F.col("n_periods") == 1) & (F.col("diab_excl") != 0) & (F.col("diab_total") == 0)
    excluded = F.coalesce((F.col("hospice") == 1) | frailty | diab_only_excl, F.lit(False)).cast("int")
    return ex.select("member_id", "hospice", "frail_now", "acute_adv", "op_adv", "diab_total", "diab_excl",
                     "n_periods", excluded.alias("excluded"))


def denominator_inputs(inp: ClaimsInputs, p: MeasureParams):
    """(members with age, adults, period sums, medical-rule members, rx members, rx exclusion members)."""
    members = inp.members().withColumn("age", age_years("dob", p.measure_end))
    adults = members.filter(F.col("age") >= MIN_AGE).select("member_id", "age")
    two_years = _two_years(p)
    # member x period sums: read by the denominator rule and the exclusion rules
    periods = materialize(period_rows(inp, p, adults))
    qualifies = ((F.col("acute_ip_diabetes") >= 1) | (F.col("two_visits_non_tele") >= 2)
                 | ((F.col("two_visits_non_tele") >= 1) & (F.col("two_visits_tele") >= 1)))
    med_members = periods.filter(qualifies).select("member_id").distinct()
    pharm = inp.outpharmacy.join(adults.select("member_id"), "member_id", "left_semi")
    rx = (pharm.filter(claims_filter(inp.medications, MEASURE, "diabetes_medications", pharm) & two_years)
          .select("member_id"))
    rx_excl = (pharm.filter(claims_filter(inp.medications, MEASURE, "dementia_medications", pharm) & two_years)
               .select("member_id").distinct().withColumn("denom_rx_excl_flag", F.lit(1)))
    return members, adults, periods, med_members, rx, rx_excl
