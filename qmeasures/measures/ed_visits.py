"""Emergency-department utilisation (visits per 1000 member months) and its
mental-illness subset."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from qmeasures.functions.dates import D, age_years, in_range, within
from qmeasures.functions.text import mmddyyyy, percent0
from qmeasures.inputs import ClaimsInputs
from qmeasures.operators.flagged import FlagRequest
from qmeasures.operators.ordered import top_k
from qmeasures.operators.reuse import materialize
from qmeasures.params import MeasureParams
from qmeasures.schemas import to_result

MEASURE = "ed_visits"
MEASURE_MI = "ed_visits_mi"
MAX_COMMENT_DATES = 3
INPATIENT_LAG_DAYS = 1
PROB_ACTIONABLE_NO_VISIT = 0.50
PROB_ACTIONABLE_WITH_VISIT = 0.25
MI_LOOKBACK_MONTHS = 36
MI_MIN_DATES = 2
MI_MIN_AGE = 18


ED = ("numer_cpt", "numer_rev", "numer_procs")


def _request(inp: ClaimsInputs, component: str) -> FlagRequest:
    return inp.request("oha", MEASURE, component)


def _mi_request(inp: ClaimsInputs) -> FlagRequest:
    return inp.request("oha", MEASURE_MI, "denominator")


def requests(inp: ClaimsInputs) -> list[FlagRequest]:
    """Claim line flags of the measure."""
    return [_request(inp, x) for x in (*ED, "numer_excl_mh", "numer_excl_psych", "numer_excl_ip_stay", "denom_excl_hospice")]


def requests_mi(inp: ClaimsInputs) -> list[FlagRequest]:
    return [*requests(inp), _mi_request(inp)]


def relevant_lines(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """Lines with an ED, psychiatric-exclusion, inpatient-stay or hospice flag of the measure.

    Five branches read this narrow frame, so it is written once.
    """
    return inp.memo(("ed_lines", p.key()), lambda: materialize(_relevant(inp, p)))


def _relevant(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    lines = inp.flagged_lines(requests(inp))
    on = lambda component: F.col(f"`{_request(inp, component).name}`")
    flags = {
        "is_ed": on(ED[0]) | on(ED[1]) | on(ED[2]),
        "icddiag_excl": on("numer_excl_mh"),
        "is_psych": on("numer_excl_psych"),
        "is_ip": on("numer_excl_ip_stay"),
        "is_hospice": in_range("prm_fromdate", p.measure_start, p.measure_end) & on("denom_excl_hospice"),
    }
    keep = flags["is_ed"] | flags["is_psych"] | flags["is_ip"] | flags["is_hospice"]
    return lines.filter(keep).select("member_id", "claimid", "prm_fromdate", "prm_line",
                                     *[v.cast("int").alias(k) for k, v in flags.items()])


def denied_ed_claims(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """ED claims with a denied line; denials of other claims never leave the scan's semi-join."""
    ed_claims = relevant_lines(inp, p).filter(F.col("is_ed") == 1).select("member_id", "claimid").distinct()
    denied = inp.outclaims.filter(F.col("prm_denied_yn") == "Y").select("member_id", "claimid").distinct()
    return denied.join(ed_claims, ["member_id", "claimid"], "left_semi")


def hospice_members(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    return relevant_lines(inp, p).filter(F.col("is_hospice") == 1).select("member_id").distinct()


def member_months(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """Member months with medical cover in the year, before the run-out start."""
    mm = inp.member_months
    return (mm.filter(within("elig_month", p.measure_start, p.measure_end)
                      & (F.col("elig_month") < D(p.runout_start))
                      & (F.col("cover_medical") == "Y"))
            .groupBy("member_id").agg(F.sum("memmos").alias("memmos")))


def inpatient_follow_keys(rel: DataFrame) -> DataFrame:
    """(member_id, ed_date) pairs that have an inpatient-stay line 0-1 days later.

    The range condition ``0 <= ip_date - ed_date <= 1`` is rewritten as an equi-join:
    each inpatient date is expanded to the ED dates it covers (itself and the day
    before), so the join needs no nested loop.
    """
    ip = rel.filter(F.col("is_ip") == 1).select("member_id", "prm_fromdate").distinct()
    offsets = F.sequence(F.lit(0), F.lit(INPATIENT_LAG_DAYS))
    return (ip.select("member_id", F.explode(F.transform(offsets, lambda k: F.date_sub("prm_fromdate", k)))
                      .alias("ed_date"))
            .distinct())


def ed_lines(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """ED claim lines with their exclusion flags (one row per line)."""
    rel = relevant_lines(inp, p)
    lines = rel.filter(F.col("is_ed") == 1).select("member_id", "prm_fromdate", "prm_line", "claimid",
                                                   "icddiag_excl")
    psych = (rel.filter(F.col("is_psych") == 1).select("member_id", "claimid").distinct()
             .withColumn("cpt_exclusion_flag", F.lit(1)))
    denied = denied_ed_claims(inp, p).withColumn("denied_excl", F.lit(1))
    ip = (inpatient_follow_keys(rel).withColumnRenamed("ed_date", "prm_fromdate")
          .withColumn("ip_following", F.lit(1)))
    in_year = in_range("prm_fromdate", p.measure_start, p.measure_end).cast("int")
    # the two joins by claim follow each other: the lines are dealt by claim once
    return (lines.join(psych, ["member_id", "claimid"], "left")
            .join(denied, ["member_id", "claimid"], "left")
            .join(ip, ["member_id", "prm_fromdate"], "left")
            .select("member_id", "prm_fromdate", "prm_line", "claimid", "icddiag_excl",
                    F.coalesce("ip_following", F.lit(0)).alias("ip_following"),
                    F.coalesce("cpt_exclusion_flag", F.lit(0)).alias("cpt_exclusion_flag"),
                    F.coalesce("denied_excl", F.lit(0)).alias("denied_excl"),
                    in_year.alias("in_current_measure_year"),
                    (in_year.cast("boolean") & (F.col("prm_fromdate") >= D(p.runout_start)))
                    .cast("int").alias("in_runout_period")))


def qualifying_visits(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """Visits = (member, first date of the claim); a denied line anywhere drops the visit."""
    lines = ed_lines(inp, p)
    claim_start = lines.groupBy("member_id", "claimid").agg(F.min("prm_fromdate").alias("min_fromdate"))
    keep = ((F.col("ip_following") == 0) & (F.col("icddiag_excl") == 0) & (F.col("cpt_exclusion_flag") == 0)
            & F.coalesce(~F.upper("prm_line").startswith("I"), F.lit(True)))
    return (lines.join(claim_start, ["member_id", "claimid"], "left")
            .filter(keep)
            .groupBy("member_id", "min_fromdate")
            .agg(F.max("in_current_measure_year").alias("in_current_measure_year"),
                 F.min("in_runout_period").alias("in_runout_period"),
                 F.max("denied_excl").alias("denied"))
            .filter(F.coalesce(F.col("denied") != 1, F.lit(True))))


def numerator_members(visits: DataFrame) -> DataFrame:
    """Numerator = visits in the year outside run-out; comment lists the newest three dates."""
    cur = visits.filter(F.col("in_current_measure_year") == 1)
    counts = cur.groupBy("member_id").agg(
        F.sum(F.when(F.col("in_runout_period") == 1, 0).otherwise(1)).alias("numerator"))
    label = F.concat(mmddyyyy("min_fromdate"),
                     F.when(F.col("in_runout_period") == 1, F.lit(" (will qualify soon)")).otherwise(F.lit("")))
    recent = (top_k(cur, "member_id", [("min_fromdate", "desc")], MAX_COMMENT_DATES)
              .groupBy("member_id")
              .agg(F.sort_array(F.collect_list(F.struct(F.col("rk"), label.alias("txt")))).alias("_l")))
    text = F.concat(F.lit("Recent Visit(s):  "), F.array_join(F.col("_l.txt"), ", "))
    return counts.join(recent.select("member_id", text.alias("comments")), "member_id", "left")


def _predictions(inp: ClaimsInputs) -> DataFrame | None:
    if inp.predictions is None:
        return None
    return inp.predictions.groupBy("member_id").agg(F.max("er_visits_pred_prob").alias("er_visits_pred_prob"))


def ed_visits_all(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    # member x visit-date rows, read by the prior-year, numerator and comment branches
    visits = materialize(qualifying_visits(inp, p))
    denom = member_months(inp, p)
    prior = (visits.filter(F.col("in_current_measure_year") == 0)
             .groupBy("member_id").agg(F.max("min_fromdate").alias("visit_date")))
    excl = hospice_members(inp, p).withColumn("_hospice", F.lit(1))
    d = denom.join(prior, "member_id", "left").join(excl, "member_id", "left")
    probs = _predictions(inp)
    if probs is not None:
        d = d.join(probs, "member_id", "left")
    else:
        d = d.withColumn("er_visits_pred_prob", F.lit(None).cast("double"))
    hospice = F.col("_hospice").isNotNull()
    c_dates = F.when(F.col("visit_date").isNotNull(),
                     F.concat(F.lit("Most Recent Visit: "), mmddyyyy("visit_date")))
    c_probs = F.when(F.col("er_visits_pred_prob").isNotNull(),
                     F.concat(F.lit("Probability of ED Visit Next 6 Months: "), percent0("er_visits_pred_prob")))
    d = d.select("member_id", "er_visits_pred_prob",
                 F.when(hospice, F.lit(0.0)).otherwise(F.col("memmos") / 1000.0).alias("denominator"),
                 F.when(hospice, F.lit("Excluded due to hospice status"))
                 .otherwise(F.concat_ws("; ", c_dates, c_probs)).alias("_dc"))
    d = d.withColumn("_dc", F.when(F.col("_dc") == "", F.lit(None)).otherwise(F.col("_dc")))
    n = numerator_members(visits)
    j = d.join(n, "member_id", "left")
    zero_den = F.col("denominator") == 0
    numerator = F.when(zero_den, F.lit(0)).otherwise(F.coalesce(F.col("numerator"), F.lit(0)))
    prob = F.col("er_visits_pred_prob")
    actionable = F.when(numerator == 0, F.when(prob >= PROB_ACTIONABLE_NO_VISIT, D(p.measure_end))) \
        .otherwise(F.when(prob >= PROB_ACTIONABLE_WITH_VISIT, D(p.measure_end)))
    out = j.select("member_id", numerator.alias("numerator"), "denominator",
                   F.when(zero_den, F.col("_dc")).otherwise(F.coalesce(F.col("comments"), F.col("_dc")))
                   .alias("comments"),
                   actionable.alias("comp_quality_date_actionable"))
    return to_result(out)


def shared_visits(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """All-visits table, written once for the measures on these inputs that read it."""
    return inp.memo(("ed_all", p.key()), lambda: materialize(ed_visits_all(inp, p)))


def mental_illness_members(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """Adults with >= 2 distinct diagnosis dates in the 36 months before the year end."""
    request = _mi_request(inp)
    shared = inp.flagged_lines([request])
    lo = F.add_months(D(p.measure_end), -MI_LOOKBACK_MONTHS)
    dx = (shared.filter((F.col("prm_fromdate") > lo) & (F.col("prm_fromdate") < D(p.measure_end))
                   & F.col(f"`{request.name}`"))
          .groupBy("member_id").agg(F.count_distinct("prm_fromdate").alias("cnt"))
          .filter(F.col("cnt") >= MI_MIN_DATES))
    adults = inp.members().filter(age_years("dob", p.measure_end) >= MI_MIN_AGE).select("member_id")
    return dx.join(adults, "member_id")


def ed_visits_mi(inp: ClaimsInputs, p: MeasureParams, ed_all: DataFrame | None = None) -> DataFrame:
    ed_all = ed_all if ed_all is not None else shared_visits(inp, p)
    out = mental_illness_members(inp, p).join(ed_all, "member_id").select(
        "member_id", F.coalesce("numerator", F.lit(0.0)).alias("numerator"), "denominator",
        "comments", "comp_quality_date_actionable")
    return to_result(out)
