"""Initiation and engagement of alcohol and other drug (AOD) dependence treatment."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from qmeasures.functions.codes import claims_filter
from qmeasures.functions.dates import D, age_years
from qmeasures.inputs import ClaimsInputs
from qmeasures.operators.binned import events_in_windows
from qmeasures.operators.flagged import FlagRequest
from qmeasures.operators.intervals import contiguous_runs, eligibility_gaps
from qmeasures.operators.ordered import first_row
from qmeasures.operators.reuse import materialize
from qmeasures.params import MeasureParams
from qmeasures.schemas import to_result

MEASURE = "aod"
MIN_AGE = 18
HISTORY_DAYS = 60
CE_BEFORE, CE_AFTER = 60, 48
INIT_DAYS = 14          # initiation: 0 <= days < 14
ENGAGE_DAYS = 34        # engagement: 0 < days <= 34
NO_VISIT_COMMENT = "No Qualifying Visit"


def _on(c):
    return F.coalesce(F.col(c) != 0, F.lit(False))


def intake_start(p: MeasureParams) -> dt.date:
    return dt.date(p.measure_start.year, 1, 1)


def requests(inp: ClaimsInputs) -> list[FlagRequest]:
    """Claim line flags of the measure."""
    return [inp.request("hedis", MEASURE, c) for c, _ in inp.component_list(MEASURE, source="hedis")]


def claim_flags(inp: ClaimsInputs, p: MeasureParams, adults: DataFrame) -> tuple[DataFrame, list[str]]:
    """Medical claims in [Jan 1 - 60 d, end] of adults: component flags max'ed per claim."""
    start = intake_start(p)
    in_window = F.col("prm_fromdate").between(D(start - dt.timedelta(days=HISTORY_DAYS)), D(p.measure_end))
    wanted = requests(inp)
    comps = [r.component for r in wanted]
    keys = ["member_id", "prm_fromdate_case", "prm_todate_case", "claimid"]
    # a claim without any flag contributes nothing to any branch: flagged claims first
    any_flag = reduce(lambda a, b: a | b, [F.col(f"`{r.name}`") for r in wanted], F.lit(False))
    flagged = (inp.flagged_lines(wanted, in_window).filter(in_window & any_flag).join(adults, "member_id", "left_semi")
               .select(*keys, "prm_fromdate", *[F.col(f"`{r.name}`").cast("int").alias(r.component) for r in wanted]))
    # the claim's service date is the maximum over all its lines in the window, flagged or not
    # (a scan of five narrow columns; keys may be NULL)
    same = reduce(lambda a, b: a & b, [F.col(f"f.{k}").eqNullSafe(F.col(f"l.{k}")) for k in keys])
    dates = (inp.outclaims.filter(in_window).select(*keys, "prm_fromdate").alias("l")
             .join(flagged.select(*keys).distinct().alias("f"), same, "left_semi")
             .select(*keys, "prm_fromdate", *[F.lit(None).cast("int").alias(c) for c in comps]))
    per_claim = (flagged.unionByName(dates).groupBy(*keys)
                 .agg(F.max("prm_fromdate").alias("prm_fromdate"), *[F.max(c).alias(c) for c in comps]))
    return per_claim.withColumn("days_since_ips", F.datediff("prm_todate_case", D(start))), comps


def episodes(inp: ClaimsInputs, p: MeasureParams, adults: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Claim-level medical rows plus pharmacy rows with episode / treatment flags."""
    med, comps = claim_flags(inp, p, adults)
    pharm = inp.outpharmacy.join(adults, "member_id", "left_semi")
    rx = pharm.select(
        "member_id", "claimid", "prm_fromdate",
        F.col("prm_fromdate").alias("prm_fromdate_case"), F.col("prm_fromdate").alias("prm_todate_case"),
        claims_filter(inp.medications, MEASURE, "alcohol_treatment_meds", pharm).cast("int").alias("alcohol_rx_treatment"),
        claims_filter(inp.medications, MEASURE, "opioid_treatment_meds", pharm).cast("int").alias("opioid_rxclaim_treatment"))
    rx = rx.filter((F.col("alcohol_rx_treatment") == 1) | (F.col("opioid_rxclaim_treatment") == 1))
    both = (med.withColumn("claim_source", F.lit("med"))
            .unionByName(rx.withColumn("claim_source", F.lit("rx")), allowMissingColumns=True))
    visit = (_on("iet_standalone_visits") | (_on("iet_visits_grp_1") & _on("iet_pos_grp_1"))
             | (_on("iet_visits_grp_2") & _on("iet_pos_grp_2")) | _on("observation") | _on("ip_stay")
             | _on("telephone_visits") | _on("online_assessments"))
    acute = _on("detox") | _on("ED")
    derived = {}
    for cls, dep in (("alc", "alc_abuse_dependence"), ("opioid", "opioid_abuse_dependence"),
                     ("other", "other_abuse_dependence")):
        derived[f"{cls}_episode"] = _on(dep) & (visit | acute)
        derived[f"{cls}_treatment"] = _on(dep) & visit
    derived["alc_rx_treatment"] = _on("aod_med_treatment") | _on("alcohol_rx_treatment")
    derived["opioid_rx_treatment"] = _on("aod_med_treatment") | _on("opioid_rxclaim_treatment")
    return both.select("*", *[v.cast("int").alias(k) for k, v in derived.items()]), med


def index_episodes(eps: DataFrame) -> DataFrame:
    """First episode per member on/after Jan 1, inpatient transfers chained into one stay."""
    ip = eps.filter(F.col("ip_stay") == 1)
    stay_of = _stay_ids(ip)
    stays = stay_of.groupBy("member_id", "ip_stay_id").agg(
        F.min("prm_fromdate_case").alias("_stay_from"), F.max("prm_todate_case").alias("_stay_to"))
    chained = ip.join(stay_of, ["member_id", "prm_fromdate_case", "prm_todate_case"])
    transfers = (chained.join(stays, ["member_id", "ip_stay_id"])
                 .withColumn("_orig_from", F.col("prm_fromdate_case")).withColumn("_orig_to", F.col("prm_todate_case"))
                 .withColumn("prm_fromdate_case", F.col("_stay_from")).withColumn("prm_todate_case", F.col("_stay_to"))
                 .withColumn("_src", F.lit(0)).drop("ip_stay_id", "_stay_from", "_stay_to"))
    others = (eps.filter(F.coalesce(F.col("ip_stay") != 1, F.lit(True)))
              .withColumn("_orig_from", F.col("prm_fromdate_case")).withColumn("_orig_to", F.col("prm_todate_case"))
              .withColumn("_src", F.when(F.col("claim_source") == "med", 1).otherwise(2)))
    potential = transfers.unionByName(others)
    candidates = potential.filter((F.col("alc_episode") == 1) | (F.col("opioid_episode") == 1)
                                  | (F.col("other_episode") == 1)).filter(F.col("days_since_ips") >= 0)
    return first_row(candidates, "member_id",
                     [("prm_fromdate_case", "asc"), ("prm_todate_case", "desc"), ("_src", "asc"),
                      ("_orig_from", "asc"), ("_orig_to", "asc"), ("claimid", "asc")],
                     columns=["claimid", "prm_fromdate_case", "prm_todate_case", "alc_episode",
                              "opioid_episode", "other_episode", "ip_stay"])


def negative_history(eps: DataFrame, index: DataFrame) -> DataFrame:
    """Members with an AOD event 1-59 days before the index start (interval semi-join)."""
    aod_events = eps.filter(_on("aod_abuse_dependence") | _on("aod_med_treatment") | _on("alc_rx_treatment")
                            | _on("opioid_rx_treatment")).select("member_id", F.col("prm_fromdate_case").alias("_ev"))
    before = index.select("member_id", F.date_sub("prm_fromdate_case", HISTORY_DAYS - 1).alias("_from"),
                          F.date_sub("prm_fromdate_case", 1).alias("_to"))
    return events_in_windows(aod_events, before, "member_id", "_ev", "_from", "_to").select("member_id").distinct()


def _stay_ids(ip: DataFrame) -> DataFrame:
    """Stay id per distinct (member, from, to) inpatient row.

    Identical rows always continue the same stay (their gap is <= 0), so chaining runs
    over distinct date pairs: the window never sees more rows per member than there
    are distinct admission/discharge pairs, however many claim rows repeat them.
    """
    pairs = ip.select("member_id", "prm_fromdate_case", "prm_todate_case").distinct()
    return contiguous_runs(pairs, "member_id", "prm_fromdate_case", "prm_todate_case",
                           order=["prm_fromdate_case", "prm_todate_case"], allow_overlap=True,
                           run_col="ip_stay_id", first_id=0)


def transfer_stays(eps: DataFrame) -> DataFrame:
    """Inpatient stays after chaining transfers: member_id, ip_stay_id, stay_from, stay_to."""
    chained = _stay_ids(eps.filter(F.col("ip_stay") == 1))
    return chained.groupBy("member_id", "ip_stay_id").agg(F.min("prm_fromdate_case").alias("stay_from"),
                                                         F.max("prm_todate_case").alias("stay_to"))


def adult_members(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    return inp.members().filter(age_years("dob", p.measure_end) >= MIN_AGE).select("member_id")


def episode_rows(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """Materialised claim-level episode rows of adult members."""
    eps, _ = episodes(inp, p, adult_members(inp, p))
    return materialize(eps)


def denominator(inp: ClaimsInputs, p: MeasureParams, eps: DataFrame, med: DataFrame,
                index: DataFrame) -> DataFrame:
    negative = negative_history(eps, index)
    hospice = (med.filter((_on("hospice_encounter") | _on("hospice_intervention"))
                          & F.col("prm_fromdate_case").between(D(p.measure_start), D(p.measure_end)))
               .select("member_id").distinct())
    spans = (index.select("member_id", "prm_todate_case")
             .join(inp.member_time.select("member_id", "date_start", "date_end"), "member_id", "left"))
    gaps = eligibility_gaps(spans, ["member_id", "prm_todate_case"],
                            F.date_sub("prm_todate_case", CE_BEFORE), F.date_add("prm_todate_case", CE_AFTER))
    return (index.join(negative, "member_id", "left_anti").join(hospice, "member_id", "left_anti")
            .join(gaps.select("member_id", "gap_cnt"), "member_id", "left")
            .filter(F.col("gap_cnt") == 0)
            .select("member_id", "claimid", F.col("prm_todate_case").alias("iesd"),
                    "alc_episode", "opioid_episode", "other_episode", "ip_stay"))


def initiation(eps: DataFrame, denom: DataFrame) -> DataFrame:
    """Per denominator member: first initiating event (inpatient index initiates by itself)."""
    d = denom.alias("d")
    e = eps.alias("e")
    days = F.datediff(F.col("e.prm_fromdate"), F.col("d.iesd"))
    init_treatment = (F.when(_on("d.alc_episode") & (_on("e.alc_treatment") | _on("e.alc_rx_treatment")), 1)
                      # the opioid path tests the alcohol drug flag (kept as published)
                      .when(_on("d.opioid_episode") & (_on("e.opioid_treatment") | _on("e.alc_rx_treatment")), 1)
                      .when(_on("d.other_episode") & _on("e.other_treatment"), 1).otherwise(0))
    non_ip = (d.filter(F.coalesce(F.col("d.ip_stay") != 1, F.lit(True)))
              .join(e, F.col("d.member_id") == F.col("e.member_id"))
              .filter((init_treatment == 1) & (days >= 0) & (days < INIT_DAYS)
                      & F.coalesce(F.col("e.claimid") != F.col("d.claimid"), F.lit(False)))
              .select(F.col("d.member_id").alias("member_id"),
                      F.col("e.prm_fromdate_case").alias("prm_fromdate_case"),
                      F.col("e.prm_todate_case").alias("prm_todate_case"),
                      F.col("e.claimid").alias("claimid"),
                      *[F.col(f"e.{c}").alias(c) for c in ("alc_treatment", "opioid_treatment", "other_treatment",
                                                             "alc_rx_treatment", "opioid_rx_treatment")]))
    ip = (denom.filter(F.col("ip_stay") == 1)
          .select("member_id", F.col("iesd").alias("prm_fromdate_case"), F.col("iesd").alias("prm_todate_case"),
                  "claimid",
                  _on("alc_episode").cast("int").alias("alc_treatment"),
                  _on("opioid_episode").cast("int").alias("opioid_treatment"),
                  _on("other_episode").cast("int").alias("other_treatment"),
                  F.lit(0).alias("alc_rx_treatment"), F.lit(0).alias("opioid_rx_treatment")))
    firsts = first_row(non_ip.unionByName(ip), "member_id",
                       [("prm_fromdate_case", "asc"), ("prm_todate_case", "desc"), ("claimid", "asc"),
                        ("alc_treatment", "desc"), ("opioid_treatment", "desc"), ("other_treatment", "desc"),
                        ("alc_rx_treatment", "desc"), ("opioid_rx_treatment", "desc")])
    return (denom.join(firsts.select("member_id", F.col("prm_todate_case").alias("engage_start_date"),
                                     "alc_rx_treatment", "opioid_rx_treatment", F.lit(1).alias("numer_init_treatment")),
                       "member_id", "left")
            .withColumn("numer_init_treatment", F.coalesce("numer_init_treatment", F.lit(0))))


def engagement(eps: DataFrame, init: DataFrame) -> DataFrame:
    engaged = init.filter(F.col("numer_init_treatment") == 1)
    e = eps.select("member_id", "prm_fromdate_case", *[F.col(c).alias("_" + c) for c in (
        "alc_rx_treatment", "opioid_rx_treatment", "alc_treatment", "opioid_treatment", "other_treatment")])
    after = engaged.select("member_id", F.date_add("engage_start_date", 1).alias("_from"),
                           F.date_add("engage_start_date", ENGAGE_DAYS).alias("_to"))
    sums = (events_in_windows(e, after, "member_id", "prm_fromdate_case", "_from", "_to",
                              sums=[c for c in e.columns if c.startswith("_")])
            .select("member_id", F.col("_alc_rx_treatment").alias("sum_alc_rx"),
                    F.col("_opioid_rx_treatment").alias("sum_opioid_rx"),
                    F.col("_alc_treatment").alias("sum_alc_treatment"),
                    F.col("_opioid_treatment").alias("sum_opioid_treatment"),
                    F.col("_other_treatment").alias("sum_other_treatment")))
    j = engaged.join(sums, "member_id", "left")
    visits = (F.when(_on("alc_episode"), F.col("sum_alc_treatment"))
              .when(_on("opioid_episode"), F.col("sum_opioid_treatment"))
              .when(_on("other_episode"), F.col("sum_other_treatment")).otherwise(0))
    meds = (F.when(_on("alc_episode"), F.col("sum_alc_rx"))
            .when(_on("opioid_episode"), F.col("sum_opioid_rx")).otherwise(0))
    rx_event = _on("alc_rx_treatment") | _on("opioid_rx_treatment")
    engaged_flag = F.coalesce((rx_event & (visits >= 1) & ((visits + meds) >= 2))
                              | (~rx_event & ((meds >= 1) | (visits >= 2))), F.lit(False))
    return j.select("member_id", engaged_flag.cast("int").alias("numer_engage_treatment"))


def aod_flags(inp: ClaimsInputs, p: MeasureParams) -> DataFrame:
    """Per adult member in a denominator: init/engage numerator and denominator flags."""
    # claim-level episode rows are read by five branches (index, history, hospice,
    # initiation, engagement): materialise once
    eps = episode_rows(inp, p)
    # one row per member each; every later step reads them several times, so they are
    # written once instead of being re-derived inside each branch of the plan
    index = materialize(index_episodes(eps))
    denom = materialize(denominator(inp, p, eps, eps.filter(F.col("claim_source") == "med"), index))
    init = materialize(initiation(eps, denom))
    engage = engagement(eps, init)
    return (init.join(engage, "member_id", "left")
            .select("member_id",
                    F.lit(1).alias("denom_init"),
                    F.col("numer_init_treatment").alias("numer_init"),
                    F.col("numer_init_treatment").alias("denom_engage"),
                    F.coalesce("numer_engage_treatment", F.lit(0)).alias("numer_engage")))


def _result(flags: DataFrame, p: MeasureParams, num: str, den: str) -> DataFrame:
    out = flags.filter(F.col(den) == 1).select(
        "member_id", F.col(num).alias("numerator"), F.col(den).alias("denominator"),
        F.lit(None).cast("string").alias("comments"),
        D(p.measure_end).alias("comp_quality_date_actionable"))
    # the published program names its text column ``comment``; it does not reach the
    # combined table (which reads ``comments``), so ``comments`` stays empty here
    return to_result(out).withColumn("comment", F.lit(NO_VISIT_COMMENT))


def _flags(inp, p):
    return inp.memo(("aod_flags", p.key()), lambda: materialize(aod_flags(inp, p)))


def aod_init(inp: ClaimsInputs, p: MeasureParams, flags: DataFrame | None = None) -> DataFrame:
    return _result(flags if flags is not None else _flags(inp, p), p, "numer_init", "denom_init")


def aod_engage(inp: ClaimsInputs, p: MeasureParams, flags: DataFrame | None = None) -> DataFrame:
    return _result(flags if flags is not None else _flags(inp, p), p, "numer_engage", "denom_engage")
