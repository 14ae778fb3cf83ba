"""Operator-level queries (one per inventory row that returns rows) and their SQL oracles.

Each Spark query runs the library operator on the adapter's claims model over the
whole driver tables; each oracle is the independent SQL formulation of the same step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from qmeasures.functions.codes import any_versioned_diag, claims_filter, versioned_diag_codes
from qmeasures.functions.dates import D, age_years
from qmeasures.measures import aod, dental, ed_visits, oral_eval, prenatal
from qmeasures.operators.empirical import elig_end_frequency, empirical_elig_end
from qmeasures.operators.intervals import coverage_islands, eligibility_gaps
from qmeasures.operators.rollup import flag_columns
from qmeasures.plans import oracle_sql as S
from qmeasures.sources.adapter import DRIVER_PARAMS as P, load_inputs
from qmeasures.sources.refdata import HEDIS_MAPPING

ED = "ed_visits"
DHS = "DHS_assessments"


def _inp(spark, sf_dir):
    return load_inputs(spark, sf_dir)


# ---- F1 / F2: predicates and data-driven flags ------------------------------------

def code_predicate_lines(spark, sf_dir) -> DataFrame:
    inp = _inp(spark, sf_dir)
    c = inp.outclaims
    f = {k: claims_filter(inp.oha_codes, ED, k, c) for k in ("numer_cpt", "numer_rev", "numer_excl_mh")}
    return c.filter(f["numer_cpt"] | f["numer_rev"] | f["numer_excl_mh"]).select(
        "member_id", "claimid", "prm_fromdate", "prm_line", *[v.cast("int").alias(k) for k, v in f.items()])


def code_predicate_lines_sql() -> str:
    f = {k: S.O(ED, k) for k in ("numer_cpt", "numer_rev", "numer_excl_mh")}
    cols = ", ".join(f"CAST({v} AS INTEGER) AS {k}" for k, v in f.items())
    return S.prefix("lines") + f"""
SELECT member_id, claimid, prm_fromdate, prm_line, {cols} FROM lines WHERE {' OR '.join(f.values())}"""


def grouped_code_lines(spark, sf_dir) -> DataFrame:
    inp = _inp(spark, sf_dir)
    c = inp.outclaims
    f = {"numer_procs": claims_filter(inp.oha_codes, ED, "numer_procs", c),
         "numerator_mental": claims_filter(inp.oha_codes, DHS, "numerator_mental", c),
         "numerator_prts": claims_filter(inp.oha_codes, DHS, "numerator_prts", c)}
    return c.filter(f["numer_procs"] | f["numerator_mental"] | f["numerator_prts"]).select(
        "member_id", "claimid", "prm_fromdate", "hcpcs", "pos", "modifier",
        *[v.cast("int").alias(k) for k, v in f.items()])


def grouped_code_lines_sql() -> str:
    f = {"numer_procs": S.O(ED, "numer_procs"), "numerator_mental": S.O(DHS, "numerator_mental"),
         "numerator_prts": S.O(DHS, "numerator_prts")}
    cols = ", ".join(f"CAST({v} AS INTEGER) AS {k}" for k, v in f.items())
    return S.prefix("lines") + f"""
SELECT member_id, claimid, prm_fromdate, hcpcs, pos, modifier, {cols} FROM lines WHERE {' OR '.join(f.values())}"""


AOD_COMPONENTS = [c for m, _, c in HEDIS_MAPPING if m == "aod"]


def component_flags(spark, sf_dir) -> DataFrame:
    """One 0/1 column per mapped AOD component for every claim line (data-driven list)."""
    inp = _inp(spark, sf_dir)
    c = inp.outclaims
    comps = [x for x, _ in inp.component_list("aod", source="hedis")]
    return flag_columns(c, inp.hedis_codes, "aod", comps, keep=["member_id", "claimid", "prm_fromdate"])


def component_flags_sql() -> str:
    cols = ", ".join(f"CAST({S.H(x, measure='aod')} AS INTEGER) AS {x}" for x in AOD_COMPONENTS)
    return S.prefix("lines") + f"\nSELECT member_id, claimid, prm_fromdate, {cols} FROM lines"


# ---- oral evaluation steps (A2, A3, W8, O3) ------------------------------------

ORAL_COMPONENTS = [c for m, _, c in HEDIS_MAPPING if m == "diabetes_oral_eval"]
ORAL_DERIVED = ["acute_ip_diabetes", "nonacute_ip_diabetes", "other_outpatient_non_tele", "other_outpatient_tele",
                "telephone_diabetes", "online_assessments_diabetes", "acute_ip_advanced_illness",
                "any_outpatient_advanced_illness"]


def _oral_parts(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    return inp, oral_eval.denominator_inputs(inp, P)


def claim_rollup(spark, sf_dir) -> DataFrame:
    inp = _inp(spark, sf_dir)
    adults = (inp.members().withColumn("age", age_years("dob", P.measure_end))
              .filter(F.col("age") >= oral_eval.MIN_AGE).select("member_id", "age"))
    return oral_eval.claim_flags(inp, P, adults, every_claim=True)


def claim_rollup_sql() -> str:
    cols = ", ".join(ORAL_COMPONENTS + ORAL_DERIVED)
    return S._oral_core() + f"""
SELECT member_id, prm_fromdate, claimid, {cols}, tvn AS two_visits_non_tele, tvt AS two_visits_tele,
    tp AS time_period FROM der"""


def period_sums(spark, sf_dir) -> DataFrame:
    _, (members, adults, periods, med, rx, rx_excl) = _oral_parts(spark, sf_dir)
    return periods


def period_sums_sql() -> str:
    cols = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in ORAL_COMPONENTS + ORAL_DERIVED)
    return S._oral_core() + f"""
SELECT member_id, tp AS time_period, {cols}, CAST(tvn AS BIGINT) AS two_visits_non_tele,
    CAST(tvt AS BIGINT) AS two_visits_tele FROM per"""


def period_running_flags(spark, sf_dir) -> DataFrame:
    _, (members, adults, periods, med, rx, rx_excl) = _oral_parts(spark, sf_dir)
    return oral_eval.exclusion_flags(periods, adults, rx_excl)


def period_running_flags_sql() -> str:
    return S._oral_core() + """
SELECT e.member_id, e.hosp AS hospice, e.frail AS frail_now, CAST(e.aa AS BIGINT) AS acute_adv,
    CAST(e.oa AS BIGINT) AS op_adv, CAST(e.dtot AS BIGINT) AS diab_total, CAST(e.dex AS BIGINT) AS diab_excl,
    e.n AS n_periods,
    CASE WHEN e.member_id IN (SELECT member_id FROM excl) THEN 1 ELSE 0 END AS excluded FROM ex e"""


def member_union(spark, sf_dir) -> DataFrame:
    _, (members, adults, periods, med, rx, rx_excl) = _oral_parts(spark, sf_dir)
    return med.union(rx.select("member_id")).distinct()


def member_union_sql() -> str:
    return S._oral_core() + "\nSELECT member_id FROM dm"


# ---- F7, A1, A4, A5, J2, J3, W9 -------------------------------------------------

def age_buckets(spark, sf_dir) -> DataFrame:
    m = _inp(spark, sf_dir).members()
    age = age_years("dob", P.measure_end)
    return m.select("member_id", age.alias("age"), dental.age_bucket(age).alias("age_bucket"))


def age_buckets_sql() -> str:
    return S._dental_long_sql().split(",\nsp AS")[0] + f"""
SELECT b.member_id, CAST({S.age('m.dob', S.ME)} AS INTEGER) AS age, b.age_bucket
FROM bucket b JOIN mem m ON b.member_id = m.member_id"""


def member_months(spark, sf_dir) -> DataFrame:
    return ed_visits.member_months(_inp(spark, sf_dir), P)


def member_months_sql() -> str:
    return S._ed_core() + "\nSELECT member_id, memmos FROM mm"


def visit_rollup(spark, sf_dir) -> DataFrame:
    return ed_visits.qualifying_visits(_inp(spark, sf_dir), P)


def visit_rollup_sql() -> str:
    return S._ed_core() + """
SELECT member_id, min_fromdate, iy AS in_current_measure_year, ro AS in_runout_period, dn AS denied FROM visits"""


def inpatient_follow(spark, sf_dir) -> DataFrame:
    return ed_visits.ed_lines(_inp(spark, sf_dir), P)


def inpatient_follow_sql() -> str:
    return S._ed_core() + """
SELECT member_id, prm_fromdate, prm_line, claimid, mh AS icddiag_excl, ipf AS ip_following,
    px AS cpt_exclusion_flag, dn AS denied_excl, iy AS in_current_measure_year, ro AS in_runout_period FROM flagged"""


def denied_claims(spark, sf_dir) -> DataFrame:
    return ed_visits.ed_lines(_inp(spark, sf_dir), P).select("member_id", "claimid", "denied_excl").distinct()


def denied_claims_sql() -> str:
    return S._ed_core() + "\nSELECT DISTINCT member_id, claimid, dn AS denied_excl FROM flagged"


def recent_dates_text(spark, sf_dir) -> DataFrame:
    return ed_visits.numerator_members(ed_visits.qualifying_visits(_inp(spark, sf_dir), P))


def recent_dates_text_sql() -> str:
    return S._ed_core() + """
SELECT n.member_id, CAST(n.n AS BIGINT) AS numerator, t.c AS comments FROM num n LEFT JOIN txt t ON n.member_id = t.member_id"""


def distinct_dates_ge2(spark, sf_dir) -> DataFrame:
    return ed_visits.mental_illness_members(_inp(spark, sf_dir), P)


def distinct_dates_ge2_sql() -> str:
    return S.prefix("mem", "lines") + f""",
adults AS (SELECT member_id FROM mem WHERE {S.age('dob', S.ME)} >= 18)
SELECT member_id, count(DISTINCT prm_fromdate) AS cnt FROM lines
WHERE prm_fromdate > {S.ME} - INTERVAL 36 MONTH AND prm_fromdate < {S.ME} AND {S.O('ED_Visits_MI', 'denominator')}
  AND member_id IN (SELECT member_id FROM adults)
GROUP BY member_id HAVING count(DISTINCT prm_fromdate) >= 2"""


# ---- A6, W1, W2, J8 --------------------------------------------------------------

def empirical_end(spark, sf_dir) -> DataFrame:
    spans = _inp(spark, sf_dir).member_time
    chosen = empirical_elig_end(spans, P.measure_end, P.min_member_count)
    return elig_end_frequency(spans).withColumn("chosen", (F.col("elig_date_end") == chosen).cast("int"))


def empirical_end_sql() -> str:
    return S.prefix("member_time") + f""",
lastend AS (SELECT member_id, max(date_end) AS e FROM member_time GROUP BY member_id),
freq AS (SELECT e, count(*) AS c FROM lastend GROUP BY e),
emp AS (SELECT least(coalesce((SELECT max(e) FROM freq WHERE c >= 42), {S.ME}), {S.ME}) AS we)
SELECT e AS elig_date_end, c AS memcnt, CAST(e = (SELECT we FROM emp) AS INTEGER) AS chosen FROM freq"""


def elig_gaps(spark, sf_dir) -> DataFrame:
    return eligibility_gaps(_inp(spark, sf_dir).member_time, "member_id", P.measure_start, P.measure_end)


def elig_gaps_sql() -> str:
    return S.prefix("member_time") + f""",
src AS (SELECT member_id, {S.MS} AS ws, {S.ME} AS we, date_start, date_end FROM member_time),
{S.gaps_sql('gaps', 'src', ['member_id'])}
SELECT member_id, gap_cnt, gap_days FROM gaps"""


def coverage_islands_q(spark, sf_dir) -> DataFrame:
    return coverage_islands(_inp(spark, sf_dir).member_time, "member_id", P.measure_start, P.measure_end)


def coverage_islands_sql() -> str:
    return S.prefix("member_time") + f""",
sp AS (SELECT member_id, date_start AS os, date_end AS oe, greatest(date_start, {S.MS}) AS cs,
    least(date_end, {S.ME}) AS ce FROM member_time WHERE date_end >= {S.MS} AND date_start <= {S.ME}),
lagged AS (SELECT *, lag(ce) OVER (PARTITION BY member_id ORDER BY os, oe) AS prev FROM sp),
runs AS (SELECT *, sum(CASE WHEN prev IS NULL OR cs - prev <> 1 THEN 1 ELSE 0 END)
    OVER (PARTITION BY member_id ORDER BY os, oe ROWS UNBOUNDED PRECEDING) AS isl FROM lagged)
SELECT member_id, CAST(isl AS BIGINT) AS island_id, min(cs) AS island_start, max(ce) AS island_end,
    CAST(sum(ce - cs + 1) AS BIGINT) AS days FROM runs GROUP BY member_id, isl"""


def unmatched_rows(spark, sf_dir) -> DataFrame:
    """Roster members without any covered member month in the year (anti-join validation)."""
    inp = _inp(spark, sf_dir)
    months = ed_visits.member_months(inp, P).select("member_id")
    return inp.members().select("member_id").join(months, "member_id", "left_anti")


def unmatched_rows_sql() -> str:
    return S.prefix("mem", "member_months") + f"""
SELECT m.member_id FROM mem m WHERE NOT EXISTS (SELECT 1 FROM member_months x WHERE x.member_id = m.member_id
    AND x.elig_month BETWEEN {S.MS} AND {S.ME} AND x.elig_month < {S.RUNOUT} AND x.cover_medical = 'Y')"""


# ---- J7, J10 ---------------------------------------------------------------------

def diag_lookup(spark, sf_dir) -> DataFrame:
    inp = _inp(spark, sf_dir)
    c = inp.outclaims
    keys = versioned_diag_codes(inp.oha_codes, DHS, "numerator_physment")
    return c.filter(any_versioned_diag(c, keys)).select("member_id", "claimid", "prm_fromdate", "icdversion")


def diag_lookup_sql() -> str:
    keys = sorted({("09|" if r[2].upper() == "ICD9CM-DIAG" else "10|") + r[3] for r in S.A.OHA_CODES
                   if r[0] == DHS and r[1] == "Numerator_PhysMent" and r[2].upper().endswith("-DIAG")})
    return S.prefix("lines") + f"""
SELECT member_id, claimid, prm_fromdate, icdversion FROM lines WHERE {S.versioned(keys)}"""


def taxonomy_semi(spark, sf_dir) -> DataFrame:
    return dental.member_dental_flags(_inp(spark, sf_dir), P)


def taxonomy_semi_sql() -> str:
    return S._dental_long_sql() + """
SELECT member_id, anyd AS any_dental, dd AS diagnostic_dental, pd AS preventive_dental, td AS dental_treatment
FROM mf"""


# ---- prenatal steps (W3, W5, J6, O7) ------------------------------------------

def _deliveries(spark, sf_dir):
    inp = _inp(spark, sf_dir)
    flags = prenatal.relevant_lines(inp)
    return inp, prenatal.delivery_dates(flags, P)


def delivery_groups(spark, sf_dir) -> DataFrame:
    return _deliveries(spark, sf_dir)[1]


def delivery_groups_sql() -> str:
    return S._prenatal_core() + "\nSELECT member_id, CAST(gid AS BIGINT) AS delivery_id, delivery_date FROM dd"


def enrollment_segments(spark, sf_dir) -> DataFrame:
    inp, dd = _deliveries(spark, sf_dir)
    return prenatal.enrollment_segments(prenatal.delivery_spans(inp, dd))


def enrollment_segments_sql() -> str:
    return S._prenatal_core() + """
SELECT member_id, delivery_date, CAST(sid - 1 AS BIGINT) AS enrollment_segment_id,
    ss AS enrollment_segment_start, se AS enrollment_segment_end FROM segw"""


def last_segment(spark, sf_dir) -> DataFrame:
    inp, dd = _deliveries(spark, sf_dir)
    return prenatal.delivery_windows(inp, P, dd)


def last_segment_sql() -> str:
    return S._prenatal_core() + """
SELECT w.member_id, w.delivery_date, w.gap_cnt, l.ss AS enrollment_segment_start, w.ps AS prenatal_care_start_date,
    w.pe AS prenatal_care_end_date, w.qs AS postpartum_care_start_date, w.qe AS postpartum_care_end_date
FROM win w JOIN lastseg l ON w.member_id = l.member_id AND w.delivery_date = l.delivery_date"""


def two_tag_rows(spark, sf_dir) -> DataFrame:
    return prenatal.prenatal_postpartum_long(_inp(spark, sf_dir), P)


def two_tag_rows_sql() -> str:
    return S._prenatal_core() + """
SELECT member_id, measure, CAST(denominator AS BIGINT) AS denominator, CAST(numerator AS BIGINT) AS numerator
FROM summ"""


# ---- AOD steps (W4, W6, J4) --------------------------------------------------------

def transfer_stays(spark, sf_dir) -> DataFrame:
    return aod.transfer_stays(aod.episode_rows(_inp(spark, sf_dir), P))


def transfer_stays_sql() -> str:
    return S._aod_core() + """
SELECT member_id, CAST(sid AS BIGINT) AS ip_stay_id, sfc AS stay_from, stc AS stay_to FROM stays"""


def index_episode(spark, sf_dir) -> DataFrame:
    return aod.index_episodes(aod.episode_rows(_inp(spark, sf_dir), P))


def index_episode_sql() -> str:
    return S._aod_core() + """
SELECT member_id, claimid, fc AS prm_fromdate_case, tc AS prm_todate_case, alc_ep AS alc_episode,
    op_ep AS opioid_episode, ot_ep AS other_episode, ip_stay FROM idx"""


def neg_history(spark, sf_dir) -> DataFrame:
    eps = aod.episode_rows(_inp(spark, sf_dir), P)
    return aod.negative_history(eps, aod.index_episodes(eps))


def neg_history_sql() -> str:
    return S._aod_core() + "\nSELECT member_id FROM neg"


QUERIES = {
    "code_predicate_lines": code_predicate_lines,
    "grouped_code_lines": grouped_code_lines,
    "component_flags": component_flags,
    "claim_rollup": claim_rollup,
    "period_sums": period_sums,
    "period_running_flags": period_running_flags,
    "member_union": member_union,
    "age_buckets": age_buckets,
    "member_months": member_months,
    "visit_rollup": visit_rollup,
    "inpatient_follow": inpatient_follow,
    "denied_claims": denied_claims,
    "recent_dates_text": recent_dates_text,
    "distinct_dates_ge2": distinct_dates_ge2,
    "empirical_end": empirical_end,
    "elig_gaps": elig_gaps,
    "coverage_islands": coverage_islands_q,
    "unmatched_rows": unmatched_rows,
    "diag_lookup": diag_lookup,
    "taxonomy_semi": taxonomy_semi,
    "delivery_groups": delivery_groups,
    "enrollment_segments": enrollment_segments,
    "last_segment": last_segment,
    "two_tag_rows": two_tag_rows,
    "transfer_stays": transfer_stays,
    "index_episode": index_episode,
    "neg_history": neg_history,
}


def ORACLES() -> dict:
    return {
        "code_predicate_lines": code_predicate_lines_sql(),
        "grouped_code_lines": grouped_code_lines_sql(),
        "component_flags": component_flags_sql(),
        "claim_rollup": claim_rollup_sql(),
        "period_sums": period_sums_sql(),
        "period_running_flags": period_running_flags_sql(),
        "member_union": member_union_sql(),
        "age_buckets": age_buckets_sql(),
        "member_months": member_months_sql(),
        "visit_rollup": visit_rollup_sql(),
        "inpatient_follow": inpatient_follow_sql(),
        "denied_claims": denied_claims_sql(),
        "recent_dates_text": recent_dates_text_sql(),
        "distinct_dates_ge2": distinct_dates_ge2_sql(),
        "empirical_end": empirical_end_sql(),
        "elig_gaps": elig_gaps_sql(),
        "coverage_islands": coverage_islands_sql(),
        "unmatched_rows": unmatched_rows_sql(),
        "diag_lookup": diag_lookup_sql(),
        "taxonomy_semi": taxonomy_semi_sql(),
        "delivery_groups": delivery_groups_sql(),
        "enrollment_segments": enrollment_segments_sql(),
        "last_segment": last_segment_sql(),
        "two_tag_rows": two_tag_rows_sql(),
        "transfer_stays": transfer_stays_sql(),
        "index_episode": index_episode_sql(),
        "neg_history": neg_history_sql(),
    }
