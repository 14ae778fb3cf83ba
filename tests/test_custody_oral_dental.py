"""Custody assessments, oral evaluation and preventive dental: one scenario per rule."""
import datetime as dt

import pytest

from conftest import codes, df
from qmeasures.functions.codes import CodeTableError
from qmeasures.inputs import ClaimsInputs
from qmeasures.measures.custody import dhs_assessments
from qmeasures.measures.dental import dental_long, prev_dental_1_to_5
from qmeasures.measures.oral_eval import oral_eval
from qmeasures.params import MeasureParams
from qmeasures.sources.mappings import default_components

# --- custody: notified on 10 April 2030, so day -30 is 11 March and day 60 is 9 June --------------

NOTICE = dt.date(2030, 4, 10)
P = MeasureParams.for_year(2030, dt.date(2031, 1, 31), empirical_elig_date_end=dt.date(2030, 12, 31))
LIST = """
DHS_assessments~Numerator_Physical~CPT~BODY~~
DHS_assessments~Numerator_Physical~CPT~BOTH~~
DHS_assessments~Numerator_Mental~CPT~MIND~~
DHS_assessments~Numerator_Mental~CPT~MPAIR~pair~
DHS_assessments~Numerator_Mental~MODIFIER~MM~pair~
DHS_assessments~Numerator_PRTS~CPT~HOME~place~
DHS_assessments~Numerator_PRTS~POS~56~place~
DHS_assessments~Numerator_Dental~CDT~TOOTH~~
DHS_assessments~Numerator_PhysMent~CPT~BOTH~joint~
DHS_assessments~Numerator_PhysMent~ICD9CM-Diag~MD9~joint~
DHS_assessments~Numerator_PhysMent~ICD10CM-Diag~MD10~joint~
"""
TEN = "2019-06-01"      # ten years old when notified
TWO = "2028-01-01"
BABY = "2029-12-01"


def day(n):
    return str(NOTICE + dt.timedelta(days=n))


def seen(n, code, modifier="", pos="", version="10", dx2=""):
    return (day(n), code, modifier, pos, version, dx2)


def teeth(n, code="TOOTH"):
    return (day(n), code)


ALL = [seen(5, "BODY"), seen(6, "MIND"), seen(7, "TOOTH")]
YEARS = [("2029-01-01", "2030-12-31")]
# scenario -> (birth date, spans, claims, dental lines, (denominator, numerator) or None)
CUSTODY = {
    "all three": (TEN, YEARS, ALL, [], (1, 1)),
    "nothing": (TEN, YEARS, [], [], (1, 0)),
    "no physical": (TEN, YEARS, ALL[1:], [], (1, 0)),
    "no mental": (TEN, YEARS, [ALL[0], ALL[2]], [], (1, 0)),
    "no dental": (TEN, YEARS, ALL[:2], [], (1, 0)),
    "mental by code and modifier": (TEN, YEARS, [seen(5, "BODY"), seen(6, "MPAIR", "MM"), seen(7, "TOOTH")], [], (1, 1)),
    "mental code without its modifier": (TEN, YEARS, [seen(5, "BODY"), seen(6, "MPAIR", "XX"), seen(7, "TOOTH")], [], (1, 0)),
    "residential stay is body and mind": (TEN, YEARS, [seen(5, "HOME", pos="56"), seen(7, "TOOTH")], [], (1, 1)),
    "residential code elsewhere": (TEN, YEARS, [seen(5, "HOME", pos="11"), seen(7, "TOOTH")], [], (1, 0)),
    "day -30 and day 60": (TEN, YEARS, [seen(-30, "BODY"), seen(60, "MIND"), seen(60, "TOOTH")], [], (1, 1)),
    "day -31": (TEN, YEARS, [seen(-31, "BODY"), seen(6, "MIND"), seen(7, "TOOTH")], [], (1, 0)),
    "day 61": (TEN, YEARS, [seen(5, "BODY"), seen(61, "MIND"), seen(7, "TOOTH")], [], (1, 0)),
    "two-year-old needs no mental": (TWO, YEARS, [seen(5, "BODY"), seen(7, "TOOTH")], [], (1, 1)),
    "two-year-old needs dental": (TWO, YEARS, [seen(5, "BODY")], [], (1, 0)),
    "baby needs physical alone": (BABY, YEARS, [seen(5, "BODY")], [], (1, 1)),
    "fourth birthday on the day": ("2026-04-10", YEARS, [seen(5, "BODY"), seen(7, "TOOTH")], [], (1, 0)),
    "first birthday on the day": ("2029-04-10", YEARS, [seen(5, "BODY")], [], (1, 0)),
    "seventeen": ("2012-04-11", YEARS, ALL, [], (1, 1)),
    "eighteen on the day": ("2012-04-10", YEARS, ALL, [], None),
    "dental table": (TEN, YEARS, ALL[:2], [teeth(60)], (1, 1)),
    "dental table, day 61": (TEN, YEARS, ALL[:2], [teeth(61)], (1, 0)),
    "dental table, another code": (TEN, YEARS, ALL[:2], [teeth(7, "BODY")], (1, 0)),
    "joint visit, new version": (TEN, YEARS, [seen(5, "BOTH", dx2="MD10")], [teeth(7)], (1, 1)),
    "joint visit, old version": (TEN, YEARS, [seen(5, "BOTH", version="09", dx2="MD9")], [teeth(7)], (1, 1)),
    "joint visit, wrong version": (TEN, YEARS, [seen(5, "BOTH", dx2="MD9")], [teeth(7)], (1, 0)),
    "joint visit outside the window counts": (TEN, YEARS, [seen(200, "BOTH", dx2="MD10")], [teeth(7)], (1, 1)),
    "cover ends on day 60": (TEN, [("2029-01-01", day(60))], ALL, [], (1, 1)),
    "cover ends on day 59": (TEN, [("2029-01-01", day(59))], ALL, [], None),
    "cover starts late, assessed": (TEN, [(day(4), "2030-12-31")], ALL, [], (1, 1)),
    "cover starts late, not assessed": (TEN, [(day(4), "2030-12-31")], [], [], (0, 0)),
}
# scenario -> (branch code, eligibility date, report date) where they differ
NOTICES = {"moved to guardianship": ("6050", day(0), day(0)), "adopted": ("0060", day(0), day(0)),
           "another branch": ("1234", day(0), day(0)), "eligible 30 days before": ("", day(-30), day(0)),
           "eligible 31 days before": ("", day(-31), day(0))}
CUSTODY |= {n: (TEN, YEARS, ALL, [], None if n in ("moved to guardianship", "adopted", "eligible 31 days before") else (1, 1))
            for n in NOTICES}


def custody(spark, scenarios, with_table=True, listed=LIST, notes=True):
    notice = [(n, NOTICES.get(n, ("", day(0), day(0)))[2], s[0], *NOTICES.get(n, ("", day(0)))[:2])
              for n, s in scenarios.items()] if notes else []
    return ClaimsInputs(
        member=df(spark, [(n, s[0]) for n, s in scenarios.items()], "member_id string, dob date"),
        member_time=df(spark, [(n, *x) for n, s in scenarios.items() for x in s[1]],
                       "member_id string, date_start date, date_end date"),
        outclaims=df(spark, [(n, *c) for n, s in scenarios.items() for c in s[2]],
                     "member_id string, prm_fromdate date, hcpcs string, modifier2 string, pos string, icdversion string, "
                     "icddiag2 string").selectExpr("*", "'' as modifier", "'' as icddiag1"),
        inpdental=df(spark, [(n, *c) for n, s in scenarios.items() for c in s[3]],
                     "member_id string, fromdate date, hcpcs string") if with_table else None,
        foster_care=df(spark, notice, "member_id string, report_date date, dob date, branch_code string, "
                                      "eligibility_effective_date date"),
        oha_codes=codes(spark, listed))


@pytest.fixture(scope="module")
def children(spark):
    return {r["member_id"]: r for r in dhs_assessments(custody(spark, CUSTODY), P).collect()}


@pytest.mark.parametrize("name", CUSTODY)
def test_custody(children, name):
    want, got = CUSTODY[name][4], children.get(name)
    assert (got and (got["denominator"], got["numerator"])) == (want and tuple(map(float, want)))


def test_custody_without_dental_table(spark):
    some = {n: s for n, s in CUSTODY.items() if not s[3]}
    some["joint visit"] = (TEN, YEARS, [seen(5, "BOTH", dx2="MD10"), seen(7, "TOOTH")], [], (1, 0))  # no joint rule then
    got = {r["member_id"]: (r["denominator"], r["numerator"]) for r in dhs_assessments(custody(spark, some, False), P).collect()}
    assert got == {n: tuple(map(float, s[4])) for n, s in some.items() if s[4]}


def test_custody_text_and_empty(spark, children):
    assert children["all three"]["comments"] == "DHS Notification Date: 04/10/2030; Assessment period ended"
    early = MeasureParams.for_year(2030, dt.date(2030, 5, 31), empirical_elig_date_end=dt.date(2030, 12, 31))
    rows = {r["member_id"]: r for r in dhs_assessments(custody(spark, {n: CUSTODY[n] for n in ("all three", "nothing")}), early)
            .collect()}
    assert rows["nothing"]["comments"] == "DHS Notification Date: 04/10/2030; Assessment period ends 06/09/2030"
    assert rows["nothing"]["comp_quality_date_actionable"] == dt.date(2030, 6, 9)
    assert rows["all three"]["comp_quality_date_actionable"] is None
    assert dhs_assessments(custody(spark, {"nothing": CUSTODY["nothing"]}, notes=False), P).count() == 0


def test_custody_lookup_key_must_be_unique(spark):
    for again in ("DHS_assessments~Numerator_PhysMent~ICD10CM-Diag~MD10~joint~", "DHS_assessments~Numerator_PhysMent~ICD10CM-Diag~MD10~x~"):
        with pytest.raises(CodeTableError, match="more than once"):
            dhs_assessments(custody(spark, {"nothing": CUSTODY["nothing"]}, listed=LIST + again), P)


def test_custody_many_equal_lines(spark):
    """One member with 100,000 equal lines: they fold into one before the join with the notification."""
    inp = custody(spark, {"all three": CUSTODY["all three"]})
    crowd = inp.outclaims.crossJoin(spark.range(40_000).select()).unionByName(inp.outclaims)
    rows = dhs_assessments(inp.with_(outclaims=crowd), P).collect()
    assert [(r["denominator"], r["numerator"]) for r in rows] == [(1.0, 1.0)]


# --- oral evaluation of adults with diabetes: performance year 2030 ------------------------------

SWEET = """
diabetes_oral_eval~acute_inpatient~CPT~WARD~~
diabetes_oral_eval~outpatient~CPT~DESK~~
diabetes_oral_eval~nonacute_inpatient~CPT~CARE~~
diabetes_oral_eval~observation~CPT~WATCH~~
diabetes_oral_eval~telephone_visits~CPT~CALL~~
diabetes_oral_eval~online_assessments~CPT~WEB~~
diabetes_oral_eval~hospice_intervention~CPT~REST~~
diabetes_oral_eval~frailty_encounter~CPT~FRAIL~~
diabetes_oral_eval~telehealth_modifier~MODIFIER~TM~~
diabetes_oral_eval~telehealth_pos~POS~T9~~
diabetes_oral_eval~diabetes~ICD10CM-Diag~DIA~~
diabetes_oral_eval~diabetes_exclusions~ICD10CM-Diag~TMP~~
diabetes_oral_eval~advanced_illness~ICD10CM-Diag~ADV~~
"""
PILLS = "diabetes_oral_eval~diabetes_medications~NDC~11~~\ndiabetes_oral_eval~dementia_medications~NDC~22~~"
ADULT, OLD, NOT_YET = "1991-07-07", "1964-12-31", "1965-01-01"   # the last two: 66 and 65 at the end of 2030


def care(date, code, dx="DIA", modifier2="", pos="", claim=None):
    return (claim or f"{date}{code}{dx}", date, code, dx, modifier2, pos)


WARD = care("2030-03-03", "WARD")
HALVES = [("2030-01-01", "2030-06-30"), ("2030-07-01", "2030-12-31")]
# scenario -> (birth date, spans, claims, pills (date, ndc), dental (date, code), (denominator, numerator) or None)
ORAL = {
    "one stay": (ADULT, HALVES, [WARD], [], [], (1, 0)),
    "one stay the year before": (ADULT, HALVES, [care("2029-01-01", "WARD")], [], [], (1, 0)),
    "two years before": (ADULT, HALVES, [care("2028-12-31", "WARD")], [], [], None),
    "one office visit": (ADULT, HALVES, [care("2030-02-02", "DESK")], [], [], None),
    "two office visits": (ADULT, HALVES, [care("2030-02-02", "DESK"), care("2030-02-09", "DESK")], [], [], (1, 0)),
    "two claims of one day": (ADULT, HALVES, [care("2030-02-02", "DESK"), care("2030-02-02", "WATCH")], [], [], (1, 0)),
    "one in each year": (ADULT, HALVES, [care("2029-02-02", "DESK"), care("2030-02-02", "DESK")], [], [], None),
    "visit and diagnosis on two claims": (ADULT, HALVES, [care("2030-02-02", "WARD", ""), care("2030-02-02", "NONE")], [], [], None),
    "visit and diagnosis on two lines": (ADULT, HALVES, [care("2030-02-02", "WARD", "", claim="c"), care("2030-02-02", "NONE", claim="c")],
                                         [], [], (1, 0)),
    "stay by telehealth": (ADULT, HALVES, [care("2030-03-03", "WARD", modifier2="TM")], [], [], None),
    "office visits by telehealth": (ADULT, HALVES, [care("2030-02-02", "DESK", pos="T9"), care("2030-02-09", "DESK", pos="T9")], [], [], None),
    "one of each": (ADULT, HALVES, [care("2030-02-02", "DESK", pos="T9"), care("2030-02-09", "DESK")], [], [], (1, 0)),
    "office and call": (ADULT, HALVES, [care("2030-02-02", "CALL"), care("2030-02-09", "CARE")], [], [], (1, 0)),
    "office and web": (ADULT, HALVES, [care("2030-02-02", "WEB"), care("2030-02-09", "DESK")], [], [], (1, 0)),
    "calls alone": (ADULT, HALVES, [care("2030-02-02", "CALL"), care("2030-02-09", "WEB")], [], [], None),
    "pill": (ADULT, HALVES, [], [("2030-02-02", "11")], [], (1, 0)),
    "pill the year before": (ADULT, HALVES, [], [("2029-01-01", "11")], [], (1, 0)),
    "pill too early": (ADULT, HALVES, [], [("2028-12-31", "11")], [], None),
    "temporary diabetes only": (ADULT, HALVES, [care("2030-02-02", "NONE", "TMP")], [("2030-02-02", "11")], [], None),
    "temporary and real": (ADULT, HALVES, [care("2030-02-02", "NONE", "TMP"), care("2030-05-05", "NONE")], [("2030-02-02", "11")], [], (1, 0)),
    "temporary, rows in both years": (ADULT, HALVES, [care("2029-02-02", "NONE", "TMP"), care("2030-02-02", "NONE", "TMP")],
                                      [("2030-02-02", "11")], [], (1, 0)),  # the counter is not carried over
    "turns 18 on the last day": ("2012-12-31", HALVES, [WARD], [], [], (1, 0)),
    "turns 18 a day too late": ("2013-01-01", HALVES, [WARD], [], [], None),
    "evaluated": (ADULT, HALVES, [WARD], [], [("2030-12-31", "D0120")], (1, 1)),
    "evaluated the year before": (ADULT, HALVES, [WARD], [], [("2029-12-31", "D0120")], (1, 0)),
    "another dental code": (ADULT, HALVES, [WARD], [], [("2030-12-31", "D9999")], (1, 0)),
    "gap of 45 days": (ADULT, [("2030-01-01", "2030-06-30"), ("2030-08-15", "2030-12-31")], [WARD], [], [], (1, 0)),
    "gap of 46 days": (ADULT, [("2030-01-01", "2030-06-30"), ("2030-08-16", "2030-12-31")], [WARD], [], [], None),
    "two short gaps": (ADULT, [("2030-01-01", "2030-03-30"), ("2030-04-01", "2030-06-29"), ("2030-07-01", "2030-12-31")], [WARD], [], [], None),
    "hospice": (ADULT, HALVES, [WARD, care("2030-04-04", "REST", "")], [], [], None),
    "hospice the year before": (ADULT, HALVES, [WARD, care("2029-04-04", "REST", "")], [], [], (1, 0)),
    "frail with one ill stay": (OLD, HALVES, [WARD, care("2030-04-04", "FRAIL", ""), care("2029-04-04", "WARD", "ADV")], [], [], None),
    "frail with one ill office visit": (OLD, HALVES, [WARD, care("2030-04-04", "FRAIL", ""), care("2029-04-04", "DESK", "ADV")], [], [], (1, 0)),
    "frail with two ill office visits": (OLD, HALVES, [WARD, care("2030-04-04", "FRAIL", ""), care("2029-04-04", "DESK", "ADV"),
                                                       care("2030-04-05", "DESK", "ADV")], [], [], None),
    "frail with a dementia pill": (OLD, HALVES, [WARD, care("2030-04-04", "FRAIL", "")], [("2029-05-05", "22")], [], None),
    "frail the year before": (OLD, HALVES, [WARD, care("2029-04-04", "FRAIL", "")], [("2029-05-05", "22")], [], (1, 0)),
    "frail at 65": (NOT_YET, HALVES, [WARD, care("2030-04-04", "FRAIL", ""), care("2030-04-05", "WARD", "ADV")], [], [], (1, 0)),
}


@pytest.fixture(scope="module")
def evaluated(spark):
    rows = lambda k: [(n, *x) for n, s in ORAL.items() for x in s[k]]
    inp = ClaimsInputs(
        member=df(spark, [(n, s[0]) for n, s in ORAL.items()], "member_id string, dob date"),
        member_time=df(spark, rows(1), "member_id string, date_start date, date_end date"),
        outclaims=df(spark, rows(2), "member_id string, claimid string, prm_fromdate date, hcpcs string, icddiag3 string, "
                                     "modifier2 string, pos string").selectExpr(
            "*", "'' as icddiag1", "'' as icddiag2", "'' as revcode", "'' as modifier"),
        outpharmacy=df(spark, rows(3), "member_id string, prm_fromdate date, ndc string"),
        inpdental=df(spark, rows(4), "member_id string, fromdate date, hcpcs string"),
        hedis_codes=codes(spark, SWEET), medications=codes(spark, PILLS),
        oha_codes=codes(spark, "diabetes_oral_eval~numerator~CDT~D0120~~"), components=default_components(spark))
    return {r["member_id"]: r for r in oral_eval(inp, MeasureParams.for_year(2030, dt.date(2031, 3, 31))).collect()}


@pytest.mark.parametrize("name", ORAL)
def test_oral_evaluation(evaluated, name):
    want, got = ORAL[name][5], evaluated.get(name)
    assert (got and (got["denominator"], got["numerator"])) == (want and tuple(map(float, want)))
    assert got is None or (got["comments"], got["comp_quality_date_actionable"]) == (None, None)


# --- preventive dental: performance year 2030 ------------------------------------------------------

DRILL = """
dental_services~diagnostic_dental~CDT~LOOK~~
dental_services~preventive_dental~CDT~CLEAN~~
dental_services~dental_treatment~CDT~FILL~~
"""
# scenario -> (birth date, spans, claims (date, provider, code), bucket or None, services found)
DENTAL = {
    "cleaned": ("2027-02-02", HALVES, [("2030-05-05", "dentist", "CLEAN")], "1_to_5", {"prev", "any"}),
    "looked at": ("2027-02-02", HALVES, [("2030-05-05", "dentist", "LOOK")], "1_to_5", {"diag", "any"}),
    "filled": ("2020-02-02", HALVES, [("2030-05-05", "dentist", "FILL")], "6_to_14", {"treat", "any"}),
    "all three": ("1980-02-02", HALVES, [("2030-05-05", "dentist", c) for c in ("LOOK", "CLEAN", "FILL")], "26_to_65",
                  {"diag", "prev", "treat", "any"}),
    "another code": ("2027-02-02", HALVES, [("2030-05-05", "dentist", "PULL")], "1_to_5", set()),
    "not a dentist": ("2027-02-02", HALVES, [("2030-05-05", "doctor", "CLEAN")], "1_to_5", set()),
    "unknown provider": ("2027-02-02", HALVES, [("2030-05-05", "nobody", "CLEAN")], "1_to_5", set()),
    "first and last day": ("2027-02-02", HALVES, [("2030-01-01", "dentist", "LOOK"), ("2030-12-31", "dentist", "FILL")], "1_to_5",
                           {"diag", "treat", "any"}),
    "the year before": ("2027-02-02", HALVES, [("2029-12-31", "dentist", "CLEAN")], "1_to_5", set()),
    "180 days of cover": ("2027-02-02", [("2030-03-01", "2030-08-27")], [], "1_to_5", set()),
    "179 days of cover": ("2027-02-02", [("2030-03-01", "2030-08-26")], [], None, set()),
    "broken cover": ("2027-02-02", [("2030-01-01", "2030-05-31"), ("2030-06-02", "2030-10-31")], [], None, set()),
    "overlapping spans do not add up": ("2027-02-02", [("2030-01-01", "2030-05-31"), ("2030-05-31", "2030-10-31")], [], None, set()),
    "adjacent spans do": ("2027-02-02", [("2030-01-01", "2030-05-31"), ("2030-06-01", "2030-06-29")], [], "1_to_5", set()),
    **{f"age {a}": (f"{2030 - a}-12-31", HALVES, [], b, set()) for a, b in (
        (0, "0-1"), (1, "1_to_5"), (5, "1_to_5"), (6, "6_to_14"), (14, "6_to_14"), (15, "15_to_17"), (17, "15_to_17"),
        (18, "18_to_25"), (25, "18_to_25"), (26, "26_to_65"), (65, "26_to_65"), (66, "65+"))},
}


@pytest.fixture(scope="module")
def dental_inputs(spark):
    return ClaimsInputs(
        member=df(spark, [(n, s[0]) for n, s in DENTAL.items()], "member_id string, dob date"),
        member_time=df(spark, [(n, *x) for n, s in DENTAL.items() for x in s[1]],
                       "member_id string, date_start date, date_end date"),
        outclaims=None,
        inpdental=df(spark, [(n, *x) for n, s in DENTAL.items() for x in s[2]],
                     "member_id string, fromdate date, providerid string, hcpcs string"),
        providers=df(spark, [("dentist", "TAXD"), ("doctor", "TAXM")], "prv_id string, prv_taxonomy_cd string"),
        dental_taxonomy=df(spark, [("TAXD",)], "taxonomy_code string"), oha_codes=codes(spark, DRILL))


def test_dental_long_form(dental_inputs):
    rows = dental_long(dental_inputs, MeasureParams.for_year(2030, dt.date(2031, 3, 31))).collect()
    got = {(r["member_id"], r["measure"]): (r["denominator"], r["numerator"]) for r in rows}
    assert len(got) == len(rows)
    assert got == {(n, f"{kind}_dental_{s[3]}"): (1, int(kind in s[4])) for n, s in DENTAL.items() if s[3]
                   for kind in ("any", "diag", "prev", "treat")}


def test_dental_published(spark, dental_inputs):
    p = MeasureParams.for_year(2030, dt.date(2031, 3, 31))
    rows = {r["member_id"]: r for r in prev_dental_1_to_5(dental_inputs, p).collect()}
    assert set(rows) == {n for n, s in DENTAL.items() if s[3] == "1_to_5"}
    assert rows["cleaned"]["numerator"] == 1.0 and rows["cleaned"]["comp_quality_date_actionable"] is None
    assert rows["filled" if "filled" in rows else "looked at"]["comp_quality_date_actionable"] == dt.date(2030, 12, 31)
    # paid through March 2030: 89 days can have passed, so 89 days of cover are enough
    short = MeasureParams.for_year(2030, dt.date(2030, 3, 31))
    assert {"179 days of cover", "broken cover"} <= {r["member_id"] for r in prev_dental_1_to_5(dental_inputs, short).collect()}
    assert prev_dental_1_to_5(dental_inputs.with_(inpdental=None), p).count() == 0
