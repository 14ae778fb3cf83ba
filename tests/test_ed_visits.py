"""Emergency-department measures: one small scenario per rule, performance year 2031.

Paid through August 2031, so visits from June 1 on are still in run-out.
"""
import datetime as dt

import pytest

from conftest import codes, df
from qmeasures.inputs import ClaimsInputs
from qmeasures.measures.ed_visits import ed_visits_all, ed_visits_mi
from qmeasures.params import MeasureParams

P = MeasureParams.for_year(2031, dt.date(2031, 8, 31))
LIST = """
ed_visits~numer_cpt~CPT~E77~~
ed_visits~numer_rev~UBREV~0911~~
ed_visits~numer_procs~CPT~SUT~er~
ed_visits~numer_procs~POS~3X~er~
ed_visits~numer_excl_mh~ICD10CM-Diag~M10~~Primary
ed_visits~numer_excl_mh~ICD9CM-Diag~M09~~Primary
ed_visits~numer_excl_psych~CPT~PSY~~
ed_visits~numer_excl_ip_stay~UBREV~BED~~
ed_visits~denom_excl_hospice~CPT~HOS~~
ed_visits~denom_excl_hospice~UBREV~0HOS~~
ED_Visits_MI~Denominator~ICD10CM-Diag~S10~~
ED_Visits_MI~Denominator~ICD9CM-Diag~S09~~
"""
COLUMNS = ("member_id string, claimid string, prm_fromdate date, prm_line string, hcpcs string, revcode string, "
           "pos string, icddiag1 string, icddiag2 string, prm_denied_yn string")


def line(claim, date, hcpcs="", rev="", pos="", dx1="", dx2="", kind="O9", denied="N"):
    return (claim, f"2031-{date}" if len(date) == 5 else date, kind, hcpcs, rev, pos, dx1, dx2, denied)


# scenario -> (claim lines, qualifying visits)
SCENARIOS = {
    "code and revenue claims are two visits": ([line("a", "01-04", "E77"), line("b", "01-09", rev="0911")], 2),
    "a claim over two days is one visit": ([line("a", "01-04", "E77"), line("a", "01-05", "E77")], 1),
    "two claims that start on one day are one visit": ([line("a", "01-04", "E77"), line("b", "01-04", rev="0911")], 1),
    "procedure needs its place of service": ([line("a", "01-04", "SUT", pos="3X"), line("b", "01-09", "SUT", pos="4X")], 1),
    "place of service alone is nothing": ([line("a", "01-04", "OTHER", pos="3X")], 0),
    "inpatient stay on the day": ([line("a", "02-10", "E77"), line("b", "02-10", rev="BED")], 0),
    "inpatient stay a day later": ([line("a", "02-10", "E77"), line("b", "02-11", rev="BED")], 0),
    "inpatient stay two days later": ([line("a", "02-10", "E77"), line("b", "02-12", rev="BED")], 1),
    "inpatient stay the day before": ([line("a", "02-10", "E77"), line("b", "02-09", rev="BED")], 1),
    "a denied line drops the visit": ([line("a", "02-10", "E77"), line("a", "02-10", "XX", denied="Y")], 0),
    "a denial of another claim does not": ([line("a", "02-10", "E77"), line("b", "02-17", "XX", denied="Y")], 1),
    "a denied claim of the same first day does": ([line("a", "02-10", "E77"), line("b", "02-10", "E77", denied="Y")], 0),
    "primary mental diagnosis, new version": ([line("a", "02-10", "E77", dx1="M10")], 0),
    "primary mental diagnosis, old version": ([line("a", "02-10", "E77", dx1="M09")], 0),
    "secondary mental diagnosis counts": ([line("a", "02-10", "E77", dx1="Z", dx2="M10")], 1),
    "psychiatry on the claim": ([line("a", "02-10", "E77"), line("a", "02-10", "PSY")], 0),
    "psychiatry on another claim": ([line("a", "02-10", "E77"), line("b", "02-10", "PSY")], 1),
    "inpatient line type": ([line("a", "02-10", "E77", kind="I4")], 0),
    "last day before run-out": ([line("a", "05-31", "E77")], 1),
    "first day of run-out": ([line("a", "06-01", "E77")], 0),
    "visit of the year before": ([line("a", "2030-12-31", "E77")], 0),
    "hospice by code": ([line("a", "02-10", "E77"), line("h", "07-01", "HOS")], None),
    "hospice by revenue code": ([line("a", "02-10", "E77"), line("h", "12-31", rev="0HOS")], None),
    "hospice the year before": ([line("a", "02-10", "E77"), line("h", "2030-12-31", "HOS")], 1),
    "no claims": ([], 0),
}
# member months: scenario by name, else January to March
MONTHS = {
    "no cover": [("2031-01-01", "N")],
    "months in run-out do not count": [("2031-05-01", "Y"), ("2031-06-01", "Y"), ("2031-07-01", "Y")],
    "months of another year do not count": [("2030-12-01", "Y"), ("2031-01-01", "Y"), ("2032-01-01", "Y")],
}


def inputs(spark, scenarios=SCENARIOS, predictions=None):
    names = [*scenarios, *MONTHS]
    months = [(n, d, 1.0, c) for n in names
              for d, c in MONTHS.get(n, [(f"2031-0{m}-01", "Y") for m in (1, 2, 3)])]
    return ClaimsInputs(
        member=df(spark, [(n, "1985-05-05") for n in names], "member_id string, dob date"),
        member_months=df(spark, months, "member_id string, elig_month date, memmos double, cover_medical string"),
        outclaims=df(spark, [(n, *x) for n, (lines, _) in scenarios.items() for x in lines], COLUMNS),
        predictions=predictions, oha_codes=codes(spark, LIST))


@pytest.fixture(scope="module")
def result(spark):
    return {r["member_id"]: r for r in ed_visits_all(inputs(spark), P).collect()}


@pytest.mark.parametrize("name", SCENARIOS)
def test_visits_and_member_months(result, name):
    visits = SCENARIOS[name][1]
    row = result[name]
    want = (0.0, 0.0) if visits is None else (float(visits), 0.003)  # hospice leaves the measure
    assert (row["numerator"], round(row["denominator"], 6)) == want


def test_month_rules(result):
    assert "no cover" not in result
    assert result["months in run-out do not count"]["denominator"] == 0.001
    assert result["months of another year do not count"]["denominator"] == 0.001


def test_comments(spark, result):
    assert result["first day of run-out"]["comments"] == "Recent Visit(s):  06/01/2031 (will qualify soon)"
    assert result["hospice by code"]["comments"] == "Excluded due to hospice status"
    assert result["visit of the year before"]["comments"] == "Most Recent Visit: 12/31/2030"
    assert result["no claims"]["comments"] is None
    five = {"five": ([line(str(k), f"03-0{k}", "E77") for k in range(1, 6)], 5)}
    row = [r for r in ed_visits_all(inputs(spark, five), P).collect() if r["member_id"] == "five"][0]
    assert row["numerator"] == 5.0
    assert row["comments"] == "Recent Visit(s):  03/05/2031, 03/04/2031, 03/03/2031"


def test_predictions(spark):
    some = {"likely, no visit": ([], 0), "half, no visit": ([], 0), "just below, no visit": ([], 0),
            "quarter, one visit": ([line("a", "01-04", "E77")], 1), "less, one visit": ([line("a", "01-04", "E77")], 1),
            "no score": ([], 0)}
    scores = [("likely, no visit", 0.905), ("half, no visit", 0.5), ("half, no visit", 0.1), ("just below, no visit", 0.49),
              ("quarter, one visit", 0.25), ("less, one visit", 0.24)]
    frame = df(spark, scores, "member_id string, er_visits_pred_prob double")
    rows = {r["member_id"]: r for r in ed_visits_all(inputs(spark, some, frame), P).collect()}
    end = dt.date(2031, 12, 31)
    assert {n: rows[n]["comp_quality_date_actionable"] for n in some} == {
        "likely, no visit": end, "half, no visit": end, "just below, no visit": None, "quarter, one visit": end,
        "less, one visit": None, "no score": None}
    assert rows["likely, no visit"]["comments"] == "Probability of ED Visit Next 6 Months: 91%"
    assert rows["quarter, one visit"]["comments"] == "Recent Visit(s):  01/04/2031"
    assert rows["no score"]["comments"] is None


# member -> (birth date, diagnosis rows (date, dx1, dx2), in the subset)
MI = {
    "two dates, both versions": ("1980-02-02", [("2030-03-01", "S10", ""), ("2031-03-02", "", "S09")], True),
    "one date twice": ("1980-02-02", [("2031-03-01", "S10", ""), ("2031-03-01", "S09", "")], False),
    "one date": ("1980-02-02", [("2031-03-01", "S10", "")], False),
    "first day inside 36 months": ("1980-02-02", [("2029-01-01", "S10", ""), ("2031-03-02", "S10", "")], True),
    "last day outside 36 months": ("1980-02-02", [("2028-12-31", "S10", ""), ("2031-03-02", "S10", "")], False),
    "last day of the year is outside": ("1980-02-02", [("2031-12-31", "S10", ""), ("2031-03-02", "S10", "")], False),
    "turns 18 on the last day": ("2013-12-31", [("2031-03-01", "S10", ""), ("2031-03-02", "S10", "")], True),
    "turns 18 a day too late": ("2014-01-01", [("2031-03-01", "S10", ""), ("2031-03-02", "S10", "")], False),
    "no result to take over": ("1980-02-02", [("2031-03-01", "S10", ""), ("2031-03-02", "S10", "")], False),
}


def test_mental_illness_subset(spark):
    given = [(n, 3.0, 0.004, f"text of {n}", "") for n in MI if n != "no result to take over"]
    roster = [(n, b) for n, (b, _, _) in MI.items()]
    inp = ClaimsInputs(
        member=df(spark, roster + roster[:3], "member_id string, dob date"),  # members listed twice count once
        outclaims=df(spark, [(n, *r) for n, (_, rows, _) in MI.items() for r in rows],
                     "member_id string, prm_fromdate date, icddiag1 string, icddiag2 string"),
        oha_codes=codes(spark, LIST))
    all_ed = df(spark, given, "member_id string, numerator double, denominator double, comments string, "
                              "comp_quality_date_actionable date")
    rows = ed_visits_mi(inp, P, ed_all=all_ed).collect()
    assert sorted(r["member_id"] for r in rows) == sorted(n for n, (_, _, inside) in MI.items() if inside)
    assert all((r["numerator"], r["denominator"], r["comments"]) == (3.0, 0.004, f"text of {r['member_id']}") for r in rows)
