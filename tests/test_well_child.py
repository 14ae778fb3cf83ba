"""Well-child visits: one scenario per rule, performance year 2033."""
import datetime as dt

import pytest

from conftest import codes, df
from qmeasures.inputs import ClaimsInputs
from qmeasures.measures.well_child import well_child_visits
from qmeasures.params import MeasureParams

LIST = """
well_child_visits~well_care~CPT~WELL~~
well_child_visits~well_care~ICD10CM-Diag~Z33~~
well_child_visits~telehealth_modifier~Modifier~TM~~
well_child_visits~telehealth_pos~POS~T9~~
well_child_visits~hospice_encounter~UBREV~0HSP~~
well_child_visits~hospice_intervention~CPT~HSPI~~
"""
FOUR = "2029-05-20"                               # four years old at the end of 2033
WHOLE = [("2033-01-01", "2033-12-31")]
VISIT = ("2033-06-15", "WELL", "", "", "", "", "N")   # date, hcpcs, revcode, dx2, modifier2, pos, denied


def visit(date="2033-06-15", hcpcs="", rev="", dx2="", modifier2="", pos="", denied="N"):
    return (date, hcpcs, rev, dx2, modifier2, pos, denied)


# scenario -> (birth date, spans, claims, (denominator, numerator) or None)
SCENARIOS = {
    "plain": (FOUR, WHOLE, [VISIT], (1, 1)),
    "turns three on the last day": ("2030-12-31", WHOLE, [VISIT], (1, 1)),
    "turns three a day too late": ("2031-01-01", WHOLE, [VISIT], None),
    "still six on the last day": ("2027-01-01", WHOLE, [VISIT], (1, 1)),
    "turns seven on the last day": ("2026-12-31", WHOLE, [VISIT], None),
    "gap of 45 days": (FOUR, [("2032-07-01", "2033-03-31"), ("2033-05-16", "2034-01-31")], [VISIT], (1, 1)),
    "gap of 46 days": (FOUR, [("2032-07-01", "2033-03-31"), ("2033-05-17", "2034-01-31")], [VISIT], None),
    "two gaps of a day": (FOUR, [("2033-01-01", "2033-03-31"), ("2033-04-02", "2033-08-31"), ("2033-09-02", "2033-12-31")],
                          [VISIT], None),
    "adjacent spans are no gap": (FOUR, [("2033-01-01", "2033-03-31"), ("2033-04-01", "2033-08-31"), ("2033-09-02", "2033-12-31")],
                                  [VISIT], (1, 1)),
    "late start within 45 days": (FOUR, [("2033-02-15", "2033-12-31")], [VISIT], (1, 1)),
    "no cover in the year": (FOUR, [("2032-01-01", "2032-12-31")], [VISIT], None),
    "by diagnosis in second place": (FOUR, WHOLE, [visit(dx2="Z33")], (1, 1)),
    "denied visits count": (FOUR, WHOLE, [visit(hcpcs="WELL", denied="Y")], (1, 1)),
    "visit by modifier is telehealth": (FOUR, WHOLE, [visit(hcpcs="WELL", modifier2="TM")], (1, 0)),
    "visit by place is telehealth": (FOUR, WHOLE, [visit(hcpcs="WELL", pos="T9")], (1, 0)),
    "first day of the year": (FOUR, WHOLE, [visit("2033-01-01", "WELL")], (1, 1)),
    "last day of the year": (FOUR, WHOLE, [visit("2033-12-31", "WELL")], (1, 1)),
    "the year before": (FOUR, WHOLE, [visit("2032-12-31", "WELL")], (1, 0)),
    "another code": (FOUR, WHOLE, [visit(hcpcs="OTHER")], (1, 0)),
    "no claims": (FOUR, WHOLE, [], (1, 0)),
    "hospice code": (FOUR, WHOLE, [visit(hcpcs="HSPI")], (0, 0)),
    "hospice revenue code and a visit": (FOUR, WHOLE, [VISIT, visit(rev="0HSP")], (0, 1)),
    "hospice the year before": (FOUR, WHOLE, [VISIT, visit("2032-12-31", "HSPI")], (1, 1)),
}


def inputs(spark):
    return ClaimsInputs(
        member=df(spark, [(n, s[0]) for n, s in SCENARIOS.items()], "member_id string, dob date"),
        member_time=df(spark, [(n, *x) for n, s in SCENARIOS.items() for x in s[1]],
                       "member_id string, date_start date, date_end date"),
        outclaims=df(spark, [(n, *c) for n, s in SCENARIOS.items() for c in s[2]],
                     "member_id string, fromdate date, hcpcs string, revcode string, icddiag2 string, modifier2 string, "
                     "pos string, prm_denied_yn string").selectExpr("*", "'' as icddiag1", "'' as modifier"),
        hedis_codes=codes(spark, LIST))


def run(spark, **kw):
    p = MeasureParams.for_year(2033, dt.date(2034, 3, 31), **kw)
    return {r["member_id"]: r for r in well_child_visits(inputs(spark), p).collect()}


@pytest.fixture(scope="module")
def rows(spark):
    return run(spark, empirical_elig_date_end=dt.date(2033, 12, 31))


@pytest.mark.parametrize("name", SCENARIOS)
def test_scenario(rows, name):
    want = SCENARIOS[name][3]
    got = rows.get(name)
    assert (got and (got["denominator"], got["numerator"])) == (want and tuple(map(float, want)))


def test_text_and_actionable_date(rows):
    assert rows["plain"]["comments"] == "Most recent visit performed 06/15/2033"
    assert rows["the year before"]["comments"] == "Most recent visit performed 12/31/2032 (not in performance year)"
    assert rows["no claims"]["comments"] == "No qualifying visit"
    assert rows["hospice code"]["comments"] == "Excluded due to hospice status"
    assert rows["no claims"]["comp_quality_date_actionable"] == dt.date(2033, 12, 31)
    assert rows["plain"]["comp_quality_date_actionable"] is None


def test_eligibility_end(spark, rows):
    later = run(spark, empirical_elig_date_end=dt.date(2034, 2, 28))      # never beyond the year
    assert set(later) == set(rows)
    cut = run(spark, empirical_elig_date_end=dt.date(2033, 8, 31))        # the second one-day gap lies behind
    assert "two gaps of a day" in cut and "gap of 46 days" not in cut
    assert set(run(spark)) == set(rows)                                   # no date shared by 42 members: the year's end
