"""Prenatal / postpartum care and alcohol-drug treatment: one scenario per rule, year 2032."""
import datetime as dt

import pytest

from conftest import codes, df
from qmeasures.functions.codes import CodeTableError
from qmeasures.inputs import ClaimsInputs
from qmeasures.measures.aod import aod_engage, aod_init
from qmeasures.measures.prenatal import prenatal_postpartum_long
from qmeasures.params import MeasureParams
from qmeasures.sources.mappings import default_components

P = MeasureParams.for_year(2032, dt.date(2033, 2, 28), empirical_elig_date_end=dt.date(2032, 12, 31))
MOTHER = """
prenatal_postpartum_care~deliveries~CPT~BORN~~
prenatal_postpartum_care~deliveries~ICD10CM-Proc~BPROC~~
prenatal_postpartum_care~non_live_births~ICD10CM-Diag~LOSS~~
prenatal_postpartum_care~pregnancy_diagnosis~ICD10CM-Diag~PREG~~
prenatal_postpartum_care~prenatal_visits~CPT~PRE~~
prenatal_postpartum_care~prenatal_bundled~CPT~PREB~~
prenatal_postpartum_care~postpartum_visits~CPT~POST~~
prenatal_postpartum_care~hospice_intervention~HCPCS~REST~~
prenatal_postpartum_care~acute_inpatient_pos~POS~IP~~
"""
BIRTH = dt.date(2032, 5, 10)
LONG = [("2030-01-01", "2033-12-31", "Y")]
NEW = [("2030-01-01", "2031-06-30", "Y"), ("2032-01-01", "2033-12-31", "Y")]   # 130 days before the birth


def on(days, code, dx="", dx3="", pos="", version="10", proc="", length=0):
    """A claim ``days`` from the birth."""
    end = BIRTH + dt.timedelta(days=days)
    return (str(end - dt.timedelta(days=length)), str(end), code, pos, version, dx, dx3, proc)


BORN = on(0, "BORN")
# scenario -> (spans, claims, (denominator, prenatal, postpartum) or None)
DELIVERIES = {
    "birth alone": (LONG, [BORN], (1, 0, 0)),
    "birth by procedure in last place": (LONG, [on(0, "", proc="BPROC")], (1, 0, 0)),
    "no birth": (LONG, [on(-100, "PREB")], None),
    "first day of intake": (LONG, [("2031-10-01", "2031-10-08", "BORN", "", "10", "", "", "")], (1, 0, 0)),
    "day before intake": (LONG, [("2031-10-01", "2031-10-07", "BORN", "", "10", "", "", "")], None),
    "last day of intake": (LONG, [("2032-10-01", "2032-10-06", "BORN", "", "10", "", "", "")], (1, 0, 0)),
    "day after intake": (LONG, [("2032-10-01", "2032-10-08", "BORN", "", "10", "", "", "")], None),
    "claims 60 days apart are one delivery": (LONG, [on(-60, "BORN"), BORN], (1, 0, 0)),
    "claims 61 days apart are two": (LONG, [on(-61, "BORN"), BORN], (2, 0, 0)),
    "a later claim counts from the anchor": (LONG, [on(-80, "BORN"), on(-40, "BORN"), BORN], (2, 0, 0)),
    "six deliveries in one year": (LONG, [on(d, "BORN") for d in (-200, -139, -78, -17, 44, 105)], (6, 0, 0)),
    "loss at any date excludes": (LONG, [BORN, on(-400, "", dx="LOSS")], (0, 0, 0)),
    "hospice at any date excludes": (LONG, [BORN, on(-900, "REST")], (0, 0, 0)),
    "excluded delivery keeps its visit": (LONG, [BORN, on(-400, "", dx="LOSS"), on(21, "POST")], (0, 0, 1)),
    "cover ends 59 days after": ([("2030-01-01", str(BORN_END := BIRTH + dt.timedelta(days=59)), "Y")], [BORN], (0, 0, 0)),
    "cover ends 60 days after": ([("2030-01-01", str(BORN_END + dt.timedelta(days=1)), "Y")], [BORN], (1, 0, 0)),
    "cover starts 43 days before": ([(str(BIRTH - dt.timedelta(days=43)), "2033-01-01", "Y")], [BORN], (1, 0, 0)),
    "cover starts 42 days before": ([(str(BIRTH - dt.timedelta(days=42)), "2033-01-01", "Y")], [BORN], (0, 0, 0)),
    "no medical cover": ([("2030-01-01", "2033-12-31", "N")], [BORN], None),
    "visit with pregnancy diagnosis": (LONG, [BORN, on(-200, "PRE", dx3="PREG")], (1, 1, 0)),
    "visit without it": (LONG, [BORN, on(-200, "PRE", dx="OTHER")], (1, 0, 0)),
    "visit with the code in the old version": (LONG, [BORN, on(-200, "PRE", dx="PREG", version="09")], (1, 0, 0)),
    "bundled care needs no diagnosis": (LONG, [BORN, on(-200, "PREB")], (1, 1, 0)),
    "long cover: 280 days before": (LONG, [BORN, on(-280, "PREB")], (1, 1, 0)),
    "long cover: 281 days before": (LONG, [BORN, on(-281, "PREB")], (1, 0, 0)),
    "long cover: 176 days before": (LONG, [BORN, on(-176, "PREB")], (1, 1, 0)),
    "long cover: 175 days before": (LONG, [BORN, on(-175, "PREB")], (1, 0, 0)),
    "new cover: on its first day": (NEW, [BORN, ("2032-01-01", "2032-01-01", "PREB", "", "10", "", "", "")], (1, 1, 0)),
    "new cover: 42 days in": (NEW, [BORN, ("2032-02-12", "2032-02-12", "PREB", "", "10", "", "", "")], (1, 1, 0)),
    "new cover: 43 days in": (NEW, [BORN, ("2032-02-13", "2032-02-13", "PREB", "", "10", "", "", "")], (1, 0, 0)),
    "new cover: before it": (NEW, [BORN, ("2031-12-31", "2031-12-31", "PREB", "", "10", "", "", "")], (1, 0, 0)),
    "postpartum after 6 days": (LONG, [BORN, on(6, "POST")], (1, 0, 0)),
    "postpartum after 7 days": (LONG, [BORN, on(7, "POST")], (1, 0, 1)),
    "postpartum after 84 days": (LONG, [BORN, on(84, "POST")], (1, 0, 1)),
    "postpartum after 85 days": (LONG, [BORN, on(85, "POST")], (1, 0, 0)),
    "postpartum in hospital": (LONG, [BORN, on(21, "POST", pos="IP")], (1, 0, 0)),
    "both": (LONG, [BORN, on(-200, "PREB"), on(21, "POST")], (1, 1, 1)),
}


def mothers(spark, scenarios, listed=MOTHER):
    return ClaimsInputs(
        member=df(spark, [(n, "2000-01-01") for n in scenarios], "member_id string, dob date"),
        member_time=df(spark, [(n, *s) for n, x in scenarios.items() for s in x[0]],
                       "member_id string, date_start date, date_end date, cover_medical string"),
        outclaims=df(spark, [(n, *c) for n, x in scenarios.items() for c in x[1]],
                     "member_id string, prm_fromdate date, prm_todate date, hcpcs string, pos string, icdversion string, "
                     "icddiag1 string, icddiag3 string, icdproc3 string").selectExpr("*", "'' as revcode", "'' as icddiag2"),
        hedis_codes=codes(spark, listed), components=default_components(spark))


@pytest.fixture(scope="module")
def born(spark):
    out = {}
    for r in prenatal_postpartum_long(mothers(spark, DELIVERIES), P).collect():
        out.setdefault(r["member_id"], {})[r["measure"]] = (r["denominator"], r["numerator"])
    return out


@pytest.mark.parametrize("name", DELIVERIES)
def test_delivery(born, name):
    want = DELIVERIES[name][2]
    got = born.get(name)
    assert got == (want and {"prenatal_care": (want[0], want[1]), "postpartum_care": (want[0], want[2])})


def test_pregnancy_list_must_be_icd10(spark):
    one = {"birth alone": DELIVERIES["birth alone"]}
    for extra in ("prenatal_postpartum_care~pregnancy_diagnosis~ICD9CM-Diag~OLD~~",
                  "prenatal_postpartum_care~pregnancy_diagnosis~ICD10CM-Proc~PROC~~",
                  "prenatal_postpartum_care~pregnancy_diagnosis~ICD10CM-Diag~PREG~~"):
        with pytest.raises(CodeTableError):
            prenatal_postpartum_long(mothers(spark, one, MOTHER + extra), P)


DRUGS = """
aod~iet_standalone_visits~HCPCS~TALK~~
aod~alc_abuse_dependence~ICD10CM-Diag~ALC~~
aod~aod_abuse_dependence~ICD10CM-Diag~ALC~~
aod~opioid_abuse_dependence~ICD10CM-Diag~OPI~~
aod~aod_abuse_dependence~ICD10CM-Diag~OPI~~
aod~detox~CPT~DTX~~
aod~ip_stay~UBREV~0BED~~
aod~hospice_intervention~HCPCS~REST~~
"""
MEDS = "aod~alcohol_treatment_meds~NDC~77~~\naod~opioid_treatment_meds~NDC~88~~"
INDEX = dt.date(2032, 4, 12)


def talk(days, dx="ALC", code="TALK", rev="", stay=0):
    """(from, to, code, revenue code, diagnosis): a claim that starts ``days`` from the index."""
    start = INDEX + dt.timedelta(days=days)
    return (str(start), str(start + dt.timedelta(days=stay)), code, rev, dx)


def bed(days, stay, dx="ALC"):
    return talk(days, dx, "", "0BED", stay)


def pill(days, ndc="77"):
    return (str(INDEX + dt.timedelta(days=days)), ndc)


ALL_YEAR = [("2032-01-01", "2032-12-31")]
# scenario -> (birth date, spans, claims, pharmacy, (initiation, engagement) or None); the
# denominator of engagement is who initiated
TREATMENT = {
    "index only": ("1990-01-01", ALL_YEAR, [talk(0)], [], (0, None)),
    "initiated on day 13": ("1990-01-01", ALL_YEAR, [talk(0), talk(13)], [], (1, 0)),
    "day 14 is too late": ("1990-01-01", ALL_YEAR, [talk(0), talk(14)], [], (0, None)),
    "another claim of the day initiates": ("1990-01-01", ALL_YEAR, [talk(0), talk(0)], [], (1, 0)),
    "visit for another drug does not": ("1990-01-01", ALL_YEAR, [talk(0), talk(5, "OPI")], [], (0, None)),
    "two visits engage": ("1990-01-01", ALL_YEAR, [talk(0), talk(5), talk(6), talk(39)], [], (1, 1)),
    "one visit does not": ("1990-01-01", ALL_YEAR, [talk(0), talk(5), talk(6)], [], (1, 0)),
    "engagement ends after 34 days": ("1990-01-01", ALL_YEAR, [talk(0), talk(5), talk(6), talk(40)], [], (1, 0)),
    "one pill after a visit engages": ("1990-01-01", ALL_YEAR, [talk(0), talk(5)], [pill(8)], (1, 1)),
    "pill initiates": ("1990-01-01", ALL_YEAR, [talk(0)], [pill(5)], (1, 0)),
    "pill first, then only pills": ("1990-01-01", ALL_YEAR, [talk(0)], [pill(5), pill(8), pill(9)], (1, 0)),
    "pill first, then a visit and a pill": ("1990-01-01", ALL_YEAR, [talk(0), talk(9)], [pill(5), pill(8)], (1, 1)),
    "opioid pill does not initiate": ("1990-01-01", ALL_YEAR, [talk(0, "OPI")], [pill(5, "88")], (0, None)),
    "alcohol pill initiates an opioid episode": ("1990-01-01", ALL_YEAR, [talk(0, "OPI")], [pill(5, "77")], (1, 0)),
    "detox is an episode": ("1990-01-01", ALL_YEAR, [talk(0, code="DTX"), talk(5)], [], (1, 0)),
    "detox is no treatment": ("1990-01-01", ALL_YEAR, [talk(0), talk(5, code="DTX")], [], (0, None)),
    "inpatient index initiates itself": ("1990-01-01", ALL_YEAR, [bed(0, 4)], [], (1, 0)),
    "transfer moves the start to its end": ("1990-01-01", ALL_YEAR, [bed(0, 4), bed(5, 10, "X"), talk(17), talk(49)], [], (1, 1)),
    "a later stay is no transfer": ("1990-01-01", ALL_YEAR, [bed(0, 4), bed(6, 10, "X"), talk(17), talk(49)], [], (1, 0)),
    "seventeen": ("2015-01-01", ALL_YEAR, [talk(0), talk(5)], [], None),
    "turns 18 on the last day": ("2014-12-31", ALL_YEAR, [talk(0), talk(5)], [], (1, 0)),
    "hospice in the year": ("1990-01-01", ALL_YEAR, [talk(0), talk(5), talk(200, "", "REST")], [], None),
    "event 59 days before": ("1990-01-01", ALL_YEAR, [("2031-12-04", "2031-12-04", "TALK", "", "ALC"),
                                                      ("2032-02-01", "2032-02-01", "TALK", "", "ALC")], [], None),
    "event 60 days before": ("1990-01-01", [("2031-11-01", "2032-12-31")], [("2031-12-03", "2031-12-03", "TALK", "", "ALC"),
                                                      ("2032-02-01", "2032-02-01", "TALK", "", "ALC")], [], (0, None)),
    "pill before the index": ("1990-01-01", ALL_YEAR, [talk(0), talk(5)], [pill(-20)], None),
    "cover starts 59 days before": ("1990-01-01", [(str(INDEX - dt.timedelta(days=59)), "2032-12-31")], [talk(0)], [], None),
    "cover starts 60 days before": ("1990-01-01", [(str(INDEX - dt.timedelta(days=60)), "2032-12-31")], [talk(0)], [], (0, None)),
    "cover ends 47 days after": ("1990-01-01", [("2032-01-01", str(INDEX + dt.timedelta(days=47)))], [talk(0)], [], None),
    "cover ends 48 days after": ("1990-01-01", [("2032-01-01", str(INDEX + dt.timedelta(days=48)))], [talk(0)], [], (0, None)),
    "no cover row": ("1990-01-01", [], [talk(0)], [], None),
}


def treated(spark, scenarios):
    claims, number = [], 0
    for n, (_, _, rows, _, _) in scenarios.items():
        for start, end, code, rev, dx in rows:
            number += 1
            claims.append((n, f"c{number}", start, end, start, end, code, rev, dx))
    pills = [(n, f"p{k}", *x) for n, s in scenarios.items() for k, x in enumerate(s[3])]
    return ClaimsInputs(
        member=df(spark, [(n, s[0]) for n, s in scenarios.items()], "member_id string, dob date"),
        member_time=df(spark, [(n, *x) for n, s in scenarios.items() for x in s[1]],
                       "member_id string, date_start date, date_end date"),
        outclaims=df(spark, claims, "member_id string, claimid string, prm_fromdate date, prm_todate date, "
                                    "prm_fromdate_case date, prm_todate_case date, hcpcs string, revcode string, icddiag1 string"),
        outpharmacy=df(spark, pills, "member_id string, claimid string, prm_fromdate date, ndc string"),
        hedis_codes=codes(spark, DRUGS), medications=codes(spark, MEDS), components=default_components(spark))


@pytest.fixture(scope="module")
def treatment(spark):
    inp = treated(spark, TREATMENT)
    return [{r["member_id"]: (r["denominator"], r["numerator"]) for r in f(inp, P).collect()} for f in (aod_init, aod_engage)]


@pytest.mark.parametrize("name", TREATMENT)
def test_treatment(treatment, name):
    want = TREATMENT[name][4]
    start = None if want is None else (1.0, float(want[0]))
    then = None if want is None or want[1] is None else (1.0, float(want[1]))
    assert (treatment[0].get(name), treatment[1].get(name)) == (start, then)
