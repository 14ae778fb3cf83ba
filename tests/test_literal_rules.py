"""One test per literal behaviour not already pinned by the measure fixtures."""
import datetime as dt

from conftest import codes, df
from qmeasures.inputs import ClaimsInputs
from qmeasures.measures.aod import aod_init
from qmeasures.measures.custody import dhs_assessments
from qmeasures.measures.ed_visits import ed_visits_all
from qmeasures.measures.oral_eval import oral_eval
from qmeasures.measures.prenatal import prenatal_postpartum_long
from qmeasures.measures.well_child import well_child_visits
from qmeasures.params import MeasureParams
from qmeasures.sources.mappings import default_components

P2014 = MeasureParams.for_year(2014, dt.date(2015, 2, 26), empirical_elig_date_end=dt.date(2014, 12, 31))


def _claims(spark, rows, cols):
    return df(spark, rows, cols)


def test_k2_k4_custody_year_and_one_row_per_notification(spark):
    cds = codes(spark, "DHS_assessments~Numerator_Physical~CPT~PH~~")
    member_time = df(spark, [("kid", "2013-01-01", "2014-12-31")], "member_id string, date_start date, date_end date")
    notes = df(spark, [("kid", "2013-11-15", "2013-11-01", "", "2013-11-15"),
                       ("kid", "2014-06-01", "2013-11-01", "", "2014-06-01")],
               "member_id string, report_date date, dob date, branch_code string, eligibility_effective_date date")
    claims = df(spark, [("kid", "2013-11-20", "PH"), ("kid", "2014-06-10", "PH")],
                "member_id string, prm_fromdate date, hcpcs string")
    inp = ClaimsInputs(member=df(spark, [("kid", "2013-11-01")], "member_id string, dob date"),
                       member_time=member_time, outclaims=claims, foster_care=notes, oha_codes=cds)
    rows = {r["comments"][23:33]: r["numerator"] for r in dhs_assessments(inp, P2014).collect()}
    # K4: one row per notification outcome; K2: the Nov-2013 visit is outside the calendar year
    assert rows == {"11/15/2013": 0.0, "06/01/2014": 1.0}


def test_k6_two_claims_same_day_count_as_two_visits(spark):
    hedis = codes(spark, "diabetes_oral_eval~outpatient~CPT~OP~~\ndiabetes_oral_eval~diabetes~ICD10CM-Diag~DX~~")
    claims = df(spark, [("m", "2014-05-01", "c1", "OP", "DX"), ("m", "2014-05-01", "c2", "OP", "DX")],
                "member_id string, prm_fromdate date, claimid string, hcpcs string, icddiag1 string")
    inp = ClaimsInputs(member=df(spark, [("m", "1970-01-01")], "member_id string, dob date"),
                       member_time=df(spark, [("m", "2014-01-01", "2014-12-31")],
                                      "member_id string, date_start date, date_end date"),
                       outclaims=claims, outpharmacy=df(spark, [], "member_id string, prm_fromdate date, ndc string"),
                       inpdental=df(spark, [], "member_id string, fromdate date, hcpcs string"),
                       hedis_codes=hedis, medications=codes(spark, "x~y~NDC~1~~"),
                       oha_codes=codes(spark, "diabetes_oral_eval~numerator~CDT~D0120~~"),
                       components=default_components(spark))
    assert [(r["member_id"], r["denominator"]) for r in oral_eval(inp, MeasureParams.for_year(
        2014, dt.date(2015, 2, 15))).collect()] == [("m", 1.0)]


def test_k8_well_child_numerator_kept_for_hospice(spark):
    hedis = codes(spark, "well_child_visits~well_care~CPT~WC~~\nwell_child_visits~hospice_intervention~CPT~HS~~")
    claims = df(spark, [("kid", "2020-03-01", "WC"), ("kid", "2020-04-01", "HS")],
                "member_id string, fromdate date, hcpcs string")
    inp = ClaimsInputs(member=df(spark, [("kid", "2016-01-01")], "member_id string, dob date"),
                       member_time=df(spark, [("kid", "2020-01-01", "2020-12-31")],
                                      "member_id string, date_start date, date_end date"),
                       outclaims=claims, hedis_codes=hedis)
    r = well_child_visits(inp, MeasureParams.for_year(2020, dt.date(2021, 2, 1))).collect()[0]
    assert (r["denominator"], r["numerator"], r["comments"]) == (0.0, 1.0, "Excluded due to hospice status")


PRE_CODES = """
prenatal_postpartum_care~deliveries~CPT~DLV~~
prenatal_postpartum_care~non_live_births~ICD10CM-Diag~NLB~~
prenatal_postpartum_care~hospice_intervention~HCPCS~HSP~~
prenatal_postpartum_care~postpartum_visits~CPT~PPV~~
"""


def _prenatal(spark, claims):
    inp = ClaimsInputs(member=df(spark, [("mom", "1990-01-01")], "member_id string, dob date"),
                       member_time=df(spark, [("mom", "2010-01-01", "2014-12-31", "Y")],
                                      "member_id string, date_start date, date_end date, cover_medical string"),
                       outclaims=df(spark, claims, "member_id string, prm_fromdate date, prm_todate date, "
                                                   "hcpcs string, icdversion string, icddiag1 string"),
                       hedis_codes=codes(spark, PRE_CODES), components=default_components(spark))
    return {r["measure"]: (r["denominator"], r["numerator"]) for r in prenatal_postpartum_long(inp, P2014).collect()}


def test_k11_k12_any_non_live_birth_or_hospice_excludes(spark):
    base = [("mom", "2014-04-20", "2014-04-25", "DLV", "10", "")]
    assert _prenatal(spark, base)["prenatal_care"] == (1, 0)
    far_nlb = base + [("mom", "2011-01-01", "2011-01-01", "X", "10", "NLB")]
    assert _prenatal(spark, far_nlb)["prenatal_care"] == (0, 0)        # K11: years away still excludes
    old_hospice = base + [("mom", "2010-06-01", "2010-06-01", "HSP", "10", "")]
    assert _prenatal(spark, old_hospice)["prenatal_care"] == (0, 0)    # K12: no date limit


def test_k13_zero_denominator_delivery_adds_numerator(spark):
    claims = [("mom", "2014-04-20", "2014-04-25", "DLV", "10", ""),
              ("mom", "2014-05-20", "2014-05-20", "PPV", "10", ""),
              ("mom", "2011-01-01", "2011-01-01", "X", "10", "NLB")]
    assert _prenatal(spark, claims)["postpartum_care"] == (0, 1)


AOD = """
aod~iet_standalone_visits~HCPCS~VIS~~
aod~opioid_abuse_dependence~ICD10CM-Diag~OPI~~
aod~aod_abuse_dependence~ICD10CM-Diag~OPI~~
"""


def test_k15_opioid_initiation_uses_alcohol_drug_flag(spark):
    claims = df(spark, [("p", "c1", "2014-03-15", "2014-03-15", "2014-03-15", "2014-03-15", "VIS", "OPI")],
                "member_id string, claimid string, prm_fromdate date, prm_todate date, prm_fromdate_case date, "
                "prm_todate_case date, hcpcs string, icddiag1 string")
    spans = df(spark, [("p", "2013-01-01", "2014-12-31")], "member_id string, date_start date, date_end date")

    def run(ndc):
        rx = df(spark, [("p", "r1", "2014-03-20", ndc)], "member_id string, claimid string, prm_fromdate date, ndc string")
        inp = ClaimsInputs(member=df(spark, [("p", "1980-01-01")], "member_id string, dob date"), member_time=spans,
                           outclaims=claims, outpharmacy=rx, hedis_codes=codes(spark, AOD),
                           medications=codes(spark, "aod~alcohol_treatment_meds~NDC~ALC~~\n"
                                                    "aod~opioid_treatment_meds~NDC~OPD~~"),
                           components=default_components(spark))
        return [(r["denominator"], r["numerator"]) for r in aod_init(inp, P2014).collect()]
    assert run("ALC") == [(1.0, 1.0)]   # alcohol drug initiates an opioid episode
    assert run("OPD") == [(1.0, 0.0)]   # the opioid drug does not


ED = """
ed_visits~numer_cpt~CPT~ED~~
ed_visits~numer_excl_psych~CPT~PSY~~
"""


def _ed(spark, claims):
    mm = df(spark, [("a", "2015-01-01", 1.0, "Y")], "member_id string, elig_month date, memmos double, cover_medical string")
    inp = ClaimsInputs(member=df(spark, [("a", "1980-01-01")], "member_id string, dob date"), member_months=mm,
                       outclaims=df(spark, claims, "member_id string, prm_fromdate date, prm_line string, "
                                                   "claimid string, hcpcs string, prm_denied_yn string"),
                       oha_codes=codes(spark, ED))
    return [(r["numerator"]) for r in ed_visits_all(inp, MeasureParams.for_year(2015, dt.date(2015, 12, 31))).collect()]


def test_k21_denied_line_drops_visit_sharing_date(spark):
    paid = [("a", "2015-03-01", "O1", "c1", "ED", "N")]
    assert _ed(spark, paid) == [1.0]
    denied_other_claim = paid + [("a", "2015-03-01", "O1", "c2", "ED", "Y")]
    assert _ed(spark, denied_other_claim) == [0.0]


def test_k23_psych_exclusion_is_per_claim(spark):
    same_claim = [("a", "2015-03-01", "O1", "c1", "ED", "N"), ("a", "2015-03-01", "O2", "c1", "PSY", "N")]
    assert _ed(spark, same_claim) == [0.0]
    other_claim = [("a", "2015-03-01", "O1", "c1", "ED", "N"), ("a", "2015-03-01", "O2", "c2", "PSY", "N")]
    assert _ed(spark, other_claim) == [1.0]


def test_required_and_optional_sources(spark):
    """S9/S10: measures needing the dental table or notifications return an empty result without them."""
    from qmeasures.measures.dental import prev_dental_1_to_5
    from qmeasures.schemas import RESULT_SCHEMA
    inp = ClaimsInputs(member=df(spark, [("a", "1980-01-01")], "member_id string, dob date"),
                       outclaims=df(spark, [], "member_id string, prm_fromdate date, hcpcs string"))
    for fn in (oral_eval, prev_dental_1_to_5, dhs_assessments):
        out = fn(inp, P2014)
        assert out.count() == 0 and [f.name for f in out.schema.fields] == [f.name for f in RESULT_SCHEMA.fields]
