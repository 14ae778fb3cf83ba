import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import codes, df
from qmeasures.plans import combine as C
from qmeasures.plans import validate as V
from qmeasures.plans.registry import MeasureRegistry, SchemaMismatch, default_registry
from qmeasures.sources import mappings as M
from qmeasures.sources import reference as R
from qmeasures.sources import refdata
from qmeasures.sources.valuesets import read_value_set_concepts, value_set_codes


def _tmp():
    os.makedirs("/tmp/qm", exist_ok=True)
    return tempfile.mkdtemp(prefix="qm-test-", dir="/tmp/qm")


def test_reference_ingest_roundtrip(spark):
    folder = refdata.write_reference_files(_tmp())
    schema = R.build_structtype_from_csv(os.path.join(folder, "_schemas", "OHA_Abbreviations.csv"))
    assert [f.name for f in schema.fields] == ["measure_abbreviation", "measure_name", "measure_format",
                                               "measure_calculation_type"]
    assert not schema["measure_name"].nullable
    refs = R.import_flatfile_references(spark, folder)
    assert set(refs) == {"oha_abbreviations", "dental_taxonomy"}
    ab = refs["oha_abbreviations"].orderBy("_ordinal").collect()
    # header says Measure_Description; the schema is applied by position
    assert ab[0]["measure_abbreviation"] == "Alcohol_SBIRT" and len(ab) == len(refdata.ABBREVIATIONS)
    assert ab[16]["measure_name"].startswith("Well-Child Visits in the Third, Fourth")
    assert refs["dental_taxonomy"].count() == 18
    out = R.write_references(refs, _tmp())
    assert spark.read.parquet(out["dental_taxonomy"]).count() == 18


def test_strict_csv_fails_fast(spark):
    folder = _tmp()
    os.makedirs(os.path.join(folder, "_data"))
    os.makedirs(os.path.join(folder, "_schemas"))
    with open(os.path.join(folder, "_schemas", "t.csv"), "w") as fh:
        fh.write("name,datatype,nullable,sas_informat\nx,double,false,12.\n")
    with open(os.path.join(folder, "_data", "t.csv"), "w") as fh:
        fh.write("x\n1.5\nnot_a_number\n")
    refs = R.import_flatfile_references(spark, folder)
    with pytest.raises(Exception):
        refs["t"].collect()


SVS = """<?xml version="1.0" encoding="UTF-8"?>
<ns0:RetrieveMultipleValueSetsResponse xmlns:ns0="urn:ihe:iti:svs:2008">
<ns0:ValueSet ID="1.2" displayName="Set A" version="x">
  <ns0:ConceptList>
    <ns0:Concept code="F10.10" codeSystem="2.16.840.1.113883.6.90" codeSystemName="ICD10CM" codeSystemVersion="2020" displayName="Alcohol abuse"/>
    <ns0:Concept code="99201" codeSystem="2.16.840.1.113883.6.12" codeSystemName="CPT" codeSystemVersion="2020" displayName="Office visit"/>
  </ns0:ConceptList>
</ns0:ValueSet>
<ns0:ValueSet ID="2.16.840.1" displayName="Set B" version="y">
  <ns0:ConceptList>
    <ns0:Concept code="0111" codeSystem="x" codeSystemName="UBREV" codeSystemVersion="1" displayName="Room"/>
  </ns0:ConceptList>
</ns0:ValueSet>
</ns0:RetrieveMultipleValueSetsResponse>
"""


def test_value_set_xml(spark):
    folder = _tmp()
    path = os.path.join(folder, "svs.xml")
    with open(path, "w") as fh:
        fh.write(SVS)
    concepts = read_value_set_concepts(spark, path)
    assert concepts.count() == 3
    assert {r["value_set_oid"] for r in concepts.collect()} == {"1.2", "2.16.840.1"}
    requests = df(spark, [("aod", "alc", "Set A", "1.2"), ("aod", "ip", "Set B", "2.16.840.1")],
                  "Measure string, component_name string, value_set_name string, value_set_oid string")
    full, skinny = value_set_codes(concepts, requests)
    assert full.count() == 3
    rows = {(r["component"], r["codesystem"], r["code"]) for r in skinny.collect()}
    assert rows == {("alc", "ICD10CM-Diag", "F1010"), ("alc", "CPT", "99201"), ("ip", "UBREV", "0111")}


def test_mappings_and_normalizers(spark):
    hedis_path, meds_path = refdata.write_mapping_files(_tmp())
    hedis = M.read_mapping_csv(spark, hedis_path)
    meds = M.read_mapping_csv(spark, meds_path)
    assert hedis.count() == len(refdata.HEDIS_MAPPING)
    union = M.mapping_union(hedis, meds, measures=["prenatal_postpartum_care"],
                            drop_components=["Pregnancy_Diagnosis", "cervical_cytology_result"])
    comps = [r["component"] for r in union.orderBy("ordinal").collect()]
    assert comps[0] == "deliveries" and "pregnancy_diagnosis" not in comps and len(comps) == 12
    code_list = df(spark, [("Deliveries", "O80.0", "ICD10CM"), ("Deliveries", "59400", "CPT-CAT-II"),
                           ("Unused", "X", "CPT")], "value_set_name string, code string, code_system string")
    with pytest.raises(M.MissingValueSets, match="Some value sets were not found"):
        M.normalize_medical_codes(code_list, hedis)
    norm = M.normalize_medical_codes(code_list, hedis, require_all=False)
    got = {(r["measure"], r["component"], r["codesystem"], r["code"]) for r in norm.collect()}
    assert got == {("prenatal_postpartum_care", "deliveries", "ICD10CM-Diag", "O800"),
                   ("prenatal_postpartum_care", "deliveries", "CPT", "59400")}
    missing = M.missing_value_sets(code_list, hedis)
    assert missing.count() == len(refdata.HEDIS_MAPPING) - 1
    meds_list = df(spark, [("Diabetes Medications", "00002143301", "NDC"),
                           ("Diabetes Medications", "123", "RXNORM")],
                   "value_set_name string, code string, code_system string")
    drugs = M.normalize_drug_codes(meds_list, meds, require_all=False).collect()
    assert [(r["component"], r["code"]) for r in drugs] == [("diabetes_medications", "00002143301")]


def test_reference_checks(spark):
    ab = C.abbreviations_frame(spark)
    bad = codes(spark, """
well_child_visits~well_care~CPT~A1~~
unknown_measure~x~CPT~A2~~
well_child_visits~x~BOGUS~A3~~
well_child_visits~y~CPT~A.4~~
well_child_visits~z~ICD10CM-Diag~A5~~Weird
well_child_visits~z~CPT~A6~~Primary
well_child_visits~g~ICD10CM-Diag~A7~G1~Primary
well_child_visits~g~ICD10CM-Diag~A8~G1~Primary
prenatal_care~g~CPT~A9~G1~
well_child_visits~m~NDC~1~~
well_child_visits~m~CPT~2~~
""")
    rules = {r["rule"] for r in V.code_table_checks(bad, ab).collect()}
    assert rules == {"measure_known", "codesystem_allowed", "code_without_dot", "diag_type_allowed",
                     "one_primary_per_group", "grouping_id_unique_per_component", "one_source_table_per_component"}
    good = codes(spark, "well_child_visits~well_care~CPT~A1~~\nED_Visits~x~ICD10CM-Diag~B~~Primary")
    assert V.code_table_checks(good, ab).count() == 0
    assert V.abbreviation_checks(ab).count() == 0
    dup = ab.unionByName(ab.limit(1))
    assert {r["rule"] for r in V.abbreviation_checks(dup).collect()} == {"abbreviation_unique", "measure_name_unique"}
    with pytest.raises(AssertionError):
        V.check_references({"oha_abbreviations": ab, "oha_codes": bad}, fail_fast=True)
    lk = codes(spark, "m~c~ICD9CM-Diag~X~~\nm~c~ICD9CM-Diag~X~g~\nm~c~ICD10CM-Diag~X~~")
    assert V.lookup_key_checks(lk, "m", "c").count() == 1


def _res(spark, rows):
    return df(spark, rows, "member_id string, denominator double, numerator double, comments string, "
                           "comp_quality_date_actionable date")


def test_combine_and_reference(spark):
    ab = C.abbreviations_frame(spark)
    results = {
        "well_child_visits": _res(spark, [("a", 1, 1, "x", ""), ("b", 1, 0, "y", "2020-12-31"), ("zz", 1, 1, "", "")]),
        "ED_Visits_MI": _res(spark, [("a", 0.002, 2, "Recent", "")]),
        "aod_init": _res(spark, [("b", 1, 0, None, "2020-12-31")]).withColumn("comment", F.lit("No Qualifying Visit")),
    }
    targets = df(spark, [("well_child_visits", 0.6, "higher"), ("ED_VISITS_MI", 44.0, "lower"),
                         ("aod_init", 0.4, "higher")],
                 "measure_name_short string, measure_target_value double, measure_direction string")
    roster = df(spark, [("a", "North"), ("b", "South")], "member_id string, mem_report_hier_1 string")
    out = C.combine_results(results, ab, targets, roster)
    assert out.columns == C.PUBLISHED_COLUMNS
    rows = {(r["member_id"], r["Measure_Abbreviation"]): r for r in out.collect()}
    assert set(rows) == {("a", "WELL_CHILD_VISITS"), ("b", "WELL_CHILD_VISITS"), ("a", "ED_VISITS_MI"),
                         ("b", "AOD_INIT")}
    assert rows[("a", "ED_VISITS_MI")]["comp_quality_short"] == "ED_Visits_MI"
    assert rows[("b", "AOD_INIT")]["comp_quality_comments"] is None        # K18
    assert rows[("a", "WELL_CHILD_VISITS")]["comp_quality_date_last"] is None
    ref = C.measure_reference(ab, targets)
    assert ref.columns == C.REFERENCE_COLUMNS
    r = {x["comp_quality_short"]: x for x in ref.collect()}
    assert r["ED_Visits_MI"]["comp_quality_dual"] == 2 and r["ED_Visits_MI"]["comp_quality_target_value"] == 44.0
    assert r["Hypertension"]["comp_quality_target_value"] is None
    assert r["aod_init"]["comp_quality_category"] == "CCO Incentive Measures"
    rates = {x["Measure_Abbreviation"]: x for x in C.rate_summary(results).collect()}
    assert rates["WELL_CHILD_VISITS"]["measure_rate"] == round(2 / 3, 4)


def test_combine_validation_errors(spark):
    ab = C.abbreviations_frame(spark)
    roster = df(spark, [("a", "N")], "member_id string, mem_report_hier_1 string")
    res = {"well_child_visits": _res(spark, [("a", 1, 1, "", "")])}
    surplus = df(spark, [("well_child_visits", 0.5, "h"), ("not_a_measure", 1.0, "h")],
                 "measure_name_short string, measure_target_value double, measure_direction string")
    with pytest.raises(C.CombineError, match="not reported"):
        C.combine_results(res, ab, surplus, roster)
    missing = df(spark, [("prenatal_care", 0.5, "h")],
                 "measure_name_short string, measure_target_value double, measure_direction string")
    with pytest.raises(C.CombineError, match="Targets were not found"):
        C.combine_results(res, ab, missing, roster)
    with pytest.raises(C.CombineError, match="matching reference"):
        C.combine_results({"custom_thing": res["well_child_visits"]}, ab, missing, roster)


def test_registry_override_and_opt_in(spark):
    reg = default_registry()
    assert "DHS_assessments" not in reg.active()
    reg.enable("DHS_assessments", "prev_dental_1_to_5")
    assert reg.active()[-2:] == ["DHS_assessments", "prev_dental_1_to_5"]
    custom = MeasureRegistry()
    custom.register("well_child_visits", lambda inp, p: _res(spark, [("a", 1, 0, "", "")]))
    custom.register("well_child_visits", lambda inp, p: _res(spark, [("a", 1, 1, "custom", "")]))
    out = custom.run(None, None)
    assert [tuple(r) for r in out["well_child_visits"].select("numerator", "comments").collect()] == [(1.0, "custom")]
    bad = MeasureRegistry().register("x", lambda inp, p: df(spark, [("a",)], "member_id string"))
    with pytest.raises(SchemaMismatch):
        bad.run(None, None)


def test_compare_results_helper(spark):
    exp = df(spark, [("a", 1, 1), ("b", 1, 0), ("c", 0, 0)],
             "member_id string, anticipated_denominator double, anticipated_numerator double")
    act = df(spark, [("a", 1, 1), ("b", 1, 1)], "member_id string, denominator double, numerator double")
    bad = V.compare_results(exp, act).collect()
    assert [r["member_id"] for r in bad] == ["b"]
