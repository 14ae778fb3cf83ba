import datetime as dt

import pytest

from qmeasures.measures.well_child import well_child_visits
from qmeasures.params import MeasureParams
from qmeasures.sources import loader


def write(spark, folder, tables, rows=None):
    for name, columns in tables.items():
        schema = ", ".join(f"{c} {t}" for c, t in columns.items()) or "code string"
        spark.createDataFrame((rows or {}).get(name, []), schema).write.parquet(f"{folder}/{name}.parquet")


def test_load_and_run(spark, tmp_path):
    claims, refs = str(tmp_path / "claims"), str(tmp_path / "refs")
    born = dt.date(2029, 5, 5)
    rows = {"member": [("kid", born)], "member_time": [("kid", dt.date(2033, 1, 1), dt.date(2033, 12, 31), "Y")]}
    write(spark, claims, loader.REQUIRED, rows)
    write(spark, claims, {"predictions": loader.OPTIONAL["predictions"]})
    write(spark, refs, loader.REFERENCES, {"hedis_codes": [("well_child_visits", "well_care", "CPT", "W", None, None)]})
    write(spark, refs, {"dental_taxonomy": {"Dental_Code": "string", "_ordinal": "bigint"}}, {"dental_taxonomy": [("T", 0)]})
    inp = loader.load_claims(spark, claims, refs)
    assert inp.predictions is not None and inp.inpdental is None and inp.foster_care is None
    assert inp.dental_taxonomy.columns == ["taxonomy_code"] and inp.components.count() > 0
    out = well_child_visits(inp, MeasureParams.for_year(2033, dt.date(2034, 3, 31))).collect()
    assert [(r["member_id"], r["denominator"], r["numerator"]) for r in out] == [("kid", 1.0, 0.0)]


def test_all_faults_are_named(spark, tmp_path):
    claims, refs = str(tmp_path / "claims"), str(tmp_path / "refs")
    broken = {n: dict(c) for n, c in loader.REQUIRED.items() if n != "outpharmacy"}
    del broken["outclaims"]["pos"]
    broken["member"]["dob"] = "string"
    write(spark, claims, broken)
    write(spark, refs, {n: c for n, c in loader.REFERENCES.items() if n != "medications"})
    with pytest.raises(loader.InputError) as caught:
        loader.load_claims(spark, claims, refs)
    assert set(str(caught.value).split("; ")) == {"table outpharmacy is missing", "table medications is missing",
                                                  "outclaims.pos is missing", "member.dob is string, not date"}
