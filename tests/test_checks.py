"""Nothing is cut or dropped silently: each fault raises or is reported; combine and registry rules."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import codes, df
from qmeasures.functions.codes import CodeTableError, any_versioned_diag, claims_filter, versioned_diag_codes
from qmeasures.operators import reuse
from qmeasures.operators.intervals import anchored_groups
from qmeasures.params import MeasureParams
from qmeasures.plans import combine as C
from qmeasures.plans import validate as V
from qmeasures.plans.registry import MeasureRegistry, SchemaMismatch
from qmeasures.schemas import to_result
from qmeasures.sources import mappings as M
from qmeasures.sources import reference as R
from qmeasures.sources.valuesets import value_set_checks, value_set_codes

RESULT = "member_id string, denominator double, numerator double, comments string, comp_quality_date_actionable date"
TARGETS = "measure_name_short string, measure_target_value double, measure_direction string"


def test_comments_are_whole(spark):
    long = "c" * 200
    out = to_result(df(spark, [("m", 1, 1, long, ""), ("n", 1, 1, "short", "")], RESULT))
    assert {r["comments"] for r in out.collect()} == {long, "short"}
    assert [(r["rule"], r["key"], r["detail"]) for r in V.comment_length_checks(out).collect()] == [("comment_fits", "m", "200")]


def test_unknown_code_system_raises(spark):
    listed = codes(spark, "m~c~CTP~1~~\nm~quiet~LOINC~2~~\nm~quiet~SNOMEDCT~3~~")
    with pytest.raises(CodeTableError):
        claims_filter(listed, "m", "c", ["hcpcs"])
    claims_filter(listed, "m", "quiet", ["hcpcs"])  # these have no claim column


def test_versioned_lookup(spark):
    listed = codes(spark, "m~c~ICD9CM-Diag~A~~\nm~c~ICD10CM-Diag~A~~\nm~c~ICD10CM-Diag~B~~\nm~c~CPT~X~~")
    found = versioned_diag_codes(listed, "m", "c")
    assert found == {"09": ["A"], "10": ["A", "B"]}
    rows = df(spark, [("1", "09", "A", ""), ("2", "09", "", "B"), ("3", "10", "Z", "B"), ("4", "11", "A", "A"), ("5", "", "A", "A"),
                      ("6", "10", "", "")], "id string, icdversion string, icddiag1 string, icddiag2 string")
    assert {r["id"] for r in rows.filter(any_versioned_diag(rows, found)).collect()} == {"1", "3"}
    assert any_versioned_diag(["icddiag1"], found) is not None
    with pytest.raises(CodeTableError):
        versioned_diag_codes(listed, "m", "c", only=("ICD9CM-Diag", "ICD10CM-Diag"))


def test_null_and_unknown_systems_are_violations(spark):
    table = df(spark, [("well_child_visits", "a", "", "1", "", ""), ("well_child_visits", "b", "XX", "2", "", "")],
               "measure string, component string, codesystem string, code string, grouping_id string, diag_type string")
    rules = [(r["rule"], r["key"]) for r in V.code_table_checks(table, C.abbreviations_frame(spark)).collect()]
    assert sorted(k for r, k in rules if r == "codesystem_allowed") == ["(none)", "XX"]
    mapping = df(spark, [("well_child_visits", "Set", "a")], "measure string, value_set_name string, component string")
    listed = df(spark, [("Set", "1", "CPT"), ("Set", "2", "Mystery"), ("Set", "3", "")],
                "value_set_name string, code string, code_system string")
    normal = M.normalize_medical_codes(listed, mapping)
    assert {(r["code"], r["codesystem"]) for r in normal.collect()} == {("1", "CPT"), ("2", "Mystery"), ("3", "(none)")}
    assert V.code_table_checks(normal, C.abbreviations_frame(spark)).filter("rule = 'codesystem_allowed'").count() == 2


def test_value_sets_must_be_there_and_known(spark):
    concepts = df(spark, [("1.1", "A", "s", "CPT", "", ""), ("1.1", "B", "s", "Riddle", "", ""), ("9.9", "C", "s", "Riddle", "", "")],
                  "value_set_oid string, code string, codeSystem string, codeSystemName string, codeSystemVersion string, "
                  "displayName string")
    wanted = df(spark, [("m", "c", "One", "1.1"), ("m", "c", "Two", "2.2")],
                "Measure string, component_name string, value_set_name string, value_set_oid string")
    bad = {(r["rule"], r["key"], r["detail"]) for r in value_set_checks(concepts, wanted).collect()}
    assert bad == {("value_set_present", "2.2", "Two"), ("code_system_known", "1.1", "Riddle")}
    with pytest.raises(V.ReferenceError_, match="code_system_known: 1, value_set_present: 1"):
        value_set_codes(concepts, wanted)
    _, skinny = value_set_codes(concepts, wanted, fail_fast=False)
    assert {(r["code"], r["codesystem"]) for r in skinny.collect()} == {("A", "CPT"), ("B", "Riddle")}


def test_every_violation_is_kept(spark):
    many = spark.range(57).select(F.lit("r").alias("rule"), F.col("id").cast("string").alias("key"), F.lit("").alias("detail"))
    with pytest.raises(V.ReferenceError_, match="r: 57") as caught:
        V.raise_violations(many)
    assert caught.value.violations.count() == 57
    V.raise_violations(many.limit(0))


def test_roster_listed_twice(spark):
    results = {"well_child_visits": df(spark, [("a", 1, 1, "", ""), ("b", 1, 0, "", "")], RESULT)}
    targets = df(spark, [("well_child_visits", 0.5, "higher")], TARGETS)
    roster = df(spark, [("a", "North"), ("a", "North"), ("a", "East"), ("b", "South"), ("b", "South")],
                "member_id string, mem_report_hier_1 string")
    out = C.combine_results(results, C.abbreviations_frame(spark), targets, roster).collect()
    assert sorted((r["member_id"], r["mem_report_hier_1"]) for r in out) == [("a", "East"), ("b", "South")]
    assert [(r["key"], r["detail"]) for r in V.roster_checks(roster).collect()] == [("a", "2")]


def test_reference_table_order_and_repeated_targets(spark):
    ab = C.abbreviations_frame(spark)
    targets = df(spark, [("well_child_visits", 0.5, "higher")], TARGETS)
    order = [r["comp_quality_dual"] for r in C.measure_reference(ab.orderBy(F.desc("measure_name")), targets).collect()]
    assert order == list(range(1, len(order) + 1))
    with pytest.raises(V.ReferenceError_, match="target_unique"):
        C.measure_reference(ab, targets.unionByName(df(spark, [("WELL_CHILD_VISITS", 0.6, "higher")], TARGETS)))


def test_override_ignores_case(spark):
    def one(text):
        return lambda inp, p: df(spark, [("a", 1, 1, text, "")], RESULT)
    reg = MeasureRegistry().register("Some_Measure", one("first"), optional=True).register("Other", one("other"))
    reg.register("some_measure", one("second"))
    assert reg.active() == ["Other", "some_measure"]
    assert [r["comments"] for r in reg.run(None, None)["some_measure"].collect()] == ["second"]
    reg.register("OTHER", one("x"), optional=True)
    assert reg.active() == ["some_measure"] and reg.enable("other").active() == ["some_measure", "OTHER"]


@pytest.mark.parametrize("schema", [RESULT.replace("denominator double", "denominator string"),
                                    RESULT.replace("member_id string", "member_id int"),
                                    RESULT.replace("actionable date", "actionable string")])
def test_result_types_are_checked(spark, schema):
    reg = MeasureRegistry().register("m", lambda inp, p: spark.createDataFrame([], schema))
    with pytest.raises(SchemaMismatch):
        reg.run(None, None)


def test_one_row_per_member(spark):
    rows = df(spark, [("a", 1, 1, "", ""), ("a", 1, 0, "", ""), ("b", 1, 0, "", "")], RESULT)
    assert [(r["key"], r["detail"]) for r in V.one_row_per_member_checks(rows).collect()] == [("a", "2")]


def test_label_and_ordinal_survive(spark, tmp_path):
    path = R.write_results({"m": df(spark, [("a", 1, 1, "", "")], RESULT)}, str(tmp_path), labels={"m": "A label"})["m"]
    assert R.dataset_label(path, spark) == "A label"
    table = df(spark, [("z", 0), ("y", 1), ("x", 2)], "measure_abbreviation string, _ordinal long")
    back = spark.read.parquet(R.write_references({"t": table}, str(tmp_path))["t"])
    got = C.with_ordinal(back).orderBy("comp_quality_dual").collect()
    assert [r["measure_abbreviation"] for r in got] == ["z", "y", "x"]


def test_bounded_groups_equal_the_open_loop(spark):
    start = dt.date(2030, 1, 1)
    rows = [(k, str(start + dt.timedelta(days=d))) for k in "abc" for d in sorted({(i * i * (7 + ord(k))) % 300 for i in range(25)})]
    frame = df(spark, rows, "k string, d date")
    loop = anchored_groups(frame, "k", ["d"], "d", 60)
    chain = anchored_groups(frame, "k", ["d"], "d", 60, max_groups=5)
    assert sorted(map(tuple, loop.collect())) == sorted(map(tuple, chain.collect()))
    with pytest.raises(Exception, match="rows beyond 2 anchored groups"):
        anchored_groups(frame, "k", ["d"], "d", 60, max_groups=2).collect()


def test_run_identity_knows_extra():
    a = MeasureParams.for_year(2030, dt.date(2031, 1, 1), extra={"x": 1})
    b = MeasureParams.for_year(2030, dt.date(2031, 1, 1), extra={"x": 2})
    assert a == b and a.key() != b.key() and a.key() == a.with_().key()


def _folder(frame):
    return "/" + frame.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0].lstrip("/")


def test_release_deletes_only_what_was_written(spark, tmp_path):
    kept = reuse._OUTSIDE.pop(spark.sparkContext.applicationId, None)
    folder = _folder(reuse.materialize(spark.range(3).toDF("x")))
    assert os.path.isdir(folder)
    assert reuse.release(spark) == 1 and not os.path.isdir(folder)
    if kept:
        reuse._OUTSIDE[spark.sparkContext.applicationId] = kept


def test_interleaved_runs_delete_their_own_folders(spark):
    with reuse.run_scope(spark) as first:
        a = _folder(reuse.materialize(spark.range(3).toDF("x")))
        later = first.hold()
        with reuse.run_scope(spark):
            b = _folder(reuse.materialize(spark.range(4).toDF("x")))
            assert os.path.isdir(a) and os.path.isdir(b)
        assert os.path.isdir(a) and not os.path.isdir(b)
    assert os.path.isdir(a)  # still held
    assert later.let_go() == 1 and not os.path.isdir(a)
