"""Queries over the given tables for validators, comparisons and run variants, with SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from qmeasures.measures import custody, ed_visits, prenatal, well_child
from qmeasures.operators.rollup import flag_columns, max_rollup
from qmeasures.plans import oracle_sql as S
from qmeasures.plans import validate as V
from qmeasures.plans.combine import stack_results
from qmeasures.plans.registry import MeasureRegistry, default_registry
from qmeasures.sources.adapter import DRIVER_PARAMS as P, load_inputs

ED_COMPONENTS = ["numer_cpt", "numer_rev", "numer_procs", "numer_excl_mh", "numer_excl_psych", "numer_excl_ip_stay"]


def result_null_violations(spark, sf_dir) -> DataFrame:
    """Q7: ED results without a comment or an actionable date, one violation row each."""
    res = ed_visits.ed_visits_all(load_inputs(spark, sf_dir), P)
    return V.result_null_checks(res, ["member_id", "numerator", "comments", "comp_quality_date_actionable"])


def result_null_violations_sql() -> str:
    parts = [f"SELECT 'no_nulls' AS rule, '{c}' AS key, member_id AS detail FROM r WHERE {c} IS NULL"
             for c in ("member_id", "numerator", "comments", "comp_quality_date_actionable")]
    return f"WITH r AS ({S.ed_all_sql()}) " + " UNION ALL ".join(parts)


def lookup_key_violations(spark, sf_dir) -> DataFrame:
    """Q8 on claim keys: members with several claim lines on one day."""
    lines = load_inputs(spark, sf_dir).outclaims
    return V.unique_values(lines, ["member_id", "prm_fromdate"], "claim_key_unique")


def lookup_key_violations_sql() -> str:
    return S.prefix("lines") + """
SELECT 'claim_key_unique' AS rule, member_id || '|' || CAST(prm_fromdate AS VARCHAR) AS key,
    CAST(count(*) AS VARCHAR) AS detail FROM lines GROUP BY member_id, prm_fromdate HAVING count(*) > 1"""


def compare_two_results(spark, sf_dir) -> DataFrame:
    """J12 / Q9: full outer comparison of the prenatal and the well-child result."""
    inp = load_inputs(spark, sf_dir)
    expected = prenatal.prenatal_care(inp, P).select(
        "member_id", F.col("denominator").alias("anticipated_denominator"), F.col("numerator").alias("anticipated_numerator"))
    actual = well_child.well_child_visits(inp, P).select("member_id", "denominator", "numerator")
    return V.compare_results(expected, actual, full_outer=True)


def compare_two_results_sql() -> str:
    return f"""SELECT coalesce(a.member_id, b.member_id) AS member_id, a.denominator AS anticipated_denominator,
    a.numerator AS anticipated_numerator, b.denominator, b.numerator
FROM ({S.prenatal_sql('prenatal_care')}) a FULL OUTER JOIN ({S.well_child_sql()}) b ON a.member_id = b.member_id
WHERE round(coalesce(a.denominator, 0), 4) <> round(coalesce(b.denominator, 0), 4)
   OR round(coalesce(a.numerator, 0), 4) <> round(coalesce(b.numerator, 0), 4)"""


def numeric_rollup(spark, sf_dir) -> DataFrame:
    """F8: the flags to roll up are found by their type, not by a list of names."""
    inp = load_inputs(spark, sf_dir)
    flags = flag_columns(inp.outclaims, inp.oha_codes, "ed_visits", ED_COMPONENTS, keep=["member_id", "claimid", "prm_fromdate"])
    return max_rollup(flags, "member_id")


def numeric_rollup_sql() -> str:
    cols = ", ".join(f"max(CAST({S.O('ed_visits', c)} AS INTEGER)) AS {c}" for c in ED_COMPONENTS)
    return S.prefix("lines") + f"\nSELECT member_id, {cols} FROM lines GROUP BY member_id"


def ed_without_predictions(spark, sf_dir) -> DataFrame:
    """S9: the optional prediction table is absent."""
    return ed_visits.ed_visits_all(load_inputs(spark, sf_dir).with_(predictions=None), P)


def custody_without_dental(spark, sf_dir) -> DataFrame:
    """S9: the optional dental table is absent."""
    return custody.dhs_assessments(load_inputs(spark, sf_dir).with_(inpdental=None), P)


def custom_override(spark, sf_dir) -> DataFrame:
    """U2: a custom measure replaces a standard one whatever the case of its name."""
    standard = default_registry()
    reg = MeasureRegistry()
    for name in ("ED_Visits_MI", "well_child_visits"):
        reg.register(name, standard._measures[name])
    reg.register("ed_visits_mi", lambda inp, p: ed_visits.ed_visits_all(inp, p).where("numerator >= 2"))
    return stack_results(reg.run(load_inputs(spark, sf_dir), P))


def custom_override_sql() -> str:
    cols = "member_id, denominator, numerator, comments, comp_quality_date_actionable"
    return f"""SELECT {cols}, 'WELL_CHILD_VISITS' AS Measure_Abbreviation FROM ({S.well_child_sql()})
UNION ALL SELECT {cols}, 'ED_VISITS_MI' FROM ({S.ed_all_sql()}) WHERE numerator >= 2"""


QUERIES = {
    "result_null_violations": result_null_violations,
    "lookup_key_violations": lookup_key_violations,
    "compare_two_results": compare_two_results,
    "numeric_rollup": numeric_rollup,
    "ed_without_predictions": ed_without_predictions,
    "custody_without_dental": custody_without_dental,
    "custom_override": custom_override,
}


def oracles() -> dict:
    return {
        "result_null_violations": result_null_violations_sql(),
        "lookup_key_violations": lookup_key_violations_sql(),
        "compare_two_results": compare_two_results_sql(),
        "numeric_rollup": numeric_rollup_sql(),
        "ed_without_predictions": S.ed_all_sql(predictions=False),
        "custody_without_dental": S.custody_sql(dental_table=False),
        "custom_override": custom_override_sql(),
    }
