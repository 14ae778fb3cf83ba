"""Registered queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver parquet tables through :mod:`qmeasures.sources.adapter`
and runs over the whole tables.  Oracles live in :mod:`qmeasures.plans.oracle_sql`.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession, functions as F

from qmeasures.measures import aod, custody, dental, ed_visits, oral_eval, prenatal, well_child
from qmeasures.sources.adapter import DRIVER_PARAMS, load_inputs

P = DRIVER_PARAMS


def _inputs(spark: SparkSession, sf_dir: str):
    return load_inputs(spark, sf_dir)


def m_well_child(spark, sf_dir) -> DataFrame:
    return well_child.well_child_visits(_inputs(spark, sf_dir), P)


def m_ed_visits(spark, sf_dir) -> DataFrame:
    return ed_visits.ed_visits_all(_inputs(spark, sf_dir), P)


def m_ed_visits_mi(spark, sf_dir) -> DataFrame:
    return ed_visits.ed_visits_mi(_inputs(spark, sf_dir), P)


def m_custody(spark, sf_dir) -> DataFrame:
    return custody.dhs_assessments(_inputs(spark, sf_dir), P)


def m_oral_eval(spark, sf_dir) -> DataFrame:
    return oral_eval.oral_eval(_inputs(spark, sf_dir), P)


def m_prev_dental(spark, sf_dir) -> DataFrame:
    long = dental.dental_long(_inputs(spark, sf_dir), P)
    return long.filter(F.col("measure").isin(list(dental.PUBLISHED))).select(
        "member_id", "measure", F.col("denominator").cast("double").alias("denominator"),
        F.col("numerator").cast("double").alias("numerator"), "comments", "comp_quality_date_actionable")


def m_prenatal(spark, sf_dir) -> DataFrame:
    return prenatal.prenatal_care(_inputs(spark, sf_dir), P)


def m_postpartum(spark, sf_dir) -> DataFrame:
    return prenatal.postpartum_care(_inputs(spark, sf_dir), P)


def m_aod_init(spark, sf_dir) -> DataFrame:
    return aod.aod_init(_inputs(spark, sf_dir), P)


def m_aod_engage(spark, sf_dir) -> DataFrame:
    return aod.aod_engage(_inputs(spark, sf_dir), P)


def long_flags(spark, sf_dir) -> DataFrame:
    """Dental flags in long form: every measure x age bucket combination (wide -> long)."""
    long = dental.dental_long(_inputs(spark, sf_dir), P)
    return long.select("member_id", "age_bucket", "measure", F.col("numerator").cast("long").alias("numerator"))


# Published measure keys -> fixed targets (direction, value): a small reference dimension
# used by the combine step.  Values are illustrative run parameters, not published targets.
DRIVER_TARGETS = [
    ("ED_Visits_MI", 0.08, "lower"), ("DHS_assessments", 0.9, "higher"), ("diabetes_oral_eval", 0.3, "higher"),
    ("well_child_visits", 0.6, "higher"), ("prev_dental_1_to_5", 0.5, "higher"),
    ("prev_dental_6_to_14", 0.5, "higher"), ("prenatal_care", 0.9, "higher"), ("postpartum_care", 0.7, "higher"),
    ("aod_init", 0.4, "higher"), ("aod_engage", 0.15, "higher"),
]


def all_measure_results(spark, sf_dir, shared_pass: bool | None = None, inputs=None) -> dict:
    """Every registered measure (opt-in ones enabled) on one set of inputs."""
    from qmeasures.plans.registry import default_registry
    reg = default_registry().enable("DHS_assessments", "diabetes_oral_eval", "prev_dental_1_to_5",
                                    "prev_dental_6_to_14")
    return reg.run(_inputs(spark, sf_dir) if inputs is None else inputs, P, shared_pass=shared_pass)


def roster(spark, sf_dir) -> DataFrame:
    """member_id + reporting hierarchy (the member's first nation name)."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"])
            .select(F.concat(F.lit("M"), F.floor(F.col("c_custkey") / 5).cast("long").cast("string"))
                    .alias("member_id"), "n_name")
            .groupBy("member_id").agg(F.min("n_name").alias("mem_report_hier_1")))


def stack_results_q(spark, sf_dir) -> DataFrame:
    from qmeasures.plans.combine import stack_results
    return stack_results(all_measure_results(spark, sf_dir))


def shared_pass_results(spark, sf_dir) -> DataFrame:
    """All measures over one written pass of the claim lines' code columns."""
    from qmeasures.plans.combine import stack_results
    return stack_results(all_measure_results(spark, sf_dir, shared_pass=True))


def combined_results(spark, sf_dir) -> DataFrame:
    from qmeasures.plans.combine import abbreviations_frame, combine_results
    targets = spark.createDataFrame(DRIVER_TARGETS, "measure_name_short string, measure_target_value double, "
                                                    "measure_direction string")
    return combine_results(all_measure_results(spark, sf_dir), abbreviations_frame(spark), targets,
                           roster(spark, sf_dir))


def rate_summary_q(spark, sf_dir) -> DataFrame:
    from qmeasures.plans.combine import rate_summary
    # the all-visits table is reported as a rate beside the published measures; it is the one that the
    # mental-illness measure reads
    inp = _inputs(spark, sf_dir)
    results = all_measure_results(spark, sf_dir, inputs=inp)
    return rate_summary(results | {"ed_visits_all": ed_visits.shared_visits(inp, P)})


MEASURE_QUERIES = {
    "m_well_child": m_well_child,
    "m_ed_visits": m_ed_visits,
    "m_ed_visits_mi": m_ed_visits_mi,
    "m_custody": m_custody,
    "m_oral_eval": m_oral_eval,
    "m_prev_dental": m_prev_dental,
    "m_prenatal": m_prenatal,
    "m_postpartum": m_postpartum,
    "m_aod_init": m_aod_init,
    "m_aod_engage": m_aod_engage,
    "long_flags": long_flags,
    "stack_results": stack_results_q,
    "shared_pass_results": shared_pass_results,
    "combined_results": combined_results,
    "rate_summary": rate_summary_q,
}


def all_queries() -> dict:
    from qmeasures.plans import check_queries, operator_queries, scale_queries
    return MEASURE_QUERIES | operator_queries.QUERIES | check_queries.QUERIES | scale_queries.QUERIES


@lru_cache(maxsize=1)
def all_oracles() -> dict:
    from qmeasures.plans import oracle_sql as S
    from qmeasures.plans import check_queries, operator_queries, scale_queries
    out = {
        "m_well_child": S.well_child_sql(),
        "m_ed_visits": S.ed_all_sql(),
        "m_ed_visits_mi": S.ed_mi_sql(),
        "m_custody": S.custody_sql(),
        "m_oral_eval": S.oral_eval_sql(),
        "m_prev_dental": S.prev_dental_sql(),
        "m_prenatal": S.prenatal_sql("prenatal_care"),
        "m_postpartum": S.prenatal_sql("postpartum_care"),
        "m_aod_init": S.aod_sql("init"),
        "m_aod_engage": S.aod_sql("engage"),
        "long_flags": S.dental_long_sql(),
        "stack_results": S.stack_sql(),
        "shared_pass_results": S.stack_sql(),
        "combined_results": S.combined_sql(),
        "rate_summary": S.rate_summary_sql(),
    }
    return out | operator_queries.ORACLES() | check_queries.oracles() | scale_queries.oracles()
