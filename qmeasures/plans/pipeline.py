"""Full run: every active measure -> result tables -> stacked, published and reference tables.

``python -m qmeasures.plans.pipeline --sf-dir /root/testdata/sf0.01 --out <folder>`` runs the
pipeline on the driver tables through the adapter; :func:`run_pipeline` takes any
``ClaimsInputs``.
"""

from __future__ import annotations

import argparse
import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from qmeasures.inputs import ClaimsInputs
from qmeasures.operators.reuse import run_scope
from qmeasures.params import MeasureParams
from qmeasures.plans.combine import combine_results, measure_reference, rate_summary, stack_results
from qmeasures.plans.publish import discover, publish, write_run
from qmeasures.plans.registry import MeasureRegistry
from qmeasures.plans.validate import (check_references, one_row_per_member_checks, raise_violations, roster_checks,
                                      target_checks)


# custody keeps one row per notification outcome
SEVERAL_ROWS_PER_MEMBER = {"DHS_ASSESSMENTS"}


def run_pipeline(inputs: ClaimsInputs, params: MeasureParams, registry: MeasureRegistry,
                 abbreviations: DataFrame, targets: DataFrame, roster: DataFrame, out_dir: str) -> dict:
    """Write ``results_<measure>`` into a run folder and publish it by its manifest; then write
    ``stacked_results_raw``, ``quality_measures`` and ``ref_quality_measures`` as parquet under
    ``out_dir``.  Returns the rate summary rows.

    Reference tables, targets and roster are checked before anything is computed, the
    results while and after they are written; any violation raises and nothing is published.
    """
    # checks first: nothing is written when a reference table or the roster is faulty
    # (measure names and code systems of the mapped value-set tables are the mapping's own)
    refs = {"oha_abbreviations": abbreviations, "oha_codes": inputs.oha_codes}
    checks = [check_references(refs), roster_checks(roster), target_checks(targets)]
    raise_violations(reduce(DataFrame.unionByName, checks))
    spark = abbreviations.sparkSession
    with run_scope(spark):  # the run's intermediates go when its results are written
        described = write_run(registry.run(inputs, params), out_dir)
        inputs.forget()
    # NULLs and comment lengths were counted by the writes; repeated members need a look at the tables
    single = [one_row_per_member_checks(spark.read.parquet(t["path"])) for name, t in described["tables"].items()
              if name.upper() not in SEVERAL_ROWS_PER_MEMBER]
    raise_violations(reduce(DataFrame.unionByName, single))
    publish(spark, described, out_dir)
    # later steps read the published result tables, not the measure plans again
    written = discover(spark, out_dir, described["run"])
    stack_results(written).write.mode("overwrite").parquet(os.path.join(out_dir, "stacked_results_raw.parquet"))
    combine_results(written, abbreviations, targets, roster).write.mode("overwrite").parquet(
        os.path.join(out_dir, "quality_measures.parquet"))
    measure_reference(abbreviations, targets).write.mode("overwrite").parquet(
        os.path.join(out_dir, "ref_quality_measures.parquet"))
    rates = {r["Measure_Abbreviation"]: (r["sum_numerator"], r["sum_denominator"], r["measure_rate"])
             for r in rate_summary(written).collect()}
    return rates


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--out", required=True)
    args = ap.parse_args(argv)
    from qmeasures.plans.combine import abbreviations_frame
    from qmeasures.plans.queries import DRIVER_TARGETS, roster
    from qmeasures.plans.registry import default_registry
    from qmeasures.session import local_session
    from qmeasures.sources.adapter import DRIVER_PARAMS, load_inputs
    spark = SparkSession.getActiveSession() or local_session()
    reg = default_registry().enable("DHS_assessments", "diabetes_oral_eval", "prev_dental_1_to_5",
                                    "prev_dental_6_to_14")
    targets = spark.createDataFrame(DRIVER_TARGETS, "measure_name_short string, measure_target_value double, "
                                                    "measure_direction string")
    rates = run_pipeline(load_inputs(spark, args.sf_dir), DRIVER_PARAMS, reg, abbreviations_frame(spark), targets,
                         roster(spark, args.sf_dir), args.out)
    for name, (num, den, rate) in sorted(rates.items()):
        print(f"{name:24s} numerator={num:10.3f} denominator={den:10.3f} rate={rate:.4f}")


if __name__ == "__main__":
    main()
