"""End-to-end smoke: driver entry on sf0.001 and the full pipeline writing parquet."""
import os
import tempfile

import pytest

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
def test_entry_and_pipeline(spark):
    import __spark_entry__ as E
    from qmeasures.plans.combine import PUBLISHED_COLUMNS, abbreviations_frame
    from qmeasures.plans.pipeline import run_pipeline
    from qmeasures.plans.queries import DRIVER_TARGETS, roster
    from qmeasures.plans.registry import default_registry
    from qmeasures.schemas import RESULT_SCHEMA
    from qmeasures.sources.adapter import DRIVER_PARAMS, load_inputs

    res = E.entry(spark)
    assert [f.name for f in res.schema.fields] == [f.name for f in RESULT_SCHEMA.fields]
    assert res.count() >= 0
    from qmeasures.plans.queries import all_oracles, all_queries
    assert set(all_queries()) == set(all_oracles()) and set(E.oracle_sql()) <= set(E.queries())

    os.makedirs("/tmp/qm", exist_ok=True)
    out = tempfile.mkdtemp(prefix="pipeline-", dir="/tmp/qm")
    reg = default_registry().enable("DHS_assessments", "diabetes_oral_eval", "prev_dental_1_to_5",
                                    "prev_dental_6_to_14")
    targets = spark.createDataFrame(DRIVER_TARGETS, "measure_name_short string, measure_target_value double, "
                                                    "measure_direction string")
    rates = run_pipeline(load_inputs(spark, SF), DRIVER_PARAMS, reg, abbreviations_frame(spark), targets,
                         roster(spark, SF), out)
    assert set(rates) <= {k.upper() for k, *_ in DRIVER_TARGETS}
    published = spark.read.parquet(os.path.join(out, "quality_measures.parquet"))
    assert published.columns == PUBLISHED_COLUMNS
    assert spark.read.parquet(os.path.join(out, "ref_quality_measures.parquet")).count() == 23
