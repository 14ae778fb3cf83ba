import datetime as dt
import os

from qmeasures.inputs import ClaimsInputs
from qmeasures.session import ensure_checkpoint_dir
from qmeasures.sources import adapter


def tables(spark, path):
    rows = [(k, k % 7, dt.date(1998, 1 + k % 9, 1 + k % 28), "P" if k % 3 else "F", "1-URGENT") for k in range(60)]
    lines = [(k, k * 3 + n, k % 11, 2 * n, "A", "O") for k in range(60) for n in range(1, 4)]
    frames = {
        "customer": spark.createDataFrame([(k, 1.0) for k in range(7)], "c_custkey long, c_acctbal double"),
        "supplier": spark.createDataFrame([(k, k % 5) for k in range(11)], "s_suppkey long, s_nationkey int"),
        "orders": spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate date, o_orderstatus string, "
                                              "o_orderpriority string"),
        "lineitem": spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                                                 "l_returnflag string, l_linestatus string"),
    }
    for name, frame in frames.items():
        frame.write.parquet(f"{path}/{name}.parquet")
    return str(path)


def staged(spark):
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f"{m}/{t}" for m in os.listdir(root) if m.startswith("model-") for t in os.listdir(f"{root}/{m}")}


def test_only_tables_that_are_read_are_written(spark, tmp_path):
    before, inputs = staged(spark), adapter.load_inputs(spark, tables(spark, tmp_path))
    assert inputs.members().count() == 2
    assert staged(spark) == before
    spans = inputs.with_(predictions=None).member_time
    assert {t.split("/")[1] for t in staged(spark) - before} == {"member_time"}
    assert inputs.member_time is spans and inputs.with_(predictions=None).predictions is None
    plain = adapter.load_inputs(spark, str(tmp_path), staged=False)
    for name in ("member_time", "member_months", "outclaims", "outpharmacy", "inpdental", "foster_care", "providers"):
        got, want = (sorted(map(str, getattr(i, name).collect())) for i in (inputs, plain))
        assert got == want and got, name
    assert isinstance(inputs, ClaimsInputs) and len(staged(spark) - before) == 4


def test_claim_lines_are_ordered_before_they_are_wide(spark, tmp_path):
    model = adapter.derive_model(spark, tables(spark, tmp_path), by_date=True)
    plan = model["lines"]._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Sort":
        plan = plan.children().apply(0)
    assert plan.output().size() <= 12
    days = model["lines"].coalesce(1).select("prm_fromdate").collect()
    assert len(days) == 180


def test_rate_summary_flags_emergency_lines_once(spark, tmp_path):
    from qmeasures.operators import reuse
    from qmeasures.plans.queries import rate_summary_q
    path, written = tables(spark, tmp_path), []
    reuse.observers.append(lambda df: written.append(df.columns))
    try:
        rates = rate_summary_q(spark, path)
    finally:
        reuse.observers.pop()
    assert sum("is_psych" in columns for columns in written) == 1
    assert {"ED_VISITS_ALL", "ED_VISITS_MI"} <= {r.Measure_Abbreviation.upper() for r in rates.collect()}
