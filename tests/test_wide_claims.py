"""Claim lines with 15 diagnoses and 15 procedures: predicates match by position, and stay compilable."""
import re

import pytest
from pyspark.sql import functions as F

from conftest import codes
from qmeasures.functions.codes import any_versioned_diag, claims_filter, versioned_diag_codes
from qmeasures.operators.rollup import flag_columns

DIAGS, PROCS = [f"icddiag{i}" for i in range(1, 16)], [f"icdproc{i}" for i in range(1, 16)]


@pytest.fixture(scope="module")
def lines(spark):
    """Line (kind, i) holds the code X in the i-th column of its kind and nothing else."""
    rows = [("d", i) for i in range(1, 16)] + [("p", i) for i in range(1, 16)] + [("-", 0)]
    frame = spark.createDataFrame(rows, "kind string, i int")
    return frame.select("*", F.lit("10").alias("icdversion"), F.lit(None).cast("string").alias("hcpcs"),
                        *[F.when((F.col("kind") == "d") & (F.col("i") == k + 1), "X").alias(c) for k, c in enumerate(DIAGS)],
                        *[F.when((F.col("kind") == "p") & (F.col("i") == k + 1), "X").alias(c) for k, c in enumerate(PROCS)])


@pytest.mark.parametrize("system,kind,position,expected", [
    ("ICD10CM-Diag", "", "", [("d", i) for i in range(1, 16)]),
    ("ICD10CM-Diag", "", "All", [("d", i) for i in range(1, 16)]),
    ("ICD10CM-Diag", "", "Primary", [("d", 1)]),
    ("ICD10CM-Diag", "", "Secondary", [("d", i) for i in range(2, 16)]),
    ("ICD10CM-Proc", "", "", [("p", i) for i in range(1, 16)]),
])
def test_positions(spark, lines, system, kind, position, expected):
    listed = codes(spark, f"m~c~{system}~X~~{position}\nm~c~{system}~Y~~{position}")
    got = [(r["kind"], r["i"]) for r in lines.filter(claims_filter(listed, "m", "c", lines)).collect()]
    assert sorted(got) == sorted(expected)
    flagged = lines.select(claims_filter(listed, "m", "c", lines).alias("f"))
    assert flagged.filter("f is null").count() == 0


def test_versioned_lookup_reads_all_columns(spark, lines):
    for version, expected in (("10", 15), ("09", 0)):
        system = "ICD10CM-Diag" if version == "10" else "ICD9CM-Diag"
        found = versioned_diag_codes(codes(spark, f"m~c~{system}~X~~"), "m", "c")
        assert lines.filter(any_versioned_diag(lines, found)).count() == expected


def test_generated_code_stays_compilable(spark, lines, tmp_path):
    """The JVM does not compile methods above 8,000 bytes: 20 components of 40 codes in 3 systems stay below."""
    listed = codes(spark, "\n".join(f"m~c{c}~{s}~{s[-1]}{c}x{k}~~" for c in range(20) for k in range(40)
                                    for s in ("CPT", "ICD10CM-Diag", "ICD10CM-Proc")))
    path = str(tmp_path / "lines")
    lines.write.parquet(path)
    wide = spark.read.parquet(path)
    plan = flag_columns(wide, listed, "m", [f"c{c}" for c in range(20)], keep=["kind"])
    text = plan._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000, sizes
