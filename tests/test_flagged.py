"""Component flags by literals and by the join with the code table: same rules, same rows."""
import re
from functools import reduce

import pytest
from pyspark.sql import functions as F

from conftest import codes
from qmeasures.functions.codes import CodeTableError, any_versioned_diag, claims_filter, versioned_diag_codes
from qmeasures.inputs import ClaimsInputs
from qmeasures.operators import flagged, reuse
from qmeasures.operators.flagged import FlagRequest, flag_lines
from qmeasures.sources.adapter import load_inputs

TABLE = """
m~single~CPT~A1
m~single~HCPCS~A2
m~rev~UBREV~R1
m~mod~Modifier~95
m~first~ICD10CM-Diag~D1~~Primary
m~later~ICD10CM-Diag~D1~~Secondary
m~any~ICD10CM-Diag~D1~~All
m~any~ICD9CM-Diag~D2
m~proc~ICD10CM-Proc~P1
m~grp~CPT~A1~g1
m~grp~CPT~A3~g1
m~grp~ICD10CM-Diag~D2~g1
m~grp~UBREV~R1~g2
m~grp~Modifier~95~g2
m~quiet~LOINC~x
m~list~ICD10CM-Diag~D1
m~list~ICD9CM-Diag~D2
"""
COMPONENTS = ["single", "rev", "mod", "first", "later", "any", "proc", "grp", "quiet", "absent"]
REQUESTS = [FlagRequest("oha", "M", c.upper()) for c in COMPONENTS] + [
    FlagRequest("oha", "m", "list", versioned=True), FlagRequest("oha", "m", "grp", systems=("CPT",))]
SCHEMA = ("id long, member_id string, hcpcs string, revcode string, modifier string, modifier2 string, icdversion string, "
          "icddiag1 string, icddiag2 string, icddiag3 string, icdproc1 string")


@pytest.fixture(scope="module")
def lines(spark):
    values = [("A1", "A2", "A3", None), ("R1", None), ("95", None), (None, "95"), ("10", "09", None), ("D1", "D2", None),
              (None, "D1"), ("D2", None), ("P1", None)]
    rows, x = [], 7
    for i in range(400):
        row = []
        for v in values:
            x = (x * 1103515245 + 12345) % 2**31
            row.append(v[(x >> 8) % len(v)])
        rows.append((i, "hot" if i % 3 == 0 else f"m{i}", *row))
    rows += [rows[0], rows[1], (1000, None, *[None] * 9), (1001, "x", "", "", "", "", "", "", "", "", "")]
    return spark.createDataFrame(rows, SCHEMA)


def direct(lines, table):
    """Flags by one literal predicate each over all lines, for lines with any."""
    listed = versioned_diag_codes(table, "m", "list")
    flags = {FlagRequest("oha", "m", c).name: claims_filter(table, "m", c, lines) for c in COMPONENTS}
    flags[REQUESTS[-2].name] = any_versioned_diag(lines, listed)
    flags[REQUESTS[-1].name] = F.coalesce(F.col("hcpcs").isin("A1", "A3"), F.lit(False))
    rows = lines.select("id", "member_id", *[v.alias(k) for k, v in flags.items()]).collect()
    return sorted((tuple(r.asDict().items()) for r in rows if any(r[k] for k in flags)), key=str)


def got(frame, columns):
    rows = [tuple((c, r[c]) for c in columns) for r in frame.collect()]
    return sorted((r for r in rows if any(v for k, v in r[2:])), key=str)


@pytest.mark.parametrize("literal_codes", [2_000, 0])
def test_both_ways_follow_the_predicate_rules(spark, lines, literal_codes):
    table = codes(spark, TABLE)
    want = direct(lines, table)
    found = flag_lines(lines, {"oha": table}, REQUESTS, ["id", "member_id"], literal_codes)
    assert got(found, [k for k, _ in want[0]]) == want
    names = [r.name for r in REQUESTS]
    assert found.filter(" OR ".join(f"`{n}` IS NULL" for n in names)).count() == 0


def test_more_components_than_one_word(spark, lines):
    table = codes(spark, "\n".join(f"m~c{i}~CPT~A{i % 4}" for i in range(150)))
    requests = [FlagRequest("oha", "m", f"c{i}") for i in range(150)]
    found = flag_lines(lines, {"oha": table}, requests, ["id"])
    sums = found.agg(*[F.count_if(f"`{r.name}`").alias(r.component) for r in requests]).first()
    by_code = {r.hcpcs: r["count"] for r in lines.groupBy("hcpcs").count().collect()}
    assert [sums[f"c{i}"] for i in range(150)] == [by_code.get(f"A{i % 4}", 0) for i in range(150)]


@pytest.mark.parametrize("literal_codes", [2_000, 0])
def test_faults_raise(spark, lines, literal_codes):
    table = codes(spark, "m~a~NOPE~1\nm~b~ICD10CM-Diag~D1\nm~b~ICD10CM-Diag~D1~g\nm~c~CPT~1\nm~c~ICD10CM-Diag~D1")
    for request in (FlagRequest("oha", "m", "a"), FlagRequest("oha", "m", "b", versioned=True),
                    FlagRequest("oha", "m", "c", versioned=True, only=("ICD10CM-Diag",))):
        with pytest.raises(CodeTableError):
            flag_lines(lines, {"oha": table}, [request], ["id"], literal_codes)


def test_a_large_list_stays_off_the_driver(spark, lines, monkeypatch):
    """100,000 codes: the driver reads at most the literal bound and the shape of the lists."""
    many = spark.range(100_000).select(
        F.lit("m").alias("measure"), F.lit("big").alias("component"), F.lit("CPT").alias("codesystem"),
        F.concat(F.lit("A"), F.col("id")).alias("code"), F.lit(None).cast("string").alias("grouping_id"),
        F.lit(None).cast("string").alias("diag_type"))
    read = []
    from pyspark.sql.classic.dataframe import DataFrame
    collect = DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: read.append(collect(self)) or read[-1])
    found = flag_lines(lines, {"oha": many}, [FlagRequest("oha", "m", "big")], ["id"], literal_codes=100)
    assert max(map(len, read)) <= 101
    monkeypatch.undo()
    assert found.count() == lines.where("hcpcs rlike '^A'").count()
    text = found._jdf.queryExecution().toString()
    assert "A99999" not in text


def test_what_is_written_for_many_components_stays_compilable(spark, lines, monkeypatch):
    """The JVM does not compile methods above 8,000 bytes: 70 components are written as bits, and read as their flags."""
    systems = [("CPT", "A"), ("ICD10CM-Diag", "D"), ("UBREV", "R"), ("Modifier", "9")]
    table = codes(spark, "\n".join(f"m~c{i}~{s}~{c}{i % 6}~{'' if i % 2 else 'g'}" for i in range(70) for s, c in systems))
    requests = [FlagRequest("oha", "m", f"c{i}") for i in range(70)]
    inputs = ClaimsInputs(member=lines.select("member_id"), outclaims=lines, oha_codes=table)
    written = []
    monkeypatch.setattr(reuse, "observers", [written.append])
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan has no generated code before it runs
    try:
        inputs.prepare_flags(requests)
        text = written[-1]._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000, sizes
    shared = inputs.flagged_lines(requests)
    lazy = flag_lines(lines, {"oha": table}, requests, inputs.LINE_COLUMNS)
    assert shared.columns == lazy.columns
    assert sorted(map(str, shared.collect())) == sorted(map(str, lazy.collect()))
    assert shared.where(F.col(f"`{requests[1].name}`")).count() == lines.where(
        "hcpcs = 'A1' or icddiag1 = 'D1' or icddiag2 = 'D1' or icddiag3 = 'D1' or revcode = 'R1'").count()


def test_filters_on_many_shared_flags_stay_small_plans(spark, lines):
    """A constraint for each subset of 12 flags (4,096) filled the driver's memory."""
    table = codes(spark, "\n".join(f"m~c{i}~CPT~A{i % 6}~~" for i in range(30)))
    requests = [FlagRequest("oha", "m", f"c{i}") for i in range(30)]
    inputs = ClaimsInputs(member=lines.select("member_id"), outclaims=lines, oha_codes=table)
    inputs.prepare_flags(requests)
    for n in (2, 12):
        wanted = requests[:n]
        got = inputs.flagged_lines(wanted, F.col("member_id").isNotNull() if n == 12 else None)
        some = reduce(lambda a, b: a | b, [F.col(f"`{r.name}`") for r in wanted])
        plan = got.where(some).select("member_id", *[F.col(f"`{r.name}`").cast("int").alias(r.component) for r in wanted])
        assert plan._jdf.queryExecution().optimizedPlan().constraints().size() < 100
        listed = sorted({f"A{i % 6}" for i in range(n)})
        assert plan.count() == lines.where(F.col("hcpcs").isin(listed)).count() > 0
        assert got.count() == plan.count()


def test_shared_pass_scans_the_codes_once(spark):
    from qmeasures.operators import reuse
    from qmeasures.plans.registry import default_registry
    from qmeasures.sources.adapter import DRIVER_PARAMS
    inputs = load_inputs(spark, "/root/testdata/sf0.001")
    plans = []
    reuse.observers.append(lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()))
    try:
        reg = default_registry()
        shared = reg.run(inputs, DRIVER_PARAMS, shared_pass=True)
    finally:
        reuse.observers.pop()
    assert sum("icddiag15" in p for p in plans) == 1
    inputs.forget()
    apart = default_registry().run(load_inputs(spark, "/root/testdata/sf0.001"), DRIVER_PARAMS, shared_pass=False)
    for name in shared:
        assert sorted(map(str, shared[name].collect())) == sorted(map(str, apart[name].collect())), name


def test_words_hold_the_bits_of_a_long():
    assert flagged.WORD_BITS < 63
