"""Data-quality checks on reference tables and a result comparison helper.

Every check returns a violations DataFrame ``rule, key, detail`` (empty = pass);
:func:`check_references` stacks them and raises with ``fail_fast=True``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from qmeasures.schemas import COMMENT_LENGTH

# FIXED VALUES — code systems a code table may use.
ALLOWED_CODESYSTEMS = ["CPT", "HCPCS", "ICD9CM-Proc", "ICD9CM-Diag", "ICD10CM-Proc", "ICD10CM-Diag", "UBREV",
                       "UBTOB", "POS", "NDC", "CDT", "MODIFIER", "SNOMEDCT", "DENTAL", "TOOTH", "LOINC", "RXNORM"]
# FIXED VALUES — measure categories allowed in the code table besides reported abbreviations.
EXTRA_MEASURE_CATEGORIES = ["dental_services", "ED_Visits"]
DIAG_SYSTEMS = ["ICD9CM-Diag", "ICD10CM-Diag"]
DIAG_TYPES = ["", "All", "Primary", "Secondary"]


class ReferenceError_(AssertionError):
    """Failed checks; ``violations`` holds every violating row."""

    def __init__(self, message: str, violations: DataFrame):
        super().__init__(message)
        self.violations = violations


def raise_violations(violations: DataFrame) -> None:
    """Raise when there is any violation: counts by rule in the message, all rows attached."""
    counts = violations.groupBy("rule").count().orderBy("rule").collect()  # one row per rule
    if counts:
        raise ReferenceError_("checks failed: " + ", ".join(f"{r['rule']}: {r['count']}" for r in counts), violations)


def _v(df: DataFrame, rule: str, key: F.Column, detail: F.Column | None = None) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), key.cast("string").alias("key"),
                     (detail if detail is not None else F.lit(None)).cast("string").alias("detail"))


def unique_values(df: DataFrame, cols, rule: str) -> DataFrame:
    cols = [cols] if isinstance(cols, str) else list(cols)
    dup = df.groupBy(*cols).count().filter(F.col("count") > 1)
    return _v(dup, rule, F.concat_ws("|", *[F.col(c).cast("string") for c in cols]), F.col("count"))


def abbreviation_checks(abbreviations: DataFrame) -> DataFrame:
    """Q1: abbreviation and name are each unique."""
    return (unique_values(abbreviations, "measure_abbreviation", "abbreviation_unique")
            .unionByName(unique_values(abbreviations, "measure_name", "measure_name_unique")))


def code_table_checks(codes: DataFrame, abbreviations: DataFrame) -> DataFrame:
    """Q2-Q5 on one code table."""
    allowed_measures = (abbreviations.select(F.col("measure_abbreviation").alias("measure"))
                        .unionByName(codes.sparkSession.createDataFrame(
                            [(m,) for m in EXTRA_MEASURE_CATEGORIES], "measure string")))
    bad_measure = codes.join(allowed_measures, "measure", "left_anti")
    checks = [
        _v(bad_measure, "measure_known", F.col("measure"), F.col("component")),
        _v(codes.filter(~F.coalesce(F.col("codesystem").isin(ALLOWED_CODESYSTEMS), F.lit(False))), "codesystem_allowed",
           F.coalesce("codesystem", F.lit("(none)")), F.col("code")),
    ]
    grouped = codes.select("measure", "component", "grouping_id").distinct().filter(F.col("grouping_id").isNotNull())
    checks.append(unique_values(grouped, ["component", "grouping_id"], "grouping_id_unique_per_component"))
    dtype = F.coalesce(F.col("diag_type"), F.lit(""))
    bad_dtype = codes.filter((F.col("codesystem").isin(DIAG_SYSTEMS) & ~dtype.isin(DIAG_TYPES))
                             | (~F.col("codesystem").isin(DIAG_SYSTEMS) & (dtype != "")))
    checks.append(_v(bad_dtype, "diag_type_allowed", F.col("code"), F.col("diag_type")))
    checks.append(_v(codes.filter(F.col("code").contains(".")), "code_without_dot", F.col("code"),
                     F.col("component")))
    primaries = (codes.filter(F.col("grouping_id").isNotNull() & F.col("codesystem").isin(DIAG_SYSTEMS)
                              & (F.col("diag_type") == "Primary"))
                 .select("measure", "component", "grouping_id", "code").distinct())
    checks.append(unique_values(primaries, ["measure", "component", "grouping_id"], "one_primary_per_group"))
    sources = codes.select("measure", "component",
                           F.when(F.col("codesystem") == "NDC", "Outpharmacy").otherwise("Outclaims").alias("src")
                           ).distinct()
    checks.append(unique_values(sources, ["measure", "component"], "one_source_table_per_component"))
    return reduce(DataFrame.unionByName, checks)


def lookup_key_checks(codes: DataFrame, measure: str, component: str) -> DataFrame:
    """Q8: (code, ICD version) keys of a diagnosis lookup list are unique."""
    sl = codes.filter((F.lower("measure") == measure.lower()) & (F.lower("component") == component.lower())
                      & F.col("codesystem").isin(DIAG_SYSTEMS))
    keyed = sl.select("code", F.when(F.col("codesystem") == "ICD9CM-Diag", "09").otherwise("10").alias("ver"))
    return unique_values(keyed, ["code", "ver"], "lookup_key_unique")


def result_null_checks(df: DataFrame, cols) -> DataFrame:
    """Q7: no NULLs in required columns."""
    parts = [_v(df.filter(F.col(c).isNull()), "no_nulls", F.lit(c), F.col("member_id") if "member_id" in df.columns
                else F.lit(None)) for c in cols]
    return reduce(DataFrame.unionByName, parts)


def comment_length_checks(df: DataFrame, most: int = COMMENT_LENGTH) -> DataFrame:
    """Comments longer than the published column holds (they are kept whole)."""
    return _v(df.filter(F.length("comments") > most), "comment_fits", F.col("member_id"), F.length("comments"))


def one_row_per_member_checks(df: DataFrame) -> DataFrame:
    return unique_values(df, "member_id", "one_row_per_member")


def roster_checks(roster: DataFrame) -> DataFrame:
    """Members listed with more than one reporting hierarchy."""
    seen = roster.groupBy("member_id").agg(F.count_distinct(F.coalesce("mem_report_hier_1", F.lit("(none)"))).alias("n"))
    return _v(seen.filter("n > 1"), "one_hierarchy_per_member", F.col("member_id"), F.col("n"))


def target_checks(targets: DataFrame) -> DataFrame:
    return unique_values(targets.select(F.upper("measure_name_short").alias("measure_name_short")), "measure_name_short",
                         "target_unique")


def check_references(refs: dict, fail_fast: bool = False) -> DataFrame:
    """All reference-table checks; ``refs`` holds ``oha_abbreviations`` and any code tables."""
    abbreviations = refs["oha_abbreviations"]
    parts = [abbreviation_checks(abbreviations)]
    for name in ("oha_codes", "hedis_codes", "medications", "ecqm_value_sets"):
        if refs.get(name) is not None:
            parts.append(code_table_checks(refs[name], abbreviations)
                         .withColumn("detail", F.concat_ws(" ", F.lit(name + ":"), F.col("detail"))))
    out = reduce(DataFrame.unionByName, parts)
    if fail_fast:
        raise_violations(out)
    return out


def compare_results(expected: DataFrame, actual: DataFrame, keys=("member_id",),
                    pairs=(("anticipated_denominator", "denominator"), ("anticipated_numerator", "numerator")),
                    full_outer: bool = False) -> DataFrame:
    """Q9: expected vs actual rows that differ at 4 decimals (missing actual counts as 0).

    Left join from the expected rows; ``full_outer=True`` also reports actual rows
    without an expectation (multi-measure comparisons).
    """
    keys = list(keys)
    how = "full_outer" if full_outer else "left"
    j = expected.join(actual, keys, how)
    diff = None
    for exp, act in pairs:
        e = F.round(F.coalesce(F.col(exp).cast("double"), F.lit(0.0)), 4)
        a = F.round(F.coalesce(F.col(act).cast("double"), F.lit(0.0)), 4)
        d = ~e.eqNullSafe(a)
        diff = d if diff is None else (diff | d)
    return j.filter(diff)
