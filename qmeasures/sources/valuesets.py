"""Value-set XML ingest (IHE SVS ``RetrieveValueSetResponse`` files already on disk).

Each ``ValueSet`` element carries its OID in the ``ID`` attribute and a
``ConceptList`` of ``Concept`` elements whose attributes are the codes.  The XML
source reads one row per value set (``rowTag``), so the OID stays attached to its
concepts; ``explode`` flattens the concepts.  An explicit schema keeps OIDs such as
``1.2`` as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# FIXED VALUES — value-set code-system names -> code table code systems.
VALUESET_CODESYSTEM_MAP = {
    "SNOMEDCT": "SNOMEDCT",
    "CPT": "CPT",
    "HCPCS": "HCPCS",
    "ICD10CM": "ICD10CM-Diag",
    "ICD10PCS": "ICD10CM-Proc",
    "ICD9CM": "ICD9CM-Diag",
    "ICD9PCS": "ICD9CM-Proc",
    "LOINC": "LOINC",
    "UBREV": "UBREV",
    "RXNORM": "RXNORM",
}

CONCEPT_ATTRS = ["code", "codeSystem", "codeSystemName", "codeSystemVersion", "displayName"]


def _schema(prefix: str) -> T.StructType:
    concept = T.StructType([T.StructField("_" + a, T.StringType()) for a in CONCEPT_ATTRS])
    return T.StructType([
        T.StructField("_ID", T.StringType()),
        T.StructField("_displayName", T.StringType()),
        T.StructField(f"{prefix}ConceptList", T.StructType([
            T.StructField(f"{prefix}Concept", T.ArrayType(concept))])),
    ])


def read_value_set_concepts(spark: SparkSession, path: str, prefix: str = "ns0:") -> DataFrame:
    """value_set_oid + concept attributes, one row per concept."""
    raw = (spark.read.format("xml").option("rowTag", f"{prefix}ValueSet")
           .schema(_schema(prefix)).load(path))
    concepts = raw.select(F.col("_ID").alias("value_set_oid"),
                          F.explode(F.col(f"`{prefix}ConceptList`.`{prefix}Concept`")).alias("c"))
    return concepts.select("value_set_oid", *[F.col("c._" + a).alias(a) for a in CONCEPT_ATTRS])


def value_set_checks(concepts: DataFrame, requests: DataFrame) -> DataFrame:
    """Violations (rule, key, detail): requested OIDs without a file, unknown code systems."""
    absent = requests.join(concepts.select("value_set_oid").distinct(), "value_set_oid", "left_anti")
    listed = requests.select("value_set_oid").distinct().join(concepts, "value_set_oid")
    unknown = listed.filter(~F.coalesce(F.col("codeSystemName").isin(list(VALUESET_CODESYSTEM_MAP)), F.lit(False)))
    return absent.select(F.lit("value_set_present").alias("rule"), F.col("value_set_oid").alias("key"),
                         F.col("value_set_name").alias("detail")).unionByName(
        unknown.select(F.lit("code_system_known").alias("rule"), F.col("value_set_oid").alias("key"),
                       F.coalesce("codeSystemName", F.lit("(none)")).alias("detail")).distinct())


def value_set_codes(concepts: DataFrame, requests: DataFrame, fail_fast: bool = True) -> tuple[DataFrame, DataFrame]:
    """(full listing, code-table rows) for the requested value sets.

    ``requests``: Measure, component_name, value_set_name, value_set_oid.  With
    ``fail_fast`` any violation of :func:`value_set_checks` raises.
    """
    if fail_fast:
        from qmeasures.plans.validate import raise_violations
        raise_violations(value_set_checks(concepts, requests))
    full = requests.join(concepts, "value_set_oid").select(
        "Measure", "component_name", "value_set_name", "value_set_oid", *CONCEPT_ATTRS)
    cs_map = F.create_map(*[F.lit(x) for kv in VALUESET_CODESYSTEM_MAP.items() for x in kv])
    skinny = full.select(
        F.col("Measure").alias("measure"), F.col("component_name").alias("component"),
        F.coalesce(cs_map[F.col("codeSystemName")], F.col("codeSystemName"), F.lit("(none)")).alias("codesystem"),
        F.regexp_replace("code", r"\.", "").alias("code"),
        F.lit(None).cast("string").alias("grouping_id"), F.lit(None).cast("string").alias("diag_type"))
    return full, skinny
