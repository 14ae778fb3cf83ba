"""Component mappings (value set -> component) and code-set normalizers.

* :func:`read_mapping_csv`        – a 3-column mapping CSV with a header row (S4).
* :func:`mapping_union`           – medical + drug mappings stacked with a source tag (S5).
* :func:`normalize_medical_codes` – vendor value-set code list x mapping -> code table (S6).
* :func:`normalize_drug_codes`    – medication list x mapping -> NDC code table (S7).
* :func:`missing_value_sets`      – mapped value sets without any code (Q6).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from qmeasures.sources import refdata

# FIXED VALUES — vendor code-system names -> code table code systems.
MEDICAL_CODESYSTEM_MAP = {
    "SNOMED CT US Edition": "SNOMEDCT",
    "CPT": "CPT",
    "HCPCS": "HCPCS",
    "CPT-CAT-II": "CPT",
    "ICD10CM": "ICD10CM-Diag",
    "ICD10PCS": "ICD10CM-Proc",
    "ICD9CM": "ICD9CM-Diag",
    "ICD9PCS": "ICD9CM-Proc",
    "LOINC": "LOINC",
    "UBREV": "UBREV",
    "RXNORM": "RXNORM",
    "POS": "POS",
    "Modifier": "Modifier",
}


def _map_literal(mapping: dict):
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])


def read_mapping_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read a mapping CSV (header, 3 columns) as measure, value_set_name, component + ordinal."""
    raw = spark.read.csv(path, header=True, schema="measure string, value_set_name string, component string",
                         enforceSchema=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    # The file order is meaningful (component order); keep it as an explicit ordinal.  A
    # mapping is one small file: the ordinal is the line number, whatever the splits are.
    return raw.coalesce(1).withColumn("ordinal", F.monotonically_increasing_id())


def default_mappings(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    schema = "measure string, value_set_name string, component string, ordinal long"
    hedis = spark.createDataFrame([(*r, i) for i, r in enumerate(refdata.HEDIS_MAPPING)], schema)
    meds = spark.createDataFrame([(*r, i) for i, r in enumerate(refdata.MEDICATION_MAPPING)], schema)
    return hedis, meds


def mapping_union(hedis: DataFrame, meds: DataFrame, measures=None, drop_components=()) -> DataFrame:
    """Stack both mappings: measure, value_set_name, component, source, ordinal.

    Medical rows come first (source ``hedis``), then drug rows (source ``medications``).
    ``drop_components`` removes components by name (case-insensitive).
    """
    h = hedis.select("measure", "value_set_name", "component", F.lit("hedis").alias("source"),
                     F.col("ordinal").cast("long").alias("ordinal"))
    m = meds.select("measure", "value_set_name", "component", F.lit("medications").alias("source"),
                    (F.col("ordinal").cast("long") + F.lit(1_000_000_000)).alias("ordinal"))
    out = h.unionByName(m)
    if measures is not None:
        out = out.filter(F.col("measure").isin(list(measures)))
    if drop_components:
        out = out.filter(~F.lower("component").isin([c.lower() for c in drop_components]))
    return out


def default_components(spark: SparkSession) -> DataFrame:
    return mapping_union(*default_mappings(spark))


class MissingValueSets(ValueError):
    pass


def require_value_sets(code_list: DataFrame, mapping: DataFrame) -> None:
    """Raise when a mapped value set has no code in the list (the mapping names a few hundred)."""
    missing = sorted(r[0] for r in missing_value_sets(code_list, mapping)
                     .select(F.coalesce("value_set_name", F.lit("(none)"))).distinct().collect())
    if missing:
        raise MissingValueSets(f"Some value sets were not found: {missing}")


def normalize_medical_codes(code_list: DataFrame, mapping: DataFrame, require_all: bool = True) -> DataFrame:
    """Vendor code list (``value_set_name, code, code_system``) x mapping -> code table.

    Dots are removed from codes; vendor code systems map through
    :data:`MEDICAL_CODESYSTEM_MAP`.  An unknown system keeps its vendor name (a missing one
    reads ``(none)``), so the code-system check reports the row.  A mapped set without
    codes raises :class:`MissingValueSets` unless ``require_all`` is off.
    """
    if require_all:
        require_value_sets(code_list, mapping)
    joined = code_list.join(mapping.select("measure", "value_set_name", "component"),
                            "value_set_name", "inner")
    return joined.select(
        F.col("measure"), F.col("component"),
        F.coalesce(_map_literal(MEDICAL_CODESYSTEM_MAP)[F.col("code_system")], F.col("code_system"),
                   F.lit("(none)")).alias("codesystem"),
        F.regexp_replace(F.col("code").cast("string"), r"\.", "").alias("code"),
        F.lit(None).cast("string").alias("grouping_id"),
        F.lit(None).cast("string").alias("diag_type"))


def normalize_drug_codes(med_list: DataFrame, mapping: DataFrame, require_all: bool = True) -> DataFrame:
    """Medication list (``value_set_name, code, code_system``) x mapping -> NDC code table.

    A mapped list without codes raises, as in :func:`normalize_medical_codes`.
    """
    if require_all:
        require_value_sets(med_list, mapping)
    joined = med_list.join(mapping.select("measure", "value_set_name", "component"),
                           "value_set_name", "inner")
    return joined.filter(F.col("code_system") == "NDC").select(
        F.col("measure"), F.col("component"), F.lit("NDC").alias("codesystem"),
        F.col("code").cast("string").alias("code"),
        F.lit(None).cast("string").alias("grouping_id"),
        F.lit(None).cast("string").alias("diag_type"))


def missing_value_sets(code_list: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mapping rows whose value set has no code in the list (must be empty)."""
    return mapping.join(code_list.select("value_set_name").distinct(), "value_set_name", "left_anti")
