"""Claims inputs from a folder of parquet tables, with a schema check.

``load_claims(spark, claims, references)`` reads ``<claims>/<table>.parquet`` and
``<references>/<table>.parquet`` (as written by the reference sink).  A required table
that is absent, a column that is absent and a column of another type are all reported
together in one :class:`InputError`; optional tables that are absent become ``None``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qmeasures.inputs import ClaimsInputs
from qmeasures.schemas import CODE_TABLE_SCHEMA
from qmeasures.sources.mappings import default_components

_LINE = {"member_id": "string", "hcpcs": "string"}
REQUIRED = {
    "member": {"member_id": "string", "dob": "date"},
    "outclaims": {**_LINE, "claimid": "string", "prm_line": "string", "prm_fromdate": "date", "prm_todate": "date",
                  "fromdate": "date", "prm_fromdate_case": "date", "prm_todate_case": "date", "revcode": "string",
                  "pos": "string", "modifier": "string", "modifier2": "string", "icdversion": "string",
                  "icddiag1": "string", "prm_denied_yn": "string"},
    "member_time": {"member_id": "string", "date_start": "date", "date_end": "date", "cover_medical": "string"},
    "member_months": {"member_id": "string", "elig_month": "date", "memmos": "double", "cover_medical": "string"},
    "outpharmacy": {"member_id": "string", "claimid": "string", "prm_fromdate": "date", "ndc": "string"},
}
OPTIONAL = {
    "inpdental": {**_LINE, "fromdate": "date", "providerid": "string"},
    "providers": {"prv_id": "string", "prv_taxonomy_cd": "string"},
    "foster_care": {"member_id": "string", "report_date": "date", "dob": "date", "branch_code": "string",
                    "eligibility_effective_date": "date"},
    "predictions": {"member_id": "string", "er_visits_pred_prob": "double"},
}
_CODES = {f.name: f.dataType.simpleString() for f in CODE_TABLE_SCHEMA.fields}
REFERENCES = {"oha_codes": _CODES, "hedis_codes": _CODES, "medications": _CODES}
OPTIONAL_REFERENCES = {"dental_taxonomy": {}, "components": {"measure": "string", "component": "string", "source": "string",
                                                            "ordinal": "bigint"}}


class InputError(ValueError):
    """What is wrong with the input tables, all of it."""


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def schema_faults(name: str, df: DataFrame, wanted: dict[str, str]) -> list[str]:
    have = {c.lower(): t for c, t in df.dtypes}
    out = [f"{name}.{c} is missing" for c in wanted if c not in have]
    return out + [f"{name}.{c} is {have[c]}, not {t}" for c, t in wanted.items() if c in have and have[c] != t]


def load_claims(spark: SparkSession, claims: str, references: str) -> ClaimsInputs:
    tables: dict[str, DataFrame] = {}
    faults: list[str] = []
    for folder, wanted, needed in ((claims, REQUIRED, True), (claims, OPTIONAL, False), (references, REFERENCES, True),
                                   (references, OPTIONAL_REFERENCES, False)):
        for name, columns in wanted.items():
            path = f"{folder.rstrip('/')}/{name}.parquet"
            if _exists(spark, path):
                tables[name] = spark.read.parquet(path)
                faults += schema_faults(name, tables[name], columns)
            elif needed:
                faults.append(f"table {name} is missing")
    if faults:
        raise InputError("; ".join(faults))
    tables.setdefault("components", default_components(spark))
    if "dental_taxonomy" in tables:  # the reference file has one column, under its own name
        tables["dental_taxonomy"] = tables["dental_taxonomy"].drop("_ordinal").toDF("taxonomy_code")
    return ClaimsInputs(**tables)
