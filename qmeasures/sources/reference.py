"""Reference-data ingest: schema CSVs, strict CSV scans, parquet sink.

Layout of a reference folder: ``_data/<Name>.csv`` holds the rows and
``_schemas/<Name>.csv`` the declared columns (``name, datatype, nullable,
sas_informat``).  Every data file becomes one table named after its lower-cased stem.
"""

from __future__ import annotations

import csv
import os

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from qmeasures.operators.ordinal import file_ordinal

_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "integer": T.IntegerType(), "int": T.IntegerType(),
          "long": T.LongType(), "date": T.DateType(), "boolean": T.BooleanType()}


def build_structtype_from_csv(path: str) -> T.StructType:
    """Schema from a 4-column schema CSV (read on the driver: a handful of lines).

    Nullability is recorded as declared; file reads make every field nullable, so
    :func:`not_null` enforces it while rows are read and :func:`null_violations` reports it.
    """
    spark = SparkSession.active()
    lines = [r["value"] for r in spark.read.text(path, wholetext=True).collect()]
    fields = []
    for row in csv.DictReader(lines[0].splitlines()):
        dtype = _TYPES[row["datatype"].strip().lower()]
        nullable = row["nullable"].strip().lower() == "true"
        fields.append(T.StructField(row["name"].strip(), dtype, nullable))
    return T.StructType(fields)


def not_null(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """``df`` whose reads raise at a NULL in a column that the schema declares not nullable."""
    strict = {f.name for f in schema.fields if not f.nullable}
    held = {c: F.coalesce(F.col(c), F.raise_error(F.lit(f"NULL in {table}.{c}, declared not nullable"))) for c in strict}
    return df.select(*[held[c].alias(c) if c in held else F.col(c) for c in df.columns])


def null_violations(df: DataFrame, schema: T.StructType, table: str) -> DataFrame:
    """``rule, key, detail``: NULLs by column that the schema declares not nullable (one pass)."""
    strict = [f.name for f in schema.fields if not f.nullable]
    if not strict:
        return df.sparkSession.createDataFrame([], "rule string, key string, detail string")
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in strict])
    listed = F.explode(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).alias("n")) for c in strict])).alias("v")
    return counts.select(listed).filter("v.n > 0").select(
        F.lit("declared_not_null").alias("rule"), F.concat_ws(".", F.lit(table), "v.key").alias("key"),
        F.col("v.n").cast("string").alias("detail"))


def read_reference_csv(spark: SparkSession, data_path: str, schema: T.StructType,
                       ordinal_col: str | None = "_ordinal") -> DataFrame:
    """Strict CSV scan: declared schema applied by position, FAILFAST, header, trimmed.

    ``ordinal_col`` keeps the file order as an explicit column (the order of the
    abbreviation file is meaningful).
    """
    df = spark.read.csv(data_path, schema=schema, sep=",", mode="FAILFAST", header=True,
                        enforceSchema=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    if ordinal_col:
        df = file_ordinal(df, ordinal_col)
    return df


def import_flatfile_references(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every ``_data/*.csv`` with its ``_schemas`` twin, keyed by lower-cased stem.

    The folder may lie on any file system that Spark reads.  Reading a table raises when its
    file breaks the schema or a column declared not nullable holds a NULL.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/") + "/_data")
    listed = where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)
    refs = {}
    for data_path in sorted(s.getPath().toString() for s in listed):
        stem, kind = os.path.splitext(data_path.rsplit("/", 1)[1])
        if kind != ".csv":
            continue
        schema = build_structtype_from_csv(f"{folder.rstrip('/')}/_schemas/{stem}.csv")
        refs[stem.lower()] = not_null(read_reference_csv(spark, data_path, schema), schema, stem)
    return refs


def write_references(refs: dict[str, DataFrame], out_folder: str) -> dict[str, str]:
    """Parquet sink, one dataset per table (overwrite); the file order stays in ``_ordinal``."""
    paths = {}
    for name, df in refs.items():
        path = os.path.join(out_folder, f"{name}.parquet")
        df.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths


LABEL_KEY = "label"


def dataset_label(path: str, spark: SparkSession) -> str | None:
    """The label that :func:`write_results` stored with a result."""
    return spark.read.parquet(path).schema["member_id"].metadata.get(LABEL_KEY)


def label_result(df: DataFrame, label: str) -> DataFrame:
    """``df`` with its dataset label kept as metadata of the key column."""
    return df.withMetadata("member_id", {LABEL_KEY: label})


def write_results(results: dict[str, DataFrame], out_folder: str, prefix: str = "results_",
                  labels: dict[str, str] | None = None) -> dict[str, str]:
    """Result sink: ``results_<measure>`` parquet datasets.

    The dataset label (default ``<measure> results``) is kept in the schema, as metadata
    of the key column, and so survives the parquet files.
    """
    paths = {}
    for name, df in results.items():
        path = os.path.join(out_folder, f"{prefix}{name}.parquet")
        label = (labels or {}).get(name, f"{name} results")
        label_result(df, label).write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths
