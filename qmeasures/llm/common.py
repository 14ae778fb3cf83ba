"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qmeasures.operators.reuse import materialize  # noqa: F401  re-exported
from qmeasures.session import ensure_checkpoint_dir

BATCH_BYTES = 16 << 20


def bound_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Bound what one Arrow batch hands to a Python worker by bytes, not only by rows."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("bB")) > most:
        spark.conf.set(key, f"{most}b")


def scratch(spark: SparkSession, stem: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{stem}-{uuid.uuid4().hex}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(doc_id: str | Column, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id) if isinstance(doc_id, str) else doc_id, F.lit("")).cast("string")) % mod


def fold(doc_id: str, mod: int) -> Column:
    return remainder(F.col(doc_id).cast("string"), mod)


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column without decoding; null becomes empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem
