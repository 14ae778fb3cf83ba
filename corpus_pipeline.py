"""Corpus cleaning and packing pipeline over ``documents``.

Language identification, quality classifier, SimHash near-duplicates, best-fit packing.
Each stage reads what its predecessor kept; all but the last return the columns of
documents.  Rows, not ids, are filtered, so repeated ids and nulls in any column are
harmless; columns are carried by position, so their names cannot clash with a stage's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qmeasures.llm import kneser, langid, packing, simhash
from qmeasures.llm.common import materialize, table


def _by_place(docs: DataFrame) -> tuple[DataFrame, list[str], dict[str, str]]:
    """docs with columns c0, c1, ..., their names, and the place of each named column."""
    places = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*places), places, dict(zip(docs.columns, places))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not recognised go: no letters, or a score below the calibrated threshold."""
    plain, places, at = _by_place(docs)
    model = langid.train(plain, at["text"], at["lang"])
    return langid.predict(plain, model, at["text"], places).where("not rejected").select(*places).toDF(*docs.columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity falls outside their language's range of trusted texts go."""
    plain, places, at = _by_place(docs)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias(at["doc_id"]), "quality")
    judged = kneser.judge(plain, labels, at["doc_id"], at["text"], at["lang"], "quality", carry=places)
    return judged.where("keep").select(*places).toDF(*docs.columns)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the smallest id, then the first row."""
    plain, places, at = _by_place(docs)
    numbered = plain.withColumn("row", F.monotonically_increasing_id())
    keyed = numbered.select(F.struct(F.col(at["doc_id"]).isNull().alias("no_id"), F.col(at["doc_id"]).alias("id"),
                                     F.col("row")).alias("doc_id"), F.col(at["text"]).alias("text"))
    dropped = materialize(simhash.near_duplicates(keyed, shingle=3, max_bits=2, seed=42)
                          .where("doc_id <> component_id").select("doc_id.row"))
    return numbered.join(dropped, "row", "left_anti").select(*places).toDF(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in sequences of the permitted lengths."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language id", language_stage),
    ("quality classifier", quality_stage),
    ("simhash near-dedup", simhash_stage),
    ("best-fit packing", packing_stage),
]

#: Trained stages have no SQL form; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
