"""Publishing of a run's results: checked while they are written, seen all at once.

Each run writes into a folder of its own.  Counts of the publication rules are observed by the
write jobs themselves.  Only when every table is written and every rule holds does a manifest
naming the tables appear, by one rename; readers look for manifests, so the tables of a run
that was stopped half way stay unseen.
"""

from __future__ import annotations

import json
import time
import uuid
from collections import OrderedDict
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from qmeasures.plans.validate import COMMENT_LENGTH
from qmeasures.sources.reference import label_result

REQUIRED = ("member_id", "denominator", "numerator")
MANIFESTS = "_manifests"
VIOLATIONS = "result string, rule string, key string, violations long"


class PublishError(ValueError):
    pass


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _rules(df: DataFrame, required: Sequence[str], most: int):
    """(rule, key, expression that counts the rows that break it)."""
    rules = [("no_nulls", c, F.count_if(F.col(c).isNull())) for c in required]
    if "comments" in df.columns:
        rules.append(("comment_fits", "comments", F.count_if(F.length("comments") > most)))
    return rules


def write_observed(df: DataFrame, path: str, required: Sequence[str] = REQUIRED,
                   most: int = COMMENT_LENGTH) -> tuple[int, list[tuple[str, str, int]]]:
    """Write ``df`` and return its row count and ``(rule, key, violations)``, all in one pass."""
    rules = _rules(df, required, most)
    seen = Observation(f"publish-{uuid.uuid4().hex}")
    counted = df.observe(seen, F.count(F.lit(1)).alias("n"), *[e.alias(f"r{i}") for i, (_, _, e) in enumerate(rules)])
    counted.write.mode("overwrite").parquet(path)
    got = seen.get
    return got["n"], [(rule, key, got[f"r{i}"]) for i, (rule, key, _) in enumerate(rules)]


def write_run(results: dict[str, DataFrame], out_dir: str, required: Sequence[str] = REQUIRED,
              labels: dict[str, str] | None = None) -> dict:
    """Write every result into a new run folder; the run is described, not yet published."""
    run = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    tables = OrderedDict()
    for name, df in results.items():
        path = f"{out_dir.rstrip('/')}/run-{run}/results_{name}.parquet"
        labelled = label_result(df, (labels or {}).get(name, f"{name} results"))
        rows, found = write_observed(labelled, path, [c for c in required if c in df.columns])
        tables[name] = {"path": path, "rows": rows, "rules": found}
    return {"run": run, "tables": tables}


def violations(spark: SparkSession, described: dict, broken_only: bool = True) -> DataFrame:
    """One row for each result and rule with the rows that break it."""
    rows = [(name, rule, key, n) for name, t in described["tables"].items() for rule, key, n in t["rules"]]
    return spark.createDataFrame([r for r in rows if r[3] or not broken_only], VIOLATIONS)


def publish(spark: SparkSession, described: dict, out_dir: str) -> str:
    """Make a written run visible; raises and publishes nothing when a rule is broken."""
    broken = [(name, *rule) for name, t in described["tables"].items() for rule in t["rules"] if rule[2]]
    if broken:
        raise PublishError(f"results break publication rules: {broken}")
    target = f"{out_dir.rstrip('/')}/{MANIFESTS}/{described['run']}.json"
    fs, final = _files(spark, target)
    _, draft = _files(spark, f"{out_dir.rstrip('/')}/{MANIFESTS}/.{described['run']}.draft")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(described).encode()))
    finally:
        out.close()
    if not fs.rename(draft, final):
        raise PublishError(f"manifest {target} could not be put in place")
    return target


def discover(spark: SparkSession, out_dir: str, run: str | None = None) -> "OrderedDict[str, DataFrame]":
    """Results of the last published run (or of ``run``) by name; none published: empty."""
    fs, folder = _files(spark, f"{out_dir.rstrip('/')}/{MANIFESTS}")
    if not fs.exists(folder):
        return OrderedDict()
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder))
    names = [n for n in names if n.endswith(".json") and (run is None or n == f"{run}.json")]
    if not names:
        return OrderedDict()
    text = spark.read.text(f"{out_dir.rstrip('/')}/{MANIFESTS}/{names[-1]}", wholetext=True).first()[0]
    return OrderedDict((name, spark.read.parquet(t["path"])) for name, t in json.loads(text)["tables"].items())
