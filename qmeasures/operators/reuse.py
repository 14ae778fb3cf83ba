"""Materialise an intermediate that several branches of one plan read."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

observers: list = []  # called with each frame that is written (plan reports)


class RunScope:
    """Folders that one run wrote; they are deleted when its last holder lets go."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.holders = spark, [], 0

    def hold(self) -> "RunScope":
        self.holders += 1
        return self

    def let_go(self) -> int:
        """One holder less; the last one deletes the folders.  Returns how many went."""
        self.holders -= 1
        return self.delete() if self.holders <= 0 else 0

    def delete(self) -> int:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        paths, self.paths = self.paths, []
        for path in paths:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
        return len(paths)


_OPEN: ContextVar[RunScope | None] = ContextVar("run_scope", default=None)
_OUTSIDE: dict[str, RunScope] = {}  # application -> what was written outside every run


@contextmanager
def run_scope(spark: SparkSession) -> Iterator[RunScope]:
    """Intermediates written inside belong to this run and are deleted when it ends.

    Frames built on them end with the run, so its results are written inside.  A caller that
    reads them for longer takes ``scope.hold()`` and calls ``let_go()`` later.  Runs may
    interleave: each deletes only its own.  Threads started inside need the caller's context
    (``contextvars.copy_context().run``), as the measure registry gives its own.
    """
    scope = RunScope(spark).hold()
    token = _OPEN.set(scope)
    try:
        yield scope
    finally:
        _OPEN.reset(token)
        scope.let_go()


def _scope(spark: SparkSession) -> RunScope:
    app = spark.sparkContext.applicationId
    return _OPEN.get() or _OUTSIDE.setdefault(app, RunScope(spark))


def stage_path(spark: SparkSession, name: str) -> str:
    """A new folder in the session's shared folder that belongs to the open run."""
    from qmeasures.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    _scope(spark).paths.append(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """Write a reused intermediate as parquet in the shared folder and read it back.

    Cuts lineage (a lost executor no longer replays the upstream scans and joins) and
    turns the frame into a plan leaf, so the branches that read it are planned as
    small plans and get column pruning / filter pushdown on the re-read.  The plan is
    computed once (an eager RDD checkpoint of an unpersisted frame computes it twice).
    The folder is the session's ``spark.checkpoint.dir``
    (:func:`qmeasures.session.ensure_checkpoint_dir`), i.e. shared storage on a cluster.
    """
    spark = df.sparkSession
    path = stage_path(spark, f"stage-{uuid.uuid4().hex}")
    for see in observers:
        see(df)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def release(spark: SparkSession) -> int:
    """Delete what this application wrote outside every :func:`run_scope`.

    Open runs keep theirs.  Frames built on the folders end with them.  Returns how many
    were deleted.
    """
    scope = _OUTSIDE.pop(spark.sparkContext.applicationId, None)
    return scope.delete() if scope else 0
