"""Operator 7: exact top-k by inner product with multi-resolution segment statistics.

A vector is cut into segments; each segment keeps its mean and standard deviation.  For
two vectors the squared distance is at least the sum over segments of segment length
times the squared differences of means and of deviations, so their inner product is at
most half of what the squared norms leave: with statistics scaled by the root of the
segment length this bound is the inner product of the statistics.  From coarse to fine,
candidates whose bound is below the k-th best exact score so far are dropped; survivors
of all levels, and only they, get exact scores.  The last levels cut unevenly: three quarters,
then seven eighths of the components stand alone and the rest are one segment.

Queries and candidates are dealt into blocks, and every pair of blocks is one bounded
group; the best k of each group are merged by rank.  Components are integers, so exact
scores are exact sums.

Defined results: vectors that are null, empty or hold null or non-finite components take
no part; vectors of different length are not compared; rows that repeat an id are other
rows (each its own query); ties go to the smaller id, null ids last; scores beyond the
64-bit range are clipped to it; extra columns are ignored; an empty table gives nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qmeasures.llm.common import bound_batches, materialize

LEVELS = (1, 4, 16, 32)  # equal segments
ALONE = (0.75, 0.875)  # finer: this share of the components stand alone, the rest are one segment
_NO_ID = np.iinfo(np.int64).max
_SAFE = float(1 << 53)


def segmentations(dim: int) -> list[np.ndarray]:
    """Segment edges of each level, coarse to fine; none has every component alone."""
    equal = [np.unique(np.linspace(0, dim, s + 1).astype(int)) for s in LEVELS if s == 1 or s < dim]
    uneven = [np.append(np.arange(int(dim * a) + 1), dim) for a in ALONE if int(dim * a) < dim - 1]
    return equal + uneven


def statistics(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """(n, dim) -> means and deviations by segment, scaled by the root of its length (alone: the component)."""
    columns = []
    for a, b in zip(edges, edges[1:]):
        part = x[:, a:b]
        columns.append(part.mean(axis=1) * np.sqrt(b - a))
        if b - a > 1:
            columns.append(part.std(axis=1) * np.sqrt(b - a))
    return np.stack(columns, axis=1)


def _exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of integer-valued rows; in plain integers where doubles could round."""
    if not len(q) or not len(c):
        return np.zeros((len(q), len(c)), dtype=np.int64)
    if np.abs(q).max() * np.abs(c).max() * q.shape[1] < _SAFE:
        return np.rint(q @ c.T).astype(np.int64)
    as_int = lambda x: np.array([[int(v) for v in row] for row in x], dtype=object)
    whole = as_int(q) @ as_int(c).T
    return np.clip(whole, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def search(q: np.ndarray, q_row: np.ndarray, c: np.ndarray, c_row: np.ndarray, c_id: np.ndarray, k: int,
           block: int = 128, seen: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, candidate place, score) of each query's best k among the candidates.

    ``seen`` gathers, for each block of queries, the pairs alive at first and after each level.
    """
    # candidates in id order: the first of equal scores is the one with the smaller id
    order = np.lexsort((c_row, c_id))
    c, c_row = c[order], c_row[order]
    levels = [(statistics(q, edges), statistics(c, edges)) for edges in segmentations(q.shape[1])]
    norms = np.sqrt((q * q).sum(axis=1)), np.sqrt((c * c).sum(axis=1))
    out: list[tuple] = []
    for at in range(0, len(q), block):
        part = slice(at, at + block)
        rows = np.arange(at, min(at + block, len(q)))
        alive = q_row[part, None] != c_row
        slack = 1e-9 * norms[0][part, None] * norms[1] + 1e-6  # rounding of the bounds
        kth = np.full(len(rows), -np.inf)
        counts = [int(alive.sum())]
        for of_q, of_c in levels:
            bound = of_q[part] @ of_c.T + slack
            bound[~alive] = -np.inf
            m = min(4 * k, len(c))
            seeds = np.argpartition(-bound, m - 1, axis=1)[:, :m]
            for r, places in enumerate(seeds):
                places = places[alive[r, places]]
                if len(places) >= k:
                    known = _exact(q[rows[r]][None], c[places])[0]
                    kth[r] = max(kth[r], np.partition(known, len(known) - k)[len(known) - k])
            alive &= bound >= kth[:, None]
            counts.append(int(alive.sum()))
        if seen is not None:
            seen.append(counts)
        for row, left in zip(rows, alive):
            places = np.flatnonzero(left)
            scores = _exact(q[row][None], c[places])[0]
            best = np.argsort(-scores.astype(float) if not len(scores) or np.abs(scores).max() < _SAFE else
                              np.array([-int(s) for s in scores], dtype=object), kind="stable")[:k]
            out.append((np.full(len(best), row), order[places[best]], scores[best]))
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          factor: float = 64.0, query_block: int = 2048, row_block: int = 16384) -> DataFrame:
    """query_id, rank, vec_id, score; ``is_query`` is a condition on vec_id."""
    bound_batches(vectors.sparkSession)
    vector = F.col(vector_col).cast("array<double>")
    usable = (F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = vectors.where(F.coalesce(usable, F.lit(False))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.monotonically_increasing_id().alias("row"),
        F.transform(vector, lambda x: F.floor(x * factor).cast("double")).alias("v"))
    rows = materialize(rows.withColumn("dim", F.size("v")).withColumn("query", F.coalesce(is_query, F.lit(False))))
    n, n_queries = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("query").cast("long")), F.lit(0))).first()
    parts, turns = -(-n // row_block) or 1, -(-n_queries // query_block) or 1
    queries = (rows.where("query").withColumn("qb", F.pmod(F.xxhash64("row"), F.lit(turns)))
               .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
               .select("qb", "cb", "dim", "vec_id", "row", "v"))
    candidates = (rows.withColumn("cb", F.pmod(F.xxhash64("row"), F.lit(parts)))
                  .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long"))))
                  .select("qb", "cb", "dim", "vec_id", "row", "v"))

    def matrix(t: pa.Table) -> np.ndarray:
        return t["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            of = ([], [], [], [], [])
        else:
            q_row, c_row = left["row"].to_numpy(), right["row"].to_numpy()
            ids = right["vec_id"].fill_null(_NO_ID).to_numpy()
            a, b, scores = search(matrix(left), q_row, matrix(right), c_row, ids, k)
            of = (left["vec_id"].to_numpy()[a], q_row[a], ids[b], c_row[b], scores)
        return pa.table({name: pa.array(x, pa.int64()) for name, x in zip(("query_id", "query_row", "id", "row", "score"), of)})

    best = (queries.groupBy("qb", "cb", "dim").cogroup(candidates.groupBy("qb", "cb", "dim"))
            .applyInArrow(run, "query_id long, query_row long, id long, row long, score long"))
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "id", "row"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.when(F.col("id") != int(_NO_ID), F.col("id")).alias("vec_id"), "score")
