"""Operator 11: source divergence audit over a quadtree of the group-term count matrix.

Every language has a matrix: its sources (groups) are the rows, its kept terms the
columns, counts the cells.  Kept are terms that at least ``least_docs`` documents of
the language hold.  With add-two smoothing a group gives each kept term the share

    p = 1 + floor(scale * (count + 2) / (N + 2 V))

so all cells of a group that are zero have one and the same share.  Two groups differ at a
term by floor((p - q)^2 / (p + q)); a pair's divergence is the sum over the terms.

The matrix is cut into tiles of ``STRIPE`` rows and about ``BLOCK`` columns; a tile, or a pair
of tiles over the same columns, is one group of a grouped map and has a fixed size.  A tile is a
K^2 tree (K = 2): a quadrant is split only while it holds a count.  Pairs of row bands go down
the tree together; a quadrant that is empty for both bands is not entered, its columns
are counted and priced at the end as columns times the one value of two zero shares.
At the leaves, pairs with a count on either side give their values one by one.

All arithmetic is on integers: shares are decimal divisions in the plan, values 64-bit
(a share is at most ``scale`` + 1, and its square fits).

Defined results: null text, language and source are read as empty texts; every row is a
document, repeated ids and rows included; a group without terms takes part with zero counts;
a language without kept terms has pairs of value 0 and no term rows; an empty table
gives no rows; ties go to the smaller item by its bytes; very long texts are read in
pieces; extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from qmeasures.llm.common import as_bytes, bound_batches, materialize

LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
STRIPE = 64          # groups in a tile
BLOCK = 200          # kept terms in a tile, on average
PIECE = 1 << 20      # bytes of one text that are cut into words at a time
ENTRIES = 400_000    # (group, term) counts that a task holds

#: Bytes of a term stay, A-Z become a-z, all else separates.
_WORDS = bytes(c + 32 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))


def pieces(text: bytes, size: int = PIECE) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text in order, in lists from about ``size`` bytes each."""
    if len(text) <= size:
        yield text.translate(_WORDS).split()
        return
    text, at = text.translate(_WORDS), 0
    while at < len(text):
        end = text.find(b" ", at + size)
        end = len(text) if end < 0 else end
        yield text[at:end].split()
        at = end


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, term, n, docs): counts of this task, given out before they grow past ENTRIES."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                pa.array([docs[t] for t in terms], pa.int64())], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang, source, text in zip(langs, sources, as_bytes(batch.column(2))):
            if (lang, source) not in held:
                held[lang, source] = (Counter(), Counter())
            n, docs = held[lang, source]
            before, seen = len(n), None
            for words in pieces(text):
                n.update(words)
                seen = set(words) if seen is None else seen.union(words)
            docs.update(seen or ())
            size += len(n) - before
            if size > ENTRIES:
                yield from out()
                held.clear()
                size = 0
    yield from out()


def _share(count: str, total: str, scale: int) -> str:
    """SQL of a share; the decimal division is exact."""
    return (f"1 + (CAST({count} + 2 AS DECIMAL(20,0)) * CAST({scale} AS DECIMAL(10,0)))"
            f" DIV CAST({total} + 2 * terms AS DECIMAL(20,0))")


def _spread(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


class Tree:
    """K^2 tree (K = 2) of the cells of one tile: ``child[level][node, quadrant]``, -1 for an empty quadrant."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, values: np.ndarray, depth: int) -> None:
        code = np.zeros(len(rows), np.int64)
        for bit in range(depth):
            code |= ((rows >> bit) & 1) << (2 * bit + 1) | ((cols >> bit) & 1) << (2 * bit)
        order = np.argsort(code)
        self.values, below, self.child = values[order], code[order], []
        for _ in range(depth):
            nodes, parent = np.unique(below >> 2, return_inverse=True)
            child = np.full((len(nodes), 4), -1, np.int64)
            child[parent, below & 3] = np.arange(len(below))
            self.child.append(child)
            below = nodes
        self.child.reverse()
        self.empty = not len(rows)

    def down(self, level: int, node: np.ndarray, quadrant: np.ndarray) -> np.ndarray:
        if self.empty:
            return np.full(len(node), -1)
        return np.where(node >= 0, self.child[level][np.maximum(node, 0), quadrant], -1)


def joint(left: Tree, right: Tree, zero_left: np.ndarray, zero_right: np.ndarray, columns: int, depth: int,
          same: bool) -> np.ndarray:
    """Divergence of every row of ``left`` from every row of ``right`` over the tile's columns.

    With ``same`` the trees are one and only pairs of a row with a later one are filled.
    """
    n, m = len(zero_left), len(zero_right)
    empty, total = np.zeros((n, m), np.int64), np.zeros((n, m), np.int64)
    a = b = c = np.zeros(1, np.int64)
    u, v = (np.full(1, -1 if t.empty else 0) for t in (left, right))
    quadrants = np.array([(i, j, k) for i in (0, 1) for j in (0, 1) for k in (0, 1)])
    for level in range(depth + 1):
        width = 1 << (depth - level)
        blank = (u < 0) & (v < 0)
        if blank.any():  # uniform: counted once for the bands, priced below
            bands = (-(-n // width), -(-m // width))
            real = np.minimum(columns - c[blank] * width, width)
            met = np.bincount(a[blank] * bands[1] + b[blank], real, bands[0] * bands[1]).astype(np.int64)
            empty += np.kron(met.reshape(bands), np.ones((width, width), np.int64))[:n, :m]
            a, b, c, u, v = (x[~blank] for x in (a, b, c, u, v))
        if level == depth or not len(a):
            break
        at = np.repeat(np.arange(len(a)), 8)
        i, j, k = np.tile(quadrants, (len(a), 1)).T
        u, v = left.down(level, u[at], 2 * i + k), right.down(level, v[at], 2 * j + k)
        a, b, c, half = 2 * a[at] + i, 2 * b[at] + j, 2 * c[at] + k, width // 2
        inside = (a * half < n) & (b * half < m) & (c * half < columns)
        if same:
            inside &= a <= b
        a, b, c, u, v = (x[inside] for x in (a, b, c, u, v))
    if len(a):
        p, q = zero_left[a], zero_right[b]
        if not left.empty:
            p = np.where(u >= 0, left.values[np.maximum(u, 0)], p)
        if not right.empty:
            q = np.where(v >= 0, right.values[np.maximum(v, 0)], q)
        # whole numbers below 2^53, so the sums of doubles are exact
        total += np.bincount(a * m + b, _spread(p, q), n * m).astype(np.int64).reshape(n, m)
    return total + empty * _spread(zero_left[:, None], zero_right[None, :])


def _first_terms(rows: np.ndarray, cols: np.ndarray, p: np.ndarray, q: np.ndarray, top: int) -> np.ndarray:
    """Positions of each row's ``top`` cells above the language's share, largest difference first."""
    above = np.flatnonzero(p > q[cols])
    value = _spread(p[above], q[cols[above]])
    above = above[np.lexsort((cols[above], -value, rows[above]))]
    row = rows[above]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    return above[rank < top]


def _tile(top: int):
    def run(tile: pa.Table) -> pa.Table:
        lang, si, sj = (tile.column(x)[0].as_py() for x in ("lang", "si", "sj"))
        side, row, p = (tile.column(x).to_numpy() for x in ("side", "row", "p"))
        terms = tile.column("term").combine_chunks()
        words = sorted(as_bytes(terms.filter(pa.array(side == 2))))
        place = {w: k for k, w in enumerate(words)}
        shares = np.zeros(len(words), np.int64)
        has = ~np.asarray(terms.is_null())
        at = np.full(len(side), -1)
        at[has] = [place[w] for w in as_bytes(terms.filter(pa.array(has)))]
        shares[at[side == 2]] = p[side == 2]
        depth = max(1, int(max(len(words), STRIPE) - 1).bit_length())
        trees, zeros, first = [], [], np.zeros(0, np.int64)
        for k in ((0,) if si == sj else (0, 1)):
            heads, cells = (side == k) & ~has, np.flatnonzero((side == k) & has)
            zero = np.zeros(heads.sum(), np.int64)
            zero[row[heads] % STRIPE] = p[heads]
            zeros.append(zero)
            trees.append(Tree(row[cells] % STRIPE, at[cells], p[cells], depth))
            if si == sj:
                first = cells[_first_terms(row[cells], at[cells], p[cells], shares, top)]
        sums = joint(trees[0], trees[-1], zeros[0], zeros[-1], len(words), depth, si == sj)
        a, b = np.triu_indices(len(zeros[0]), 1) if si == sj else np.indices(sums.shape).reshape(2, -1)
        n, blank = len(a), pa.nulls(len(a), pa.string())
        value = _spread(p[first], shares[at[first]])
        return pa.table({
            "lang": pa.array([lang] * (n + len(first)), pa.string()),
            "a": np.concatenate([a + si * STRIPE, row[first]]).astype(np.int32),
            "b": np.concatenate([b + sj * STRIPE, np.full(len(first), -1)]).astype(np.int32),
            "term": pa.concat_arrays([blank, terms.take(pa.array(first)).cast(pa.string())]),
            "value": np.concatenate([sums[a, b], value]).astype(np.int64)})
    return run


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
          least_docs: int = LEAST_DOCS, scale: int = SCALE, top: int = TOP) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank: see the module text."""
    if not 0 < scale <= SCALE:
        raise ValueError(f"scale must be within 1 to {SCALE}, so that squares fit 64 bits")
    bound_batches(docs.sparkSession)
    read = docs.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name) for c, name in
                         ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    # the tasks' tallies meet once, by term: a term's rows are at most tasks x sources
    counts = read.mapInArrow(_tally, "lang string, source string, term string, n long, docs long").repartition("lang", "term")
    by_term = Window.partitionBy("lang", "term")
    cells = materialize(
        counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .select("lang", "term", "source", "n", F.sum("docs").over(by_term).alias("held"),
                F.sum("n").over(by_term).alias("lang_n"),
                (F.min("source").over(by_term) == F.col("source")).alias("first"))
        .where(F.col("held") >= least_docs).drop("held"))

    rows = Window.partitionBy("lang")
    groups = materialize(
        read.select("lang", "source").distinct()
        .join(cells.groupBy("lang", "source").agg(F.sum("n").alias("total")), ["lang", "source"], "left")
        .join(cells.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("first").alias("terms")), "lang", "left")
        .fillna(0, ["total", "lang_total", "terms"])
        .select("*", (F.row_number().over(rows.orderBy("source")) - 1).alias("row"),
                F.ceil(F.count(F.lit(1)).over(rows) / STRIPE).cast("int").alias("stripes"),
                F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK).cast("int")).alias("blocks")))

    stripe, block = f"row DIV {STRIPE}", "CAST(pmod(xxhash64(term), blocks) AS INT)"
    # a cell goes to every pair of stripes that its own stripe takes part in
    meet = f"explode(transform(sequence(0, stripes - 1), t -> CAST(t AS INT))) AS other"
    own = [f"CAST(least({stripe}, other) AS INT) AS si", f"CAST(greatest({stripe}, other) AS INT) AS sj",
           f"IF({stripe} > other, 1, 0) AS side", "row"]
    held = cells.join(groups, ["lang", "source"])
    matrix = held.selectExpr("*", meet).selectExpr(
        "lang", f"{block} AS block", *own, "term", f"{_share('n', 'total', scale)} AS p")
    zeros = (groups.selectExpr("*", "explode(sequence(0, blocks - 1)) AS block").selectExpr("*", meet).selectExpr(
        "lang", "block", *own, "CAST(NULL AS STRING) AS term",
        f"IF(terms = 0, 1, {_share('0', 'total', scale)}) AS p"))
    columns = (held.where("first").selectExpr("*", "explode(sequence(0, stripes - 1)) AS si")
               .selectExpr("*", "explode(sequence(si, stripes - 1)) AS sj").selectExpr(
        "lang", f"{block} AS block", "si", "sj", "2 AS side", "-1 AS row", "term",
        f"{_share('lang_n', 'lang_total', scale)} AS p"))
    found = materialize(
        matrix.unionByName(zeros).unionByName(columns).groupBy("lang", "block", "si", "sj")
        .applyInArrow(_tile(top), "lang string, a int, b int, term string, value long"))

    names = groups.select("lang", F.col("row").alias("a"), "source")
    sums = found.where("b >= 0").groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = (sums.union(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
             .join(names, ["lang", "a"])
             .join(names.select("lang", F.col("a").alias("b"), F.col("source").alias("item")), ["lang", "b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    terms = found.where("b < 0").join(names, ["lang", "a"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    ranked = [x.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))) for x in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))
