"""Operator 4: embedding near-duplicates by E8 lattice hashing.

Every table turns a unit vector by random orthonormal rows into ``blocks`` points of
eight coordinates, shifts and scales them, and decodes each to the nearest point of the
E8 lattice (the integer or the half-integer points of even sum).  The points of a table
together name a cell.  A vector is an owner of its cell and a visitor of the cells got
by moving one block to its second nearest lattice point.  Owners of a cell are compared
with its other owners and its visitors, by cosine in double precision.

Equal vectors are folded into one before hashing and counted by multiplicity.  Cells
without a possible pair are dropped before vectors are moved; large cells are split
into blocks, each pair of blocks its own group, so no group exceeds twice ``block``
rows.  A pair that meets in several cells counts in the first of them only.  Groups
give link counts and a spanning forest, never a list of pairs.

With 10 tables and scale 3.5 a pair at cosine 0.9 is found with probability 0.96, one
at 0.95 with 0.999 (64 dimensions; see the test for recall against brute force).

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; vectors of different length never link; repeated rows
are other vectors with the same id; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qmeasures.llm.common import bound_batches, materialize
from qmeasures.llm.components import components

_E8 = 8


def nearest_points(y: np.ndarray, count: int = 2) -> np.ndarray:
    """(..., 8) -> (..., count, 8): the nearest E8 points found, nearest first.

    In each coset the point is the rounding, its parity mended at the coordinate nearest
    to a tie; the runner-up changes the next cheapest coordinates.
    """
    found = []
    for shift in (0.0, 0.5):
        x = y - shift
        low = np.round(x)
        off = x - low
        toward = np.where(off >= 0, 1.0, -1.0)
        order = np.argsort(-np.abs(off), axis=-1)
        odd = (low.sum(axis=-1) % 2 != 0)[..., None]

        def moved(point: np.ndarray, k: int) -> np.ndarray:
            at, out = order[..., k:k + 1], point.copy()
            np.put_along_axis(out, at, np.take_along_axis(out, at, -1) + np.take_along_axis(toward, at, -1), -1)
            return out

        first, second = moved(low, 0), moved(low, 1)
        found += [np.where(odd, first, low) + shift, np.where(odd, second, moved(first, 1)) + shift]
    points = np.stack(found, axis=-2)
    near = np.argsort(((points - y[..., None, :]) ** 2).sum(axis=-1), axis=-1, kind="stable")[..., :count]
    return np.take_along_axis(points, near[..., None], axis=-2)


def projection(dim: int, tables: int, blocks: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal columns per table (as far as ``dim`` allows) and shifts."""
    rng = np.random.default_rng([seed, dim])
    width = _E8 * blocks
    turned = [np.linalg.qr(rng.normal(size=(max(dim, width), max(dim, width))))[0][:dim, :width] for _ in range(tables)]
    return np.concatenate(turned, axis=1), rng.uniform(0, 2, size=tables * width)


def cells(unit: np.ndarray, tables: int, blocks: int, scale: float, seed: int) -> np.ndarray:
    """(n, dim) unit vectors -> (n, tables, 1 + blocks) cell numbers, the own cell first."""
    turn, shift = projection(unit.shape[1], tables, blocks, seed)
    # with few dimensions a projection keeps more of a distance: hold the expected distance fixed
    y = unit @ turn * (scale * np.sqrt(unit.shape[1] / 64)) + shift
    points = np.rint(2 * nearest_points(y.reshape(len(unit), tables, blocks, _E8))).astype(np.int64)
    odd = np.random.default_rng([seed, 1]).integers(1, 1 << 62, size=(blocks, _E8), dtype=np.int64) | 1
    codes = (points * odd[:, None, :]).sum(axis=-1)  # (n, tables, blocks, 2), wraps around
    own = codes[..., 0]
    keys = [own.sum(axis=-1)] + [own.sum(axis=-1) - own[..., b] + codes[..., b, 1] for b in range(blocks)]
    out = np.stack(keys, axis=-1)
    with np.errstate(over="ignore"):
        salt = np.arange(1, tables + 1, dtype=np.int64)[:, None] * np.int64(0x5851F42D4C957F2D) + unit.shape[1]
        out = (out ^ salt) * np.int64(0x2545F4914F6CDD1D)
        return out ^ (out >> np.int64(29))


def _folded(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, row, digest, unit): digest and unit are null for vectors that link with nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, units = [], []
            for x in batch.column(2).to_pylist():
                v = np.array([np.nan if c is None else c for c in x or ()], dtype=np.float64)
                biggest = np.abs(v).max() if len(v) and np.isfinite(v).all() else 0.0
                if not biggest:
                    digests.append(None)
                    units.append(None)
                    continue
                scaled = v / biggest  # squares stay finite
                units.append((scaled / np.sqrt((scaled * scaled).sum())).tobytes())
                digests.append(hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(digests, pa.binary()),
                                              pa.array(units, pa.binary())], names=["vec_id", "row", "digest", "unit"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return vectors.select(F.col(id_col).alias("vec_id"), F.monotonically_increasing_id().alias("row"),
                          F.col(vector_col).cast("array<double>")).mapInArrow(
        run, f"vec_id {kind}, row long, digest binary, unit binary")


def _keyed(reps: DataFrame, tables: int, blocks: int, scale: float, seed: int) -> DataFrame:
    """Adds cells: the flat cell numbers of every representative."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [np.frombuffer(x) for x in batch.column(2).to_pylist()]
            out: list = [None] * len(units)
            for dim in {len(u) for u in units}:
                at = [i for i, u in enumerate(units) if len(u) == dim]
                for i, keys in zip(at, cells(np.stack([units[i] for i in at]), tables, blocks, scale, seed)):
                    out[i] = keys.ravel()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int64()))],
                                             names=[*batch.schema.names, "cells"])
    return reps.select("node", "copies", "unit").mapInArrow(
        run, "node long, copies long, unit binary, cells array<long>")


def _roots(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the classes of i[k] and j[k]; every entry then points at its class's smallest place."""
    while True:
        a, b = parent[i], parent[j]
        if (a == b).all():
            return parent
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up


def compare(node: np.ndarray, copies: np.ndarray, unit: np.ndarray, keys: np.ndarray, side: np.ndarray, cell: int,
            cross: bool, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of one group: link counts per row and the smallest linked place per row.

    keys: (n, tables, 1 + blocks); side: block of a split cell.  Pairs need an owner of
    the cell and, if ``cross``, one row of either side.
    """
    n = len(node)
    owner = (keys[:, :, 0] == cell).any(axis=1)
    links, parent = np.zeros(n, dtype=np.int64), np.arange(n)
    for at in range(0, n, 512):
        near = unit[at:at + 512] @ unit.T >= least
        near &= owner[at:at + 512, None] | owner
        near &= np.arange(at, min(at + 512, n))[:, None] < np.arange(n)
        if cross:
            near &= side[at:at + 512, None] != side
        i, j = np.nonzero(near)
        i += at
        for lo in range(0, len(i), 1 << 16):
            a, b = i[lo:lo + (1 << 16)], j[lo:lo + (1 << 16)]
            one, two = keys[a], keys[b]
            meets = np.concatenate([(one[:, :, :1] == two), (two[:, :, :1] == one)], axis=2)
            where = np.concatenate([np.broadcast_to(one[:, :, :1], two.shape), np.broadcast_to(two[:, :, :1], one.shape)], axis=2)
            first = meets.reshape(len(a), -1).argmax(axis=1)  # tables in order, then cells in order
            mine = where.reshape(len(a), -1)[np.arange(len(a)), first] == cell
            np.add.at(links, a[mine], copies[b[mine]])
            np.add.at(links, b[mine], copies[a[mine]])
            parent = _roots(parent, a, b)
    return links, parent


def _compared(groups: DataFrame, tables: int, least: float) -> DataFrame:
    """Rows sorted by group -> (node, links, root)."""
    def finish(rows: pa.Table, cell: int, lo: int, hi: int) -> pa.RecordBatch | None:
        node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        if len(node) < 2:
            return None
        keys = np.stack([np.array(x) for x in rows["cells"].to_numpy(zero_copy_only=False)]).reshape(len(node), tables, -1)
        unit = np.stack([np.frombuffer(x) for x in rows["unit"].to_pylist()])
        links, parent = compare(node, copies, unit, keys, rows["side"].to_numpy(), cell, lo != hi, least)
        use = (links > 0) | (parent != np.arange(len(node)))
        if not use.any():
            return None
        return pa.RecordBatch.from_arrays([pa.array(node[use]), pa.array(links[use]), pa.array(node[parent][use])],
                                          names=["node", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        now = None
        for batch in batches:
            marks = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            edges = np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                if a == b:
                    continue
                mark = tuple(int(x) for x in marks[a])
                if mark != now:
                    if held and (out := finish(pa.Table.from_batches(held), *now)) is not None:
                        yield out
                    held, now = [], mark
                held.append(batch.slice(a, b - a))
        if held and (out := finish(pa.Table.from_batches(held), *now)) is not None:
            yield out

    return groups.mapInArrow(run, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.9,
                    tables: int = 10, blocks: int = 2, scale: float = 3.5, block: int = 4096, seed: int = 8) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector."""
    bound_batches(vectors.sparkSession)
    rows = materialize(_folded(vectors, id_col, vector_col))
    reps = materialize(rows.where("digest is not null").groupBy("digest").agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low"),
        F.first("unit").alias("unit")))
    keyed = materialize(_keyed(reps, tables, blocks, scale, seed))
    wide = 1 + blocks
    spots = keyed.select("node", F.posexplode("cells").alias("place", "cell")).select(
        "node", "cell", (F.col("place") % wide == 0).alias("owner"))
    spots = spots.groupBy("node", "cell").agg(F.max("owner").alias("owner"))
    sizes = spots.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("owner").alias("owned")).where("n > 1 and owned")
    sizes = materialize(sizes)
    spots = materialize(spots.join(sizes, "cell").select("node", "cell", F.ceil(F.col("n") / block).cast("int").alias("parts")))
    side = F.pmod(F.xxhash64("node", "cell"), "parts").cast("int")
    groups = (spots.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .join(keyed, "node")
              .select("cell", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"), "side",
                      "node", "copies", "unit", "cells"))
    found = materialize(_compared(groups.repartition("cell", "lo", "hi").sortWithinPartitions("cell", "lo", "hi"), tables, least))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = materialize(reps.select("digest", "node", "copies", "low").join(links, "node", "left").join(roots, "node", "left")
                        .select("digest", "low", F.coalesce("root", "node").alias("root"),
                                (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    lowest = materialize(named.groupBy("root").agg(F.min("low").alias("component_id")))
    named = materialize(named.join(lowest, "root").select("digest", "n_links", "component_id"))
    out = rows.select("vec_id", "digest").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
