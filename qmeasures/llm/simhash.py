"""Operator 2: SimHash near-duplicates with pigeonring candidate pruning.

The 64 bits are cut into ``m`` consecutive segments laid on a ring.  If two
fingerprints differ in at most ``t`` bits, some start on the ring has every chain of
``l`` segments within the proportional budget ``l * t / m`` (the pigeonring
principle).  The chain's leading segments whose budget is below one bit must be equal,
so they are the equi-join key; the longer prefixes prune the pairs of a bucket before
the full Hamming check.  With t = 2 and m = 5 two neighbouring segments (25 or 26
bits) must agree, the third and fourth may hold one differing bit together.

Buckets that hold many distinct fingerprints are not paired: every fingerprint is
masked at each admissible pair of the remaining bits, and equal masked values (at most
four fingerprints each) are linked.  That is exact and linear in the bucket.

Defined results: null or word-less texts have fingerprint zero and link like any
other; repeated rows are returned as often as they occur; null ids take part in
linking and get the component's smallest non-null id (null if it has none); extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qmeasures.llm.common import as_bytes, bound_batches, materialize
from qmeasures.llm.components import components

_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE_OFFSETS = np.arange(8, dtype=np.int64) * 256
_WEIGHTS = (np.uint64(1) << np.arange(64, dtype=np.uint64)).astype(np.uint64)


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text; bytes.split() cuts at \\x20 and \\x09-\\x0D."""
    words = text.lower().split()  # bytes.lower() touches A-Z only
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    counts = np.zeros(64, dtype=np.int64)
    total = len(words) - shingle + 1
    for at in range(0, total, 65536):
        part = words[at:at + 65536 + shingle - 1]
        hashes = np.fromiter((xxhash.xxh64_intdigest(x, seed)
                              for x in map(b" ".join, zip(*(part[k:] for k in range(shingle))))), dtype=np.uint64)
        places = hashes.astype("<u8").view(np.uint8).reshape(-1, 8) + _BYTE_OFFSETS
        by_byte = np.bincount(places.ravel(), minlength=2048).reshape(8, 256)
        counts += (by_byte @ _BITS_OF_BYTE).ravel()
    return int(_WEIGHTS[counts * 2 > total].sum(dtype=np.uint64))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                 seed: int = 42) -> DataFrame:
    """(doc_id, fp): fp is the signed long with the fingerprint's bits."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(x, shingle, seed) for x in as_bytes(batch.column(1))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, fp long")


def _segments(m: int) -> list[tuple[int, int]]:
    """(offset, width) of each segment."""
    edges = [64 * k // m for k in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _exact_lead(m: int, t: int) -> int:
    """Segments at a chain's start whose budget l*t/m stays below one bit."""
    return max(1, (m - 1) // t) if t else m


def _mask(offset: int, width: int) -> int:
    bits = ((1 << width) - 1) << offset
    return bits - (1 << 64) if bits >> 63 else bits


def _lead_mask(start: int, m: int, t: int) -> int:
    segments = _segments(m)
    bits = 0
    for k in range(_exact_lead(m, t)):
        offset, width = segments[(start + k) % m]
        bits |= ((1 << width) - 1) << offset
    return bits - (1 << 64) if bits >> 63 else bits


def _chain_ok(differing: Column, start: int, m: int, t: int) -> Column:
    """Every prefix of the chain from ``start`` stays within floor(l * t / m) bits."""
    segments, ok, run = _segments(m), F.lit(True), F.lit(0)
    for length in range(1, m + 1):
        run = run + F.bit_count(differing.bitwiseAND(F.lit(_mask(*segments[(start + length - 1) % m]))))
        ok = ok & (run <= length * t // m)
    return ok


def _admissible_masks(start: int, m: int, t: int) -> list[int]:
    """Bit sets of size t outside the lead that the chain budgets admit, as signed longs."""
    from itertools import combinations
    segments = _segments(m)
    place = {}
    for k in range(_exact_lead(m, t), m):
        offset, width = segments[(start + k) % m]
        place |= {offset + b: k for b in range(width)}

    def admitted(bits: tuple[int, ...]) -> bool:
        return all(sum(place[b] < length for b in bits) <= length * t // m for length in range(1, m + 1))

    out = []
    for bits in combinations(sorted(place), t):
        if admitted(bits):
            mask = sum(1 << b for b in bits)
            out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def links(prints: DataFrame, max_bits: int = 2, segments: int = 5, heavy: int = 1024) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (a, b), a < b, that span every link.

    Buckets of up to ``heavy`` fingerprints give each linked pair; larger buckets give
    the links through masked values, which connect the same fingerprints.
    """
    m, t = segments, max_bits
    keyed = prints.select("fp", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(_lead_mask(i, m, t))).alias("key"))
        for i in range(m)])).alias("k")).select("fp", "k.i", "k.key")
    sizes = keyed.groupBy("i", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = materialize(sizes)
    big = sizes.where(F.col("n") > heavy).select("i", "key")
    keyed = materialize(keyed.join(sizes, ["i", "key"]))
    small = keyed.where(F.col("n") <= heavy)
    left, right = small.alias("l"), small.alias("r")
    differing = F.col("l.fp").bitwiseXOR(F.col("r.fp"))
    pruned = F.lit(False)
    for i in range(m):
        pruned = pruned | ((F.col("l.i") == i) & _chain_ok(differing, i, m, t))
    pairs = left.join(right, (F.col("l.i") == F.col("r.i")) & (F.col("l.key") == F.col("r.key"))
                      & (F.col("l.fp") < F.col("r.fp")) & pruned & (F.bit_count(differing) <= t)
                      ).select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b"))
    if big.isEmpty():
        return pairs.distinct()
    masks = F.create_map(*[x for i in range(m) for x in (
        F.lit(i), F.array(*[F.lit(k) for k in _admissible_masks(i, m, t)]))])
    masked = (keyed.where(F.col("n") > heavy).select("fp", "i", F.explode(masks[F.col("i")]).alias("mask"))
              .groupBy("mask", F.col("fp").bitwiseAND(F.bitwise_not("mask")).alias("rest"))
              .agg(F.collect_set("fp").alias("fps"))  # at most 2**t values of the masked bits
              .where(F.size("fps") > 1)
              .select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b"))
    return pairs.union(masked).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    max_bits: int = 2, seed: int = 42, segments: int = 5, heavy: int = 1024) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    prints = materialize(fingerprints(docs, id_col, text_col, shingle, seed))
    groups = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = components(links(groups.select("fp"), max_bits, segments, heavy))
    named = groups.join(roots, groups.fp == roots.node, "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    named = materialize(named)
    lowest = materialize(named.groupBy("root").agg(F.min("low").alias("component_id")))
    by_print = materialize(named.join(lowest, "root").select("fp", "component_id"))
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
