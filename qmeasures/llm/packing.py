"""Operator 9: best-fit packing into sequences of several permitted lengths.

Pieces go longest first into the open sequence with the least space that still holds
them.  If none does, a new sequence is opened at the permitted length that costs least
per token it can be expected to hold: the piece and what the shorter pieces still to come
could add.  At the end every sequence shrinks to the smallest permitted length that
holds its contents.  The same is done with each permitted length alone as the opening
length, and the plan with the least total cost after shrinking is kept.

Documents are measured and packed where they are read, in blocks of ``block`` pieces, so
nothing is shuffled and no task holds more than a block of lengths.  Sequence numbers
hold the partition and a running number; the same input files read in the same splits
give the same plan.

Defined results: a document longer than the largest permitted length is cut into pieces
of that length and a rest; a null or word-less text gives one row of 0 tokens without a
sequence; repeated rows are packed each; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qmeasures.llm.common import as_bytes, bound_batches

LENGTHS = (512, 1024, 2048, 4096)


def cost(length: int) -> float:
    """A sequence costs its length and a fixed share for starting it."""
    return length + 32.0


def _fill(sizes: list[int], opening: tuple[int, ...], price: Callable[[int], float]) -> tuple[list[int], list[int], list[int]]:
    """Sizes, largest first -> (sequence of each, offset of each, contents of each sequence)."""
    rising = sizes[::-1]
    sums = np.concatenate([[0], np.cumsum(rising)]).tolist()  # sums[k]: the k smallest
    place, offset, used, limit = [], [], [], []
    with_space: dict[int, list[int]] = {}
    spaces = 0  # bit s is set if some open sequence has space s
    for done, size in enumerate(sizes):
        above = spaces >> size
        if above:
            space = size + (above & -above).bit_length() - 1
            at = with_space[space].pop()
            if not with_space[space]:
                spaces &= ~(1 << space)
        else:
            left = len(sizes) - done - 1  # pieces still to come are the ``left`` smallest

            def per_token(length: int) -> float:
                return price(length) / (size + min(length - size, sums[min(left, bisect_right(rising, length - size))]))
            space = min((x for x in opening if x >= size), key=per_token)
            at = len(used)
            used.append(0)
            limit.append(space)
        place.append(at)
        offset.append(used[at])
        used[at] += size
        space = limit[at] - used[at]
        if space:
            with_space.setdefault(space, []).append(at)
            spaces |= 1 << space
    return place, offset, used


def best_fit(sizes: list[int], lengths: tuple[int, ...] = LENGTHS,
             price: Callable[[int], float] = cost) -> tuple[list[int], list[int], list[int]]:
    """Piece sizes -> (sequence of each piece, offset of each piece, final length of each sequence)."""
    lengths = tuple(sorted(lengths))
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    falling = [sizes[i] for i in order]
    best = None
    for opening in [lengths, *[(x,) for x in lengths if not falling or x >= falling[0]]]:
        place, offset, used = _fill(falling, opening, price)
        final = [next(x for x in lengths if x >= u) for u in used]
        total = sum(map(price, final))
        if best is None or total < best[0]:
            best = total, place, offset, final
    _, place, offset, final = best
    back_place, back_offset = [0] * len(sizes), [0] * len(sizes)
    for k, i in enumerate(order):
        back_place[i], back_offset[i] = place[k], offset[k]
    return back_place, back_offset, final


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lengths: tuple[int, ...] = LENGTHS,
         price: Callable[[int], float] = cost, block: int = 20_000) -> DataFrame:
    """One row per piece: doc_id, piece, start, n_tokens, seq_id, seq_length, seq_offset.

    Tokens are the text's words; ``start`` is the piece's first token in the document.
    """
    bound_batches(docs.sparkSession)
    longest = max(lengths)
    names = ["doc_id", "piece", "start", "n_tokens", "seq_id", "seq_length", "seq_offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (id, piece, start, size)
        made, part, kind = 0, None, None

        def flush() -> pa.RecordBatch:
            nonlocal held, made
            real = [k for k, p in enumerate(held) if p[3]]
            place, offset, final = best_fit([held[k][3] for k in real], lengths, price)
            columns = [list(c) for c in zip(*held)] + [[None] * len(held) for _ in range(3)]
            for k, at, start in zip(real, place, offset):
                columns[4][k], columns[5][k], columns[6][k] = (part << 33) + made + at, final[at], start
            made += len(final)
            held = []
            types = [kind, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, part = batch.column(0).type, batch.column(2)[0].as_py()
            for doc, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                total = len(text.split())
                for piece, start in enumerate(range(0, max(total, 1), longest)):
                    held.append((doc, piece, start, min(longest, total - start)))
                    if len(held) >= block:
                        yield flush()
        if held:
            yield flush()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       F.spark_partition_id().alias("part")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, n_tokens long, seq_id long, seq_length int, seq_offset int")
