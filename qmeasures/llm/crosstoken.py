"""Operator 13: alignment of two tokenizers' tokens over a corpus, by white space anchors.

Every text is tokenised whole by A (byte-level BPE, of a space and the text) and by B
(sentencepiece BPE, which puts that space itself).  Where a token of A and a token of B
both end and the next token of each starts with a space, the document is cut; each cut
is verified on the byte offsets of both.  What lies between two cuts is a window, a pair of
id tuples.  A window's alignment depends on its ids alone, so it is worked out once in a block
of documents and remembered under them; a document is then a list of windows.

    group   A and B tokens between two neighbouring offsets where tokens of both end
    link    an A token and a B token whose byte ranges overlap

Spark does the corpus side.  A task writes blocks: the documents with their window numbers, and
the table of the block's windows with the links of each id pair.  Pair counts are summed
over the distinct pairs of the blocks, joined back to them, and meet the block's
documents in one co-group; links are never expanded to rows.

Defined results: null and empty texts, and texts whose joined token bytes of A or B differ from
space and text (such as those that B's normaliser changes), have no tokens: zeros and an
empty digest.  Special tokens' strings are plain text.  A text without shared ends before
spaces is one window, whatever its length, and costs time and memory in proportion;
tokenising needs a whole text in one task.  Repeated rows and ids each give a row and each
count; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from qmeasures.llm.bpe import byte_characters
from qmeasures.llm.common import bound_batches, materialize

#: Fixed value: the public split pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: tiktoken's pattern engine overflows its stack on long white space; the tokenizers library doesn't.
_LONG_SPACE = re.compile(r"\s{500}")
STEP_BYTES = 1 << 20      # text aligned at a time
BLOCK_BYTES = 16 << 20    # text of a block
BLOCK_LINKS = 1 << 20     # links in the window table of a block


@dataclass
class Vocabularies:
    """What tasks need of both tokenizers; bounded by their files."""

    a_json: str
    a_bytes: list[bytes]
    a_ranked: bool  # ids are merge ranks, so tiktoken gives the same ids
    b_model: bytes
    b_bytes: list[bytes]


def load(a_path: str, b_path: str) -> Vocabularies:
    with open(a_path, encoding="utf-8") as f:
        a_json = f.read()
    spec = json.loads(a_json)
    cut, model = spec["pre_tokenizer"] or {}, spec["model"]
    if (model["type"] != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space")
            or not cut.get("use_regex", True) or spec["normalizer"]):
        raise ValueError("A must be a byte-level BPE tokenizer without normaliser and prefix space")
    byte_of = {c: b for b, c in enumerate(byte_characters())}
    size = 1 + max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
    a_bytes = [b""] * size
    for t in spec["added_tokens"]:
        a_bytes[t["id"]] = t["content"].encode()
    for token, i in model["vocab"].items():
        a_bytes[i] = bytes(byte_of[c] for c in token)
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    ranked = not model.get("ignore_merges") and [model["vocab"]["".join(m)] for m in merges] == list(
        range(256, 256 + len(merges))) and len(model["vocab"]) == 256 + len(merges)
    with open(b_path, "rb") as f:
        b_model = f.read()
    pieces = sentencepiece.SentencePieceProcessor(model_proto=b_model)
    names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
    b_bytes = [bytes([int(n[3:5], 16)]) if pieces.is_byte(i) else n.replace("▁", " ").encode()
               for i, n in enumerate(names)]
    return Vocabularies(a_json, a_bytes, ranked, b_model, b_bytes)


def _runs(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of the given sizes; runs may be empty."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    end = np.cumsum(sizes)
    return total[end] - total[end - sizes]


class Aligner:
    """Tokenises texts and cuts them into windows; one per Python worker."""

    def __init__(self, v: Vocabularies) -> None:
        self.v = v
        self.library = tokenizers.Tokenizer.from_str(v.a_json)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        self.fast = None
        if v.a_ranked:
            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, special_tokens={}, mergeable_ranks={
                b: i for i, b in enumerate(v.a_bytes[:256 + len(json.loads(v.a_json)["model"]["merges"])])})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=v.b_model)
        self.sides = []
        for tokens in (v.a_bytes, v.b_bytes):
            lengths = [len(t) for t in tokens]
            self.sides.append((tokens, lengths, np.array(lengths), np.array([t[:1] == b" " for t in tokens]),
                               np.uint16 if len(tokens) <= 1 << 16 else np.uint32))
        a_told, b_told = ([str(i) for i in range(len(side[0]))] for side in self.sides)
        # ids as they are written: within a group, and as the last of it
        self.told = [x + end for told, ends in ((a_told, ",|"), (b_told, ",;")) for end in ends for x in told]

    def encode_a(self, text: str) -> list[int]:
        if self.fast is None or _LONG_SPACE.search(text):
            return self.library.encode(" " + text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(" " + text)

    def tokens(self, texts: list[str | None]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of A and B of each text whose bytes both give back; None for the others."""
        b_ids = self.pieces.encode([t or "" for t in texts], num_threads=1)
        out = []
        for text, b in zip(texts, b_ids):
            pair = None
            if text:
                want, a = b" " + text.encode(), self.encode_a(text)
                if (b"".join(map(self.v.a_bytes.__getitem__, a)) == want
                        and b"".join(map(self.v.b_bytes.__getitem__, b)) == want):
                    pair = a, b
            out.append(pair)
        return out

    def windows(self, kept: list[tuple[list[int], list[int]]]) -> tuple[list[tuple[bytes, bytes]], np.ndarray]:
        """Keys of the windows of tokenised texts in order, and the place of each text's first window."""
        keys, starts, ids = [], [], []
        for k, (_, _, lengths, spaced, kind) in enumerate(self.sides):
            # one stream: texts have the same bytes on both sides, so their offsets stay level
            x = np.concatenate([np.fromiter(pair[k], kind, len(pair[k])) for pair in kept])
            size = lengths[x]
            start = np.cumsum(size) - size
            ids.append(x)
            starts.append((start, start[spaced[x]], size))
        met = np.zeros(int(starts[0][0][-1] + starts[0][2][-1]), np.uint8)
        for _, marked, _ in starts:
            met[marked] += 1
        cuts = np.flatnonzero(met == 2)  # tokens of both start here with a space, so tokens of both end here
        for x, (start, _, _) in zip(ids, starts):
            width, raw = x.itemsize, x.tobytes()
            edge = np.append(np.searchsorted(start, cuts), len(x)) * width
            edge = edge.tolist()
            keys.append([raw[s:e] for s, e in zip(edge, edge[1:])])
        first = np.cumsum([0] + [len(a) for a, _ in kept[:-1]])  # A tokens before each text
        return list(zip(*keys)), np.searchsorted(cuts, starts[0][0][first])

    def align(self, keys: list[tuple[bytes, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
        """Windows -> links (a << 32 | b, in order), links of each, groups of each, and the groups as text."""
        ids, counts, starts, ends = [], [], [], []
        for k, (_, _, lengths, _, kind) in enumerate(self.sides):
            raw = [key[k] for key in keys]
            x = np.frombuffer(b"".join(raw), kind).astype(np.int64)
            ids.append(x)
            counts.append(np.array([len(r) for r in raw]) // np.dtype(kind).itemsize)
            ends.append(np.cumsum(lengths[x]))  # both sides have the same bytes
            starts.append(ends[-1] - lengths[x])
        low, high = np.searchsorted(ends[1], starts[0], "right"), np.searchsorted(starts[1], ends[0], "left")
        met = high - low  # B tokens that each A token overlaps
        b = np.arange(met.sum()) + np.repeat(low - np.cumsum(met) + met, met)
        links = np.repeat(ids[0], met) << 32 | ids[1][b]
        last = [other[np.minimum(np.searchsorted(other, own), len(other) - 1)] == own for own, other in (ends, ends[::-1])]
        group = [np.cumsum(x) - x for x in last]
        words = [len(side[0]) for side in self.sides]
        told = np.concatenate([ids[0] + last[0] * words[0], ids[1] + 2 * words[0] + last[1] * words[1]])
        order = np.argsort(np.concatenate([2 * group[0], 2 * group[1] + 1]), kind="stable")
        parts = list(map(self.told.__getitem__, told[order].tolist()))
        edge = np.cumsum(counts[0] + counts[1]).tolist()
        texts = ["".join(parts[s:e])[:-1] for s, e in zip([0, *edge], edge)]
        return links, _runs(met, counts[0]), _runs(last[0], counts[0]), texts


class _Numbers(dict):
    """Window (id tuples of A and B, as bytes) -> its number in the block, with all windows' alignments."""

    def __init__(self, aligner: Aligner) -> None:
        super().__init__()
        self.aligner, self.texts, self.new = aligner, [], []
        self.groups, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.links: list[np.ndarray] = []
        self.n_links = 0

    def __missing__(self, key: tuple[bytes, bytes]) -> int:
        self.new.append(key)
        number = self[key] = len(self)
        return number

    def numbers(self, keys: list[tuple[bytes, bytes]]) -> list[int]:
        """The numbers of windows; those that the block hasn't met are aligned, all together."""
        found = [self[k] for k in keys]
        if self.new:
            links, sizes, groups, texts = self.aligner.align(self.new)
            self.links.append(links)
            self.n_links += len(links)
            self.sizes, self.groups = np.append(self.sizes, sizes), np.append(self.groups, groups)
            self.texts += texts
            self.new = []
        return found


_DOC = "doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
_BLOCK = ", block long, windows array<int>, sizes array<int>, links array<long>, pairs array<long>, uses array<long>"


@dataclass
class _Block:
    """Documents and windows of up to BLOCK_BYTES of text of one task."""

    number: int
    windows: _Numbers
    ids: list = field(default_factory=list)
    docs: list[tuple] = field(default_factory=list)
    bytes: int = 0

    def add(self, ids: list, texts: list[str | None]) -> None:
        pairs = self.windows.aligner.tokens(texts)
        kept = [p for p in pairs if p]
        told = iter(())
        if kept:
            keys, first = self.windows.aligner.windows(kept)
            numbers = self.windows.numbers(keys)
            flat, edge = np.array(numbers, np.int32), [*first.tolist(), len(numbers)]
            sizes = np.diff(edge)
            told = zip(_runs(self.windows.groups[flat], sizes).tolist(), _runs(self.windows.sizes[flat], sizes).tolist(),
                       zip(edge, edge[1:]))
        for pair in pairs:
            if pair is None:
                self.docs.append((0, 0, 0, 0, "", ()))
                continue
            groups, links, (start, end) = next(told)
            text = ";".join(map(self.windows.texts.__getitem__, numbers[start:end]))
            self.docs.append((len(pair[0]), len(pair[1]), groups, links, hashlib.sha256(text.encode()).hexdigest(),
                              flat[start:end]))
        self.ids += ids
        self.bytes += sum(len(t or "") for t in texts)

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """The documents, and then one row with the windows; a pair's uses are its links in the block's documents."""
        for at in range(0, len(self.docs), 500):
            part = list(zip(*self.docs[at:at + 500]))
            n, own = len(part[0]), [np.asarray(x, np.int32) for x in part[5]]
            lists = pa.ListArray.from_arrays(np.cumsum([0] + [len(x) for x in own]).astype(np.int32), np.concatenate(own))
            columns = [pa.array(self.ids[at:at + 500], schema.field(0).type),
                       *(pa.array(x, t) for x, t in zip(part[:5], schema.types[1:6])), pa.array([self.number] * n, pa.int64()),
                       lists, *(pa.nulls(n, t) for t in schema.types[8:])]
            yield pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, schema.types)], schema=schema)
        used = np.zeros(len(self.windows.texts), np.int64)
        for doc in self.docs:
            if len(doc[5]):
                used += np.bincount(doc[5], minlength=len(used))
        links = np.concatenate([np.zeros(0, np.int64), *self.windows.links])
        pairs, place = np.unique(links, return_inverse=True)
        uses = np.bincount(place, np.repeat(used, self.windows.sizes), len(pairs)).astype(np.int64)
        row = [None] * 6 + [self.number, None, self.windows.sizes, links, pairs, uses]
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, schema.types)], schema=schema)


def _blocks(shipped, mark: str, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if mark not in _ALIGNERS:
            _ALIGNERS.clear()
            _ALIGNERS[mark] = Aligner(shipped.value)
        aligner = _ALIGNERS[mark]
        number = TaskContext.get().partitionId() << 32  # the same when a lost task runs again
        block = _Block(number, _Numbers(aligner))
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, size = at, 0
                while end < len(texts) and (end == at or size + len(texts[end] or "") <= STEP_BYTES):
                    size += len(texts[end] or "")
                    end += 1
                block.add(ids[at:end], texts[at:end])
                at = end
                if block.bytes >= BLOCK_BYTES or block.windows.n_links >= BLOCK_LINKS:
                    yield from block.batches(schema)
                    number += 1
                    block = _Block(number, _Numbers(aligner))
        if block.docs:
            yield from block.batches(schema)
    return run


_ALIGNERS: dict[str, Aligner] = {}  # of this Python worker, by vocabularies


def _looked_up(block: pa.Table, counts: pa.Table) -> pa.Table:
    """Documents of one block with n_best and count_sum, from the corpus-wide counts of its pairs."""
    flat = lambda column: (column.combine_chunks().flatten().to_numpy(zero_copy_only=False),
                           column.combine_chunks().value_lengths().to_numpy(zero_copy_only=False))
    own = np.asarray(block.column("sizes").is_valid())
    table, docs = block.filter(pa.array(own)), block.filter(pa.array(~own))
    links, sizes = flat(table.column("links"))[0], flat(table.column("sizes"))[0]
    pair, n, best = (counts.column(x).to_numpy() for x in ("pair", "n", "best"))
    order = np.argsort(pair)
    at = order[np.searchsorted(pair, links, sorter=order)] if len(links) else np.zeros(0, np.int64)
    windows, lengths = flat(docs.column("windows"))
    for name, values in (("n_best", best[at]), ("count_sum", n[at])):
        docs = docs.append_column(name, pa.array(_runs(_runs(values, sizes)[windows], lengths)))
    return docs.drop_columns(["block", "windows", "sizes", "links"])


def align_corpus(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum of every document.

    ``count_sum`` adds up, over a document's links, how many links of the corpus hold the same
    id pair; ``n_best`` counts the links whose pair is the most frequent of its B id.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    vocabularies = load(a_path, b_path)
    mark = hashlib.sha256(vocabularies.a_json.encode() + vocabularies.b_model).hexdigest()
    kind = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    declared = _DOC.format(kind=kind)
    schema = to_arrow_schema(spark.createDataFrame([], declared + _BLOCK).schema)
    blocks = materialize(read.mapInArrow(_blocks(spark.sparkContext.broadcast(vocabularies), mark, schema), declared + _BLOCK))
    pairs = blocks.where("sizes IS NOT NULL").select("block", F.explode(F.arrays_zip("pairs", "uses")).alias("x")).select(
        "block", F.col("x.pairs").alias("pair"), F.col("x.uses").alias("uses"))
    counts = pairs.groupBy("pair").agg(F.sum("uses").alias("n")).select("*", F.expr("pair & 4294967295").alias("b"))
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    told = counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    looked = pairs.select(F.col("block").alias("of"), "pair").join(told, "pair")
    return (blocks.drop("pairs", "uses").groupBy("block").cogroup(looked.groupBy("of"))
            .applyInArrow(_looked_up, declared + ", n_best long, count_sum long"))
