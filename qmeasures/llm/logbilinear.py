"""Operator 6: language-model scoring with a log-bilinear neural model.

The model predicts the next word or the end of text from the two tokens before it:
position-wise scaled embeddings are added up and multiplied with output embeddings.  Every
word among the ``hot`` most frequent ones has embeddings of its own, as context and as
output; all others share 64 suffix classes, and within a class a word's share follows its
add-one count.  The softmax has two levels: outputs lie in groups of falling frequency
(sizes grow with the root of the rank), the model gives the probability of the group and
that of the word in its group.  It is trained in numpy by noise-contrastive estimation on
both levels: noise groups from the corpus frequencies, noise words evenly from the group.

Texts are split once for counting and once into numbers; the numbers are written in
partitions of equal shares of rows, by hash, whatever the layout of the input.  Every
text is learned from whole, in one of ``rounds`` rounds by hash (one round if one task
learns from everything).  In a round, tasks of about
``share`` tokens train from the same start, and Spark adds the parameters up block by block
and averages them: output embeddings by the number of examples, context embeddings by the
occurrences of the word.

Scoring normalises exactly: one matrix product with all groups and one per group with its
words give both log normalisers.  Probabilities of all known words, of one unknown word in
each class and of the end add up to one.

Word counts cover every training text.  They stay a Spark table; only words frequent
enough to be among ``hot`` (a fixed bound) are shipped to the tasks, and the occurrences
of all other words meet the table in a join.  Words are told apart by 64-bit hashes.

Defined results: a null or empty text is one end token; without training text every
base score is 0; repeated rows each give a row; extra columns are ignored.  Another layout
of the same rows gives other training shares, so ``score`` moves within 0.02 a token (tested);
every other column stays the same.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qmeasures.llm.common import bound_batches, materialize

CLASSES = 64
GROUPS = 208
BLOCK_ROWS = 1024
PART_TOKENS = 1 << 22
FLUSH_WORDS = 1_000_000
SHORT_RUN = 4


def word_hash(word: bytes) -> int:
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >> 63 else h


def word_hashes(words: list[bytes]) -> np.ndarray:
    """``word_hash`` of each."""
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)).view(np.int64)


def word_class(word: bytes) -> int:
    """Suffix class: words that end alike tend to be of one kind and language."""
    return zlib.crc32(word[-3:]) % CLASSES


def _pieces(words: pa.Array) -> list[bytes]:
    """The bytes of a string column without nulls; slices of one buffer are faster than ``to_pylist``."""
    _, offsets, data = words.buffers()
    cuts = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1].tolist() if len(words) else []
    whole = data.to_pybytes() if data else b""
    return [whole[a:b] for a, b in zip(cuts, cuts[1:])]


def split_words(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Words a text, the distinct words, and which of them each word is; A-Z are lowered."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    offsets = lists.offsets.to_numpy()
    words = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
    distinct, at = _pieces(words.dictionary), words.indices.to_numpy()
    if b"" in distinct:   # white space at an end leaves an empty piece
        empty = distinct.index(b"")
        kept = at != empty
        offsets = np.concatenate([[0], np.cumsum(kept)])[offsets - offsets[0]]
        at = at[kept]
        at -= at > empty
        del distinct[empty]
    return np.diff(offsets).astype(np.int64), distinct, at


def as_strings(column: pa.Array) -> pa.Array:
    """A text column for Arrow's string functions, its bytes unchecked; null becomes empty."""
    return pc.fill_null(column.cast(pa.binary()).view(pa.string()), "")


def _added(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """(h, n, kind) of the distinct hashes: their counts added up, one of their kinds."""
    h, n, kind = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(h)
    h = h[order]
    first = _firsts(h)
    return pa.RecordBatch.from_arrays([pa.array(h[first], pa.int64()), pa.array(np.add.reduceat(n[order], first), pa.int64()),
                                       pa.array(np.minimum.reduceat(kind[order], first), pa.int32())], names=["h", "n", "kind"])


def count_words(texts: DataFrame) -> DataFrame:
    """(text) -> (h, n, kind): occurrences of each word, added up in the task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            texts = as_strings(batch.column(0))
            for a, b in _slices(texts):
                _, words, at = split_words(texts.slice(a, b - a))
                held.append((word_hashes(words), np.bincount(at, minlength=len(words)),
                             np.fromiter(map(word_class, words), np.int32, len(words))))
                size += len(words)
                if size > FLUSH_WORDS:
                    yield _added(held)
                    held, size = [], 0
        if size:
            yield _added(held)

    return texts.select("text").mapInArrow(run, "h long, n long, kind int").groupBy("h").agg(
        F.sum("n").alias("n"), F.min("kind").alias("kind"))


@dataclass
class Counts:
    """Bounded facts about the corpus counts; arrays of hot words by falling count."""

    tokens: int            # N
    distinct: int          # V
    texts: int             # count of the end token
    hot_hash: np.ndarray
    hot_count: np.ndarray
    hot_kind: np.ndarray
    kind_count: np.ndarray   # occurrences of all words of a class
    kind_mass: np.ndarray    # the same, with one added for each distinct word

    def outputs(self) -> int:
        """Hot words, classes, end."""
        return len(self.hot_hash) + CLASSES + 1

    def weights(self) -> np.ndarray:
        """Occurrences of each output, and one."""
        rest = self.kind_count.astype(float)
        np.subtract.at(rest, self.hot_kind, self.hot_count)
        return np.concatenate([self.hot_count, rest, [self.texts]]) + 1.0

    def rest_mass(self) -> np.ndarray:
        """Add-one mass of each class without its hot words, and one for an unknown word."""
        mass = self.kind_mass.astype(float)
        np.subtract.at(mass, self.hot_kind, self.hot_count + 1)
        return mass + 1

    def group_starts(self) -> np.ndarray:
        """First output of each group, and the number of outputs; the classes are one group, the end another."""
        n = len(self.hot_hash)
        cuts = np.ceil(n * (np.arange(GROUPS) / GROUPS) ** 2).astype(np.int64)
        hot = np.unique(np.minimum(np.maximum(cuts, np.arange(GROUPS)), n))
        return np.concatenate([hot[hot < n], [n, n + CLASSES, self.outputs()]])


def gather(counts: DataFrame, texts: int, hot: int) -> Counts:
    """Totals, and the words above the lowest count step that keeps them within ``hot``."""
    step = F.floor(F.log2("n") * 8).cast("int")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    kinds = counts.groupBy("kind").agg(F.sum("n").alias("n"), F.sum(F.col("n") + 1).alias("mass")).collect()
    least, room = None, hot
    for s, n in sorted(((r[0], r[1]) for r in counts.groupBy(step.alias("s")).count().collect()), reverse=True):
        room -= n
        if room < 0:
            break
        least = s
    rows = counts.where(step >= least).toArrow() if least is not None else None
    h, n, kind = ((rows[c].to_numpy() for c in ("h", "n", "kind")) if rows is not None else
                  (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)))
    order = np.lexsort((h, -n))
    by_kind, mass = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in kinds:
        by_kind[r["kind"]], mass[r["kind"]] = r["n"], r["mass"]
    return Counts(total[0] + texts, total[1] + (1 if texts else 0), texts, h[order], n[order], kind[order], by_kind, mass)


class Words:
    """Numbers words by their outputs: a hot word's rank, or len(hot) + class."""

    def __init__(self, counts: Counts):
        self.rank = np.argsort(counts.hot_hash)
        self.hot = counts.hot_hash[self.rank]

    def number(self, texts: pa.Array | list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words a text, their outputs, cold words a text, their hashes."""
        sizes, words, of = split_words(texts if isinstance(texts, pa.Array) else as_strings(pa.array(texts, pa.binary())))
        hashes, n = word_hashes(words), len(self.hot)
        outputs = np.full(len(words), n)
        if n:
            near = np.minimum(np.searchsorted(self.hot, hashes), n - 1)
            outputs = np.where(self.hot[near] == hashes, self.rank[near], n)
        rest = np.flatnonzero(outputs == n)
        outputs[rest] += np.fromiter((word_class(words[i]) for i in rest.tolist()), np.int64, len(rest))
        places = outputs[of]
        cold = np.flatnonzero(places >= n)
        per_text = np.diff(np.searchsorted(cold, np.concatenate([[0], np.cumsum(sizes)])))
        return sizes, places, per_text, hashes[of[cold]]


def _lists(sizes: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def _slices(texts: pa.Array, most: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``most`` bytes."""
    at = size = 0
    for i, n in enumerate(pc.binary_length(texts).to_pylist()):
        size += n
        if size >= most:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)


def number_texts(docs: DataFrame, counts: Counts, parts: int) -> DataFrame:
    """(doc_id, learn, text) -> (doc_id, learn, row, ids, cold): outputs of each text's words and hashes of the cold
    ones, in ``parts`` partitions of equal shares of rows."""
    shipped = docs.sparkSession.sparkContext.broadcast(counts)  # hot words are bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shipped.value)
        for batch in batches:
            texts = as_strings(batch.column(3))
            for a, b in _slices(texts):
                sizes, ids, n_cold, cold = words.number(texts.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(3)), _lists(sizes, ids, pa.int32()),
                     _lists(n_cold, cold, pa.int64())], names=["doc_id", "learn", "row", "ids", "cold"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    numbered = docs.select("doc_id", "learn", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(
        run, f"doc_id {kind}, learn boolean, row long, ids array<int>, cold array<long>")
    return numbered.repartition(parts, F.xxhash64("row"))


@dataclass
class Tokens:
    """The tokens of a batch of texts, each text with its end: output, the ones before it, text starts."""

    of: np.ndarray
    one: np.ndarray
    two: np.ndarray
    starts: np.ndarray

    @staticmethod
    def read(ids: pa.ListArray, outputs: int) -> Tokens:
        offsets = ids.offsets.to_numpy().astype(np.int64)
        sizes = np.diff(offsets)
        ends = np.cumsum(sizes + 1) - 1
        of = np.full(int(sizes.sum()) + len(sizes), outputs - 1, dtype=np.int64)
        inside = np.ones(len(of), dtype=bool)
        inside[ends] = False
        of[inside] = ids.values.to_numpy()[offsets[0]:offsets[-1]]
        starts = ends - sizes
        one, two = np.roll(of, 1), np.roll(of, 2)
        one[starts], two[starts] = outputs, outputs
        two[starts[sizes > 0] + 1] = outputs
        return Tokens(of, one, two, starts)


@dataclass
class Model:
    scale: np.ndarray       # (2, dim): the word before, the one before that
    group: np.ndarray       # (groups, dim + 1): output embeddings of the groups, bias
    context: np.ndarray     # (outputs + 1, dim); the last row stands before the text
    target: np.ndarray      # (outputs, dim + 1): output embeddings within the group, bias

    @staticmethod
    def fresh(counts: Counts, dim: int, seed: int) -> Model:
        rng, n, starts, weight = np.random.default_rng(seed), counts.outputs(), counts.group_starts(), counts.weights()
        target = rng.normal(0, 0.05, (n, dim + 1))
        target[:, dim] = np.log(weight)
        group = rng.normal(0, 0.05, (len(starts) - 1, dim + 1))
        total = np.add.reduceat(weight, starts[:-1])
        target[:, dim] -= np.repeat(np.log(total), np.diff(starts))
        group[:, dim] = np.log(total / total.sum())
        return Model(np.full((2, dim), 0.7, np.float32), group.astype(np.float32),
                     rng.normal(0, 0.3, (n + 1, dim)).astype(np.float32), target.astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        return [self.scale, self.group, self.context, self.target]

    def copy(self) -> Model:
        return Model(*[p.copy() for p in self.parts()])

    def ahead(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Predicted embedding from the outputs one and two places before; a 1 at its end meets the bias."""
        return self.added(self.context.take(one, axis=0), self.context.take(two, axis=0))

    def added(self, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """The same from their embeddings."""
        q = np.ones((len(near), self.target.shape[1]), self.context.dtype)
        np.add(near * self.scale[0], far * self.scale[1], out=q[:, :-1])
        return q


class Normaliser:
    """log of the sum of exp(q @ rows.T) by row of q, in blocks."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.length = rows, (rows * rows).sum(axis=1).max()
        self.step = max(64, (1 << 17) // len(rows))

    def logs(self, q: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """``lengths``: squared lengths of the rows of q."""
        out = np.empty(len(q), np.float32)
        small = math.sqrt(lengths.max() * self.length) < 60  # then no exponential overflows
        for at in range(0, len(q), self.step):
            z = q[at:at + self.step] @ self.rows.T
            high = 0 if small else z.max(axis=1)
            if not small:
                z -= high[:, None]
            out[at:at + self.step] = np.log(np.exp(z, out=z).sum(axis=1)) + high
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)) in place."""
    with np.errstate(over="ignore"):   # beyond the range it is 0
        np.exp(np.negative(x, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _firsts(at: np.ndarray) -> np.ndarray:
    """Where runs of equal numbers begin."""
    return np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))


def _sum_rows(at: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct row numbers and the sums of their values."""
    order = np.argsort(at)
    at = at[order]
    first = _firsts(at)
    runs = np.diff(first, append=len(at))
    out = values.take(order[first], axis=0)
    some = np.flatnonzero((runs > 1) & (runs <= SHORT_RUN))
    rest = values.take(order[first[some] + 1], axis=0)
    for k in range(2, SHORT_RUN):   # most runs are short: all their third rows are added at once, then the fourth ones
        more = np.flatnonzero(runs[some] > k)
        rest[more] += values.take(order[first[some[more]] + k], axis=0)
    out[some] += rest   # the first row comes last, as in reduceat
    long = np.flatnonzero(runs > SHORT_RUN)
    if len(long):
        rows = values.take(order[np.repeat(runs > SHORT_RUN, runs)], axis=0)
        out[long] = np.add.reduceat(rows, np.cumsum(runs[long]) - runs[long])
    return at[first], out


class Contrast:
    """Noise-contrastive estimation on both levels with Adagrad over the rows that a batch touches."""

    def __init__(self, model: Model, counts: Counts, rng: np.random.Generator, rate: float, n_groups: int, n_words: int):
        self.m, self.rate, self.rng, self.k, self.kw = model, rate, rng, n_groups, n_words
        self.starts = counts.group_starts()
        self.sizes = np.diff(self.starts)
        self.of_output = np.repeat(np.arange(len(self.sizes)), self.sizes)
        share = np.add.reduceat(counts.weights(), self.starts[:-1])
        share /= share.sum()
        self.cumulative = np.cumsum(share)
        self.log_kn = np.log(n_groups * share).astype(np.float32)
        self.log_kw = np.log(n_words / self.sizes).astype(np.float32)
        self.seen = [np.ones(p.shape, np.float32) for p in model.parts()]
        self.met = np.zeros(len(model.context), np.float32)

    def noise(self) -> tuple[np.ndarray, np.ndarray]:
        """Noise groups, and noise words of every group."""
        groups = np.minimum(np.searchsorted(self.cumulative, self.rng.random(self.k)), len(self.cumulative) - 1)
        inside = (self.rng.random((len(self.sizes), self.kw)) * self.sizes[:, None]).astype(np.int64)
        return groups, self.starts[:-1, None] + inside

    def gradients(self, one: np.ndarray, two: np.ndarray, word: np.ndarray, groups: np.ndarray,
                  words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, gradients) of each part; ``word`` is sorted."""
        m, g, n = self.m, self.of_output[word], len(word)
        near, far = m.context.take(one, axis=0), m.context.take(two, axis=0)
        q = m.added(near, far)
        u, t, un = m.group.take(g, axis=0), m.target.take(word, axis=0), m.group[groups]
        g_fit = _sigmoid(np.einsum("nd,nd->n", q, u) - self.log_kn[g]) - 1
        against = q @ un.T
        against -= self.log_kn[groups]
        _sigmoid(against)
        d_q = against @ un
        d_q += np.multiply(u, g_fit[:, None], out=u)
        group = _sum_rows(np.concatenate([g, groups]), np.concatenate([g_fit[:, None] * q, against.T @ q]))
        many = self.sizes[g] > 1       # a group of one word has nothing to tell apart
        w_fit = np.where(many, _sigmoid(np.einsum("nd,nd->n", q, t) - self.log_kw[g]) - 1, 0).astype(q.dtype)
        d_q += np.multiply(t, w_fit[:, None], out=t)
        cuts = np.searchsorted(g, np.arange(len(self.sizes) + 1))
        met = np.flatnonzero((np.diff(cuts) > 0) & (self.sizes > 1))
        noise = words[met]
        tn = m.target.take(noise, axis=0)
        spans = [slice(a, b) for a, b in zip(cuts[met].tolist(), cuts[met + 1].tolist())]
        push = np.zeros((n, words.shape[1]), q.dtype)
        for s, other in zip(spans, tn):   # only the products are made group by group
            np.matmul(q[s], other.T, out=push[s])
        push -= self.log_kw[g][:, None]
        _sigmoid(push)
        by = np.empty(tn.shape, q.dtype)
        for s, other, sums in zip(spans, tn, by):
            d_q[s] += push[s] @ other
            np.matmul(push[s].T, q[s], out=sums)
        target = _sum_rows(np.concatenate([word, noise.ravel()]),
                           np.concatenate([w_fit[:, None] * q, by.reshape(-1, q.shape[1])]))
        d = d_q[:, :-1]
        scale = np.stack([np.einsum("nd,nd->d", d, x) for x in (near, far)])
        both = np.empty((2 * n, d.shape[1]), q.dtype)
        np.multiply(d, m.scale[0], out=both[:n])
        np.multiply(d, m.scale[1], out=both[n:])
        return [(np.arange(2), scale), group, _sum_rows(np.concatenate([one, two]), both), target]

    def step(self, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> None:
        order = np.argsort(word)
        one, two, word = one[order], two[order], word[order]
        for p, s, (at, by) in zip(self.m.parts(), self.seen, self.gradients(one, two, word, *self.noise())):
            sums = s.take(at, axis=0)
            sums += by * by
            s[at] = sums
            by *= self.rate
            by /= np.sqrt(sums, out=sums)
            p[at] = np.subtract(p.take(at, axis=0), by, out=by)

    def meet(self, one: np.ndarray, two: np.ndarray) -> None:
        """Note the occurrences of context embeddings."""
        self.met += np.bincount(np.concatenate([one, two]), minlength=len(self.met))


def _blocks(learner: Contrast, examples: int) -> Iterator[pa.RecordBatch]:
    """Parts of a trained model in blocks of rows: weights, and weighted parameters."""
    for part, p in enumerate(learner.m.parts()):
        weight = learner.met + 1e-6 * examples if part == 2 else np.full(len(p), examples)
        for at in range(0, len(p), BLOCK_ROWS):
            w = weight[at:at + BLOCK_ROWS, None].astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([at], pa.int32()), pa.array([w.tobytes()], pa.binary()),
                 pa.array([(w * p[at:at + BLOCK_ROWS]).astype(np.float32).tobytes()], pa.binary())], names=["part", "at", "w", "v"])


def _add_blocks(blocks: pa.Table) -> pa.Table:
    """One block from several of the same place."""
    sums = [np.sum([np.frombuffer(x, np.float32) for x in blocks[c].to_pylist()], axis=0, dtype=np.float64).astype(np.float32)
            for c in ("w", "v")]
    return pa.table({"part": blocks["part"].slice(0, 1), "at": blocks["at"].slice(0, 1),
                     "w": pa.array([sums[0].tobytes()], pa.binary()), "v": pa.array([sums[1].tobytes()], pa.binary())})


def train(numbered: DataFrame, counts: Counts, dim: int = 16, rounds: int = 2, batch: int = 1 << 13, n_groups: int = 64,
          n_words: int = 16, rate: float = 0.25, share: int = 1 << 23, seed: int = 5) -> Model:
    """Average of the models that tasks train, about ``share`` tokens each; every text is learned from in one round."""
    sc = numbered.sparkSession.sparkContext
    model, shipped_counts = Model.fresh(counts, dim, seed), sc.broadcast(counts)
    if counts.tokens < 1.5 * share:
        rounds = 1   # one task learns from everything: nothing to average
    tasks = max(1, round(counts.tokens / rounds / share))
    schema = "part int, at int, w binary, v binary"
    for turn in range(rounds):
        start = sc.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch], turn: int = turn, start=start) -> Iterator[pa.RecordBatch]:
            c = shipped_counts.value

            def learner() -> Contrast:
                return Contrast(start.value.copy(), c, np.random.default_rng([seed, turn]), rate, n_groups, n_words)

            own, kept, size, examples = learner(), [], 0, 0

            def learn() -> None:
                mixed = np.random.default_rng([seed, turn, examples]).permutation(size)
                one, two, of = (np.concatenate(x)[mixed] for x in zip(*kept))
                for at in range(0, size, batch):
                    own.step(one[at:at + batch], two[at:at + batch], of[at:at + batch])
                own.meet(one, two)

            for got in batches:
                t = Tokens.read(got.column(0), c.outputs())
                for at in range(0, len(t.of), 8 * batch):   # a very long text is learned in several runs
                    s = slice(at, at + 8 * batch)
                    kept.append((t.one[s], t.two[s], t.of[s]))
                    size += len(t.of[s])
                    if size >= 8 * batch:
                        learn()
                        examples, kept, size = examples + size, [], 0
                    if examples >= 1.25 * share:
                        yield from _blocks(own, examples)
                        own, examples = learner(), 0
            if size:
                learn()
                examples += size
            if examples:
                yield from _blocks(own, examples)

        turn_of = F.pmod(F.xxhash64(F.lit(seed), "row"), F.lit(rounds))
        blocks = numbered.where(turn_of == turn).select("ids").coalesce(tasks).mapInArrow(run, schema)
        if tasks > 8:   # so that no task adds up more than the root of all models
            few = max(2, math.isqrt(tasks))
            blocks = (blocks.withColumn("lot", F.spark_partition_id() % few).groupBy("part", "at", "lot")
                      .applyInArrow(lambda b: _add_blocks(b), schema))
        mean = blocks.groupBy("part", "at").applyInArrow(lambda b: _add_blocks(b), schema).toArrow()  # as large as one model
        parts = [p.copy() for p in model.parts()]
        for row in mean.to_pylist():
            w, p = np.frombuffer(row["w"], np.float32)[:, None], parts[row["part"]]
            v = np.frombuffer(row["v"], np.float32).reshape(len(w), -1)
            p[row["at"]:row["at"] + len(w)] = v / w
        model = Model(*parts)
    return model


class Scorer:
    def __init__(self, counts: Counts, model: Model):
        self.c, self.m = counts, model
        self.starts = counts.group_starts()
        self.of_output = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        self.groups = Normaliser(model.group)
        self.words = [Normaliser(model.target[a:b]) if b > a + 1 else None for a, b in zip(self.starts, self.starts[1:])]
        # log10 of a word's count, or of what a cold word's class divides by
        self.base = np.log10(np.concatenate([counts.hot_count + 1.0, np.ones(CLASSES), [counts.texts + 1.0]]))
        self.inside = np.concatenate([np.zeros(len(counts.hot_hash)), -np.log10(counts.rest_mass()), [0.0]])

    def logs(self, t: Tokens) -> np.ndarray:
        """log10 probability of each token's output."""
        order = np.argsort(t.of)
        of = t.of[order]
        g = self.of_output[of]
        before, at = np.unique(((t.one << 32) | t.two)[order], return_inverse=True)
        ahead = self.m.ahead(before >> 32, before & 0xFFFFFFFF)
        lengths = (ahead * ahead).sum(axis=1)
        q = ahead.take(at, axis=0)   # a context's first normaliser is worked out once
        found = np.einsum("nd,nd->n", q, self.m.group.take(g, axis=0)) - self.groups.logs(ahead, lengths)[at]
        lengths = lengths[at]
        cuts = np.searchsorted(g, np.arange(len(self.starts)))
        for i in np.flatnonzero((np.diff(cuts) > 0) & (np.diff(self.starts) > 1)):
            s = slice(cuts[i], cuts[i + 1])
            found[s] += np.einsum("nd,nd->n", q[s], self.m.target.take(of[s], axis=0)) - self.words[i].logs(q[s], lengths[s])
        out = np.empty(len(of))
        out[order] = found / np.log(10)
        return out

    def score(self, ids: pa.ListArray) -> tuple[np.ndarray, ...]:
        """Token counts, known tokens, sums without the cold words' counts (base, model) of the texts."""
        t, n = Tokens.read(ids, self.c.outputs()), len(self.c.hot_hash)
        logs = np.empty(len(t.of))
        for at in range(0, len(t.of), 1 << 17):
            s = slice(at, at + (1 << 17))
            logs[s] = self.logs(Tokens(t.of[s], t.one[s], t.two[s], t.starts))
        known = (t.of < n) | ((t.of == n + CLASSES) & (self.c.texts > 0))
        return (np.diff([*t.starts, len(t.of)]), np.add.reduceat(known, t.starts, dtype=np.int64),
                np.add.reduceat(self.base[t.of], t.starts), np.add.reduceat(logs + self.inside[t.of], t.starts))


def _scored(numbered: DataFrame, counts: Counts, model: Model) -> DataFrame:
    shipped = numbered.sparkSession.sparkContext.broadcast((counts, model))  # hot words and outputs are bounded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*shipped.value)
        for batch in batches:
            if batch.num_rows:
                sizes, known, base, logs = scorer.score(batch.column(2))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(known, pa.int64()),
                     pa.array(base), pa.array(logs)], names=["doc_id", "row", "n_tokens", "n_known", "base", "model"])

    kind = numbered.schema["doc_id"].dataType.simpleString()
    return numbered.select("doc_id", "row", "ids").mapInArrow(
        run, f"doc_id {kind}, row long, n_tokens long, n_known long, base double, model double")


def score(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", hot: int = 1 << 17,
          **training) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score; learns where ``learn`` holds."""
    bound_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(learn, F.lit(False)).alias("learn"),
                        F.col(text_col).cast("string").alias("text"))
    counts = materialize(count_words(texts.where("learn")))
    facts = gather(counts, texts.where("learn").count(), hot)
    parts = max(1, math.ceil(facts.tokens / PART_TOKENS))
    numbered = materialize(number_texts(texts, facts, parts))
    model = train(numbered.where("learn"), facts, **training)
    rows = _scored(numbered, facts, model)
    # cold words that were never seen add nothing: only the table's words come back from the join
    cold = (numbered.select("row", F.explode("cold").alias("h")).join(counts.select("h", "n"), "h").groupBy("row")
            .agg(F.count(F.lit(1)).alias("more_known"), F.sum(F.log10(F.col("n") + 1)).alias("more")))
    more, more_known = F.coalesce("more", F.lit(0.0)), F.coalesce("more_known", F.lit(0))
    norm = float(np.log10(facts.tokens + facts.distinct + 1))
    return rows.join(cold, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + more_known).alias("n_known"), F.lit(facts.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * norm).alias("base_score"), (F.col("model") + more).alias("score"))
