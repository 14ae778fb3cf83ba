"""Operator 3: toxicity by a bidirectional gated recurrent network with attention pooling.

Each word enters as its hashed word embedding beside the scaled sum of its hashed
character 3- to 6-gram embeddings.  A GRU reads every window of ``WINDOW`` words in both directions,
attention pools the states, and a linear layer gives the window's logit.  All
overlapping windows (half a window apart) of the whole text are scored; the largest and
third largest window logit and the count of windows become the text's probability by a
logistic calibration fitted on rows held back from training.  Everything is trained in numpy with hand-written gradients.

Labels are per text, so training first spreads the label over windows and then, as in
multiple-instance learning, goes on with the window that speaks most for the label.
It uses at most ``max_rows`` labelled rows, the first by hash, as many of either class
as there are, and all windows of each; while labels are spread, the windows of a text
share its weight.  Calibration reads all windows of the held-back texts, as scoring does.

In a task the input projections of distinct words are computed once (bounded cache),
so a window step is one table look-up and one small matrix product for many windows.

Defined results: null or word-less texts get the score of an empty window; without
labels of both classes every score is 0; repeated rows each give a row; a document
with several labels counts as toxic if any is 1; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qmeasures.llm.common import as_texts, bound_batches

WORDS = re.compile(r"\w+")
WINDOW, STRIDE = 32, 16
WORD_BUCKETS, GRAM_BUCKETS, EMBED, HIDDEN = 1 << 15, 1 << 16, 8, 8
GRAMS = (3, 4, 5, 6)
CACHE_WORDS, CHUNK = 150_000, 2048
PART = 1 << 16  # words at a time, a multiple of STRIDE


def starts(n_words: int) -> range:
    """First word of each window; the last window reaches the text's end."""
    return range(0, max(n_words - WINDOW, 0) + STRIDE, STRIDE) if n_words > WINDOW else range(1)


def word_inputs(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word bucket of each word; n-gram buckets of all words in a row; n-grams of each word.

    N-grams run over the UTF-8 bytes between boundary marks; their hashes grow byte by
    byte for all words at once.
    """
    whole = np.array([zlib.crc32(w.encode()) % WORD_BUCKETS for w in words], dtype=np.int64)
    marked = [b"<%b>" % w.encode() for w in words]
    length = np.array([len(m) for m in marked])
    data = np.frombuffer(b"".join(marked), np.uint8).astype(np.uint64)
    owner = np.repeat(np.arange(len(words)), length)
    left = np.cumsum(length)[owner] - np.arange(len(data))
    hashed, found, owners = np.zeros_like(data), [], []
    for n in range(1, max(GRAMS) + 1):
        hashed = hashed[:len(data) - n + 1] * np.uint64(0x100000001B3) + data[n - 1:]
        if n in GRAMS:
            inside = np.flatnonzero(left[:len(hashed)] >= n)
            mixed = (hashed[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(40)).astype(np.int64) % GRAM_BUCKETS)
            owners.append(owner[inside])
    owners = np.concatenate(owners)
    return whole, np.concatenate(found)[np.argsort(owners, kind="stable")], np.bincount(owners, minlength=len(words))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


@dataclass
class Network:
    word: np.ndarray   # (WORD_BUCKETS, EMBED)
    gram: np.ndarray   # (GRAM_BUCKETS, EMBED)
    w: np.ndarray      # (2 directions, 2 EMBED, 3 HIDDEN): gates z, r and candidate
    u: np.ndarray      # (2, HIDDEN, 3 HIDDEN)
    b: np.ndarray      # (2, 3 HIDDEN)
    att: np.ndarray    # (2 HIDDEN, 2 HIDDEN)
    key: np.ndarray    # (2 HIDDEN,)
    out: np.ndarray    # (2 HIDDEN,)
    bias: np.ndarray   # (1,)
    calibration: np.ndarray | None = None  # weights of the text's features and a constant

    @staticmethod
    def fresh(rng: np.random.Generator) -> Network:
        f = lambda *shape, by=0.3: rng.normal(0, by, shape).astype(np.float32)
        h = HIDDEN
        return Network(f(WORD_BUCKETS, EMBED, by=0.1), f(GRAM_BUCKETS, EMBED, by=0.1), f(2, 2 * EMBED, 3 * h),
                       f(2, h, 3 * h), np.zeros((2, 3 * h), np.float32), f(2 * h, 2 * h), f(2 * h), f(2 * h),
                       np.zeros(1, np.float32))

    def inputs(self, words: list[str]) -> np.ndarray:
        whole, grams, size = word_inputs(words)
        sums = np.add.reduceat(self.gram[grams], np.cumsum(size) - size, axis=0) / np.sqrt(size)[:, None]
        return np.concatenate([self.word[whole], sums], axis=1).astype(np.float32)

    def forward(self, gates: np.ndarray, mask: np.ndarray, keep: bool = False):
        """Logits from input projections (2, steps, windows, 3 HIDDEN) and mask (steps, windows)."""
        h, steps, n = HIDDEN, gates.shape[1], gates.shape[2]
        states = np.zeros((steps, n, 2 * h), np.float32)
        tape = {}
        for d in (0, 1):
            now = np.zeros((n, h), np.float32)
            for t in (range(steps) if d == 0 else range(steps - 1, -1, -1)):
                x, m = gates[d, t], mask[t][:, None]
                rec = now @ self.u[d]
                zr = _sigmoid(x[:, :2 * h] + rec[:, :2 * h])
                z, r = zr[:, :h], zr[:, h:]
                cand = np.tanh(x[:, 2 * h:] + r * rec[:, 2 * h:])
                new = now + m * (1 - z) * (cand - now)
                if keep:
                    tape[d, t] = (now, z, r, cand, rec[:, 2 * h:])
                now = new
                states[t, :, d * h:(d + 1) * h] = now
        hidden = np.tanh(states @ self.att)
        weight = hidden @ self.key + (mask - 1) * 1e4
        weight = np.exp(weight - weight.max(axis=0))
        weight /= weight.sum(axis=0)
        pooled = np.einsum("tn,tnk->nk", weight, states)
        logits = pooled @ self.out + self.bias[0]
        return (logits, states, hidden, weight, pooled, tape) if keep else logits

    def project(self, words: np.ndarray) -> np.ndarray:
        """(..., 2 EMBED) -> (2, ..., 3 HIDDEN)"""
        return np.stack([words @ self.w[d] + self.b[d] for d in (0, 1)])

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probabilities from :func:`features` of texts."""
        x = features @ self.calibration[:-1] + self.calibration[-1]
        return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def features(logits: np.ndarray) -> np.ndarray:
    """Largest and third largest window logit (the smallest, if fewer) and the log count of windows."""
    top = np.sort(logits)[::-1][:3]
    return np.array([top[0], top[-1], np.log(len(logits))], dtype=float)


def calibrate(x: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """Logistic regression (Newton steps, small ridge) with the classes weighted to ``prior``."""
    x = np.column_stack([x, np.ones(len(x))])
    side = np.where(y > 0, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    beta = np.zeros(x.shape[1])
    ridge = np.diag([0.02] * (x.shape[1] - 1) + [1e-6]) * len(x) * 0.05
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hess = (x * (side * p * (1 - p))[:, None]).T @ x + ridge
        beta = beta - np.clip(np.linalg.solve(hess, x.T @ (side * (p - y)) + ridge @ beta), -2, 2)
    return beta


def _sum_rows(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the rows of ``values`` with the same place; every place from 0 on occurs."""
    order = np.argsort(at, kind="stable")
    return np.add.reduceat(values[order], np.flatnonzero(np.diff(at[order], prepend=-1)), axis=0)


class Adagrad:
    def __init__(self, rate: float):
        self.rate, self.seen = rate, {}

    def dense(self, name: str, p: np.ndarray, g: np.ndarray) -> None:
        s = self.seen.setdefault(name, np.full(p.shape, 1e-6, np.float32))
        s += g * g
        p -= self.rate * g / np.sqrt(s)

    def rows(self, name: str, p: np.ndarray, at: np.ndarray, g: np.ndarray) -> None:
        s = self.seen.setdefault(name, np.full(p.shape, 1e-6, np.float32))
        places, inverse = np.unique(at, return_inverse=True)
        total = _sum_rows(g, inverse)
        s[places] += total * total
        p[places] -= self.rate * total / np.sqrt(s[places])


class Lexicon:
    """Word and n-gram buckets of the training words, by word number (0: no word)."""

    def __init__(self, windows: Iterable[list[str]]):
        self.number = {w: i for i, w in enumerate(dict.fromkeys(w for x in windows for w in x), 1)}
        word, grams, size = word_inputs(list(self.number)) if self.number else (np.zeros(0, np.int64),) * 3
        self.word, self.size = np.concatenate([[0], word]), np.concatenate([[1], size])
        self.at = np.cumsum(self.size) - self.size
        self.grams = np.concatenate([[0], grams])

    def matrix(self, windows: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(windows), WINDOW), np.int32)
        for row, window in zip(out, windows):
            row[:len(window)] = [self.number[w] for w in window]
        return out

    def inputs(self, net: Network) -> np.ndarray:
        grams = np.add.reduceat(net.gram[self.grams], self.at, axis=0) / np.sqrt(self.size)[:, None]
        return np.concatenate([net.word[self.word], grams], axis=1).astype(np.float32)


def _logits(net: Network, table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Logits of windows (n, WINDOW) of rows of ``table`` (words, 2, 3 HIDDEN); row 0 is no word."""
    out = np.empty(len(ids), np.float32)
    for at in range(0, len(ids), CHUNK):
        part = ids[at:at + CHUNK].T
        most = max(1, int((part > 0).any(axis=1).sum()))  # words come first in a window
        part = part[:most]
        gates = table[part].transpose(2, 0, 1, 3)
        out[at:at + CHUNK] = net.forward(gates, (part > 0).astype(np.float32))
    return out


def _step(net: Network, opt: Adagrad, lexicon: Lexicon, ids: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> None:
    """One gradient step on windows (n, WINDOW)."""
    h, part = HIDDEN, ids.T
    mask = (part > 0).astype(np.float32)
    used, inverse = np.unique(part, return_inverse=True)
    inverse = inverse.reshape(part.shape)
    size = lexicon.size[used]
    rows = np.repeat(np.arange(len(used)), size)
    flat = lexicon.grams[np.arange(len(rows)) + np.repeat(lexicon.at[used] - np.cumsum(size) + size, size)]
    spread = (1 / np.sqrt(size)).astype(np.float32)
    means = _sum_rows(net.gram[flat], rows)
    x = np.concatenate([net.word[lexicon.word[used]], means * spread[:, None]], axis=1)
    gates = net.project(x)[:, inverse]
    logits, states, hidden, weight, pooled, tape = net.forward(gates, mask, keep=True)
    d_logit = (weights * (_sigmoid(logits) - labels) / weights.sum()).astype(np.float32)
    d_out, d_bias = pooled.T @ d_logit, np.array([d_logit.sum()], np.float32)
    d_pooled = d_logit[:, None] * net.out
    d_states = weight[:, :, None] * d_pooled
    d_weight = np.einsum("tnk,nk->tn", states, d_pooled)
    d_key_in = weight * (d_weight - (weight * d_weight).sum(axis=0))
    d_hidden = d_key_in[:, :, None] * net.key * (1 - hidden * hidden)
    d_key = np.einsum("tn,tnk->k", d_key_in, hidden)
    d_att = np.einsum("tni,tnj->ij", states, d_hidden)
    d_states += d_hidden @ net.att.T
    d_gates, d_u = np.zeros_like(gates), np.zeros_like(net.u)
    for d in (0, 1):
        back = np.zeros((ids.shape[0], h), np.float32)
        for t in (range(WINDOW - 1, -1, -1) if d == 0 else range(WINDOW)):
            back = back + d_states[t, :, d * h:(d + 1) * h]
            before, z, r, cand, rec = tape[d, t]
            m = mask[t][:, None]
            d_cand = back * m * (1 - z) * (1 - cand * cand)
            d_z = back * m * (before - cand) * z * (1 - z)
            d_r = d_cand * rec * r * (1 - r)
            d_gates[d, t] = np.concatenate([d_z, d_r, d_cand], axis=1)
            d_rec = np.concatenate([d_z, d_r, d_cand * r], axis=1)
            d_u[d] += before.T @ d_rec
            back = back * (1 - m * (1 - z)) + d_rec @ net.u[d].T
    d_x = np.zeros_like(x)
    d_w, d_b = np.zeros_like(net.w), np.zeros_like(net.b)
    for d in (0, 1):
        by_word = _sum_rows(d_gates[d].reshape(-1, 3 * h), inverse.ravel())
        d_w[d], d_b[d] = x.T @ by_word, by_word.sum(axis=0)
        d_x += by_word @ net.w[d].T
    for name, g in (("out", d_out), ("bias", d_bias), ("key", d_key), ("att", d_att), ("u", d_u), ("w", d_w), ("b", d_b)):
        opt.dense(name, getattr(net, name), g)
    opt.rows("word", net.word, lexicon.word[used], d_x[:, :EMBED])
    opt.rows("gram", net.gram, flat, (d_x[:, EMBED:] * spread[:, None])[rows])


def fit(texts: list[str], labels: list[int], prior: float = 0.5, seed: int = 11, spread_rounds: int = 3, rounds: int = 8,
        batch: int = 256) -> Network | None:
    """Train on texts given as words between spaces; a fifth is held back to calibrate to the share
    ``prior`` of toxic texts."""
    y = np.array(labels, dtype=np.float32)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    net, opt = Network.fresh(rng), Adagrad(0.05)
    lexicon = Lexicon(t.split() for t in texts)
    parts, first_word, size = [], [], 0  # word numbers of each text, filled up to its last window
    for text in texts:
        words = [lexicon.number[w] for w in text.split()]
        at = starts(len(words))
        parts.append(np.zeros(at[-1] + WINDOW, np.int32))
        parts[-1][:len(words)] = words
        first_word.append(np.array(at) + size)
        size += len(parts[-1])
    flat, count = np.concatenate(parts), np.array([len(x) for x in first_word])
    owner, first_word = np.repeat(np.arange(len(texts)), count), np.concatenate(first_word)

    def ids(chosen: np.ndarray) -> np.ndarray:
        return flat[first_word[chosen][:, None] + np.arange(WINDOW)]

    held = rng.random(len(texts)) < 0.2
    if len(set(y[~held])) < 2 or len(set(y[held])) < 2:
        held[:] = False
    train_windows = np.flatnonzero(~held[owner])
    balance = np.where(y > 0, 0.5 / y[~held].mean(), 0.5 / (1 - y[~held].mean())).astype(np.float32)

    def passes(chosen: np.ndarray, weights: np.ndarray) -> None:
        chosen = rng.permutation(chosen)
        for at in range(0, len(chosen), batch):
            part = chosen[at:at + batch]
            _step(net, opt, lexicon, ids(part), y[owner[part]], weights[owner[part]])

    def by_text() -> tuple[np.ndarray, np.ndarray]:
        table = net.project(lexicon.inputs(net)).transpose(1, 0, 2)
        found = np.concatenate([_logits(net, table, ids(np.arange(at, min(at + CHUNK, len(owner)))))
                                for at in range(0, len(owner), CHUNK)])
        order = np.lexsort((-found, owner))
        first = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]
        return found, first  # first: the window with the largest logit of each text

    for _ in range(spread_rounds):
        passes(train_windows, balance / count)
    for _ in range(rounds):
        _, first = by_text()
        also = rng.choice(train_windows[y[owner[train_windows]] == 0],
                          min(int((y[owner[train_windows]] == 0).sum()), 2 * len(texts)), replace=False)
        passes(np.concatenate([first[~held], also]), balance)
    found, _ = by_text()
    x = np.array([features(part) for part in np.split(found, np.flatnonzero(np.diff(owner)) + 1)])
    use = held if held.any() else ~held
    net.calibration = calibrate(x[use], y[use], prior)
    return net


def _words(docs: DataFrame) -> DataFrame:
    """(label, text) -> (label, words): all words of each text with spaces between."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [" ".join(WORDS.findall(text.lower())) for text in as_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["label", "words"])
    return docs.mapInArrow(run, "label int, words string")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          learn: Column | None = None, max_rows: int = 3200) -> Network | None:
    """Fit on at most ``max_rows`` / 2 labelled rows of either class."""
    bound_batches(docs.sparkSession)
    marks = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.when(F.col(label_col) == 1, 1).otherwise(0)).alias("label"))
    if learn is not None:
        marks = marks.withColumnRenamed("id", id_col).where(learn).withColumnRenamed(id_col, "id")
    counts = {r[0]: r[1] for r in marks.groupBy("label").count().collect()}
    if set(counts) != {0, 1}:
        return None
    share = max_rows // 2
    place = F.xxhash64("id")
    part = F.when(F.col("label") == 1, min(1.0, 2 * share / counts[1])).otherwise(min(1.0, 2 * share / counts[0]))
    chosen = (marks.where(F.pmod(place, F.lit(1 << 20)) < part * (1 << 20))
              .withColumn("n", F.row_number().over(Window.partitionBy("label").orderBy(place, "id")))
              .where(F.col("n") <= share).select("id", "label"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = _words(texts.join(F.broadcast(chosen), "id")  # at most max_rows ids
                    .groupBy("id", "label").agg(F.min("text").alias("text")).select("label", "text")).collect()
    rows = sorted(rows, key=lambda r: (r.label, r.words))
    return fit([r.words for r in rows], [r.label for r in rows],
               counts[1] / (counts[0] + counts[1]))


class Scorer:
    """Scores texts; keeps the input projections of up to CACHE_WORDS distinct words."""

    def __init__(self, net: Network):
        self.net = net
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.table = np.zeros((4096, 2, 3 * HIDDEN), np.float32)

    def _learn(self, words: list[str]) -> None:
        first = len(self.number) + 1
        while first + len(words) > len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[first:first + len(words)] = self.net.project(self.net.inputs(words)).transpose(1, 0, 2)
        self.number.update(zip(words, range(first, first + len(words))))

    def _windows(self, parts: list[list[str]]) -> list[np.ndarray]:
        if len(self.number) > CACHE_WORDS:
            self.clear()
        known = self.number
        if new := [w for w in dict.fromkeys(w for part in parts for w in part) if w not in known]:
            self._learn(new)
        out = []
        for words in parts:
            flat = np.zeros(starts(len(words))[-1] + WINDOW, np.int32)
            flat[:len(words)] = [known[w] for w in words]
            out.append(np.lib.stride_tricks.sliding_window_view(flat, WINDOW)[::STRIDE])
        return out

    def features(self, texts: list[str]) -> np.ndarray:
        """The features of each text over all its windows."""
        top, count = [np.empty(0)] * len(texts), np.zeros(len(texts))
        parts: list[list[str]] = []
        owner: list[int] = []

        def flush() -> None:
            windows = self._windows(parts)
            found = _logits(self.net, self.table, np.concatenate(windows))
            for i, part in zip(owner, np.split(found, np.cumsum([len(w) for w in windows])[:-1])):
                top[i] = np.sort(np.concatenate([top[i], part]))[::-1][:3]
                count[i] += len(part)
            parts.clear()
            owner.clear()

        waiting = 0
        for i, text in enumerate(texts):
            words = WORDS.findall(text.lower())
            for at in range(0, max(1, len(words)), PART):  # very long texts in parts
                part = words[at:at + PART + WINDOW - STRIDE]
                if at and len(part) <= WINDOW - STRIDE:
                    break
                parts.append(part)
                owner.append(i)
                waiting += len(part)
                if waiting > PART:
                    flush()
                    waiting = 0
        if parts:
            flush()
        return np.array([[t[0], t[-1], np.log(n)] for t, n in zip(top, count)]).reshape(len(texts), 3)


def score(docs: DataFrame, net: Network | None, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted of every whole text."""
    spark = docs.sparkSession
    bound_batches(spark)
    shipped = spark.sparkContext.broadcast(net)  # a fixed number of weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shipped.value
        scorer = Scorer(net) if net else None
        for batch in batches:
            texts = as_texts(batch.column(1))
            found = net.score(scorer.features(texts)) if net else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, predicted int")
