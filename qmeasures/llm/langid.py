"""Operator 10: language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its hashed subwords (each word with its
character 2- to 4-grams between word-boundary marks); a linear softmax reads it.
Embeddings and softmax are trained together by stochastic gradient descent in numpy on
a bounded, hash-ordered set of labelled rows (``max_rows``, shared evenly between the
languages); their subword counts are gathered on the executors.  A temperature fitted
on a part held back from training calibrates the probability.

A softmax can't be low for every language, so rejection rests on other evidence: the mean
log frequency of a text's subwords in the language found (the smoothed mean shares of all its
labelled texts, equal ones once).  Each labelled text gets it from the texts outside its own of
five folds, to which texts are dealt by hash.  Its distance from the language's median, over the
spread expected at its length, is the text's fit; texts that fit worse than ``reject_slack`` times
the lowest ``reject_quantile`` of the labelled texts are rejected.  A language whose texts are all
in one fold has no such evidence, and its texts are not rejected.

Average and softmax are both linear before the exponent, so the product of embedding
and softmax matrix is one small score table per subword; tasks add up the scores of
whole texts over the distinct words of bounded groups of texts, told apart by 64-bit hashes.

Defined results: a null text or one without any letter is ``und`` with score 0 and
rejected; without a labelled row every text is ``und`` with score 0; ties go to the
language first in sort order; repeated rows each give a row; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qmeasures.llm.common import as_texts, bound_batches, materialize

LETTER = regex.compile(r"\p{L}")
WORDS = regex.compile(r"\p{L}+")
NO_LETTER = regex.compile(r"\P{L}")
GROUP_CHARS = 1 << 21  # characters that are split into words together
GRAMS = (2, 3, 4)
FOLDS = 5
BLOCK = 1024  # buckets whose shares are added up together


def subwords(word: str, buckets: int) -> list[int]:
    """Hash buckets of the word and of its 2- to 4-grams with boundary marks."""
    marked = f"<{word}>"
    grams = [marked]
    for n in GRAMS:
        grams += [marked[i:i + n] for i in range(len(marked) - n + 1)]
    return [zlib.crc32(g.encode()) % buckets for g in grams]


@dataclass
class LanguageModel:
    langs: list[str]
    scores: np.ndarray  # (buckets, languages): embedding times softmax weights
    bias: np.ndarray
    temperature: float
    evidence: np.ndarray  # (buckets, languages): log frequencies
    typical: np.ndarray   # median evidence of each language; -inf without any
    spread: np.ndarray    # variance of the evidence between texts, and that of one subword
    reject_below: float   # lowest fit

    def probabilities(self, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return _softmax((sums / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature)

    def fit(self, sums: np.ndarray, counts: np.ndarray, lang: np.ndarray) -> np.ndarray:
        """Distance of the evidence (sums over subwords, by language) from what is typical of ``lang``."""
        n = np.maximum(counts, 1)
        found = sums[np.arange(len(lang)), lang] / n
        return (found - self.typical[lang]) / np.sqrt(self.spread[0] + self.spread[1] / n)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    out = np.zeros(0x110000, dtype=bool)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out[[ord(c) for c in LETTER.findall(every)]] = True
    return out


@lru_cache(maxsize=1)
def _crc_steps() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... (sizes[i] of them) for each i."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)


def _subwords_of(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`subwords` of many words: how many each has, and all of them."""
    marked = [f"<{w}>" for w in words]
    points = _points("".join(marked)).astype(np.int64)
    sizes = np.array([len(w) for w in marked], dtype=np.int64)
    # UTF-8 bytes of each code point
    wide = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])
    steps = _crc_steps()

    def add(state: np.ndarray, at: np.ndarray) -> np.ndarray:
        c, w = points[at], wide[at]
        byte = (lead[w] | (c >> 6 * (w - 1))).astype(np.uint32)
        state = steps[(state ^ byte) & np.uint32(255)] ^ (state >> np.uint32(8))
        for k in (2, 3, 4):  # bytes after the first
            more = np.flatnonzero(w >= k)
            if len(more):
                byte = (0x80 | ((c[more] >> 6 * (w[more] - k)) & 0x3F)).astype(np.uint32)
                state[more] = steps[(state[more] ^ byte) & np.uint32(255)] ^ (state[more] >> np.uint32(8))
        return state

    ends = np.cumsum(sizes)
    counts = 1 + sum(np.maximum(sizes - n + 1, 0) for n in GRAMS)
    out, place = np.empty(counts.sum(), dtype=np.int64), np.cumsum(counts) - counts

    def bucket(state: np.ndarray) -> np.ndarray:
        return (state ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)
    # whole words: a step for each of their first characters, long ones by themselves
    own, state = np.flatnonzero(sizes <= 24), np.full(len(words), 0xFFFFFFFF, dtype=np.uint32)
    for k in range(24):
        own = own[sizes[own] > k]
        state[own] = add(state[own], ends[own] - sizes[own] + k)
    out[place] = bucket(state)
    for i in np.flatnonzero(sizes > 24):
        out[place[i]] = zlib.crc32(marked[i].encode()) % buckets
    place += 1
    state, at = np.full(len(points), 0xFFFFFFFF, dtype=np.uint32), np.arange(len(points))
    last = np.repeat(ends, sizes)
    for n in range(1, max(GRAMS) + 1):
        inside = np.flatnonzero(at + n <= last)
        at, state, last = at[inside], state[inside], last[inside]
        state = add(state, at + n - 1)
        if n in GRAMS:
            found = np.maximum(sizes - n + 1, 0)
            out[_ranges(place, found)] = bucket(state)
            place += found
    return counts, out


@dataclass
class Split:
    """Words of some texts."""

    texts: np.ndarray   # place of the text of each word, rising
    words: np.ndarray   # number of each word
    sizes: np.ndarray   # subwords of each distinct word
    starts: np.ndarray  # their first places
    found: np.ndarray   # subwords of all distinct words


def _cuts(text: str, most: int) -> Iterator[str]:
    """Parts of a long text, cut where no word is."""
    at = 0
    while len(text) - at > most:
        cut = NO_LETTER.search(text, at + most)
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end
    yield text[at:]


def split(texts: list[str], buckets: int, most: int = GROUP_CHARS) -> Iterator[Split]:
    """The words of the texts in bounded groups; a long text comes in several."""
    held: list[tuple[int, str]] = []
    size = 0
    for i, text in enumerate(texts):
        for part in _cuts(text.lower(), most):
            if held and size + len(part) > most:
                yield _split(held, buckets)
                held, size = [], 0
            held.append((i, part))
            size += len(part) + 1
    if held:
        yield _split(held, buckets)


def _split(parts: list[tuple[int, str]], buckets: int) -> Split:
    whole = "\n".join(x for _, x in parts) + "\n"
    points = _points(whole)
    letter = _letters()[points]
    edges = np.flatnonzero(np.diff(letter, prepend=False))
    starts, ends = edges[::2], edges[1::2]
    sizes = ends - starts
    if not len(starts):
        none = np.zeros(0, dtype=np.int64)
        return Split(none, none, none, none, none)
    weight = _mixed(np.arange(sizes.max(), dtype=np.uint64)) | np.uint64(1)
    place = _ranges(np.zeros_like(sizes), sizes)
    hashes = np.add.reduceat(_mixed(points[letter].astype(np.uint64)) * weight[place], np.cumsum(sizes) - sizes)
    _, first, words = np.unique(hashes ^ (sizes.astype(np.uint64) << np.uint64(32)), return_index=True, return_inverse=True)
    counts, found = _subwords_of([whole[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())], buckets)
    after = np.cumsum([len(x) + 1 for _, x in parts])
    owner = np.array([i for i, _ in parts])[np.searchsorted(after, starts, side="right")]
    return Split(owner, words, counts, np.cumsum(counts) - counts, found)


def _by_text(s: Split, values: np.ndarray, out: np.ndarray) -> None:
    """Adds the values of words to their texts' rows of ``out``."""
    if len(s.texts):
        firsts = np.flatnonzero(np.diff(s.texts, prepend=-1))
        out[s.texts[firsts]] += np.add.reduceat(values, firsts, axis=0)


def sums(texts: list[str], table: np.ndarray) -> np.ndarray:
    """Sum of the table's rows over each text's subwords, and how many those are."""
    width = table.shape[1]
    out, room = np.zeros((len(texts), width + 1)), max(1, (1 << 23) // width)
    for s in split(texts, len(table), max(1 << 14, min(GROUP_CHARS, (1 << 25) // width))):
        rows = np.empty((len(s.sizes), width + 1))
        rows[:, -1] = s.sizes
        groups = np.searchsorted(s.starts, np.arange(0, len(s.found), room)) if len(s.found) else []
        for a, b in zip(groups, [*groups[1:], len(s.sizes)]):
            if a < b:
                part = s.found[s.starts[a]:s.starts[b - 1] + s.sizes[b - 1]]
                rows[a:b, :-1] = np.add.reduceat(table.take(part, axis=0), s.starts[a:b] - s.starts[a], axis=0, dtype=float)
        _by_text(s, rows.take(s.words, axis=0), out)
    return out


def _features(docs: DataFrame, buckets: int) -> DataFrame:
    """Labelled rows -> (lang, bucket list, share list, subwords), the shares of a text adding up to 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, shares, sizes = [], [], []
            for text in as_texts(batch.column(1)):
                cache: dict[str, list[int]] = {}
                found: list[int] = []
                for w in WORDS.findall(text.lower()):
                    if w not in cache:
                        cache[w] = subwords(w, buckets)
                    found += cache[w]
                at, n = np.unique(np.array(found, dtype=np.int32), return_counts=True)
                places.append(at)
                shares.append((n / max(1, n.sum())).astype(np.float32))
                sizes.append(len(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(places, pa.list_(pa.int32())), pa.array(shares, pa.list_(pa.float32())),
                 pa.array(sizes, pa.int64())], names=["lang", "at", "share", "n"])
    return docs.mapInArrow(run, "lang string, at array<int>, share array<float>, n long")


def _averages(part: list, emb: np.ndarray) -> np.ndarray:
    return np.stack([share @ emb[at] for at, share, *_ in part])


def _softmax(logits: np.ndarray) -> np.ndarray:
    p = np.exp(logits - logits.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _log_frequency(shares: np.ndarray, texts: int, unseen: float) -> np.ndarray:
    return np.log((1 - unseen) * shares / max(1, texts) + unseen / len(shares))


def _pairs(s: Split, kinds: np.ndarray) -> tuple[np.ndarray, Iterator[tuple]]:
    """Distinct (kind of text, word): which of them each word is, and by kind (kind, first and last of them, their subwords)."""
    pairs, which = np.unique(kinds[s.texts] * np.int64(len(s.sizes)) + s.words, return_inverse=True)
    word, kind = pairs % max(1, len(s.sizes)), pairs // max(1, len(s.sizes))

    def each() -> Iterator[tuple]:
        for k in np.unique(kind):
            a, b = np.searchsorted(kind, [k, k + 1])
            sizes = s.sizes[word[a:b]]
            yield int(k), a, b, sizes, s.found[_ranges(s.starts[word[a:b]], sizes)]
    return which, each()


def _sizes(texts: list[str], buckets: int) -> tuple[list[Split], np.ndarray]:
    """The split texts and their numbers of subwords."""
    n, groups = np.zeros(len(texts)), list(split(texts, buckets))
    for s in groups:
        _by_text(s, s.sizes[s.words].astype(float), n)
    return groups, n


def _in_slices(batch: pa.RecordBatch, column: int, most: int = GROUP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of bounded slices of a batch."""
    texts, at, size = as_texts(batch.column(column)), 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, texts[at:i]
            at, size = i, 0
        size += len(t) + 1
    yield at, texts[at:]


def _shares(texts: DataFrame, langs: list[str], buckets: int) -> np.ndarray:
    """(languages, FOLDS, buckets + 1) from (lang, fold, text): shares of the subwords added up over texts, and the texts."""
    kind_of = {lang: i * FOLDS for i, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for k, row in total.items():
                blocks = [row[a:a + BLOCK] for a in range(0, len(row), BLOCK)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(blocks), pa.int32()), pa.array(range(len(blocks)), pa.int32()),
                     pa.array(blocks, pa.list_(pa.float32()))], names=["kind", "block", "shares"])
            total.clear()
        for batch in batches:
            kinds = np.array([kind_of[x] for x in batch.column(0).to_pylist()], dtype=np.int64) + batch.column(1).to_numpy()
            for at, texts in _in_slices(batch, 2):
                own = kinds[at:at + len(texts)]
                for k, m in zip(*np.unique(own, return_counts=True)):
                    total.setdefault(int(k), np.zeros(buckets + 1))[-1] += m
                groups, n = _sizes(texts, buckets)
                for s in groups:
                    which, each = _pairs(s, own)
                    weight = np.bincount(which, weights=1 / n[s.texts])
                    for k, a, b, sizes, found in each:
                        total[k][:-1] += np.bincount(found, weights=np.repeat(weight[a:b], sizes), minlength=buckets)
                if len(total) > 256:
                    yield from flush()
        yield from flush()

    def add(key: tuple, parts: pa.Table) -> pa.Table:
        added = np.sum([np.asarray(x, dtype=float) for x in parts["shares"].to_pylist()], axis=0)
        return pa.table({"kind": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([key[1].as_py()], pa.int32()),
                         "shares": pa.array([added], pa.list_(pa.float64()))})
    out = np.zeros((len(langs) * FOLDS, buckets + 1))
    got = (texts.mapInArrow(run, "kind int, block int, shares array<float>").groupBy("kind", "block")
           .applyInArrow(add, "kind int, block int, shares array<double>").toArrow())
    for k, block, shares in zip(got["kind"].to_pylist(), got["block"].to_pylist(), got["shares"]):
        out[k, block * BLOCK:block * BLOCK + len(shares)] = shares.values.to_numpy()
    return out.reshape(len(langs), FOLDS, buckets + 1)


def _held_out(rows: DataFrame, langs: list[str], shares: np.ndarray, unseen: float) -> DataFrame:
    """(lang, found, n) of each different labelled text: mean log frequency of its subwords by the other folds, and their number."""
    spark, buckets = rows.sparkSession, shares.shape[2] - 1
    other = shares.sum(axis=1, keepdims=True) - shares
    logs = np.stack([_log_frequency(x[:-1], x[-1], unseen).astype(np.float32) for x in other.reshape(-1, buckets + 1)])
    shipped = spark.sparkContext.broadcast((logs, other[:, :, -1].reshape(-1) > 0.5))
    kind_of = {lang: i * FOLDS for i, lang in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, known = shipped.value
        for batch in batches:
            kinds = np.array([kind_of[x] for x in batch.column(0).to_pylist()], dtype=np.int64) + batch.column(1).to_numpy()
            means, sizes = np.zeros(len(kinds)), np.zeros(len(kinds))
            for at, texts in _in_slices(batch, 2):
                own, (groups, n) = kinds[at:at + len(texts)], _sizes(texts, buckets)
                total = np.zeros(len(texts))
                for s in groups:
                    which, each = _pairs(s, own)
                    value = np.zeros(which.max() + 1 if len(which) else 0)
                    for k, a, b, counts, found in each:
                        value[a:b] = np.add.reduceat(logs[k].take(found), np.cumsum(counts) - counts, dtype=float)
                    _by_text(s, value[which], total)
                means[at:at + len(texts)], sizes[at:at + len(texts)] = total / np.maximum(n, 1), n
            there = pa.array(known[kinds])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), batch.column(4), pa.array(means), pa.array(sizes)],
                                             names=["lang", "h", "g", "found", "n"]).filter(there)
    found = rows.select("lang", "fold", "text", F.xxhash64("text").alias("h"), F.hash("text").alias("g")).mapInArrow(
        run, "lang string, h long, g int, found double, n double")
    return found.dropDuplicates(["lang", "h", "g"]).select("lang", "found", "n")


def _evidence(rows: DataFrame, langs: list[str], buckets: int, quantile: float, slack: float,
              unseen: float = 0.05) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Log frequencies, typical evidence, spread and lowest fit over all labelled rows (lang, text); see :class:`LanguageModel`."""
    rows = rows.withColumn("fold", (F.crc32("text") % FOLDS).cast("int"))
    # equal texts count once; their copies meet in a shuffle of the texts
    shares = _shares(rows.dropDuplicates(["lang", "text"]).select("lang", "fold", "text"), langs, buckets)
    whole = shares.sum(axis=1)
    table = np.stack([_log_frequency(x[:-1], x[-1], unseen) for x in whole], axis=1).astype(np.float32)
    held = materialize(_held_out(rows, langs, shares, unseen))
    medians = {r["lang"]: r["m"] for r in held.groupBy("lang").agg(F.percentile_approx("found", 0.5, 100_000).alias("m")).collect()}
    typical = np.array([medians.get(lang, -np.inf) for lang in langs])
    if not medians:
        return table, typical, np.ones(2), -np.inf
    spark = rows.sparkSession
    away = held.join(F.broadcast(spark.createDataFrame(list(medians.items()), "lang string, m double")), "lang").select(
        (F.col("found") - F.col("m")).alias("d"), (1 / F.col("n")).alias("x"))
    # least squares of d * d on 1 and 1 / n
    a = away.agg(F.count(F.lit(1)), F.sum("x"), F.sum(F.col("x") * F.col("x")), F.sum(F.col("d") * F.col("d")),
                 F.sum(F.col("d") * F.col("d") * F.col("x"))).first()
    spread = np.maximum(np.linalg.lstsq(np.array([[a[0], a[1]], [a[1], a[2]]], dtype=float), np.array([a[3], a[4]]), rcond=None)[0], 1e-3)
    fit = F.col("d") / F.sqrt(float(spread[0]) + float(spread[1]) * F.col("x"))
    lowest = away.agg(F.percentile_approx(fit, quantile, 100_000)).first()[0]
    return table, typical, spread, slack * min(-1.0, float(lowest))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", learn: Column | None = None,
          max_rows: int = 1200, buckets: int = 1 << 14, dim: int = 16, steps: int = 500, rate: float = 20.0,
          reject_quantile: float = 0.0005, reject_slack: float = 1.5, max_langs: int = 512, seed: int = 7) -> LanguageModel:
    """Fit on at most ``max_rows`` labelled rows, the first by hash of each language; evidence is of all labelled rows.

    ``learn`` marks the rows that may be learnt from.
    """
    bound_batches(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    if learn is not None:
        rows = rows.where(learn)
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(max_langs + 1).collect()}
    if len(counts) > max_langs:
        raise ValueError(f"more than {max_langs} languages are labelled")
    langs = sorted(counts)
    if not langs:
        return LanguageModel([], np.zeros((1, 0)), np.zeros(0), 1.0, np.zeros((1, 0)), np.zeros(0), np.ones(2), 0.0)
    # twice the wanted share by hash first, so that what is ordered doesn't grow with the corpus
    share = max(1, max_rows // len(langs))
    part = F.create_map(*[F.lit(x) for lang in langs for x in (lang, min(1.0, 2 * share / counts[lang]))])
    place = F.xxhash64("text")
    sample = (rows.where(F.pmod(place, F.lit(1 << 20)) < part[F.col("lang")] * (1 << 20)).dropDuplicates(["lang", "text"])
              .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(place, "text")))
              .where(F.col("n") <= share).select("lang", "text"))
    got = _features(sample, buckets).collect()
    rng = np.random.default_rng(seed)
    data = [(np.array(r.at), np.array(r.share), langs.index(r.lang), r.n) for r in got if r.at]
    order = rng.permutation(len(data))
    held = [data[i] for i in order[: len(data) // 5]]
    fit = [data[i] for i in order[len(data) // 5:]]
    emb, out, bias = rng.normal(0, 0.3, (buckets, dim)), rng.normal(0, 0.3, (dim, len(langs))), np.zeros(len(langs))
    for turn in range(steps if fit else 0):
        pace = 1 - turn / steps
        part = [fit[i] for i in rng.integers(0, len(fit), 16)]
        text = _averages(part, emb)
        p = _softmax(text @ out + bias)
        p[np.arange(len(part)), [x[2] for x in part]] -= 1
        p /= len(part)
        back = p @ out.T
        out -= rate * pace * (text.T @ p)
        bias -= 0.1 * pace * p.sum(axis=0)
        for (at, share, *_), toward in zip(part, back):
            emb[at] -= rate * pace * share[:, None] * toward
    temperature = 1.0
    if held:
        logits = _averages(held, emb) @ out + bias
        truth = np.array([x[2] for x in held])

        def loss(t: float) -> float:
            return -float(np.mean(np.log(_softmax(logits / t)[np.arange(len(held)), truth] + 1e-300)))
        temperature = min(np.geomspace(0.2, 5, 60), key=loss)
    return LanguageModel(langs, (emb @ out).astype(np.float32), bias, float(temperature),
                         *_evidence(rows, langs, buckets, reject_quantile, reject_slack))


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The ``keep`` columns with lang_pred, score (calibrated) and rejected of every whole text."""
    spark = docs.sparkSession
    bound_batches(spark)
    keep = docs.columns if keep is None else keep
    place = keep.index(text_col) if text_col in keep else len(keep)
    shipped = spark.sparkContext.broadcast(model)  # buckets x languages numbers, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        table = np.concatenate([model.scores, model.evidence], axis=1)
        for batch in batches:
            texts = as_texts(batch.column(place))
            found = sums(texts, table) if model.langs else np.zeros((len(texts), 1))
            lettered = np.array([bool(model.langs) and bool(LETTER.search(t)) for t in texts], dtype=bool)
            names, score = np.full(len(texts), "und", dtype=object), np.zeros(len(texts))
            rejected = ~lettered
            if model.langs:
                wide = len(model.langs)
                p = model.probabilities(found[:, :wide], found[:, -1])
                best = p.argmax(axis=1)
                names[lettered] = np.array(model.langs, dtype=object)[best[lettered]]
                score[lettered] = p.max(axis=1)[lettered]
                rejected |= model.fit(found[:, wide:-1], found[:, -1], best) < model.reject_below
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)], pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                names=[*keep, "lang_pred", "score", "rejected"])

    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")
    text = [] if text_col in keep else [F.col(text_col).cast("string")]
    return docs.select(*keep, *text).mapInArrow(run, schema)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             learn: Column | None = None, **training) -> DataFrame:
    """doc_id, lang_pred, score, rejected per document; see :func:`train` for the rest."""
    model = train(docs, text_col, lang_col, learn, **training)
    return predict(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, "text", ["doc_id"])
