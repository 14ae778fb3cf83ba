"""Operator 5: quality by an interpolated modified Kneser-Ney n-gram model of trusted text.

Every code point is a symbol of its own; texts have boundary symbols around them.  Counts of
4-symbol windows of trusted text are kept as a Spark table, sharded by window.  Aggregations
over it give the lower orders' continuation counts, the discounts of each order from its
counts of counts, and each context's total and weights; joins of the count tables on context
and on shorter window give every seen window's interpolated probability.

A window is written as (context, last): the symbols before the last one, ``BITS`` bits each,
and the last one.  Up to ``MOST_SHIPPED`` seen windows the finished tables go to the tasks,
which look the windows of whole texts up in them; beyond that the texts' windows, counted
within each text, are joined with the tables.  Thresholds are
quantiles of the trusted texts of each language (few trusted texts: of all), widened by a
margin; short texts are drawn towards their language's mean, since their averages say
little.

Windows are counted over every trusted text, scores cover all documents and quantiles all
trusted ones.

Defined results: a null or empty text is scored as the empty one and, like any other,
kept unless its shrunk score falls outside; without trusted text everything is kept with
a perplexity of SYMBOLS; a null language is a language of its own; a document with
several labels is trusted if none is below 1; repeated rows each give a row; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qmeasures.llm.common import as_texts, bound_batches, materialize

ORDER = 4
SYMBOLS = 0x110000 + 1  # every code point, and the text boundary
BITS = 21               # hold a symbol
MOST_SHIPPED = 4_000_000  # seen windows that a task holds, about 25 bytes each
_CHUNK = 1 << 18


def symbol_table() -> np.ndarray:
    """Symbol of each code point; 0 is the text boundary."""
    return np.arange(1, SYMBOLS, dtype=np.int32)


def _line(texts: list[str]) -> np.ndarray:
    """Symbols of the texts, one after the other."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), dtype=np.uint32)
    return points.astype(np.int64) + 1  # symbol_table()[points]


def _coded(line: np.ndarray) -> np.ndarray:
    """(context, last) of the windows that end at each symbol but the first ORDER - 1."""
    out = np.empty((2, len(line) - ORDER + 1), dtype=np.int64)
    context = out[0]
    context[:] = line[:len(context)]
    for k in range(1, ORDER - 1):
        context <<= BITS
        context |= line[k:k + len(context)]
    out[1] = line[ORDER - 1:]
    return out.T


def windows(text: str) -> Iterator[np.ndarray]:
    """(context, last) of the windows that end at each symbol and at the closing boundary, in bounded parts."""
    before = np.zeros(ORDER - 1, dtype=np.int64)
    for at in range(0, len(text) + 1, _CHUNK):
        closing = np.zeros(int(at + _CHUNK > len(text)), dtype=np.int64)
        line = np.concatenate([before, _line([text[at:at + _CHUNK]]), closing])
        before = line[-(ORDER - 1):]
        yield _coded(line)


def _grouped(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of texts, the first window of each, their windows, in bounded parts; a long text comes in several."""
    at = 0
    while at < len(texts):
        if len(texts[at]) >= _CHUNK:
            for part in windows(texts[at]):
                yield np.array([at]), np.zeros(1, dtype=np.int64), part
            at += 1
            continue
        end, size = at, 0
        while end < len(texts) and size + len(texts[end]) < _CHUNK:
            size += len(texts[end]) + 1
            end += 1
        sizes = np.array([len(t) for t in texts[at:end]])
        gaps = np.arange(len(sizes)) * ORDER + ORDER - 1  # boundary symbols before each text
        line = np.zeros(sizes.sum() + len(sizes) * ORDER, dtype=np.int64)
        line[np.arange(sizes.sum()) + np.repeat(gaps, sizes)] = _line(texts[at:end])
        starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        own = np.arange(sizes.sum() + len(sizes)) + np.repeat(gaps - (ORDER - 1) - np.arange(len(sizes)), sizes + 1)
        yield np.arange(at, end), starts, _coded(line).T[:, own].T  # columns stay contiguous
        at = end


def _tally(found: list[pa.Table]) -> pa.Table:
    """(context, last, n) of the distinct windows, their counts added up."""
    got = pa.concat_tables(found).group_by(["context", "last"], use_threads=False).aggregate([("n", "sum")])
    return pa.table({"context": got["context"], "last": got["last"], "n": got["n_sum"]})


def _once(part: np.ndarray) -> pa.Table:
    return _tally([pa.table({"context": part[:, 0], "last": part[:, 1], "n": np.ones(len(part), dtype=np.int64)})])


def count_windows(texts: DataFrame) -> DataFrame:
    """(text) -> (context, last, n): counts are added up in each task before they are shuffled."""
    most = 2_000_000  # windows held in a task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, _, part in _grouped(as_texts(batch.column(0))):
                held.append(_once(part))
                size += len(held[-1])
                if size > most:
                    held = [_tally(held)]
                    size = len(held[0])
                    if size > most // 2:
                        yield from held[0].to_batches(100_000)
                        held, size = [], 0
        if held:
            yield from _tally(held).combine_chunks().to_batches(100_000)
    return (texts.select("text").mapInArrow(run, "context long, last long, n long")
            .groupBy("context", "last").agg(F.sum("n").alias("n")))


def discounts(table: DataFrame) -> list[float]:
    """D1, D2, D3+ from the counts of counts; a missing count of counts falls back to 0.5 per step."""
    row = table.agg(*[F.sum(F.when(F.col("n") == k, 1).otherwise(0)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()
    n1, n2, n3, n4 = (float(x or 0) for x in row)
    if not (n1 and n2):
        return [0.5, 0.5, 0.5]
    y = n1 / (n1 + 2 * n2)
    raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2 - 3 * y * n3 / n2]
    return [min(max(d, 0.01), k - 0.01) for k, d in zip((1, 2, 3), raw)]


def _shorter(order: int) -> int:
    """Mask of the context of a window of ``order`` symbols."""
    return (1 << BITS * (order - 1)) - 1


def probabilities(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order 1..ORDER: (context, last, p) of seen windows and (context, rest): the weight left to the order below."""
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):  # how many symbols stand before a window
        context = F.col("context").bitwiseAND(F.lit(_shorter(order)))
        tables[order] = materialize(tables[order + 1].groupBy(context.alias("context"), "last").agg(F.count(F.lit(1)).alias("n")))
    out: list[tuple[DataFrame, DataFrame]] = []
    below = None
    for order in range(1, ORDER + 1):
        d = discounts(tables[order])
        taken = F.when(F.col("n") == 1, d[0]).when(F.col("n") == 2, d[1]).otherwise(d[2])
        rows = tables[order].select("context", "last", "n", taken.alias("taken"))
        contexts = materialize(rows.groupBy("context").agg(F.sum("n").alias("total"), F.sum("taken").alias("taken_all"))
                               .select("context", "total", (F.col("taken_all") / F.col("total")).alias("rest")))
        joined = rows.join(contexts, "context")
        if below is None:
            lower = F.lit(1.0 / SYMBOLS)
        else:
            short = F.col("context").bitwiseAND(F.lit(_shorter(order - 1)))
            joined = joined.withColumn("short", short).join(
                below.withColumnsRenamed({"context": "short", "p": "lower"}), ["short", "last"])
            lower = F.col("lower")
        below = materialize(joined.select(
            "context", "last", ((F.col("n") - F.col("taken")) / F.col("total") + F.col("rest") * lower).alias("p")))
        out.append((below, contexts.select("context", "rest")))
    return out


class Lookup:
    """Values by (context, last): sorted by a hash, whose first places are held."""

    def __init__(self, context: np.ndarray, last: np.ndarray, value: np.ndarray):
        bits = max(1, int(2 * len(context)).bit_length())
        self.shift = np.uint64(64 - bits)
        h = self._hash(context, last)
        order = np.argsort(h, kind="stable")
        self.context, self.last, self.value = context[order], last[order].astype(np.int32), value[order].astype(np.float32)
        self.first = np.zeros((1 << bits) + 1, dtype=np.int32)
        np.cumsum(np.bincount(h, minlength=1 << bits), out=self.first[1:])

    def _hash(self, context: np.ndarray, last: np.ndarray) -> np.ndarray:
        h = context.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        h ^= last.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        return (h >> self.shift).astype(np.int64)

    def find(self, context: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The values, NaN where there is none."""
        h = self._hash(context, last)
        out = np.full(len(h), np.nan, dtype=np.float32)
        at, end = self.first[h], self.first[h + 1]
        left = np.flatnonzero(at < end)
        at, end = at[left], end[left]
        while len(left):
            hit = (self.context[at] == context[left]) & (self.last[at] == last[left])
            out[left[hit]] = self.value[at[hit]]
            on = ~hit & (at + 1 < end)
            left, at, end = left[on], at[on] + 1, end[on]
        return out


class WindowLogs:
    """log10 probability of every window: seen ones from the tables, others by backing off."""

    def __init__(self, levels: list[tuple[DataFrame, DataFrame]]):
        self.seen, self.rest = [], []
        for seen, contexts in levels:
            got = seen.toArrow()
            self.seen.append(Lookup(got["context"].to_numpy(), got["last"].to_numpy(), np.log10(got["p"].to_numpy())))
            got = contexts.toArrow()
            context = got["context"].to_numpy()
            self.rest.append(Lookup(context, np.zeros_like(context), np.log10(got["rest"].to_numpy())))

    def logs(self, part: np.ndarray) -> np.ndarray:
        """log10 of the windows (context, last)."""
        context, last = np.ascontiguousarray(part[:, 0]), np.ascontiguousarray(part[:, 1])
        out, left, weight = np.zeros(len(part)), np.arange(len(part)), 0.0
        for order in range(ORDER, 0, -1):
            got = self.seen[order - 1].find(context, last).astype(float)
            out[left] = weight + got
            missed = np.isnan(got)
            left, context, last = left[missed], context[missed], last[missed]
            if not len(left):
                return out
            # an unseen context leaves all its weight to the order below
            weight = (weight if order == ORDER else weight[missed]) + np.nan_to_num(
                self.rest[order - 1].find(context, np.zeros_like(last)), nan=0.0).astype(float)
            context = context & _shorter(order - 1) if order > 1 else context
        out[left] = weight - np.log10(SYMBOLS)
        return out

    def __getitem__(self, at: np.ndarray | int | slice) -> np.ndarray | float:
        """Windows as rows (context, last), or by their numbers in base SYMBOLS."""
        if isinstance(at, np.ndarray):
            return self.logs(at)
        first, n = (at.start, at.stop - at.start) if isinstance(at, slice) else (at, 1)
        high, low = divmod(int(first), SYMBOLS)
        last = low + np.arange(n)
        digits, context = high + last // SYMBOLS, np.zeros(n, dtype=np.int64)
        for k in range(ORDER - 1):
            context |= (digits % SYMBOLS) << (BITS * k)
            digits = digits // SYMBOLS
        found = self.logs(np.column_stack([context, last % SYMBOLS]))
        return found if isinstance(at, slice) else float(found[0])


def train(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          most_shipped: int = MOST_SHIPPED) -> WindowLogs | list[tuple[DataFrame, DataFrame]] | None:
    """log10 probabilities from the texts of all ``trusted`` ids (id): for look-ups, or the tables that texts are joined with."""
    bound_batches(docs.sparkSession)
    texts = (docs.select(F.col(id_col).alias("of"), F.col(text_col).cast("string").alias("text"))
             .join(trusted.select("id").hint("shuffle_hash"), F.col("of") == F.col("id"), "left_semi").select("text"))
    counts = materialize(count_windows(texts))
    n = counts.count()
    if not n:
        return None
    levels = probabilities(counts)
    return WindowLogs(levels) if n <= most_shipped else levels


def _score_joined(docs: DataFrame, levels: list[tuple[DataFrame, DataFrame]], text_col: str, keep: list[str]) -> DataFrame:
    """As :func:`score`, by joins of each text's window counts with the tables, order by order."""
    places = [f"c{i}" for i in range(len(keep))]
    docs = materialize(docs.select(F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"),
                                   *[F.col(c).alias(p) for c, p in zip(keep, places)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), as_texts(batch.column(1))):
                for part in windows(text):
                    got = _once(part)
                    yield from got.add_column(0, "row", pa.array([row] * len(got), pa.int64())).to_batches(100_000)

    left = (docs.select("row", "text").mapInArrow(run, "row long, context long, last long, n long")
            .groupBy("row", "context", "last").agg(F.sum("n").alias("n")).withColumn("weight", F.lit(0.0)))
    parts = []
    for order in range(ORDER, 0, -1):
        seen, contexts = levels[order - 1]
        met = materialize(left.join(seen, ["context", "last"], "left"))
        parts.append(met.where("p IS NOT NULL").select("row", "n", (F.col("weight") + F.log10("p")).alias("log")))
        below = F.col("context").bitwiseAND(F.lit(_shorter(order - 1) if order > 1 else 0))
        left = met.where("p IS NULL").join(contexts, "context", "left").select(
            "row", below.alias("context"), "last", "n", (F.col("weight") + F.coalesce(F.log10("rest"), F.lit(0.0))).alias("weight"))
    parts.append(left.select("row", "n", (F.col("weight") - float(np.log10(SYMBOLS))).alias("log")))
    sums = reduce(DataFrame.union, parts).groupBy("row").agg(F.sum(F.col("n") * F.col("log")).alias("log10"),
                                                             F.sum("n").alias("n_symbols"))
    return docs.join(sums, "row").select(*places, "log10", "n_symbols").toDF(*keep, "log10", "n_symbols")


def score(docs: DataFrame, table: WindowLogs | list | None, text_col: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns with log10 (sum over the whole text) and n_symbols."""
    spark = docs.sparkSession
    bound_batches(spark)
    if isinstance(table, list):
        return _score_joined(docs, table, text_col, keep)
    place = keep.index(text_col) if text_col in keep else len(keep)
    shipped = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs = shipped.value
        for batch in batches:
            texts = as_texts(batch.column(place))
            sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
            if logs is None:
                sums = -sizes * np.log10(SYMBOLS)
            else:
                sums = np.zeros(len(texts))
                for at, starts, part in _grouped(texts):
                    sums[at] += np.add.reduceat(logs.logs(part), starts)
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(sums, pa.float64()), pa.array(sizes, pa.int64())],
                                             names=[*keep, "log10", "n_symbols"])

    schema = docs.select(*keep).schema.add("log10", "double").add("n_symbols", "long")
    text = [] if text_col in keep else [F.col(text_col).cast("string")]
    return docs.select(*keep, *text).mapInArrow(run, schema)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          label_col: str = "quality", quantile: float = 0.002, margin: float = 1.0,
          prior_symbols: float = 60.0, min_trusted: int = 50, carry: list[str] | None = None) -> DataFrame:
    """The ``carry`` columns (default: id and language), perplexity, n_symbols, score, keep per document.

    ``score`` is the mean log10 probability per symbol, drawn to the language's mean as
    by ``prior_symbols`` more symbols.  A document is kept if its score lies between the
    ``quantile`` and 1 - ``quantile`` of its language's trusted documents, widened by
    ``margin`` times their distance from the median.
    """
    trusted = materialize(labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
                          .groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("q")).where("q = 1").select("id"))
    table = train(docs, trusted, id_col, text_col)
    carry = [id_col, lang_col] if carry is None else carry
    scored = materialize(score(docs, table, text_col, carry))
    known = materialize(scored.join(trusted, scored[id_col] == trusted.id, "left_semi").select(lang_col, "log10", "n_symbols"))
    by = F.coalesce(F.col(lang_col).cast("string"), F.lit("\0"))
    means = [(F.sum("log10") / F.sum("n_symbols")).alias("mean"), F.count(F.lit(1)).alias("n")]
    overall = known.agg(*means).first()
    mean_of = {r.by: r["mean"] for r in known.groupBy(by.alias("by")).agg(*means).where(F.col("n") >= min_trusted).collect()}
    if table is None or not overall.n:
        return scored.select(*carry, F.lit(float(SYMBOLS)).alias("perplexity"), "n_symbols",
                             F.lit(-float(np.log10(SYMBOLS))).alias("score"), F.lit(True).alias("keep"))

    def lookup(values: dict, other) -> Column:
        pairs = [F.lit(x) for kv in values.items() for x in kv]
        return F.coalesce(F.create_map(*pairs)[by], F.lit(other)) if pairs else F.lit(other)
    mean = lookup(mean_of, overall["mean"])
    shrunk = ((F.col("log10") + prior_symbols * mean) / (F.col("n_symbols") + prior_symbols)).alias("score")
    points = F.percentile_approx("score", [quantile, 0.5, 1 - quantile], 10_000).alias("q")
    trusted_scores = known.select(by.alias("by"), shrunk)
    limits = {r.by: r.q for r in trusted_scores.groupBy("by").agg(points).collect() if r.by in mean_of}
    everywhere = trusted_scores.agg(points).first().q

    def bounds(q: list[float]) -> tuple[float, float]:
        return q[0] - margin * (q[1] - q[0]), q[2] + margin * (q[2] - q[1])
    low = lookup({k: bounds(q)[0] for k, q in limits.items()}, bounds(everywhere)[0])
    high = lookup({k: bounds(q)[1] for k, q in limits.items()}, bounds(everywhere)[1])
    out = scored.select(*carry, F.pow(F.lit(10.0), -F.col("log10") / F.col("n_symbols")).alias("perplexity"),
                        "n_symbols", shrunk)
    return out.withColumn("keep", (F.col("score") >= low) & (F.col("score") <= high))
