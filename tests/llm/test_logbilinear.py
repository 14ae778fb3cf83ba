import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qmeasures.llm import logbilinear as lbl
from qmeasures.llm.common import fold


def corpus(n=160, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        words = []
        for _ in range(rng.randint(1, 60)):
            words += rng.choice([["the", "cat%d" % rng.randrange(40)], ["of", "a", "Dog%d" % rng.randrange(300)]])
        out.append((i, " ".join(words)))
    return out + [(900, None), (901, ""), (902, " \t "), (903, "unseen words " * 50), (0, out[0][1]), (None, out[1][1]),
                  (904, "the cat1 " * 60_000)]


def remainder(i, mod):
    return zlib.crc32(("" if i is None else str(i)).encode()) % mod


def test_base_score_and_held_out_gain(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    got = sorted(map(tuple, lbl.score(df, fold("doc_id", 7) != 2, hot=60, batch=512).collect()), key=str)
    count = Counter()
    texts = 0
    for i, t in rows:
        if remainder(i, 7) != 2:
            count.update((t or "").encode().lower().split())
            texts += 1
    n, v = sum(count.values()) + texts, len(count) + 1
    want = []
    for i, t in rows:
        words = (t or "").encode().lower().split()
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words) + math.log10((texts + 1) / (n + v + 1))
        want.append((i, len(words) + 1, sum(count[w] > 0 for w in words) + 1, n, base))
    for g, w in zip(got, sorted(want, key=str)):
        assert g[:4] == w[:4] and g[4] == pytest.approx(w[4], rel=1e-9)
    held = [g for g in got if g[0] is not None and remainder(g[0], 7) == 2 and g[0] < 900]
    assert len(held) > 10 and sum(g[5] for g in held) > sum(g[4] for g in held) * 0.97


def learned(spark, rows, hot, **training):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("learn", F.lit(True))
    table = lbl.count_words(df)
    facts = lbl.gather(table, df.count(), hot)
    return table, facts, lbl.train(lbl.number_texts(df, facts, 2), facts, **training)


def probabilities(facts, model, one, two):
    """log of the probability of every output after the outputs one and two, level by level."""
    q = [float(model.scale[0][d] * model.context[one][d] + model.scale[1][d] * model.context[two][d])
         for d in range(model.context.shape[1])] + [1.0]
    starts = facts.group_starts()

    def normal(rows):
        z = [sum(a * float(b) for a, b in zip(q, row)) for row in rows]
        total = math.log(sum(math.exp(x) for x in z))
        return [x - total for x in z]
    groups, out = normal(model.group), []
    for g, (a, b) in enumerate(zip(starts, starts[1:])):
        out += [groups[g] + x for x in normal(model.target[a:b])]
    return out


def test_probabilities_add_up(spark):
    table, facts, model = learned(spark, corpus(40), 300, dim=6, batch=256)
    n = facts.outputs()
    starts = facts.group_starts()
    assert starts[0] == 0 and starts[-1] == n and (np.diff(starts) > 0).all() and (np.diff(starts) > 1).any()
    for one, two in ((n, n), (0, n), (3, 1)):
        every = lbl.Tokens(np.arange(n), np.full(n, one), np.full(n, two), np.array([0]))
        logs = lbl.Scorer(facts, model).logs(every)
        assert (10 ** logs).sum() == pytest.approx(1, abs=1e-4)
        assert np.allclose(logs * math.log(10), probabilities(facts, model, one, two), atol=1e-3)
    counted = {r.h: (r.n, r.kind) for r in table.collect()}
    hot = set(facts.hot_hash.tolist())
    rest = np.ones(lbl.CLASSES)
    for h, (c, kind) in counted.items():
        if h not in hot:
            rest[kind] += c + 1
    assert np.allclose(rest, facts.rest_mass())


def test_scores_by_definition(spark):
    rows = corpus(30)
    _, facts, model = learned(spark, rows, 60, dim=6, batch=256)
    rank = {h: i for i, h in enumerate(facts.hot_hash.tolist())}
    scorer, n, hot = lbl.Scorer(facts, model), facts.outputs(), len(facts.hot_hash)
    texts = [(t or "").encode() for _, t in rows[:33]]
    sizes, places, n_cold, cold = lbl.Words(facts).number(texts)
    ids = lbl._lists(sizes, places, pa.int32())
    want_cold = [[lbl.word_hash(w) for w in t.lower().split() if lbl.word_hash(w) not in rank] for t in texts]
    assert n_cold.tolist() == [len(c) for c in want_cold] and cold.tolist() == sum(want_cold, []) and len(cold)
    for part in (slice(0, 33), slice(20, 33)):   # a slice of the lists gives the same
        got = scorer.score(ids[part.start:part.stop])
        for text, size, known, found in zip(texts[part], got[0], got[1], got[3]):
            words = text.lower().split()
            total, before = 0.0, [n, n]
            for w in [*words, None]:
                r = n - 1 if w is None else rank.get(lbl.word_hash(w), hot + lbl.word_class(w))
                total += probabilities(facts, model, before[-1], before[-2])[r] / math.log(10)
                if hot <= r < n - 1:
                    total -= math.log10(facts.rest_mass()[r - hot])
                before.append(r)
            assert size == len(words) + 1 and known == sum(lbl.word_hash(w) in rank for w in words) + 1
            assert found == pytest.approx(total, rel=1e-3)


def test_gradient_lowers_the_loss():
    facts = lbl.Counts(1000, 330, 10, np.arange(300), np.arange(340, 40, -1), np.zeros(300, np.int32),
                       np.full(lbl.CLASSES, 90_000), np.full(lbl.CLASSES, 90_400))
    model = lbl.Model.fresh(facts, 5, 1)
    for name in ("scale", "group", "context", "target"):
        setattr(model, name, getattr(model, name).astype(float))
    learner = lbl.Contrast(model, facts, np.random.default_rng(0), 0.1, 4, 3)
    learner.log_kn, learner.log_kw = learner.log_kn.astype(float), learner.log_kw.astype(float)
    one, two, word = np.array([0, 3, 3, 7]), np.array([5, 0, 1, 365]), np.array([2, 250, 250, 364])
    groups, words = learner.noise()

    def loss():
        q, g = model.ahead(one, two), learner.of_output[word]
        total = 0.0
        for i, w in enumerate(word):
            total += np.log1p(np.exp(-(q[i] @ model.group[g[i]] - learner.log_kn[g[i]])))
            total += np.log1p(np.exp(model.group[groups] @ q[i] - learner.log_kn[groups])).sum()
            if learner.sizes[g[i]] > 1:
                total += np.log1p(np.exp(-(q[i] @ model.target[w] - learner.log_kw[g[i]])))
                total += np.log1p(np.exp(model.target[words[g[i]]] @ q[i] - learner.log_kw[g[i]])).sum()
        return total
    for p, (at, by) in zip(model.parts(), learner.gradients(one, two, word, groups, words)):
        dense = np.zeros(p.shape)
        dense[at] = by
        for place in [(r, c) for r in {*at[:12].tolist(), 1} for c in range(p.shape[1])]:
            kept = p[place]
            p[place] = kept + 1e-5
            up = loss()
            p[place] = kept - 1e-5
            down = loss()
            p[place] = kept
            assert dense[place] == pytest.approx((up - down) / 2e-5, abs=1e-4)


@pytest.mark.parametrize("share", [1 << 23, 20_000])
def test_layout_moves_no_score(spark, share):
    rows = [(i, t) for i, t in corpus(1500, 3) if i is not None and i < 900 or i == 901]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    means, plain = [], []
    for parts in (4, 200):
        got = lbl.score(df.repartition(parts), fold("doc_id", 7) != 2, hot=300, batch=1024, share=share)
        got = got.where(fold("doc_id", 7) == 2).agg(F.sum("n_tokens"), F.sum("base_score"), F.sum("score")).first()
        means.append(got[2] / got[0])
        plain.append(got[1] / got[0])
    assert plain[0] == pytest.approx(plain[1], rel=1e-12)
    assert abs(means[0] - means[1]) < 0.02 and max(means) < 1 and min(means) > plain[0] + 0.2


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {tuple(r) for r in lbl.score(df, F.lit(False)).select("doc_id", "n_tokens", "n_known", "train_tokens", "base_score").collect()}
    assert got == {(1, 3, 0, 0, 0.0), (2, 1, 0, 0, 0.0)}
    assert lbl.score(df.limit(0), F.lit(True)).collect() == []


@pytest.mark.parametrize("share", [1 << 23, 20])
def test_training_reads_every_token(spark, share):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(6))) for i in range(30)]
    _, facts, model = learned(spark, rows, 1000, dim=4, share=share)
    fresh = lbl.Model.fresh(facts, 4, 5)
    moved = (model.context != fresh.context).any(axis=1)
    assert len(facts.hot_hash) == 180 and moved[:180].all() and moved[-1]  # each word stands before a token learned from


def test_noise_of_all_groups_is_weighed_at_once(monkeypatch):
    """A batch makes four sigmoids however many groups it meets, not one more for each group."""
    facts = lbl.Counts(1000, 330, 10, np.arange(300), np.arange(340, 40, -1), np.zeros(300, np.int32),
                       np.full(lbl.CLASSES, 90_000), np.full(lbl.CLASSES, 90_400))
    learner = lbl.Contrast(lbl.Model.fresh(facts, 5, 1), facts, np.random.default_rng(0), 0.1, 4, 3)
    word = np.arange(0, 365)
    sigmoid, calls = lbl._sigmoid, []
    monkeypatch.setattr(lbl, "_sigmoid", lambda x: calls.append(x.shape) or sigmoid(x))
    learner.step(word, word[::-1].copy(), word)
    assert len(calls) == 4, len(calls)


def test_words_are_split_by_definition():
    odd = [None, "", " ", "a", " a  B\ta ", "\x0b\x0c\r\n", "x\x1cy\x1fz\x85w\xa0v\u3000u", "\x00 \x00", "ÄÖ İ ß A\u0301", "Z" * 70 + " z" * 9]
    for texts in (odd, odd[4:7], ["  "], [None]):
        column = lbl.as_strings(pa.array(["left out", *texts, "this too"])).slice(1, len(texts))
        sizes, words, at = lbl.split_words(column)
        want = [(t or "").encode().lower().split() for t in texts]
        assert sizes.tolist() == [len(w) for w in want] and [words[i] for i in at] == sum(want, [])
        assert len(set(words)) == len(words) and set(words) == set(sum(want, []))
        assert lbl.word_hashes(words).tolist() == [lbl.word_hash(w) for w in words]
    raw = lbl.as_strings(pa.array([b"\xff\xfe A\xc3", None], pa.binary()))   # bytes that are no UTF-8
    assert lbl.split_words(raw)[1] == [b"\xff\xfe", b"a\xc3"]


class Watched(np.ndarray):
    """Rows that note how many runs ``reduceat`` adds up one by one."""

    runs: list[int] = []

    def __array_ufunc__(self, ufunc, method, *inputs, **given):
        if method == "reduceat":
            Watched.runs.append(len(inputs[1]))
        plain = [x.view(np.ndarray) if isinstance(x, Watched) else x for x in inputs]
        given = {k: tuple(x.view(np.ndarray) if isinstance(x, Watched) else x for x in v) if k == "out" else v for k, v in given.items()}
        return getattr(ufunc, method)(*plain, **given)


def test_rows_are_summed_over_short_and_long_runs():
    """The sums are those of reduceat to the last bit, but short runs are not added one by one."""
    rng = np.random.default_rng(2)
    at = rng.permutation(np.concatenate([np.repeat([7], 40), np.repeat([900, 3], 5), np.repeat([4, 11], 4), [5, 5, 5, 8, 8],
                                         np.arange(20, 200)]))
    values = rng.normal(size=(len(at), 3)).astype(np.float32)
    for part in (slice(None), slice(0, 1), slice(0, 9)):
        order = np.argsort(at[part])
        rows, first = np.unique(at[part]), np.flatnonzero(np.diff(at[part][order], prepend=-1))
        Watched.runs.clear()
        found = lbl._sum_rows(at[part], values[part].view(Watched))
        assert found[0].tolist() == rows.tolist()
        assert np.array_equal(found[1], np.add.reduceat(values[part][order], first))
        assert sum(Watched.runs) <= 3, Watched.runs   # 7, 900 and 3


@pytest.mark.parametrize("size", [0.1, 3.0, 40.0])
def test_normaliser_with_and_without_room(size):
    """Too large exponents don't overflow."""
    rng = np.random.default_rng(3)
    rows, q = (rng.normal(0, size, (n, 7)).astype(np.float32) for n in (300, 500))
    z = q.astype(float) @ rows.T.astype(float)
    high = z.max(axis=1)
    want = high + np.log(np.exp(z - high[:, None]).sum(axis=1))
    got = lbl.Normaliser(rows).logs(q, (q * q).sum(axis=1))
    assert np.isfinite(got).all() and np.allclose(got, want, rtol=1e-5, atol=1e-5)
