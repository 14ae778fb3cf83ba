import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from qmeasures.llm import toxicity


def corpus(n=260, seed=4):
    rng = random.Random(seed)
    vocab = ["".join(rng.choices(["an", "er", "th", "on", "ou", "le", "st"], k=3)) for _ in range(150)]
    docs, labels = [], []
    for i in range(n):
        words = rng.choices(vocab, k=rng.randint(10, 150))
        toxic = int(i % 3 == 0)
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["vileworm", "vilerat", "vilecrow"]))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    return docs, labels


def test_gradients_match_differences(monkeypatch):
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh(rng)
    for name in ("w", "u", "b", "att", "key", "out"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    windows = [["aa", "bb", "cc"], ["dd", "aa"], ["ee"] * 32]
    lexicon = toxicity.Lexicon(windows)
    ids, y, weight = lexicon.matrix(windows), np.array([1.0, 0, 1]), np.array([1.0, 2, 1])
    got = {}

    class Catch:
        def dense(self, name, p, g):
            got[name] = g

        def rows(self, name, p, at, g):
            got[name] = (at, g)

    def loss():
        table = net.project(lexicon.inputs(net)).transpose(1, 0, 2)
        z = toxicity._logits(net, table, ids).astype(float)
        return float((weight * (np.log1p(np.exp(z)) - y * z)).sum() / weight.sum())

    toxicity._step(net, Catch(), lexicon, ids, y, weight)
    for name in ("w", "u", "b", "att", "key", "out"):
        p = getattr(net, name)
        for at in list(np.ndindex(p.shape))[::max(1, p.size // 5)]:
            kept = p[at]
            p[at] = kept + 1e-3
            up = loss()
            p[at] = kept - 1e-3
            down = loss()
            p[at] = kept
            assert got[name][at] == pytest.approx((up - down) / 2e-3, abs=2e-4)
    bucket = toxicity.word_inputs(["aa"])[0][0]
    kept = net.word[bucket, 0]
    net.word[bucket, 0] = kept + 1e-2
    up = loss()
    net.word[bucket, 0] = kept - 1e-2
    down = loss()
    at, g = got["word"]
    assert g[at == bucket, 0].sum() == pytest.approx((up - down) / 2e-2, abs=3e-4)


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 47, 48, 49, 64, 65, 1000):
        at = list(toxicity.starts(n))
        assert at[0] == 0 and at[-1] + toxicity.WINDOW >= n and all(b - a == toxicity.STRIDE for a, b in zip(at, at[1:]))
        assert n <= toxicity.WINDOW or at[-1] + toxicity.WINDOW - n < toxicity.STRIDE


def test_scores_equal_one_text_at_a_time(monkeypatch):
    rng = np.random.default_rng(2)
    net = toxicity.Network.fresh(rng)
    net.calibration = np.array([1.0, 0.5, 0.1, 0.0])
    docs, _ = corpus(40)
    texts = [t for _, t in docs] + ["", "one", " ".join(t for _, t in docs)]
    plain = []
    for text in texts:
        words = toxicity.WORDS.findall(text.lower())
        z = []
        for at in toxicity.starts(len(words)):
            x = words[at:at + toxicity.WINDOW]
            gates = net.project(net.inputs(x) if x else np.zeros((1, 2 * toxicity.EMBED), np.float32))[:, :, None]
            z.append(net.forward(gates, np.full((max(1, len(x)), 1), float(bool(x)), np.float32))[0])
        plain.append(toxicity.features(np.array(z)))
    monkeypatch.setattr(toxicity, "PART", 64)
    monkeypatch.setattr(toxicity, "CACHE_WORDS", 20)
    assert np.allclose(toxicity.Scorer(net).features(texts), np.array(plain), atol=1e-4)


def test_held_out_and_edges(spark):
    docs, labels = corpus()
    extra = [(1000, None), (1001, ""), (1002, "?!"), (1003, "an er th " * 40_000), (0, docs[0][1]), (None, "vilerat " * 3)]
    df = spark.createDataFrame([(*r, 0.5) for r in docs + extra], "doc_id long, text string, score double")
    marks = spark.createDataFrame(labels + [(0, None, None), (5000, 1, 1)], "doc_id long, quality int, toxic int")
    net = toxicity.train(df, marks, learn=F.col("doc_id") % 4 != 2)
    got = [tuple(r) for r in toxicity.score(df, net).collect()]
    assert len(got) == len(docs) + len(extra)
    by_id = {r[0]: r for r in got}
    held = [(by_id[i][2], t) for i, _, t in labels if i % 4 == 2]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert by_id[1000][1] == by_id[1001][1] == by_id[1002][1] and by_id[1003][2] == 0
    assert all(0 <= r[1] <= 1 and r[2] == (r[1] >= 0.3) for r in got)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.train(df, none) is None
    assert {tuple(r) for r in toxicity.score(df, None).collect()} == {(1, 0.0, 0), (2, 0.0, 0)}
    assert toxicity.score(df.limit(0), None).collect() == []


def test_one_passage_in_a_very_long_text(spark, monkeypatch):
    docs, labels = corpus(150)
    rng = random.Random(8)
    vocab = sorted({w for _, t in docs for w in t.split() if not w.startswith("vile")})

    def long_text(toxic):
        words = rng.choices(vocab, k=20_000)
        if toxic:
            at = rng.randrange(100, 19_900)
            words[at:at + 6] = ["vileworm", "vilerat", "vilecrow"] * 2
        return " ".join(words)
    for i in range(200, 216):
        docs.append((i, long_text(i % 2)))
        labels.append((i, 1, i % 2))
    read, features = [], toxicity.features
    monkeypatch.setattr(toxicity, "features", lambda logits: read.append(len(logits)) or features(logits))
    net = toxicity.train(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(read)[-16:] == [len(toxicity.starts(20_000))] * 16  # calibrated on what scoring reads
    fresh = [long_text(i % 2) for i in range(8)]
    found = net.score(toxicity.Scorer(net).features(fresh)) >= 0.3
    assert found.tolist() == [bool(i % 2) for i in range(8)]
