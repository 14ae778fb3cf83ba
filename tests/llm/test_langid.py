import random
import zlib

import numpy as np
import pytest

from qmeasures.llm import langid

SYLLABLES = {"aa": ["the", "ing", "and", "er", "ion", "sh"], "bb": ["que", "ción", "ado", "ez", "ll", "os"],
             "cc": ["sch", "ung", "keit", "ein", "pf", "ö"]}


def rows(n=240, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(sorted(SYLLABLES))
        text = " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(rng.randint(3, 60)))
        out.append((i, text.capitalize(), lang if i % 10 else None))
    return out


def test_held_out_accuracy_and_edges(spark):
    data = rows()
    extra = [(1000, None, "aa"), (1001, "", "bb"), (1002, "123 !? ...", "cc"), (1003, "The ingand " * 9000, None),
             (0, data[0][1], None), (None, data[1][1], None)]
    df = spark.createDataFrame([(*r, 0.5) for r in data + extra], "doc_id long, text string, lang string, score double")
    got = [tuple(r) for r in langid.identify(df, learn=df.doc_id % 4 != 2, max_rows=120).collect()]
    assert len(got) == len(data) + len(extra)
    by_id = {r[0]: r for r in got}
    held = [(by_id[i][1], lang) for i, _, lang in data if i % 4 == 2 and lang]
    assert sum(a == b for a, b in held) >= 0.98 * len(held)
    assert all(by_id[i][1:] == ("und", 0.0, True) for i in (1000, 1001, 1002))
    assert by_id[1003][1] == "aa" and all(0 <= r[2] <= 1 for r in got)
    assert sum(by_id[i][3] for i, _, _ in data) <= 2


def test_same_scores_as_plain_average(spark):
    data = rows(60)
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    model = langid.train(df, max_rows=60)
    got = {r.doc_id: r for r in langid.predict(df, model, keep=["doc_id"]).collect()}
    for i, text, _ in data:
        found = [b for w in langid.WORDS.findall(text.lower()) for b in langid.subwords(w, len(model.scores))]
        p = model.probabilities(model.scores[found].sum(axis=0, dtype=float)[None], __import__("numpy").array([len(found)]))[0]
        assert got[i].lang_pred == model.langs[p.argmax()] and got[i].score == pytest.approx(p.max(), abs=1e-6)


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, None)], "doc_id long, text string, lang string")
    assert {tuple(r) for r in langid.identify(df).collect()} == {(1, "und", 0.0, True), (2, "und", 0.0, True)}
    assert langid.identify(df.limit(0)).collect() == []


def test_rejects_a_language_not_learned_and_gibberish(spark):
    data = rows(400)
    rng = random.Random(5)
    noise = [(2000 + i, " ".join("".join(rng.choices("bdfghjkmpqvwxyz", k=rng.randint(3, 9))) for _ in range(40)), None)
             for i in range(20)]
    for known in (["aa", "bb"], ["aa"]):
        df = spark.createDataFrame(data + noise, "doc_id long, text string, lang string")
        got = {r.doc_id: r.rejected for r in langid.identify(df, learn=df.lang.isin(known)).collect()}
        own = [got[i] for i, _, lang in data if lang in known]
        foreign = [got[i] for i, text, lang in data if lang == "cc" and len(text.split()) >= 10]
        assert sum(own) <= 0.01 * len(own)
        assert sum(foreign) >= 0.95 * len(foreign) > 0 and all(got[i] for i, *_ in noise)


def test_evidence_is_of_every_labelled_text(spark):
    data = rows(300, seed=9)
    more = [(1000 + i, *r[1:]) for i, r in enumerate(data[:20])] + [(2000, "ein", "dd"), (2001, "12", "aa")]  # equal texts count once
    df = spark.createDataFrame(data + more, "doc_id long, text string, lang string")
    model = langid.train(df, max_rows=30, buckets=1 << 10)
    texts = {lang: sorted({t for _, t, x in data + more if x == lang and t != "12"}) for lang in ("aa", "bb", "cc", "dd")}
    away, sizes = [], []
    for at, lang in enumerate(sorted(texts)):
        shares, fold, found, n = [], [], [], []
        for t in texts[lang]:
            grams = [b for w in langid.WORDS.findall(t.lower()) for b in langid.subwords(w, 1 << 10)]
            shares.append(np.bincount(grams, minlength=1 << 10) / len(grams))
            fold.append(zlib.crc32(t.encode()) % langid.FOLDS)
            n.append(len(grams))

        def logs(some):
            return np.log(0.95 * np.sum(some, axis=0) / len(some) + 0.05 / (1 << 10))
        assert model.evidence[:, at] == pytest.approx(logs(shares), abs=1e-5)
        for x, k in zip(shares, fold):
            other = [y for y, f in zip(shares, fold) if f != k]
            found += [x @ logs(other)] if other else []
        if not found:
            assert lang == "dd" and model.typical[at] == -np.inf
            continue
        assert abs(model.typical[at] - np.median(found)) < 0.02
        away += list(np.array(found) - model.typical[at])
        sizes += n
    square = np.linalg.lstsq(np.column_stack([np.ones(len(away)), 1 / np.array(sizes)]), np.square(away), rcond=None)[0]
    spread = np.maximum(square, 1e-3)
    assert model.spread == pytest.approx(spread, rel=1e-3)
    fit = np.array(away) / np.sqrt(spread[0] + spread[1] / np.array(sizes))
    assert model.reject_below == pytest.approx(1.5 * min(-1, fit.min()), rel=1e-3)


def test_subwords_of_many_texts_at_once():
    odd = [t for _, t, _ in rows(20)] + ["", "Ǆ İstanbul ΑΣ Σίσυφος 漢字かな交じり😀 𐐀𐐨 ǅ ß", "a b\nc", "123 !", "x" * 3000 + " " + "é" * 50]
    table = np.random.default_rng(3).normal(size=(1 << 12, 5)).astype(np.float32)
    want = []
    for t in odd:
        found = [b for w in langid.WORDS.findall(t.lower()) for b in langid.subwords(w, 1 << 12)]
        want.append([*table[found].sum(axis=0, dtype=float), len(found)])
    assert langid.sums(odd, table) == pytest.approx(np.array(want), abs=1e-6)
    for most in (1, 30):
        n = np.zeros(len(odd))
        for s in langid.split(odd, 1 << 12, most):
            langid._by_text(s, s.sizes[s.words].astype(float), n)
        assert list(n) == [x[-1] for x in want]
