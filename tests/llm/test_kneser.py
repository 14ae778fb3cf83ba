import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from qmeasures.llm import kneser


def plain_model(texts):
    """Interpolated modified Kneser-Ney by its definition, over dictionaries."""
    table, order = kneser.symbol_table(), kneser.ORDER
    grams = Counter()
    for t in texts:
        line = [0] * (order - 1) + [int(table[min(ord(c), 0xFFFF)]) for c in t] + [0]
        grams.update(tuple(line[i:i + order]) for i in range(len(line) - order + 1))
    levels = {order: grams}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    cut = {}
    for k, c in levels.items():
        n = Counter(c.values())
        if not n[1] or not n[2]:
            cut[k] = (0.5, 0.5, 0.5)
            continue
        y = n[1] / (n[1] + 2 * n[2])
        raw = (1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 2 - 3 * y * n[3] / n[2])
        cut[k] = tuple(min(max(d, 0.01), i - 0.01) for i, d in zip((1, 2, 3), raw))
    total, taken = defaultdict(float), defaultdict(float)
    for k, c in levels.items():
        for g, n in c.items():
            total[g[:-1]] += n
            taken[g[:-1]] += cut[k][min(n, 3) - 1]

    def p(g):
        if not g:
            return 1 / kneser.SYMBOLS
        if not total[g[:-1]]:
            return p(g[1:])
        n = levels[len(g)][g]
        return (max(n - (cut[len(g)][min(n, 3) - 1] if n else 0), 0) + taken[g[:-1]] * p(g[1:])) / total[g[:-1]]
    return p


def sentences(rng, n):
    parts = ["the", "an", "er", "ing", "tion", "ou", "Ma", "é", "st", ", ", ". ", " ", " ", " ", "\n", "7"]
    return ["".join(rng.choices(parts, k=rng.randint(1, 50))) for _ in range(n)]


def test_probabilities_by_definition(spark):
    texts = sentences(random.Random(1), 60) + ["", None]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    table = kneser.train(docs, docs.selectExpr("doc_id as id"))
    p = plain_model([t or "" for t in texts])
    rng = random.Random(2)
    for _ in range(400):
        g = tuple(rng.randrange(kneser.SYMBOLS) for _ in range(4))
        if rng.random() < 0.7:
            t = rng.choice([t for t in texts if t and len(t) > 5])
            i = rng.randrange(len(t) - 4)
            g = tuple(int(kneser.symbol_table()[ord(c)]) for c in t[i:i + 4])
        code = sum(s * kneser.SYMBOLS ** (3 - k) for k, s in enumerate(g))
        assert table[code] == pytest.approx(np.log10(p(g)), abs=1e-4)
    for context in (0, 5, 1234, 99999):
        at = context * kneser.SYMBOLS
        assert (10.0 ** table[at:at + kneser.SYMBOLS].astype(float)).sum() == pytest.approx(1, abs=1e-4)


def test_every_trusted_text_is_counted(spark):
    n = 21_000  # more texts than any part of them that could be taken
    docs = spark.range(n).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'ab', 'ba') AS text")
    twice = docs.union(docs.where("doc_id < 10"))  # repeated rows count each time
    table = kneser.train(twice, docs.selectExpr("doc_id as id"))
    p = plain_model([r.text for r in twice.collect()])
    code = {w: next(iter(kneser.windows(w)))[:2] for w in ("ab", "ba")}
    for w in code:
        a, b = (int(kneser.symbol_table()[ord(c)]) for c in w)
        for got, want in zip(table[code[w]], (p((0, 0, 0, a)), p((0, 0, a, b)))):
            assert got == pytest.approx(np.log10(want), abs=1e-6)


def test_every_code_point_is_a_symbol(spark):
    # each text and one of other characters of the same kind, alike modulo 5, above U+FFFF, capitals, digits
    pairs = [("дом", "йом"), ("漢字", "漧字"), ("😀𐍈", "𐍈😀"), ("Aa Bb", "Ba Ab"), ("12 34", "21 43")]
    texts = [t * 5 for t, _ in pairs] + [""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    table = kneser.train(docs, docs.selectExpr("doc_id as id"))
    marks = {c: chr(0x100 + i) for i, c in enumerate(sorted(set("".join(texts))))}  # the plain model's characters
    p = plain_model([t.translate({ord(c): m for c, m in marks.items()}) for t in texts])

    def plain(text):
        line = [0] * 3 + [ord(marks[c]) + 1 for c in text] + [0]
        return sum(np.log10(p(tuple(line[i:i + 4]))) for i in range(len(line) - 3))
    for own, other in pairs:
        logs = [sum(float(table[w].sum()) for w in kneser.windows(t)) for t in (own, other)]
        assert logs[0] == pytest.approx(plain(own), abs=1e-4) and logs[0] > logs[1] + 0.5


def test_joins_score_as_look_ups_do(spark, monkeypatch):
    texts = sentences(random.Random(6), 40) + ["", None, "ж😀 not seen"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(0, texts[0])], "doc_id long, text string")
    trusted = docs.selectExpr("doc_id as id").where("id < 20")
    table = kneser.train(docs, trusted)
    want = sorted((r.doc_id, r.n_symbols, r.log10) for r in kneser.score(docs, table, "text", ["doc_id"]).collect())
    assert [(i, n) for i, n, _ in want] == sorted([(i, len(t or "") + 1) for i, t in enumerate(texts)] + [(0, len(texts[0]) + 1)])
    for (i, n, x), t in zip(want, [texts[0], *texts]):
        assert x == pytest.approx(sum(float(table[w].sum()) for w in kneser.windows(t or "")), abs=1e-4)
    joined = kneser.score(docs, kneser.train(docs, trusted, most_shipped=0), "text", ["doc_id"])
    got = sorted((r.doc_id, r.n_symbols, r.log10) for r in joined.collect())
    assert [g[:2] for g in got] == [w[:2] for w in want] and [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-3)
    monkeypatch.setattr(kneser, "_CHUNK", 7)
    sums = [sum(len(part) for at, _, part in kneser._grouped([t or "" for t in texts]) if i in at) for i in range(3)]
    assert all(sums) and sum(len(part) for _, _, part in kneser._grouped([t or "" for t in texts])) == sum(n for _, n, _ in want[1:])


def test_windows_in_parts(monkeypatch):
    text = "".join(sentences(random.Random(3), 9))
    whole = np.concatenate(list(kneser.windows(text)))
    monkeypatch.setattr(kneser, "_CHUNK", 7)
    for t in (text, text[:7], text[:14], ""):
        assert (np.concatenate(list(kneser.windows(t))) == (whole if t == text else np.concatenate(list(kneser.windows(t))))).all()
    assert len(whole) == len(text) + 1


def test_junk_goes_and_clean_stays(spark):
    rng = random.Random(4)
    clean = ["".join(sentences(rng, 4)) for _ in range(300)]
    junk = [" ".join(w.upper() + "!!" for w in t.split()) for t in clean[:20] if len(t) > 40]
    junk += ["| ".join(w + "###" for w in t.split()) for t in clean[20:40] if len(t) > 40]
    rows = [(i, t, "aa" if i % 2 else None, 0.0) for i, t in enumerate(clean)]
    rows += [(1000 + i, t, "aa", 0.0) for i, t in enumerate(junk)]
    rows += [(5000, None, "zz", 0.0), (5001, "", None, 0.0), (5002, clean[0] * 30_000, "aa", 0.0), (0, clean[0], "aa", 0.0),
             (None, clean[1], "aa", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 300, 2)] + [(1000, 0, 0), (None, 1, 0), (4, None, 0), (6, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = kneser.judge(docs.select("doc_id", "text", "lang"), labels).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert sum(not by_id[i].keep for i in range(300)) <= 3
    assert not any(by_id[1000 + i].keep for i in range(len(junk)))
    assert by_id[5000].keep and by_id[5001].keep and by_id[5002].keep and by_id[5002].n_symbols == len(clean[0]) * 30_000 + 1


def test_nothing_trusted(spark):
    docs = spark.createDataFrame([(1, "a", "x"), (2, None, None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int")
    assert all(r.keep and r.perplexity == kneser.SYMBOLS for r in kneser.judge(docs, labels).collect())
    assert kneser.judge(docs.limit(0), labels).collect() == []
    assert kneser.judge(docs.limit(0), labels.selectExpr("doc_id", "1 as quality")).collect() == []


def test_columns_that_clash_with_own_names(spark):
    rng = random.Random(8)
    rows = [(i, "".join(sentences(rng, 3)), "aa") for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 80, 2)], "doc_id long, quality int")
    more = docs.selectExpr("*", "'x' AS id", "1 AS n", "2 AS code", "0 AS label", "3.0 AS log10", "'y' AS of")
    want, got = (sorted(map(tuple, kneser.judge(d, labels).collect())) for d in (docs, more))
    assert got == want
