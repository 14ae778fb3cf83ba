import itertools
import random

import pytest
import xxhash

from qmeasures.llm import simhash


def slow_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints, t):
    root = {i: i for i in range(len(ids))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, j in itertools.combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= t:
            root[find(i)] = find(j)
    lows = {}
    for i, d in enumerate(ids):
        if d is not None:
            lows[find(i)] = min(lows.get(find(i), d), d)
    return [lows.get(find(i)) for i in range(len(ids))]


def documents():
    rng = random.Random(5)
    vocab = ["w%d" % i for i in range(300)]
    base = [" ".join(rng.choices(vocab, k=rng.choice([1, 2, 3, 9, 120, 400]))) for _ in range(40)]
    texts = base + [b.upper() for b in base[:8]] + [None, "", " \t\x0b ", "ÄÖ É", "a b c"]
    for b in base:
        if len(b.split()) > 100:
            words = b.split()
            for _ in range(4):
                changed = words[:]
                changed[rng.randrange(len(words))] = "x"
                texts.append(" ".join(changed))
    texts.append(" ".join(rng.choices(vocab, k=70_000)))
    return list(enumerate(texts)) + [(0, texts[0]), (None, texts[1]), (None, "only here")]


@pytest.mark.parametrize("heavy", [1024, 1])
def test_against_brute_force(spark, heavy):
    rows = documents()
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, fp string")
    got = sorted(map(tuple, simhash.near_duplicates(df, heavy=heavy).collect()), key=str)
    prints = [slow_print(t) for _, t in rows]
    roots = slow_components([i for i, _ in rows], prints, 2)
    want = sorted(((i, f"{p:016x}", r) for (i, _), p, r in zip(rows, prints, roots)), key=str)
    assert got == want
    assert len({r for r in roots}) < len(rows) - 20


@pytest.mark.parametrize("m,t", [(5, 2), (4, 3), (3, 1), (7, 3)])
def test_links_are_whole(spark, m, t):
    rng = random.Random(m * 10 + t)
    prints = set()
    for _ in range(25):
        p = rng.getrandbits(64)
        for _ in range(8):
            q = p
            for b in rng.sample(range(64), rng.randint(0, t + 2)):
                q ^= 1 << b
            prints.add(q)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {tuple(r) for r in simhash.links(df, t, m).collect()}
    want = {(min(a, b), max(a, b)) for a, b in itertools.combinations(signed, 2)
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= t}
    assert got == want and want


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []
