import random
import re
from collections import Counter

import numpy as np

from qmeasures.llm import divergence
from qmeasures.llm.divergence import Tree, joint

TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def slow(rows, least=10, top=10, scale=10**9):
    """(lang, source, text) rows -> the result rows, cell by cell."""
    rows = [tuple(x or "" for x in r) for r in rows]
    out = []
    for lang in {r[0] for r in rows}:
        count, docs, whole = {}, Counter(), Counter()
        for own, source, text in rows:
            if own == lang:
                terms = [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in TERM.findall(text)]
                count.setdefault(source, Counter()).update(terms)
                whole.update(terms)
                docs.update(set(terms))
        kept = [t for t in docs if docs[t] >= least]

        def share(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + scale * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in count.items()}, share(whole)
        differ = lambda x, y: (x - y) ** 2 // (x + y)
        for s in count:
            parts = {"pair": [(o, sum(differ(p[s][t], p[o][t]) for t in kept)) for o in count if o != s],
                     "term": [(t, differ(p[s][t], q[t])) for t in kept if count[s][t] and p[s][t] > q[t]]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


def got(spark, rows, **how):
    df = spark.createDataFrame([(1, 2.0, *r, "x") for r in rows],
                               "n long, value double, lang string, source string, text string, term string")
    return sorted(map(tuple, divergence.audit(df, **how).collect()))


def random_rows(rng, n, sources, words, langs=("en", "de", None)):
    vocabulary = ["".join(rng.choices("abcdeé日ß", k=rng.randint(1, 4))) for _ in range(words)]
    return [(rng.choice(langs), rng.choice(sources),
             rng.choice(["", " ", "-1\x00"]).join(" " + w.capitalize() for w in rng.choices(vocabulary, k=rng.randint(0, 40))))
            for _ in range(n)]


def test_against_slow(spark):
    rng = random.Random(5)
    rows = random_rows(rng, 300, ["a", "b", "ß", "", None, "A"], 60)
    rows += [("fr", "a", None), ("fr", "b", "one two"), ("xx", None, None), ("de", "silent", "12 - 3"),
             ("en", "long", "lorem ipsum " * 200_000)] + [("en", "copies", "same words here")] * 12
    assert got(spark, rows) == slow(rows)


def test_many_groups_in_stripes(spark):
    rng = random.Random(6)
    rows = random_rows(rng, 700, [f"s{i}" for i in range(150)], 450, langs=("en",))
    want = slow(rows, least=3, top=4)
    assert len({r[1] for r in want}) > 2 * divergence.STRIPE
    assert got(spark, rows, least_docs=3, top=4) == want


def test_empty_and_all_below_the_bound(spark):
    assert got(spark, []) == []
    rows = [("en", "a", "x y"), ("en", "b", "x"), ("en", "c", None)]
    assert got(spark, rows) == slow(rows) and len(slow(rows)) == 6
    assert got(spark, [("en", "a", "x")] * 9) == []


def test_tree_prices_empty_quadrants_without_entering_them():
    rng = np.random.default_rng(1)
    dense = np.where(rng.random((40, 300)) < 0.03, rng.integers(1000, 9000, (40, 300)), 0)
    dense[:, 128:] = 0
    zero = rng.integers(10, 99, 40)
    rows, cols = np.nonzero(dense)
    tree = Tree(rows, cols, dense[rows, cols], 9)
    full = np.where(dense, dense, zero[:, None])
    want = ((full[:, None] - full[None]) ** 2 // (full[:, None] + full[None])).sum(2)
    assert (np.triu(joint(tree, tree, zero, zero, 300, 9, True), 1) == np.triu(want, 1)).all()
    assert (joint(tree, Tree(rows[:0], cols[:0], rows[:0], 9), zero, zero[:7], 300, 9, False)
            == ((full[:, None] - zero[None, :7, None]) ** 2 // (full[:, None] + zero[None, :7, None])).sum(2)).all()
    assert tree.child[0][0, 1] == -1  # the quadrant right of column 255 holds nothing and has no node


def test_pieces_cut_between_words():
    text = "Ab é\x85x, ".encode() * 50
    assert sum(divergence.pieces(text, 7), []) == sum(divergence.pieces(text), [])
