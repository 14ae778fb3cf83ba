import itertools
import random

from qmeasures.llm import packing


def least_cost(sizes, lengths):
    """Optimum by trying every partition of the pieces into sequences."""
    if not sizes:
        return 0
    best = float("inf")
    head, rest = sizes[0], sizes[1:]
    for k in range(len(rest) + 1):
        for chosen in itertools.combinations(range(len(rest)), k):
            total = head + sum(rest[i] for i in chosen)
            if total <= max(lengths):
                own = packing.cost(min(x for x in lengths if x >= total))
                best = min(best, own + least_cost([rest[i] for i in range(len(rest)) if i not in chosen], lengths))
    return best


def check_plan(sizes, lengths, plan):
    place, offset, final = plan
    inside = {}
    for size, at, start in zip(sizes, place, offset):
        inside.setdefault(at, []).append((start, start + size))
    assert sorted(inside) == list(range(len(final)))
    for at, spans in inside.items():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert final[at] == min(x for x in lengths if x >= spans[-1][1])


def test_near_the_optimum():
    rng = random.Random(1)
    got = want = 0
    for _ in range(40):
        lengths = (8, 16, 40)
        sizes = [rng.randint(1, 40) for _ in range(7)]
        plan = packing.best_fit(sizes, lengths)
        check_plan(sizes, lengths, plan)
        got += sum(map(packing.cost, plan[2]))
        want += least_cost(sizes, lengths)
    assert got <= 1.04 * want


def test_large_block_is_tight():
    rng = random.Random(2)
    sizes = [min(4096, int(rng.lognormvariate(5.5, 1.2)) + 1) for _ in range(6000)]
    plan = packing.best_fit(sizes)
    check_plan(sizes, packing.LENGTHS, plan)
    assert sum(plan[2]) <= 1.005 * sum(sizes) + 4096
    one_size = packing.best_fit(sizes, (4096,))
    assert sum(map(packing.cost, plan[2])) <= sum(map(packing.cost, one_size[2]))


def test_rows(spark):
    words = {0: 3, 1: 0, 2: 9000, 3: 512, 4: 512, 5: 4096, 6: 1, 7: 40, 8: 700}
    rows = [(i, "w " * n, 1) for i, n in words.items()] + [(9, None, 1), (None, "a b", 1), (0, "x y z", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, seq_id int")
    for block in (20_000, 2):
        got = packing.pack(df, block=block).collect()
        total = {}
        for r in got:
            total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
        assert total == {**words, 9: 0, None: 2, 0: 6}
        spans = {}
        for r in got:
            if r.n_tokens:
                spans.setdefault((r.seq_id, r.seq_length), []).append((r.seq_offset, r.seq_offset + r.n_tokens))
            else:
                assert (r.seq_id, r.seq_length, r.seq_offset) == (None, None, None)
        assert len({s for s, _ in spans}) == len(spans)
        for (_, length), inside in spans.items():
            inside.sort()
            assert inside[0][0] == 0 and all(a[1] == b[0] for a, b in zip(inside, inside[1:])) and inside[-1][1] <= length
            assert length in packing.LENGTHS
        assert [(r.piece, r.start, r.n_tokens) for r in sorted((r for r in got if r.doc_id == 2), key=lambda r: r.piece)] == [
            (0, 0, 4096), (1, 4096, 4096), (2, 8192, 808)]
    assert packing.pack(df.limit(0)).collect() == []
