"""Property tests: interval operators against plain Python loops; code predicate rules."""
import datetime as dt
import random

from conftest import codes, df
from qmeasures.functions.codes import claims_filter
from qmeasures.operators.intervals import anchored_groups, contiguous_runs, coverage_islands, eligibility_gaps
from qmeasures.operators.ordered import first_row, top_k

D0 = dt.date(2020, 1, 1)


def _d(n):
    return D0 + dt.timedelta(days=n)


def _random_spans(seed, members=40):
    rnd = random.Random(seed)
    rows = []
    for m in range(members):
        for _ in range(rnd.randint(0, 6)):
            s = rnd.randint(-60, 400)
            rows.append((f"m{m}", _d(s), _d(s + rnd.randint(0, 90))))
            if rnd.random() < 0.3:          # exact duplicates and adjacent follow-ons
                rows.append(rows[-1])
                rows.append((f"m{m}", rows[-1][2] + dt.timedelta(days=1), rows[-1][2] + dt.timedelta(days=30)))
    return rows


def _loop_gaps(spans, ws, we):
    """Reference loop: walk the window day by day."""
    if ws > we:
        return 0, 0
    covered = set()
    for s, e in spans:
        if s is None:
            continue
        d = max(s, ws)
        while d <= min(e, we):
            covered.add(d)
            d += dt.timedelta(days=1)
    cnt = days = 0
    in_gap = False
    d = ws
    while d <= we:
        if d not in covered:
            days += 1
            if not in_gap:
                cnt += 1
            in_gap = True
        else:
            in_gap = False
        d += dt.timedelta(days=1)
    return cnt, days


def test_eligibility_gaps_matches_loop(spark):
    rows = _random_spans(7)
    rows += [("nospan", None, None)]
    frame = df(spark, rows, "member_id string, date_start date, date_end date")
    ws, we = _d(0), _d(365)
    got = {r["member_id"]: (r["gap_cnt"], r["gap_days"])
           for r in eligibility_gaps(frame, "member_id", ws, we).collect()}
    by = {}
    for m, s, e in rows:
        by.setdefault(m, []).append((s, e))
    for m, spans in by.items():
        assert got[m] == _loop_gaps(spans, ws, we), m
    assert got["nospan"] == (1, 366)


def test_eligibility_gaps_global_end_and_empty_window(spark):
    frame = df(spark, [("a", "2020-01-01", "2020-02-01"), ("a", "2020-02-04", "2020-08-01"),
                       ("a", "2020-08-04", "2020-12-31")], "member_id string, date_start date, date_end date")
    full = eligibility_gaps(frame, "member_id", _d(0), dt.date(2020, 12, 31)).collect()[0]
    assert (full["gap_cnt"], full["gap_days"]) == (2, 4)
    cut = eligibility_gaps(frame, "member_id", _d(0), dt.date(2020, 12, 31), global_end=dt.date(2020, 6, 30)).collect()[0]
    assert (cut["gap_cnt"], cut["gap_days"]) == (1, 2)
    empty = eligibility_gaps(frame, "member_id", dt.date(2020, 7, 1), dt.date(2020, 6, 30)).collect()[0]
    assert (empty["gap_cnt"], empty["gap_days"]) == (0, 0)


def _loop_islands(spans, lo, hi):
    spans = sorted([(s, e) for s, e in spans if e >= lo and s <= hi])
    out, prev, cur = [], None, 0
    for s, e in spans:
        cs, ce = max(s, lo), min(e, hi)
        if prev is None or (cs - prev).days != 1:
            out.append(0)
        out[-1] += (ce - cs).days + 1
        prev = ce
    return sorted(out)


def test_coverage_islands_matches_loop(spark):
    rows = _random_spans(11)
    frame = df(spark, rows, "member_id string, date_start date, date_end date")
    lo, hi = _d(0), _d(365)
    got = {}
    for r in coverage_islands(frame, "member_id", lo, hi).collect():
        got.setdefault(r["member_id"], []).append(r["days"])
    by = {}
    for m, s, e in rows:
        by.setdefault(m, []).append((s, e))
    for m, spans in by.items():
        assert sorted(got.get(m, [])) == _loop_islands(spans, lo, hi), m


def test_duplicate_spans_open_islands(spark):
    # three identical spans after an adjacent one: the first continues, the others each open one
    rows = [("a", "2020-01-01", "2020-01-31")] + [("a", "2020-02-01", "2020-02-29")] * 3 + \
           [("a", "2020-03-01", "2020-03-31")]
    frame = df(spark, rows, "member_id string, date_start date, date_end date")
    got = sorted(r["days"] for r in coverage_islands(frame, "member_id", _d(0), dt.date(2020, 12, 31)).collect())
    spans = [(dt.date.fromisoformat(s), dt.date.fromisoformat(e)) for _, s, e in rows]
    assert got == _loop_islands(spans, _d(0), dt.date(2020, 12, 31)) == [29, 31 + 29, 29 + 31]


def test_overlap_starts_new_island(spark):
    # literal rule: overlapping spans do not continue an island
    frame = df(spark, [("a", "2020-01-01", "2020-03-31"), ("a", "2020-03-01", "2020-06-30")],
               "member_id string, date_start date, date_end date")
    got = sorted(r["days"] for r in coverage_islands(frame, "member_id", _d(0), dt.date(2020, 12, 31)).collect())
    assert got == [91, 122]


def _loop_anchored(rows, window):
    rows = sorted(rows)
    gid, end, out = -1, None, []
    for f, t in rows:
        if end is None or t > end:
            gid += 1
            end = t + dt.timedelta(days=window)
        out.append((f, t, gid))
    return out


def test_anchored_groups_matches_fold(spark):
    rnd = random.Random(3)
    rows = []
    for m in range(25):
        for _ in range(rnd.randint(1, 8)):
            f = rnd.randint(0, 400)
            rows.append((f"m{m}", _d(f), _d(f + rnd.randint(0, 10))))
    rows = sorted(set(rows))
    frame = df(spark, rows, "member_id string, f date, t date")
    got = {(r["member_id"], r["f"], r["t"]): r["group_id"]
           for r in anchored_groups(frame, "member_id", ["f", "t"], "t", 60).collect()}
    by = {}
    for m, f, t in rows:
        by.setdefault(m, []).append((f, t))
    for m, pairs in by.items():
        for f, t, g in _loop_anchored(pairs, 60):
            assert got[(m, f, t)] == g


def test_anchored_is_not_sliding(spark):
    # 0, 50, 100: with a sliding window all would chain; anchored -> two groups
    frame = df(spark, [("a", _d(0), _d(0)), ("a", _d(50), _d(50)), ("a", _d(100), _d(100))], "member_id string, f date, t date")
    got = sorted((r["t"], r["group_id"]) for r in anchored_groups(frame, "member_id", ["f", "t"], "t", 60).collect())
    assert [g for _, g in got] == [0, 0, 1]


def test_transfer_runs_compare_previous_row_only(spark):
    # allow_overlap: a stay continues when start - previous end <= 1 (previous row, not running max)
    frame = df(spark, [("a", "2020-01-01", "2020-01-30"), ("a", "2020-01-02", "2020-01-03"),
                       ("a", "2020-01-10", "2020-01-12")], "member_id string, s date, e date")
    ids = [r["run_id"] for r in contiguous_runs(frame, "member_id", "s", "e", allow_overlap=True)
           .orderBy("s").collect()]
    assert ids == [1, 1, 2]


def test_first_row_and_top_k(spark):
    frame = df(spark, [("a", "2020-01-05", "x"), ("a", "2020-01-01", "y"), ("a", "2020-01-01", "b"),
                       ("b", "2020-02-01", "z")], "k string, d date, v string")
    first = {r["k"]: r["v"] for r in first_row(frame, "k", [("d", "asc"), ("v", "asc")]).collect()}
    assert first == {"a": "b", "b": "z"}
    last = {r["k"]: r["v"] for r in first_row(frame, "k", [("d", "desc")]).collect()}
    assert last["a"] == "x"
    assert top_k(frame, "k", [("d", "desc")], 2).count() == 3


CODES = """
m~plain~CPT~A~~
m~plain~UBREV~R1~~
m~grp~CPT~PROCA~G1~
m~grp~CPT~PROCB~G1~
m~grp~POS~PA~G1~
m~grp~CPT~SOLO~G2~
m~diag~ICD10CM-Diag~DX1~~Primary
m~diag~ICD10CM-Diag~DX2~~Secondary
m~diag~ICD9CM-Diag~DX3~~
m~mods~Modifier~95~~
m~proc~ICD10CM-Proc~PR1~~
m~empty~LOINC~L1~~
"""


def test_code_predicate_rules(spark):
    table = codes(spark, CODES)
    lines = df(spark, [
        ("1", "A", None, None, None, None, None, None, None),
        ("2", "PROCA", None, "PA", None, None, None, None, None),
        ("3", "PROCB", None, "XX", None, None, None, None, None),
        ("4", "SOLO", None, None, None, None, None, None, None),
        ("5", None, None, None, "DX2", "DX1", None, None, None),
        ("6", None, None, None, None, "DX2", "DX3", None, None),
        ("7", None, None, None, None, None, None, "95", None),
        ("8", None, None, None, None, None, None, None, "PR1"),
        ("9", None, "R1", None, None, None, None, None, None),
    ], "id string, hcpcs string, revcode string, pos string, icddiag1 string, icddiag2 string, "
       "icddiag3 string, modifier2 string, icdproc1 string")
    def ids(comp, measure="M"):  # measure / component compare case-insensitively
        return sorted(r["id"] for r in lines.filter(claims_filter(table, measure, comp.upper(), lines)).collect())
    assert ids("plain") == ["1", "9"]
    assert ids("grp") == ["2", "4"]               # AND across code systems within a group
    assert ids("diag") == ["6"]                   # DX1 only as primary, DX2 only as secondary
    assert ids("mods") == ["7"]
    assert ids("proc") == ["8"]
    assert ids("empty") == []                     # no claim column for the code system
    assert ids("absent") == []
    never_null = lines.select(claims_filter(table, "m", "grp", lines).alias("p")).filter("p is null").count()
    assert never_null == 0


def test_empty_inputs(spark):
    from qmeasures.operators.reuse import materialize
    empty = df(spark, [], "member_id string, f date, t date")
    assert materialize(empty).schema == empty.schema
    assert anchored_groups(empty, "member_id", ["f", "t"], "t", 60).count() == 0
    spans = df(spark, [], "member_id string, date_start date, date_end date")
    assert eligibility_gaps(spans, "member_id", _d(0), _d(30)).count() == 0
    assert coverage_islands(spans, "member_id", _d(0), _d(30)).count() == 0
