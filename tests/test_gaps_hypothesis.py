"""Hypothesis property test: eligibility gaps with per-key windows vs a day-by-day loop."""
import datetime as dt

from hypothesis import given, settings, strategies as st, HealthCheck

from conftest import df
from qmeasures.operators.intervals import eligibility_gaps
from test_operators import _loop_gaps

BASE = dt.date(2021, 1, 1)
day = st.integers(min_value=0, max_value=120)
span = st.one_of(st.tuples(day, st.integers(min_value=0, max_value=40)), st.just(None))
member = st.tuples(st.tuples(day, st.integers(min_value=-5, max_value=90)), st.lists(span, max_size=6))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(members=st.lists(member, min_size=1, max_size=8), global_end=st.integers(min_value=20, max_value=200))
def test_gaps_property(spark, members, global_end):
    rows, expected = [], {}
    g_end = BASE + dt.timedelta(days=global_end)
    for i, ((ws, length), spans) in enumerate(members):
        key = f"k{i}"
        w_start = BASE + dt.timedelta(days=ws)
        w_end = w_start + dt.timedelta(days=length)
        pairs = []
        for sp in spans or [None]:
            if sp is None:
                rows.append((key, w_start, w_end, None, None))
                pairs.append((None, None))
            else:
                s = BASE + dt.timedelta(days=sp[0])
                e = s + dt.timedelta(days=sp[1])
                rows.append((key, w_start, w_end, s, e))
                pairs.append((s, e))
        expected[key] = _loop_gaps(pairs, w_start, min(w_end, g_end))
    frame = df(spark, rows, "k string, ws date, we date, date_start date, date_end date")
    got = {r["k"]: (r["gap_cnt"], r["gap_days"])
           for r in eligibility_gaps(frame, "k", "ws", "we", global_end=g_end).collect()}
    assert got == expected
