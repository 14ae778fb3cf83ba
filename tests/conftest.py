import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from qmeasures.session import local_session
    s = local_session(cpus=4, partitions=4, driver_memory="4g")
    yield s


def d(s):
    return dt.date.fromisoformat(s) if s else None


def df(spark, rows, schema):
    """Fixture frame: '' -> NULL, ISO strings in date columns -> DATE."""
    from pyspark.sql import types as T
    st = spark.createDataFrame([], schema).schema if isinstance(schema, str) else schema
    fixed = []
    for r in rows:
        vals = []
        for v, f in zip(r, st.fields):
            if isinstance(v, str) and v.strip() == "":
                v = None
            if v is not None and isinstance(f.dataType, T.DateType) and isinstance(v, str):
                v = d(v)
            if v is not None and isinstance(f.dataType, T.DoubleType):
                v = float(v)
            vals.append(v)
        fixed.append(tuple(vals))
    return spark.createDataFrame(fixed, st)


def codes(spark, text):
    """Code table from '~'-separated lines: measure~component~codesystem~code~group~diag_type."""
    rows = []
    for line in text.strip().splitlines():
        parts = (line.split("~") + [""] * 6)[:6]
        rows.append(parts)
    return df(spark, rows, "measure string, component string, codesystem string, code string, "
                            "grouping_id string, diag_type string")


def by_member(result, value_cols=("denominator", "numerator")):
    return {r["member_id"]: tuple(r[c] for c in value_cols) for r in result.collect()}


def compare_expected(result, expected: dict, key="member_id", cols=("denominator", "numerator")):
    """Left join expected -> actual, missing actual = 0, equal at 4 decimals."""
    actual = {}
    for r in result.collect():
        actual[r[key]] = tuple(r[c] for c in cols)
    bad = {}
    for k, exp in expected.items():
        got = actual.get(k, tuple(0.0 for _ in cols))
        got = tuple(round(float(g or 0), 4) for g in got)
        if got != tuple(round(float(e), 4) for e in exp):
            bad[k] = (exp, got)
    assert not bad, bad
