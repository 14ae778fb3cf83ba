"""Binned interval joins, ordinals and global order, publishing by manifest."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import df
from qmeasures.operators.binned import events_in_windows, latest_window_at, overlapping_pairs
from qmeasures.operators.empirical import empirical_elig_end
from qmeasures.operators.ordinal import file_ordinal, prefix_sums, write_sorted
from qmeasures.plans.publish import PublishError, discover, publish, violations, write_run
from qmeasures.sources import reference as R

DAY0 = dt.date(2030, 1, 1)


def _day(n):
    return DAY0 + dt.timedelta(days=n)


def _spans(rng, n, longest):
    out = []
    for _ in range(n):
        s = rng.randrange(-40, 300)
        out.append((rng.choice("aab"), _day(s), _day(s + rng.randrange(-2, longest))))
    return out


@pytest.mark.parametrize("width", [1, 7, 32, 1000])
def test_binned_joins_equal_nested_loops(spark, width):
    rng = random.Random(width)
    wins = _spans(rng, 60, 90) + [("a", None, _day(3)), (None, _day(0), _day(9))]
    evs = [(rng.choice("aabc"), _day(rng.randrange(-60, 360)), rng.randrange(9)) for _ in range(150)]
    evs += [("a", None, 1), (None, _day(1), 1), evs[0]]
    w = df(spark, wins, "m string, s date, e date")
    v = df(spark, evs, "m string, d date, x int").withColumn("y", F.col("x"))
    real = {x for x in wins if None not in x and x[1] <= x[2]}
    want = {}
    for m, s, e in real:
        hit = [x for k, d, x in evs if k == m and d and s <= d <= e]
        if hit:
            want[m, s, e] = (len(hit), max(hit), sum(hit))
    got = {(r.m, r.s, r.e): (r.events, r.x, r.y)
           for r in events_in_windows(v, w, "m", "d", "s", "e", maxes=["x"], sums=["y"], width=width).collect()}
    assert got == want
    last = {(r.m, r.d): (r.s, r.e) for r in latest_window_at(v, w, "m", "d", "s", "e", width=width).collect()}
    open_on = {(m, d): [(s, e) for k, s, e in real if k == m and s <= d <= e] for m, d, _ in evs if m and d}
    assert last == {k: max(o) for k, o in open_on.items() if o}
    other = df(spark, _spans(rng, 40, 60), "m string, s2 date, e2 date").distinct()
    pairs = sorted(tuple(r) for r in overlapping_pairs(w.distinct(), other, "m", ("s", "e"), ("s2", "e2"), width)
                   .select("m", "s", "e", "s2", "e2").collect())
    assert pairs == sorted((m, s, e, s2, e2) for m, s, e in real for k, s2, e2 in map(tuple, other.collect())
                           if k == m and s2 <= e2 and s <= e2 and s2 <= e)


def test_a_hot_member_meets_by_bin(spark):
    w = df(spark, [("a", _day(0), _day(9))], "m string, s date, e date")
    v = df(spark, [("a", _day(1), 1)], "m string, d date, x int")
    plan = events_in_windows(v, w, "m", "d", "s", "e")._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "_bin" in join and "m#" in join


def test_empirical_end_runs_no_job_while_planning(spark):
    spans = df(spark, [("a", _day(5)), ("b", _day(5)), ("c", _day(9))], "member_id string, date_end date")
    group = "plan-empirical"
    spark.sparkContext.setJobGroup(group, group)
    col = empirical_elig_end(spans, _day(7), 2)
    picked = spark.range(1).select(col.alias("end"))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    assert picked.first()[0] == _day(5)
    late = spark.range(1).select(empirical_elig_end(spans, _day(7), 1).alias("a"),
                                 empirical_elig_end(spans, _day(7), 9).alias("b"),
                                 empirical_elig_end(spans, _day(7), 1, _day(2)).alias("c")).first()
    assert tuple(late) == (_day(7), _day(7), _day(2))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_prefix_sums_over_many_ranges(spark):
    rows = [(f"f{i % 7}", i // 7, i * 3 % 11) for i in range(100)]
    got = {(r.p, r.b): r.offset for r in prefix_sums(df(spark, rows, "p string, b int, n int"), ["p", "b"], "n", ranges=9).collect()}
    total, want = 0, {}
    for p, b, n in sorted(rows):
        want[p, b] = total
        total += n
    assert got == want


def test_ordinal_and_global_sort_over_files(spark, tmp_path):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 1, 1, 2]), rng.choice([None, "x", "y"]), i % 50) for i in range(600)]
    path = str(tmp_path / "sorted")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_sorted(df(spark, rows, "a int, b string, c int").repartition(5), [("a", "desc"), ("b", "asc")], path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = file_ordinal(spark.read.parquet(path), "pos").orderBy("pos").collect()
    assert [r.pos for r in back] == list(range(600))
    key = lambda r: ((r[0] is None, -(r[0] or 0)), (r[1] is None, r[1] or ""), r[2])
    assert [(r.a, r.b, r.c) for r in back] == sorted(rows, key=key)
    assert sum(f.endswith(".parquet") for f in os.listdir(path)) > 1  # equal keys do not fill one file
    one = tmp_path / "text.csv"
    one.write_text("x\n" + "\n".join(str(i) for i in range(4000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = R.read_reference_csv(spark, str(one), R.T.StructType([R.T.StructField("x", R.T.IntegerType())]))
        assert lines.filter("x <> _ordinal").count() == 0 and lines.count() == 4000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    empty = str(tmp_path / "empty")
    spark.range(0).write.parquet(empty)
    assert file_ordinal(spark.read.parquet(empty)).count() == 0


RESULT = "member_id string, denominator double, numerator double, comments string"


def test_runs_are_seen_when_published(spark, tmp_path):
    out = str(tmp_path / "out")
    assert not discover(spark, out)
    good = {"a": df(spark, [("m1", 1, 0, "x")], RESULT), "none": df(spark, [], RESULT)}
    first = write_run(good, out)
    assert not discover(spark, out)  # written, not published
    publish(spark, first, out)
    seen = discover(spark, out)
    assert list(seen) == ["a", "none"] and seen["a"].count() == 1 and seen["none"].count() == 0
    assert R.dataset_label(first["tables"]["a"]["path"], spark) == "a results"
    # a writer that dies half way leaves tables without a manifest
    write_run({"a": df(spark, [("m2", 1, 0, "x")], RESULT)}, out)
    open(os.path.join(out, "_manifests", ".99999999999999999999-x.draft"), "w").write("{")
    assert [r.member_id for r in discover(spark, out)["a"].collect()] == ["m1"]
    broken = write_run({"a": df(spark, [("", 1, 0, "x" * 129), ("m3", "", 0, "y")], RESULT)}, out)
    assert {tuple(r) for r in violations(spark, broken).collect()} == {
        ("a", "no_nulls", "member_id", 1), ("a", "no_nulls", "denominator", 1), ("a", "comment_fits", "comments", 1)}
    with pytest.raises(PublishError, match="comment_fits"):
        publish(spark, broken, out)
    assert [r.member_id for r in discover(spark, out)["a"].collect()] == ["m1"]


def test_declared_not_null_is_enforced(spark, tmp_path):
    os.makedirs(tmp_path / "_data")
    os.makedirs(tmp_path / "_schemas")
    (tmp_path / "_schemas" / "t.csv").write_text("name,datatype,nullable,sas_informat\nx,string,false,$8.\ny,string,true,$8.\n")
    (tmp_path / "_data" / "t.csv").write_text("x,y\na,\n,b\n")
    refs = R.import_flatfile_references(spark, str(tmp_path))
    with pytest.raises(Exception, match="NULL in t.x, declared not nullable"):
        refs["t"].collect()
    schema = R.build_structtype_from_csv(str(tmp_path / "_schemas" / "t.csv"))
    raw = R.read_reference_csv(spark, str(tmp_path / "_data" / "t.csv"), schema)
    assert [tuple(r) for r in R.null_violations(raw, schema, "t").collect()] == [("declared_not_null", "t.x", "1")]
    (tmp_path / "_data" / "t.csv").write_text("x,y\na,\nc,b\n")
    assert R.import_flatfile_references(spark, str(tmp_path))["t"].count() == 2
