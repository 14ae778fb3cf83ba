import datetime as dt

from pyspark.sql import functions as F

from conftest import df
from qmeasures.functions.dates import age_years, shift_date
from qmeasures.params import MeasureParams


def test_completed_age_edges(spark):
    rows = [("1996-12-31", "2014-12-31", 18), ("1997-01-01", "2014-12-31", 17),
            ("2000-02-29", "2018-02-28", 17), ("2000-02-29", "2018-03-01", 18),
            ("2010-01-31", "2014-01-30", 3), ("2010-01-31", "2014-01-31", 4)]
    frame = df(spark, rows, "dob date, at date, want int")
    got = [(r["want"], r["age"]) for r in frame.select("want", age_years("dob", "at").alias("age")).collect()]
    assert all(w == a for w, a in got), got


def test_parameter_dates():
    assert shift_date(dt.date(2014, 12, 31), years=-1) == dt.date(2013, 12, 31)
    assert shift_date(dt.date(2014, 1, 1), months=-2) == dt.date(2013, 11, 1)
    assert shift_date(dt.date(2020, 3, 31), months=-1) == dt.date(2020, 2, 29)
    p = MeasureParams.for_year(2015, dt.date(2015, 7, 31))
    assert (p.measure_end, p.runout_start) == (dt.date(2015, 12, 31), dt.date(2015, 5, 1))
    assert p.round_elig_date == dt.date(2015, 7, 31)
