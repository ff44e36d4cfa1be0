"""Wide files as arrays: any width, alignment of two headers, increments across id rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from paneltide.operators import wide as W
from paneltide.operators.series import increments
from paneltide.plans import catalog as C
from paneltide.plans import totals as TT
from paneltide.sources import tables as TB

SF = "/root/testdata/sf0.001"
IDS = "p string, c string, lat double, lon double"


def _labels(n, first=dt.date(2014, 1, 1)):
    days = [first + dt.timedelta(days=i) for i in range(n)]
    return [f"{d.month}/{d.day}/{d.strftime('%y')}" for d in days]


def _wide(spark, rows, labels):
    header = spark.createDataFrame([(labels,)], "labels array<string>")
    return W.WideTable(spark.createDataFrame(rows, IDS + ", values array<long>"), header)


def test_arrays_equal_columns(spark):
    """The arrays and the pivoted columns of one feed give the same panel."""
    frame, aliases = C._frame(spark, SF), TB.nation_aliases(spark, SF)
    arrays = TT.panel_from_wide_cumulative(*TB.wide_arrays(spark, SF), frame, aliases)
    columns = TT.panel_from_wide_cumulative(*TB.wide_cumulative(spark, SF), frame, aliases)
    assert arrays.count() > 0 and sorted(map(tuple, arrays.collect())) == sorted(map(tuple, columns.collect()))


def test_plan_does_not_grow_with_the_days(spark):
    def plan(n):
        labels = _labels(n)
        cases = _wide(spark, [("a", "x", 1.0, 2.0, list(range(n)))], labels)
        deaths = _wide(spark, [("a", "x", 1.0, 2.0, [1] * n)], labels)
        days = W.paired_days(cases, deaths, ("c", "d"), ("nc", "nd"), ["c", "p"], ["lat", "lon"])
        text = days._jdf.queryExecution().optimizedPlan().toString()
        return days, text

    (few, small), (many, large) = plan(30), plan(4000)
    assert large.count("\n") == small.count("\n") and len(large) < 1.1 * len(small) + 200
    got = many.orderBy("Date").collect()
    assert len(got) == 4000 and got[-1]["Date"] == dt.date(2014, 1, 1) + dt.timedelta(days=3999)
    assert [r["nc"] for r in got] == [None] + [1] * 3999 and few.count() == 30


def test_headers_differ_and_places_are_missing(spark):
    cases = _wide(spark, [("a", "x", 1.0, 2.0, [3, 1, 5]), (None, "y", None, 2.0, [1, 1, 2]), ("b", "x", 1.0, 2.0, [7, 8, 9])],
                  ["1/2/20", "1/1/20", "total"])
    deaths = _wide(spark, [("a", "x", 1.0, 2.0, [4, 6]), (None, "y", None, 2.0, [0, None]), ("d", "z", 0.0, 0.0, [2, 1])], ["1/3/20", "1/2/20"])
    got = W.paired_days(cases, deaths, ("c1", "d1"), ("nc", "nd"), ["c", "p"], ["lat", "lon"])
    rows = {(r["p"], r["c"]): [] for r in got.collect()}
    for r in sorted(got.collect(), key=lambda r: (r["Date"] is None, r["Date"])):
        rows[r["p"], r["c"]].append((r["Date"] and r["Date"].day, r["c1"], r["d1"], r["nc"], r["nd"]))
    assert rows[("a", "x")] == [(1, 1, None, None, None), (2, 3, 6, 2, None), (3, None, 4, None, 0), (None, 5, None, None, None)]
    assert rows[(None, "y")] == [(1, 1, None, None, None), (2, 1, None, 0, None), (3, None, 0, None, None), (None, 2, None, None, None)]
    assert rows[("d", "z")] == [(1, None, None, None, None), (2, None, 1, None, None), (3, None, 2, None, 1), (None, None, None, None, None)]
    assert len(rows[("b", "x")]) == 4


def test_increments_equal_the_row_form(spark):
    """Several id rows of one series follow one another, as the row window orders them."""
    rnd = random.Random(7)
    labels = _labels(40)
    rows = [(p, c, lat, 0.0, [rnd.randrange(50) if rnd.random() < 0.9 else None for _ in labels])
            for p, c in [("a", "x"), (None, "x"), ("b", "y")] for lat in (1.0, None, -3.0)]
    wide = _wide(spark, rows, labels)
    got = W.paired_days(wide, wide, ("v", "v2"), ("n", "n2"), ["c", "p"], ["lat", "lon"]).select("p", "c", "lat", "Date", "v", "n")
    long = W.unpivot_wide(wide, "label", "v").withColumn("Date", F.to_date("label", "M/d/yy"))
    want = increments(long, ["c", "p"], "Date", {"v": "n"}, clamp=True, order=["lat", "lon", "Date"]).select("p", "c", "lat", "Date", "v", "n")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert W.unpivot_wide(wide, drop_nulls=True).where("value is null").count() == 0


def test_a_series_with_missing_days_is_refused(spark):
    long = spark.createDataFrame([(1, 1, 5), (1, 2, 6), (2, 1, 7)], "u long, d int, v long")
    header = spark.createDataFrame([(["x", "y"],)], "labels array<string>")
    assert [tuple(r) for r in W.pack_arrays(long.where("u = 1"), ["u"], "d", ["v"], header).collect()] == [(1, [5, 6])]
    with pytest.raises(Exception, match="one row for each label"):
        W.pack_arrays(long, ["u"], "d", ["v"], header).collect()
