"""Properties of the operators, checked against plain-Python brute force on generated data."""

import datetime as dt
import re

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paneltide.functions import classify as CL
from paneltide.operators import aggregate as AG
from paneltide.operators import reshape as R
from paneltide.operators import series as S

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
D0 = dt.date(2021, 1, 1)

values = st.lists(st.one_of(st.none(), st.integers(0, 50)), min_size=1, max_size=25)
many_series = st.lists(values, min_size=1, max_size=8)


def frame(spark, series_list):
    rows = [(f"s{k}", D0 + dt.timedelta(days=i), v) for k, vals in enumerate(series_list) for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "k string, date date, v long")


def by_key(df, col):
    out = {}
    for r in df.orderBy("k", "date").collect():
        out.setdefault(r["k"], []).append(r[col])
    return out


def locf_reference(vals, maxgap):
    out, last, i = list(vals), None, 0
    n = len(vals)
    while i < n:
        if vals[i] is not None:
            last = vals[i]
            i += 1
            continue
        j = i
        while j < n and vals[j] is None:
            j += 1
        if last is not None and j - i <= maxgap:
            out[i:j] = [last] * (j - i)
        i = j
    return out


@SETTINGS
@given(many_series, st.integers(1, 4))
def test_locf_maxgap_matches_reference(spark, series_list, maxgap):
    got = by_key(S.locf_maxgap(frame(spark, series_list), ["k"], "date", "v", "f", maxgap), "f")
    for k, vals in enumerate(series_list):
        assert got[f"s{k}"] == locf_reference(vals, maxgap)


@SETTINGS
@given(many_series)
def test_fill_downup_matches_reference(spark, series_list):
    got = by_key(S.fill_downup(frame(spark, series_list), ["k"], ["date"], ["v"]), "v")
    for k, vals in enumerate(series_list):
        down, last = [], None
        for v in vals:
            last = v if v is not None else last
            down.append(last)
        up, nxt = [], None
        for v in reversed(down):
            nxt = v if v is not None else nxt
            up.append(nxt)
        assert got[f"s{k}"] == list(reversed(up))


@SETTINGS
@given(st.lists(st.lists(st.integers(0, 40), min_size=1, max_size=6, unique=True), min_size=1, max_size=6))
def test_complete_per_group_row_count_and_values(spark, day_sets):
    rows = [(f"g{k}", D0 + dt.timedelta(days=d), d) for k, days in enumerate(day_sets) for d in days]
    df = spark.createDataFrame(rows, "k string, date date, v long")
    out = R.complete_per_group(df, ["k"], "date", ["v"])
    assert out.count() == sum(max(d) - min(d) + 1 for d in day_sets)
    kept = sorted((r["k"], r["v"]) for r in out.filter(F.col("v").isNotNull()).collect())
    assert kept == sorted((f"g{k}", d) for k, days in enumerate(day_sets) for d in days)


@SETTINGS
@given(st.lists(st.lists(st.integers(0, 9), min_size=1, max_size=20), min_size=1, max_size=6))
def test_increments_sum_to_last_cumulative(spark, daily_lists):
    cums = [list(np.cumsum(d)) for d in daily_lists]
    df = frame(spark, [[int(x) for x in c] for c in cums])
    got = by_key(S.inc_from_cum(df, ["k"], "date", ["v"], 1, "_new"), "v_new")
    for k, c in enumerate(cums):
        assert sum(got[f"s{k}"]) == int(c[-1])


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abcd"), st.sampled_from(["x", "y", "z"]), st.integers(0, 99)), min_size=1, max_size=30,
                unique_by=lambda t: (t[0], t[1])))
def test_long_wide_round_trip(spark, triples):
    long = spark.createDataFrame(triples, "k string, n string, v long")
    wide = R.long_to_wide(long, ["k"], "n", "v", ["x", "y", "z"])
    back = R.wide_to_long(wide, ["k"], ["x", "y", "z"], "n", "v", drop_nulls=True)
    assert sorted(map(tuple, back.collect())) == sorted(triples)


@SETTINGS
@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=40), min_size=1, max_size=5))
def test_quantile_cuts_equal_numpy_type7(spark, groups):
    rows = [(f"g{k}", float(v)) for k, vals in enumerate(groups) for v in vals]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: [r[f"q{i}"] for i in range(1, 6)] for r in AG.quantile_cuts(df, ["g"], "v").collect()}
    for k, vals in enumerate(groups):
        pos = [v for v in vals if v > 0]
        if not pos:
            assert got[f"g{k}"] == [None] * 5
        else:
            want = np.quantile(np.array(pos, dtype=float), [1 / 6, 2 / 6, 3 / 6, 4 / 6, 5 / 6])
            assert np.allclose(got[f"g{k}"], want, rtol=0, atol=1e-9)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(-5, 200, allow_nan=False)), min_size=1, max_size=40))
def test_cut_right_closed_equals_searchsorted(spark, vals):
    breaks = [0, 5, 10, 20, 50, 70]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(CL.cut_right_closed("v", breaks)).collect()]
    for v, g in zip(vals, got):
        if v is None or v <= 0:
            assert g is None
        else:
            assert g == int(np.searchsorted(np.array(breaks, dtype=float), v, side="left"))


sparse_daily = st.lists(
    st.tuples(st.integers(1, 4), st.sampled_from(["A", "B"]), st.integers(0, 34), st.integers(0, 5), st.integers(0, 3)),
    min_size=1, max_size=60, unique_by=lambda t: (t[0], t[1], t[2]),
)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(sparse_daily, st.integers(0, 5))
def test_cross_sections_aggregation_form_equals_window_form(spark, rows_, pad):
    """Snapshot and change cross-sections from one aggregation of sparse daily counts equal
    the lag-window form on the densified cumulative panel (any gaps, any calendar length)."""
    from paneltide.operators import reshape as RS
    from paneltide.plans import tracker as TR

    daily = spark.createDataFrame(
        [(e, D0 + dt.timedelta(days=d), s, c, x, float(100 * e)) for e, s, d, c, x in rows_],
        "country_code long, Date date, data_source string, cases_new long, deaths_new long, pop double",
    )
    lo = D0
    hi = D0 + dt.timedelta(days=max(r[2] for r in rows_) + pad)
    bounds = spark.createDataFrame([(lo, hi)], "__lo date, __hi date")
    dense = RS.complete_calendar(daily, ["country_code", "data_source"], "Date", ["cases_new", "deaths_new"], bounds=bounds)
    dense = S.running_sum(dense.fillna(0, subset=["cases_new", "deaths_new"]), ["country_code", "data_source"], "Date",
                          {"cases_new": "cases_cum", "deaths_new": "deaths_cum"})
    as_of = bounds.select(F.col("__hi").alias("__max"))
    a = TR.snapshot_values_from_daily(daily, bounds)
    b = TR.snapshot_values(dense, as_of=as_of)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    c = TR.change_cross_from_daily(daily, bounds, (1, 7, 14)).drop("changecat", "changecatx")
    w = TR.change_series(dense, (1, 7, 14)).join(as_of, F.col("Date") == F.col("__max"), "left_semi")
    assert sorted(map(tuple, c.collect())) == sorted(map(tuple, w.select(*c.columns).collect()))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(-3, 3, allow_nan=False), st.sampled_from([-0.5, -0.1, 0.0, 0.1, 1.0, 99999.0])),
                min_size=1, max_size=40))
def test_change_classes_equal_reference_cut(spark, vals):
    cuts = [-0.5, -0.1, 0.0, 0.1, 1.0]
    df = spark.createDataFrame([(v,) for v in vals], "p double")
    got = [r[0] for r in df.select(CL.change_class_index("p")).collect()]
    for v, g in zip(vals, got):
        want = None if v is None else 1 + sum(1 for c in cuts if v > c)
        assert g == want


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(-5, 120, allow_nan=False), st.sampled_from([3.0, 10.0, 20.0, 30.0, 40.0, 60.0, 70.0])),
                min_size=1, max_size=40))
def test_coverage_bins_equal_reference(spark, vals):
    uppers = [3, 10, 20, 30, 40, 60, 70]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    lab, order = CL.coverage_bin("v")
    got = [tuple(r) for r in df.select(lab, order).collect()]
    for v, (gl, go) in zip(vals, got):
        if v is None:
            assert (gl, go) == ("No data", 0)
        else:
            k = next((i + 1 for i, u in enumerate(uppers) if v < u), 8)
            assert go == k and gl == (CL.COVERAGE_TOP if k == 8 else CL.COVERAGE_BINS[k - 1][1])


@SETTINGS
@given(st.lists(st.lists(st.integers(0, 30), min_size=1, max_size=50), min_size=1, max_size=5))
def test_sorted_quantiles_equal_percentile_exactly(spark, groups):
    rows = [(f"g{k}", float(v) / 3) for k, vals in enumerate(groups) for v in vals]
    df = spark.createDataFrame(rows, "g string, v double")
    a = {r["g"]: tuple(r[f"q{i}"] for i in range(1, 6)) for r in AG.quantile_cuts(df, ["g"], "v").collect()}
    b = {r["g"]: tuple(r[f"q{i}"] for i in range(1, 6)) for r in AG.quantile_cuts_sorted(df, ["g"], "v").collect()}
    # groups without a positive value have no histogram rows: they are absent (null cuts)
    assert {g: q for g, q in a.items() if q[0] is not None} == b


def test_ranked_quantiles_equal_percentile_over_many_partitions(spark):
    """Groups cut over several range partitions, hot values, nulls, NaN and empty groups."""
    rnd = np.random.default_rng(11)
    rows = [("big", float(v)) for v in rnd.normal(5, 40, 6000)] + [("big", 7.25)] * 3000
    rows += [("few", float(v)) for v in (1, 2, 2, 9)] + [("one", 4.0), (None, 3.0), (None, 8.0), ("none", None), ("none", -1.0), ("nan", float("nan")), ("nan", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    probs = [0.0, 1 / 6, 0.5, 0.999, 1.0]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cuts = AG.quantile_cuts(df, ["g"], "v", probs)
        got = {r[0]: tuple(r[1:]) for r in cuts.collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    v = F.when(F.col("v") > 0, F.col("v"))
    want = df.groupBy("g").agg(F.percentile(v, F.array(*map(F.lit, probs))).alias("q"))
    as_text = lambda q: str([None] * len(probs) if q is None else list(q))
    assert {g: as_text(q) for g, q in got.items()} == {r["g"]: as_text(r["q"]) for r in want.collect()}


def test_ranked_quantiles_work_no_group_in_one_task(spark):
    """The only window on the group keys sees partition counts; values are windowed by group and
    partition, and no object aggregate holds a group."""
    df = spark.createDataFrame([("a", float(i)) for i in range(500)], "grp string, v double")
    plan = AG.quantile_cuts(df, ["grp"], "v")._jdf.queryExecution().executedPlan().toString()
    windows = re.findall(r"Window \[(.*)\], \[(grp#\d+[^\]]*)\]", plan)
    assert windows and all("__part" in keys for calc, keys in windows if "__c" in calc), plan
    assert "ObjectHashAggregate" not in plan and "percentile" not in plan
