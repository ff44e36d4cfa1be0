"""Hand-derived golden rows per operator and per R null rule (FIXTURES.md §3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from paneltide.functions import classify as CL
from paneltide.functions import measures as M
from paneltide.functions import nulls as N
from paneltide.functions.dates import COMPACT, US_SHORT, parse_date
from paneltide.operators import aggregate as AG
from paneltide.operators import joins as J
from paneltide.operators import reshape as R
from paneltide.operators import series as S

D = dt.date


def day(i):
    return D(2020, 1, 1) + dt.timedelta(days=i)


def series(spark, values, key="k", extra=None):
    """One series ``key`` with one row per consecutive day."""
    data = [(key, day(i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "k string, date date, v long")


# ------------------------------------------------------------------ null rules


def test_strict_and_zero_sum(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1), ("b", 2), ("c", None), ("c", None)], "g string, x long")
    got = dict(rows(df.groupBy("g").agg(N.strict_sum("x").alias("s")).orderBy("g")))
    assert got == {"a": None, "b": 3, "c": None}
    got = dict(rows(df.groupBy("g").agg(N.zero_sum("x").alias("s")).orderBy("g")))
    assert got == {"a": 1, "b": 3, "c": 0}


def test_not_in_keeps_null(spark):
    df = spark.createDataFrame([("TWN",), (None,), ("AFG",)], "c string")
    got = sorted(rows(df.filter(N.not_in_keep_null("c", ["TWN"]))), key=str)
    assert got == [("AFG",), (None,)]
    # plain SQL NOT IN would lose the null row
    assert rows(df.filter(~F.col("c").isin("TWN"))) == [("AFG",)]


def test_null_safe_join_matches_null_keys(spark):
    left = spark.createDataFrame([(None, 1)], "k string, a int")
    right = spark.createDataFrame([(None, 2)], "k string, b int")
    assert rows(J.join_null_safe(left, right, ["k"], "left")) == [(None, 1, 2)]
    assert rows(J.natural_left_join(left, right)) == [(None, 1, 2)]


def test_paste_renders_null_as_na(spark):
    df = spark.createDataFrame([(None, D(2020, 1, 1))], "iso string, d date")
    assert rows(df.select(N.paste_na("iso", "d", sep="_"))) == [("NA_2020-01-01",)]


def test_paste0_with_sep_argument_appends_space(spark):
    df = spark.createDataFrame([("AFG", "WHO")], "a string, b string")
    from paneltide.plans.tracker import trajectory_columns

    assert rows(df.select(F.concat("a", "b", F.lit(" ")))) == [("AFGWHO ",)]
    t = trajectory_columns(
        spark.createDataFrame([("AFG", "WHO", 5, 100.0, 0.1, "Cases", "7 days")],
                              "country_code string, data_source string, curr_val long, pop double, perc_change double, Indicator string, periodval string")
    )
    assert rows(t, "country_code_and_data_source") == [("AFGWHO ",)]


def test_num_text(spark):
    df = spark.createDataFrame([(12.0,), (12.5,), (None,), (-0.04,)], "x double")
    assert rows(df.select(N.num_text("x"))) == [("12",), ("12.5",), (None,), ("0",)]
    df = spark.createDataFrame([(1234.0,), (1234567.5,)], "x double")
    assert rows(df.select(N.num_text_grouped("x"))) == [("1,234",), ("1,234,567.5",)]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-1,), (None,), (3,)], "x long")
    assert rows(df.select(N.clamp_negative("x"))) == [(0,), (None,), (3,)]


def test_if_else_null_condition(spark):
    df = spark.createDataFrame([(None,), (1,), (-1,)], "x long")
    assert rows(df.select(N.if_else(F.col("x") > 0, "pos", "neg"))) == [(None,), ("pos",), ("neg",)]


def test_parse_dates(spark):
    df = spark.createDataFrame([("1/22/20",), ("20200122",), ("x",)], "s string")
    got = rows(df.select(parse_date("s", US_SHORT, COMPACT)))
    assert got == [(D(2020, 1, 22),), (D(2020, 1, 22),), (None,)]


# ------------------------------------------------------------------ series windows


def test_increments_clamp_restore(spark):
    df = series(spark, [5, 7, 6, 9])
    inc = S.increments(df, ["k"], "date", {"v": "new"})
    assert rows(inc.orderBy("date"), "new") == [(None,), (2,), (-1,), (3,)]
    cl = S.increments(df, ["k"], "date", {"v": "new"}, clamp=True)
    assert rows(cl.orderBy("date"), "new") == [(None,), (2,), (0,), (3,)]
    rs = S.restore_first(cl, ["k"], "date", {"new": "v"})
    assert rows(rs.orderBy("date"), "new") == [(5,), (2,), (0,), (3,)]


def test_inc_from_cum(spark):
    df = series(spark, [5, 7, 6, 9])
    got = S.inc_from_cum(df, ["k"], "date", ["v"], 1, "_new")
    assert rows(got.orderBy("date"), "v_new") == [(5,), (2,), (-1,), (3,)]
    got = S.inc_from_cum(df, ["k"], "date", ["v"], 2, "_new")
    assert rows(got.orderBy("date"), "v_new") == [(5,), (None,), (1,), (2,)]


def test_rollout_diff_vs_inc_from_cum(spark):
    df = series(spark, [5, None, 9])
    got = S.rollout_diff(df, ["k"], "date", "v", "d")
    assert rows(got.orderBy("date"), "d") == [(5,), (None,), (9,)]
    w4 = S.inc_from_cum(df, ["k"], "date", ["v"], 1, "_new")
    assert rows(w4.orderBy("date"), "v_new") == [(5,), (None,), (None,)]


def test_lag_period_counts_and_change(spark):
    from paneltide.plans import tracker as TR

    data = [(1, day(i), "A", c, c, 1000.0) for i, c in enumerate([5, 7, 6])]
    panel = spark.createDataFrame(data, "country_code long, Date date, data_source string, cases_cum long, deaths_cum long, pop double")
    snap = TR.snapshot_values(panel, periods=(1,), at_max=False)
    got = rows(snap.filter("Indicator = 'Cases' AND Metric = 'Counts'").orderBy("Date"), "valuex")
    assert got == [(None,), (2.0,), (0.0,)]
    data = [(1, day(i), "A", c, c, 1000.0) for i, c in enumerate([1, 3, 6])]
    panel = spark.createDataFrame(data, "country_code long, Date date, data_source string, cases_cum long, deaths_cum long, pop double")
    ch = TR.change_series(panel, periods=(1,)).filter("Indicator = 'Cases'").orderBy("Date")
    assert rows(ch, "curr_val", "prev_val")[-1] == (3, 2)


def test_rolling_mean_full_window(spark):
    df = series(spark, list(range(1, 9)))
    got = S.rolling_mean(df, ["k"], "date", {"v": "m"}, 7)
    assert rows(got.orderBy("date"), "m") == [(None,)] * 6 + [(4.0,), (5.0,)]


def test_latest_ties_vs_one(spark):
    df = spark.createDataFrame([("g", day(0), 1), ("g", day(1), 2), ("g", day(1), 3)], "g string, date date, id long")
    assert len(rows(S.latest_with_ties(df, ["g"], "date"))) == 2
    one = S.latest_one(df, ["g"], [F.col("date").desc(), F.col("id").desc()])
    assert rows(one, "id") == [(3,)]


def test_fill_down_and_downup(spark):
    df = series(spark, [1, None, None, 4])
    assert rows(S.fill_down(df, ["k"], "date", ["v"]).orderBy("date"), "v") == [(1,), (1,), (1,), (4,)]
    two = spark.createDataFrame([("e", "A", None), ("e", "B", 7)], "k string, src string, v long")
    got = S.fill_downup(two, ["k"], ["src"], ["v"]).orderBy("src")
    assert rows(got, "v") == [(7,), (7,)]


def test_locf_maxgap(spark):
    vals = [None, 1, None, None, 5, None, None, None, 9]
    df = series(spark, vals)
    got = S.locf_maxgap(df, ["k"], "date", "v", "f", 2).orderBy("date")
    assert [r[0] for r in rows(got, "f")] == [None, 1, 1, 1, 5, None, None, None, 9]


def test_locf_never_changes_non_null(spark):
    import random

    rnd = random.Random(7)
    vals = [rnd.choice([None, None, rnd.randint(0, 9)]) for _ in range(60)]
    df = series(spark, vals)
    got = [r[0] for r in rows(S.locf_maxgap(df, ["k"], "date", "v", "f", 3).orderBy("date"), "f")]
    assert all(g == v for g, v in zip(got, vals) if v is not None)


def test_first_last_flags(spark):
    df = series(spark, [1, 2, 3])
    got = rows(S.first_last_flags(df, ["k"], "date").orderBy("date"), "is_first", "is_latest")
    assert got == [(True, False), (False, False), (False, True)]


def test_warmup_trim(spark):
    df = series(spark, list(range(10)))
    assert len(rows(S.warmup_trim(df, ["k"], "date", 6))) == 4


# ------------------------------------------------------------------ reshape / densify


def test_unpivot_drop_null(spark):
    df = spark.createDataFrame([("id1", 1, None)], "id string, x long, y long")
    got = rows(R.wide_to_long(df, ["id"], ["x", "y"], "name", "value", drop_nulls=True))
    assert got == [("id1", "x", 1)]
    assert len(rows(R.wide_to_long(df, 1, None, "name", "value"))) == 2


def test_long_to_wide_roundtrip_and_duplicates(spark):
    long = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3)], "k string, n string, v long")
    wide = R.long_to_wide(long, ["k"], "n", "v", ["x", "y"])
    assert sorted(rows(wide), key=str) == [("a", 1, 2), ("b", 3, None)]
    back = R.wide_to_long(wide, ["k"], ["x", "y"], "n", "v", drop_nulls=True)
    assert sorted(rows(back)) == sorted(rows(long))
    dup = spark.createDataFrame([("a", "x", 1), ("a", "x", 2)], "k string, n string, v long")
    with pytest.raises(Exception):
        R.long_to_wide(dup, ["k"], "n", "v", ["x"]).collect()


def test_complete_grid(spark):
    df = spark.createDataFrame([("e1", day(0), 1), ("e1", day(1), 2), ("e2", day(0), 3)], "e string, date date, v long")
    got = R.complete_grid(df, ["e", "date"])
    out = sorted(rows(got), key=str)
    assert len(out) == 4 and sum(r[2] is None for r in out) == 1


def test_complete_per_group_and_calendar(spark):
    df = spark.createDataFrame([("a", day(1), 1), ("a", day(3), 3), ("b", day(2), 2)], "g string, date date, v long")
    got = sorted(rows(R.complete_per_group(df, ["g"], "date", ["v"])))
    assert got == [("a", day(1), 1), ("a", day(2), None), ("a", day(3), 3), ("b", day(2), 2)]
    cal = rows(R.complete_calendar(df, ["g"], "date", ["v"]))
    assert len(cal) == 2 * 3  # groups x calendar days (product of the axes)


def test_complete_calendar_keeps_duplicate_days(spark):
    df = spark.createDataFrame([("a", day(1), 1), ("a", day(1), 5), ("a", day(3), 3)], "g string, date date, v long")
    got = sorted(rows(R.complete_calendar(df, ["g"], "date", ["v"], start="2020-01-01", end="2020-01-05")), key=str)
    assert len(got) == 6 and sorted(r[2] for r in got if r[2] is not None) == [1, 3, 5]


def test_complete_nested(spark):
    df = spark.createDataFrame([("e1", "A", 1), ("e2", "A", 2), ("e2", "B", 3)], "e string, src string, v long")
    got = sorted(rows(R.complete_nested(df, "e", ["src"])), key=str)
    assert ("e1", "B", None) in got and len(got) == 4


def test_explode_list(spark):
    df = spark.createDataFrame([("A, B ,C",)], "l string")
    assert rows(R.explode_list(df, "l", "item"), "item") == [("A",), ("B",), ("C",)]


# ------------------------------------------------------------------ measures / classes


def test_rate_per(spark):
    df = spark.createDataFrame([(5, 0.0), (5, 1000.0), (5, None)], "c long, p double")
    assert rows(df.select(M.rate_per("c", "p"))) == [(None,), (500.0,), (None,)]


def test_pct_change_and_label(spark):
    df = spark.createDataFrame([(3, 2), (3, 0), (0, 0), (0, 4)], "c long, p long")
    assert [r[0] for r in rows(df.select(M.pct_change("c", "p")))] == [0.5, 99999.0, 0.0, -1.0]
    df = spark.createDataFrame([(0.5,), (0.1234,), (99999.0,)], "p double")
    assert rows(df.select(M.pct_label("p"))) == [("50%",), ("12.3%",), ("Zero denominator",)]


def test_change_classes(spark):
    df = spark.createDataFrame([(x,) for x in [-0.5, -0.1, 0.0, 0.1, 1.0, 1.01]], "p double")
    assert [r[0] for r in rows(df.select(CL.change_class_index("p")))] == [1, 2, 3, 4, 5, 6]
    assert rows(df.select(CL.change_class_label("p")))[2] == ("decrease of 1-10%",)


def test_quantile_ladder_with_ties(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 2.0, 3.0, 3.5, 4.0, 5.0, None]], "v double")
    q = [F.lit(x) for x in (2.0, 3.0, 3.0, 4.0, 5.0)]
    got = [r[0] for r in rows(df.select(CL.quantile_class_index("v", q)))]
    assert got == [1, 2, 3, 4, 5, 6, None]


def test_quantile_classes_no_positive_value(spark):
    from paneltide.plans.tracker import quantile_classes

    df = spark.createDataFrame([("g", 0.0), ("g", 0.0)], "Indicator string, valuex double")
    got = quantile_classes(df, ["Indicator"], "valuex")
    assert rows(got, "qvals") == [("absent",), ("absent",)]


def test_quantile_cuts_match_r_type7(spark):
    df = spark.createDataFrame([("g", float(x)) for x in [0, 1, 2, 3, 4, 5, 6, 7]], "g string, v double")
    got = rows(AG.quantile_cuts(df, ["g"], "v"), "q1", "q3")
    # positive values 1..7: type-7 position (n-1)p -> 1/6 -> 2.0, 3/6 -> 4.0
    assert got == [(2.0, 4.0)]


def test_fixed_breaks_right_closed(spark):
    br = CL.BREAK_FAMILIES["rate_vaccinated"][1]
    df = spark.createDataFrame([(x,) for x in [0.0, 5.0, 5.1, 70.0, 70.1, None]], "v double")
    assert [r[0] for r in rows(df.select(CL.cut_right_closed("v", br)))] == [None, 1, 2, 5, 6, None]


def test_coverage_bins(spark):
    df = spark.createDataFrame([(None,), (2.9,), (3.0,), (70.0,)], "v double")
    lab, order = CL.coverage_bin("v")
    assert rows(df.select(lab, order)) == [("No data", 0), ("<3", 1), ("3 - <10", 2), ("70+", 8)]


def test_pct_capped(spark):
    df = spark.createDataFrame([(6.0,), (5.0,), (-0.2,), (None,)], "p double")
    assert [r[0] for r in rows(df.select(M.pct_capped("p")))] == [500.0, 500.0, -20.0, None]


def test_incidence_and_direction(spark):
    df = spark.createDataFrame([(9, 1000.0), (10, 1e6), (10, 1e5), (10, 2e4), (10, 1e4)], "c long, pop double")
    inc = df.withColumn("i", M.scaled_ratio("c", "pop", 100000))
    got = [r[0] for r in rows(inc.select(CL.incidence_class("c", "i", F.lit("Cases"), F.lit("7 days"))))]
    assert got == ["<10 Cases in past 7 days", "Low Incidence", "Moderate Incidence", "Substantial Incidence", "High Incidence"]
    df = spark.createDataFrame([(-10.0,), (-9.9,), (0.0,), (10.0,)], "p double")
    got = [r[0] for r in rows(df.select(CL.direction_class(F.lit(10), "p")))]
    assert got == ["Decreasing", "Moderate Decreasing", "Moderate Increasing", "Increasing"]


def test_titles(spark):
    df = spark.createDataFrame([("Cumulative", "Cases", "Counts"), ("7 days", "Deaths", "Rate")], "p string, i string, m string")
    got = rows(df.select(M.map_title("p", "i", "m")))
    assert got == [("Global cumulative cases of COVID-19 reported ",),
                   ("Global deaths from COVID-19 reported per 100,000 population in the past 7 days",)]


def test_legend_table(spark):
    from paneltide.plans.indicators import legend_table

    t = legend_table(spark)
    assert t.count() == 72
    got = dict(((r["raw_field"], r["cat_num"]), r["tick_value"]) for r in t.collect())
    assert got[("people_vaccinated_per_hundred", 6)] == 100
    assert got[("daily_vaccinations_per_million", 6)] == 10e4


# ------------------------------------------------------------------ remaining rules


def test_grouping_treats_null_as_value(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, x long")
    got = sorted(rows(df.groupBy("g").agg(F.sum("x"))), key=str)
    assert got == [("a", 3), (None, 3)]


def test_lags_count_rows_not_days(spark):
    # a gap day makes a row lag differ from a day lag; densifying first restores it
    df = spark.createDataFrame([("k", day(0), 1), ("k", day(2), 5)], "k string, date date, v long")
    raw = S.increments(df, ["k"], "date", {"v": "d"}).orderBy("date")
    assert rows(raw, "d") == [(None,), (4,)]
    dense = R.complete_per_group(df, ["k"], "date", ["v"])
    assert len(rows(dense)) == 3


def test_sort_nulls_last_both_directions(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", day(1), 2), ("k", day(0), 3)], "k string, date date, v long")
    asc = rows(df.select("v", F.row_number().over(S.series_window(["k"], "date")).alias("r")).orderBy("r"), "v")
    desc = rows(df.select("v", F.row_number().over(S.series_window(["k"], "date", desc=True)).alias("r")).orderBy("r"), "v")
    assert asc == [(3,), (2,), (1,)] and desc == [(2,), (3,), (1,)]


def test_promote_places_uses_overwritten_city(spark):
    from paneltide.plans.subnational import municipality_names, promote_places

    df = spark.createDataFrame(
        [("Hong Kong", "", 5, 1), ("Hubei", "Wuhan", 7, 2)], "province_en string, city_en string, province_confirmed long, city_confirmed long"
    )
    got = promote_places(df, ["Hong Kong"], pairs=[("city_confirmed", "province_confirmed")])
    assert sorted(rows(got, "city_en", "city_confirmed")) == [("Hong Kong", 5), ("Wuhan", 2)]
    m = municipality_names(spark.createDataFrame([("Beijing",), (None,)], "city_en string"))
    assert rows(m) == [("Beijing Municipality",), ("NA Municipality",)]


def test_clean_codes(spark):
    from paneltide.plans.indicators import clean_codes

    df = spark.createDataFrame([("AFG",), (None,), ("OWID_WRL",), ("OWID_KOS",)], "iso_code string")
    got = rows(clean_codes(df, recode={"OWID_KOS": "XKX"}))
    assert got == [("AFG",), ("XKX",)]


def test_dated_path_in_zone(spark):
    from paneltide.functions.dates import local_day_text
    from paneltide.sources.readers import dated_path

    df = spark.createDataFrame([(dt.datetime(2021, 3, 1, 17, 30),)], "ts timestamp")
    day_text = rows(df.select(local_day_text("ts")))[0][0]
    assert day_text == "2021.03.02"  # 17:30 UTC is the next day in Asia/Shanghai
    assert dated_path("releases/%s/area.csv", day_text) == "releases/2021.03.02/area.csv"


def test_indicator_long_on_reference_metadata(spark):
    from paneltide.plans.indicators import AGE_META, indicator_long

    wide = spark.createDataFrame(
        [("AFG", day(0), "18-24", 4.0, None), ("AFG", day(1), "18-24", 5.5, 80.0)],
        "iso_code string, date date, age_group string, people_vaccinated_per_hundred double, people_with_booster_per_hundred double",
    )
    out = indicator_long(wide, "iso_code", "date", ["people_vaccinated_per_hundred", "people_with_booster_per_hundred"], AGE_META)
    got = sorted(rows(out, "raw_field", "date", "data_cat_num", "data_field", "is_latest"))
    assert got == [
        ("people_vaccinated_per_hundred", day(0), 1, "Cumulative People Vaccinated (1 or more)", False),
        ("people_vaccinated_per_hundred", day(1), 2, "Cumulative People Vaccinated (1 or more)", True),
        ("people_with_booster_per_hundred", day(1), 6, "Cumulative People With Booster", True),
    ]


def test_column_helpers(spark):
    from paneltide.operators import columns as COL

    df = spark.createDataFrame([(1, 2, 3, 4)], "province_a long, province_b long, city_c long, d long")
    assert COL.select_range(df, "province_b", "city_c", keep=["d"]).columns == ["d", "province_b", "city_c"]
    assert COL.drop_range(df, "province_a", "province_b").columns == ["city_c", "d"]
    assert COL.rename_regex(df, "^province_", "city_").columns == ["city_a", "city_b", "city_c", "d"]
    assert COL.rename_with(df, str.upper).columns == ["PROVINCE_A", "PROVINCE_B", "CITY_C", "D"]
    assert COL.move_first(df, ["d"]).columns == ["d", "province_a", "province_b", "city_c"]
    dup = COL.duplicate_as(df, {"d": "d_legacy"})
    assert dup.columns[-1] == "d_legacy" and rows(dup, "d", "d_legacy") == [(4, 4)]


def test_quantile_classes_spill_safe_option_same_result(spark):
    from paneltide.plans.tracker import quantile_classes

    vals = [0.0, 1.0, 2.0, 2.0, 3.0, 5.0, 8.0, 13.0, None, 0.0]
    df = spark.createDataFrame([("g", v) for v in vals] + [("h", 0.0)], "Indicator string, valuex double")
    a = sorted(map(tuple, quantile_classes(df, ["Indicator"], "valuex").collect()), key=str)
    b = sorted(map(tuple, quantile_classes(df, ["Indicator"], "valuex", spill_safe=True).collect()), key=str)
    assert a == b


def test_alias_with_two_codes_fails_and_with_one_matches_once(spark):
    df = spark.createDataFrame([("Alpha ",), ("beta",)], "name string")
    one = spark.createDataFrame([("alpha", "A"), ("ALPHA*", "A"), ("gamma", "G")], "alias string, code string")
    assert sorted(rows(J.alias_join(df, "name", one, "alias", "code", "c")), key=str) == [("Alpha ", "A"), ("beta", None)]
    two = spark.createDataFrame([("alpha", "A"), (" Alpha", "B")], "alias string, code string")
    with pytest.raises(Exception, match="more than one code"):
        J.alias_join(df, "name", two, "alias", "code", "c").collect()


def test_row_lags_on_a_panel_with_gaps(spark):
    """Jan 1, 2, 3 and 20: the last row's lag of one is Jan 3, whatever lies between."""
    from paneltide.plans import tracker as TR

    panel = spark.createDataFrame(
        [("a", "S", D(2020, 1, d), c, 0, 100.0) for d, c in ((1, 1), (2, 2), (3, 5), (20, 10))],
        "country_code string, data_source string, Date date, cases_cum long, deaths_cum long, pop double",
    )
    got = rows(TR.snapshot_values(panel, periods=(1,)).where("Indicator = 'Cases' and Metric = 'Counts'"), "valuex")
    assert got == [(5.0,)]
    change = TR.period_change(panel, "cross", (1,)).where("Indicator = 'Cases'")
    assert rows(change, "curr_val", "prev_val", "prev_date") == [(5, 3, D(2020, 1, 3))]


def test_places_of_one_name_or_none_do_not_merge(spark):
    from paneltide.plans import subnational as SN

    counts = {m: 1 for m in SN.MEASURES}
    data = [(k, D(2020, 1, d), None, v) for k, v0 in ((1, 5), (2, 50)) for d, v in ((1, v0), (3, v0 + 2))]
    df = spark.createDataFrame(data, "user_id long, date date, last_update timestamp, v long").select(
        "user_id", "date", "last_update", *[F.col("v").alias(m) for m in counts]
    )
    got = SN.daily_from_snapshots(df, keys=["user_id"]).orderBy("user_id", "date")
    assert rows(got, "user_id", "city_deaths") == [(1, 5), (1, 0), (1, 2), (2, 50), (2, 0), (2, 2)]
