"""Forms that hold when one series, key or axis outgrows a task: equal to the plain forms."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paneltide.operators import joins as J
from paneltide.operators import names as NM
from paneltide.operators import series as S

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
D0 = dt.date(2020, 1, 1)


def _same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    return sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


# ------------------------------------------------------------------ segmented scans


@SETTINGS
@given(
    st.lists(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(-9, 60))), min_size=1, max_size=30), min_size=1, max_size=4),
    st.sampled_from([1, 2, 3, 7, 1000]),
)
def test_segmented_scans_equal_windows(spark, series, days):
    """Gaps between rows, null values on both sides of a segment's edge, segments of one day."""
    rows = []
    for k, steps in enumerate(series):
        day = D0 + dt.timedelta(days=k)
        for step, v in steps:
            day += dt.timedelta(days=step + 1)
            rows.append((None if k == 0 else f"s{k}", day, v))
    df = spark.createDataFrame(rows, "k string, date date, v long").repartition(3)
    for run in (
        lambda **o: S.fill_down(df, ["k"], "date", ["v"], **o),
        lambda **o: S.increments(df, ["k"], "date", {"v": "new"}, **o),
        lambda **o: S.increments(df, ["k"], "date", {"v": "new"}, clamp=True, **o),
        lambda **o: S.inc_from_cum(df, ["k"], "date", ["v"], suffix="_i", **o),
        lambda **o: S.running_sum(df, ["k"], "date", {"v": "cum"}, **o),
        lambda **o: S.locf_maxgap(df, ["k"], "date", "v", "filled", 2, **o),
    ):
        assert _same(run(), run(segment_days=days))


def test_runs_of_nulls_keep_their_length_across_segments(spark):
    vals = [None, 5, None, None, None, None, 6, None, None, 7, None]
    df = spark.createDataFrame([("a", D0 + dt.timedelta(days=i), v) for i, v in enumerate(vals)], "k string, date date, v long")
    got = S.locf_maxgap(df, ["k"], "date", "v", "f", 2, segment_days=2).orderBy("date").collect()
    assert [r["f"] for r in got] == [None, 5, None, None, None, None, 6, 6, 6, 7, 7]


def test_no_window_sees_rows_of_more_than_a_segment(spark):
    df = spark.createDataFrame([("a", D0, 1)], "ser string, date date, v long")
    plan = S.fill_down(df, ["ser"], "date", ["v"], segment_days=30)._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    # the one window on the series alone reads one summary a segment
    alone = [x for x in windows if "__seg" not in x.split("], [")[1]]
    assert len(alone) == 1 and "__last_0" in alone[0], plan


def test_segments_refuse_what_they_cannot_carry(spark):
    df = spark.createDataFrame([("a", D0, 1)], "k string, date date, v long")
    with pytest.raises(ValueError):
        S.inc_from_cum(df, ["k"], "date", ["v"], n=2, segment_days=3)
    with pytest.raises(ValueError):
        S.fill_down(df, ["k"], "date", ["v"], order=["date"], segment_days=3)


# ------------------------------------------------------------------ split full outer join


def _sides(spark, n=6000):
    rnd = random.Random(3)
    left = [(None if rnd.random() < 0.4 else rnd.randrange(300), rnd.randrange(3), i) for i in range(n)]
    right = [(None, k, -k) for k in range(3)] * 2 + [(500, 0, i) for i in range(n // 3)] + [(i, i % 3, i) for i in range(200)]
    return spark.createDataFrame(left, "k int, d int, a int"), spark.createDataFrame(right, "k int, d int, b int")


@pytest.mark.parametrize("keys", [["k"], ["k", "d"]])
def test_split_join_equals_plain_join(spark, keys):
    """A null key with 40 % of the left rows, a key that only the right has, both null-safe."""
    left, right = _sides(spark)
    left, right = (x.drop("d") if keys == ["k"] else x for x in (left, right))
    want = J.join_null_safe(left, right, keys, "full")
    for options in ({}, {"least": 50}, {"least": 1, "share": 0.01}):
        assert _same(want, J.full_outer_split(left, right, keys, **options))
    empty = right.limit(0)
    assert _same(J.join_null_safe(left, empty, keys, "full"), J.full_outer_split(left, empty, keys, least=50))


def test_a_heavy_null_key_is_spread(spark):
    """With the null key holding two fifths of the rows no task of the join gets more than three
    times the median."""
    left, right = _sides(spark, 20_000)
    left, right = left.select("k", "a"), right.select("k", "b")

    def sizes(df):
        found = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        return sorted(r["count"] for r in found)

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plain = sizes(J.join_null_safe(left, right.where("k is not null or b = 0"), ["k"], "full"))
        split = sizes(J.full_outer_split(left, right.where("k is not null or b = 0"), ["k"], share=0.25, least=100))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(plain) == sum(split)
    assert plain[-1] > 3 * plain[len(plain) // 2]
    assert split[-1] <= 3 * split[len(split) // 2]


# ------------------------------------------------------------------ names inside text


def test_longest_contained_alias_wins(spark):
    aliases = [("Guinea", "GIN"), ("Guinea-Bissau", "GNB"), ("Papua New Guinea", "PNG"), ("Congo", "COG"), ("Congo, Dem. Rep.", "COD"),
               ("Côte d'Ivoire", "CIV"), ("guinea", "GIN"), ("Niger", "NER"), ("!!", "XXX"), ("South Sudan", "SSD"), ("Sudan", "SDN")]
    texts = {
        "Guinea": "GIN", "The Republic of GUINEA (West Africa)": "GIN", "guinea bissau*": "GNB", "Papua  New-Guinea": "PNG",
        "Congo Dem Rep": "COD", "Rep. of Congo": "COG", "République de côte d’ivoire": "CIV", "Nigeria": None, "Niger;": "NER",
        "Sudan and South Sudan": "SSD", "Niger, Congo": "NER", "Congo Niger": "COG", "": None, "...": None, None: None,
    }
    df = spark.createDataFrame([(i % 2, t) for i, t in enumerate(texts)] * 2, "i int, name string")
    table = spark.createDataFrame(aliases, "alias string, code string")
    got = NM.contained_alias_join(df, "name", table, "alias", "code", "iso", "matched").collect()
    assert len(got) == 2 * len(texts)
    assert {r["name"]: r["iso"] for r in got} == texts
    assert {r["matched"] for r in got if r["iso"] == "COD"} == {"congo dem rep"}
    assert NM.contained_alias_join(df, "name", table.limit(0), "alias", "code", "iso").where("iso is not null").count() == 0


def test_alias_with_two_codes_is_an_error(spark):
    table = spark.createDataFrame([("New  Land", "A"), ("new-land", "B")], "alias string, code string")
    df = spark.createDataFrame([("in new land",)], "name string")
    with pytest.raises(Exception, match="more than one code: new land"):
        NM.contained_alias_join(df, "name", table, "alias", "code", "iso").collect()


# ------------------------------------------------------------------ axes beyond one row


def test_large_axes_give_the_same_grid(spark):
    from paneltide.operators import reshape as R

    rnd = random.Random(5)
    rows = [(rnd.choice([None, 1, 2, 3, 4]), rnd.choice([None, *range(40)]), rnd.choice(["x", None, "y"]), i) for i in range(120)]
    df = spark.createDataFrame({r[:3]: r for r in rows}.values(), "e int, d int, s string, v int")
    small = R.complete_grid(df, ["e", "d", "s"])
    for most in (1, 2, 16):
        assert _same(small, R.complete_grid(df, ["e", "d", "s"], axis_rows=most))
        assert _same(R.complete_nested(df, "e", ["d", "s"]), R.complete_nested(df, "e", ["d", "s"], axis_rows=most))
    plan = R.nested_grid(df, "e", ["d", "s"], axis_rows=2)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "BroadcastHashJoin" not in plan and "CartesianProduct" not in plan


# ------------------------------------------------------------------ numbers as R writes them


def test_number_text_and_rounding_of_ties(spark):
    from paneltide.functions.numbers import number_text, round_even

    texts = {
        1e5: "1e+05", 123456.0: "123456", 1e15: "1e+15", 0.0001: "1e-04", 0.00012: "0.00012", 100.0: "100", 1e4: "10000",
        0.1 + 0.2: "0.3", 1 / 3: "0.333333333333333", 2 / 3 * 1e-5: "6.66666666666667e-06", 1234567.891: "1234567.891", -2.5: "-2.5", 0.0: "0",
        -1e5: "-1e+05", 3e5: "3e+05", 123456789012345678.0: "123456789012345680", 1e-300: "1e-300", 1.5e200: "1.5e+200",
        float("inf"): "Inf", float("-inf"): "-Inf", 110000.0: "110000", 99999.99: "99999.99", 0.1: "0.1",
    }
    df = spark.createDataFrame([(x,) for x in texts], "x double")
    assert {r[0]: r[1] for r in df.select("x", number_text("x")).collect()} == texts
    odd = spark.createDataFrame([(None,), (float("nan"),)], "x double").select(number_text("x")).collect()
    assert {r[0] for r in odd} == {None, "NaN"}
    # the text in 15 digits, which costs most, is made once for a row
    plan = df.select(number_text("x").alias("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("format_string(%.14e") == 1
    ties = [(0.15, 1, 0.1), (2.5, 0, 2.0), (3.5, 0, 4.0), (0.25, 1, 0.2), (0.35, 1, 0.3), (1e15 + 0.5, 0, 1e15), (-2.5, 0, -2.0), (-0.15, 1, -0.1),
            (2.675, 2, 2.67), (1.005, 2, 1.0), (1e300, 1, 1e300), (0.0, 1, 0.0), (7.0, 2, 7.0)]
    for x, digits, want in ties:
        assert spark.createDataFrame([(x,)], "x double").select(round_even("x", digits)).first()[0] == want, (x, digits)
