"""Registered queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

driver tables through :mod:`paneltide.sources.tables`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import classify as CL
from ..functions import nulls as N
from ..functions import numbers as number
from ..operators import aggregate as AG
from ..operators import joins as J
from ..operators import names as NM
from ..operators import reshape as R
from ..operators import series as S
from ..operators import setops as U
from ..sources import tables as T
from ..session import cut_lineage
from . import totals as TT
from . import tracker as TR

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _names(spark, sf, entity="user"):
    """(country, country_code) names of the entities, read from the one table that has them."""
    if entity == "nation":
        n = T.read_table(spark, sf, "nation")
        return n.select(F.col("n_name").alias("country"), F.col("n_nationkey").cast("long").alias("country_code"))
    c = T.read_table(spark, sf, "customer")
    return c.select(F.col("c_name").alias("country"), F.col("c_custkey").alias("country_code"))


def _as_of(bounds):
    """1-row global max date: the last day of the panel's calendar."""
    return bounds.select(F.col("__hi").alias("__max"))


# ------------------------------------------------------------------ panels and tracker


@register
def cumulative_panel(spark: SparkSession, sf: str) -> DataFrame:
    """R7 + P19 + running sums: dense (entity, source) x calendar cumulative panel."""
    return T.cumulative_panel(spark, sf)


@register
def tracker_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """A6 + A14 steps 6-8: snapshot grid, sextile classes, titles, completion, codes."""
    cross = TR.period_snapshot_from_daily(T.event_rows(spark, sf), T.event_bounds(spark, sf), pop=T.population_table(spark, sf))
    return TR.complete_snapshot(cross)


@register
def snapshot_table(spark: SparkSession, sf: str) -> DataFrame:
    """A14 step 8: completed snapshot spread to Counts / Rate columns."""
    return TR.snapshot_table(tracker_snapshot(spark, sf))


@register
def quantile_classes(spark: SparkSession, sf: str) -> DataFrame:
    """A6 output before completion (window form on the dense panel)."""
    b = T.event_bounds(spark, sf)
    panel = T.cumulative_panel(spark, sf, bounds=b)
    return TR.period_snapshot(panel, as_of=_as_of(b))


@register
def period_change(spark: SparkSession, sf: str) -> DataFrame:
    """W7, W8, D3, D4, D20 (A7 series mode): change rows for every date."""
    panel = T.cumulative_panel(spark, sf)
    return TR.period_change(panel, "series", entity_names=_names(spark, sf))


@register
def change_classes(spark: SparkSession, sf: str) -> DataFrame:
    """D5 (A7 cross mode): change classes at the latest date, from one aggregation."""
    return TR.change_cross_table(T.event_rows(spark, sf), T.event_bounds(spark, sf), _names(spark, sf),
                                 pop=T.population_table(spark, sf))


@register
def tracker_change(spark: SparkSession, sf: str) -> DataFrame:
    """A14 step 9: completed cross change + suppression + trajectory classes."""
    return TR.tracker_change_from_daily(T.event_rows(spark, sf), T.event_bounds(spark, sf), _names(spark, sf),
                                        pop=T.population_table(spark, sf))


@register
def trajectory_classes(spark: SparkSession, sf: str) -> DataFrame:
    """P21, D12-D16 on the nation-level panel (counts large enough for every class)."""
    b = T.event_bounds(spark, sf)
    panel = T.cumulative_panel(spark, sf, "nation", bounds=b)
    return TR.tracker_change(panel, _names(spark, sf, "nation"), as_of=_as_of(b))


@register
def change_classes_window(spark: SparkSession, sf: str) -> DataFrame:
    """D5 via the window form on the dense cumulative panel (cross-checks the aggregation
    form of ``change_classes``)."""
    b = T.event_bounds(spark, sf)
    panel = T.cumulative_panel(spark, sf, bounds=b)
    return TR.period_change(panel, "cross", as_of=_as_of(b), entity_names=_names(spark, sf))


@register
def change_series_trajectory(spark: SparkSession, sf: str) -> DataFrame:
    """A14 step 10: 7-day case change series with trajectory classes."""
    panel = T.cumulative_panel(spark, sf)
    return TR.change_series_trajectory(panel, _names(spark, sf))




# ------------------------------------------------------------------ the order panel (2,399 days)


@register
def gappy_panel_lags(spark: SparkSession, sf: str) -> DataFrame:
    """Row lags on a panel that lacks days: the order days of each nation and
    source as they are, cumulative, without completion."""
    d = T.order_daily(spark, sf)
    cum = S.running_sum(d, [TR.KEY, TR.SOURCE], TR.DATE, {"cases_new": "cases_cum", "deaths_new": "deaths_cum"})
    return TR.snapshot_values(cum, periods=(1, 7, 30), at_max=False)


@register
def order_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """A6 on the order panel: every period has its lag, 30 days included."""
    daily = T.order_daily(spark, sf)
    return TR.period_snapshot_from_daily(daily, T.order_bounds(spark, sf))


@register
def order_change(spark: SparkSession, sf: str) -> DataFrame:
    """A7 + A14 step 9 on the order panel, 30-day periods included."""
    daily = T.order_daily(spark, sf)
    return TR.tracker_change_from_daily(daily, T.order_bounds(spark, sf), _names(spark, sf, "nation"))


@register
def order_series_trajectory(spark: SparkSession, sf: str) -> DataFrame:
    """A14 step 10 on the dense order panel: a class for every day of 2,399."""
    panel = T.order_panel(spark, sf)
    return TR.change_series_trajectory(panel, _names(spark, sf, "nation"))


# ------------------------------------------------------------------ country totals (A2-A5)


def _frame(spark, sf, bounds=None):
    b = bounds if bounds is not None else T.event_bounds(spark, sf)
    return TT.entity_date_frame(T.nation_dim(spark, sf), b)


@register
def entity_date_frame(spark: SparkSession, sf: str) -> DataFrame:
    """Nation dimension x event calendar, with the match key."""
    return _frame(spark, sf)


@register
def country_totals(spark: SparkSession, sf: str) -> DataFrame:
    """A3 (R1, S4, J2, W1, W2, G1, J8, W3, P15, J5, J3, P19) on the wide files of all events."""
    b = T.event_bounds(spark, sf)
    cases, deaths = T.wide_arrays(spark, sf, None, b)
    return TT.panel_from_wide_cumulative(cases, deaths, _frame(spark, sf, b), T.nation_aliases(spark, sf))


@register
def country_totals_remapped(spark: SparkSession, sf: str) -> DataFrame:
    """A3 with P8: three provinces count as countries; two of them become one entity with
    nation 24's code, the third has no code and goes."""
    b = T.event_bounds(spark, sf)
    cases, deaths = T.wide_arrays(spark, sf, None, b)
    aliases = T.nation_aliases(spark, sf).unionByName(spark.createDataFrame([("International Conveyance", "24")], "alias string, iso3code string"))
    return TT.panel_from_wide_cumulative(
        cases, deaths, _frame(spark, sf, b), aliases, promote=["1", "2", "3"],
        rename={"1": "International Conveyance", "2": "International Conveyance"},
    )


@register
def country_totals_long_remapped(spark: SparkSession, sf: str) -> DataFrame:
    """A4 with S5 and P8: the date column has another header, three nations collapse into one
    name and code before G3 sums them, and one code is excluded (P12)."""
    b = T.event_bounds(spark, sf)
    feed = T.long_daily(spark, sf).withColumnRenamed("Date_reported", "X.Date")
    one = "NATION_0"
    return TT.panel_from_long_daily(
        feed, _frame(spark, sf, b), "Date_reported", drop_date=b.select("__hi"), exclude_codes=["3"],
        rename={"NATION_5": one, "NATION_10": one}, recode={one: "00"},
    )


def _long_daily_panel(spark, sf, bounds=None, source=None):
    # The last event day is treated as the incomplete "today" and dropped.
    b = bounds if bounds is not None else T.event_bounds(spark, sf)
    return TT.panel_from_long_daily(T.long_daily(spark, sf, source), _frame(spark, sf, b), "Date_reported", drop_date=b.select("__hi"))


@register
def country_totals_long(spark: SparkSession, sf: str) -> DataFrame:
    """A4 (S5, G3, G2, P15, J5, J3, P19, P17) on the long daily file of all events."""
    return _long_daily_panel(spark, sf)


@register
def stack_sources_panel(spark: SparkSession, sf: str) -> DataFrame:
    """A5 (U1, P6, P7) after the O7 clip: source A limited to source B's last date."""
    bounds = T.event_bounds(spark, sf)
    cases, deaths = T.wide_arrays(spark, sf, "A", bounds)
    a = TT.panel_from_wide_cumulative(cases, deaths, _frame(spark, sf, bounds), T.nation_aliases(spark, sf))
    b = cut_lineage(_long_daily_panel(spark, sf, bounds, "B"))
    b_max = b.agg(F.max("date").alias("__bmax"))
    a = J.attach_row(a, b_max).filter(F.col("date") <= F.col("__bmax")).drop("__bmax")
    return TT.stack_two_sources(a, b)


# ------------------------------------------------------------------ reshape / densify


def _daily_by_type(spark, sf):
    """Sparse (user_id, event_type, date, n) counts."""
    ev = T.read_table(spark, sf, "events")
    return ev.groupBy("user_id", "event_type", F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n"))


@register
def complete_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Full grid of observed user x type x source x date, counts left-joined."""
    ev = T.read_table(spark, sf, "events")
    data = ev.groupBy("user_id", "event_type", T.source_tag().alias("source"), F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return R.complete_grid(data, ["user_id", "event_type", "source", "date"], materialize=True)


@register
def complete_grid_large(spark: SparkSession, sf: str) -> DataFrame:
    """R6 beyond one row: nations x order days (2,399, in chunks of 500 at most) x order status."""
    o = T.read_table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"), "o_orderstatus")
    cust = T.read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    data = o.join(cust, o.o_custkey == cust.c_custkey, "left").groupBy("c_nationkey", "date", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return R.complete_grid(data, ["c_nationkey", "date", "o_orderstatus"], materialize=True, axis_rows=500)


@register
def complete_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Every (user, type) series over the global event calendar."""
    return R.complete_calendar(_daily_by_type(spark, sf), ["user_id", "event_type"], "date", ["n"])


@register
def complete_per_group(spark: SparkSession, sf: str) -> DataFrame:
    """Every (user, type) series over its own first..last day."""
    return R.complete_per_group(_daily_by_type(spark, sf), ["user_id", "event_type"], "date", ["n"])


@register
def complete_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Every user x every observed (source, type) tuple."""
    ev = T.read_table(spark, sf, "events")
    data = ev.groupBy("user_id", T.source_tag().alias("source"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return R.complete_nested(data, "user_id", ["source", "event_type"], materialize=True)


TYPES = ["click", "error", "purchase", "signup", "view"]


def _wide_types(spark, sf):
    return R.long_to_wide(_daily_by_type(spark, sf), ["user_id", "date"], "event_type", "n", TYPES)


@register
def long_to_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Daily counts spread to one column per event type (duplicate keys raise)."""
    return _wide_types(spark, sf)


@register
def wide_to_long(spark: SparkSession, sf: str) -> DataFrame:
    """Positional unpivot of the wide table back to long, nulls kept."""
    return R.wide_to_long(_wide_types(spark, sf), 2, None, "event_type", "n")


@register
def unpivot_drop_null(spark: SparkSession, sf: str) -> DataFrame:
    """Unpivot over a named column range, nulls dropped."""
    w = _wide_types(spark, sf)
    rng = w.columns[w.columns.index("click"): w.columns.index("view") + 1]
    return R.wide_to_long(w, ["user_id", "date"], rng, "event_type", "n", drop_nulls=True)


@register
def explode_list(spark: SparkSession, sf: str) -> DataFrame:
    """Delimited cell to trimmed rows (part names split on blanks)."""
    part = T.read_table(spark, sf, "part").select("p_partkey", "p_name")
    return R.explode_list(part, "p_name", "word", sep=" ")


# ------------------------------------------------------------------ joins / set ops


def _daily_source(spark, sf, src):
    d = T.daily_counts(spark, sf)
    return d.filter(F.col("source") == src).select("entity", "date", F.col("cases_new").alias(f"cases_{src.lower()}"))


@register
def full_outer_sources(spark: SparkSession, sf: str) -> DataFrame:
    """J2 + G1: null-safe full outer join of the two sources' daily counts."""
    j = J.full_outer_split(_daily_source(spark, sf, "A"), _daily_source(spark, sf, "B"), ["entity", "date"])
    return j.withColumns(
        {
            "total_strict": F.col("cases_a") + F.col("cases_b"),
            "total_zero": F.coalesce(F.col("cases_a"), F.lit(0)) + F.coalesce(F.col("cases_b"), F.lit(0)),
        }
    )


@register
def full_outer_hot_key(spark: SparkSession, sf: str) -> DataFrame:
    """J2 + N3: every event meets the purchases of its user, both ways; views carry no user, so
    the null key holds a third or more of all rows, and is split."""
    ev = T.read_table(spark, sf, "events")
    user = F.when(F.col("event_type") != "view", F.col("user_id")).alias("user_id")
    events = ev.select("event_id", user)
    buyers = ev.select(F.when(F.col("user_id") % 50 != 0, F.col("user_id")).alias("user_id"), "event_type", "value").groupBy("user_id").agg(
        F.count(F.when(F.col("event_type") == "purchase", 1)).alias("purchases"), F.round(F.sum("value"), 2).alias("amount")
    )
    return J.full_outer_split(events, buyers, ["user_id"])


def _nation_daily(spark, sf):
    """Daily counts of both sources together."""
    d = T.daily_counts(spark, sf, "nation").groupBy("entity", "date").agg(
        F.sum("cases_new").alias("cases_new"), F.sum("deaths_new").alias("deaths_new")
    )
    return d.select(F.col("entity").cast("string").alias("iso3code"), "date", "cases_new", "deaths_new")


@register
def frame_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """J3 + P19: natural (all shared columns) left join of the daily counts onto the frame."""
    frame = _frame(spark, sf).select("country", "date", "iso3code", "who_region", "pop_2020yr", "ou_date_match")
    return AG.numeric_null_to_zero(J.natural_left_join(frame, _nation_daily(spark, sf)))


@register
def semi_clip(spark: SparkSession, sf: str) -> DataFrame:
    """P15 + J5: frame rows inside the observed dates and nations of the daily counts."""
    b = _nation_daily(spark, sf)
    clipped = J.clip_to_range(_frame(spark, sf), "date", b, "date")
    return J.semi_join(clipped, b, ["iso3code"])


@register
def pair_semi(spark: SparkSession, sf: str) -> DataFrame:
    """R6 + J6: full grid, then keep only observed (source, indicator) pairs."""
    ev = T.read_table(spark, sf, "events")
    data = ev.groupBy("user_id", F.col("event_type").alias("indicator"), T.source_tag().alias("source"), F.to_date("ts").alias("date")).agg(
        F.count(F.lit(1)).alias("value")
    )
    data = cut_lineage(data)
    grid = R.complete_grid(data, ["user_id", "indicator", "source", "date"])
    return J.semi_join(grid, data, ["source", "indicator"])


# Fixed display labels per event type (named-vector lookup, J7).
TYPE_LABELS = {"view": "Page views", "click": "Clicks", "signup": "Sign-ups", "purchase": "Purchases", "error": "Errors"}


@register
def dim_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """J4 + J7: pruned dimension left join and a literal-map lookup."""
    d = _daily_by_type(spark, sf)
    cust = T.read_table(spark, sf, "customer")
    out = J.lookup_join(d, "user_id", cust, "c_custkey", ["c_name", "c_mktsegment"])
    return out.withColumn("label", CL.lookup("event_type", TYPE_LABELS))


# Fixed alias spellings for the name-standardisation join.
TYPE_ALIASES = [("View", "VIEW"), (" click", "CLICK"), ("Error*", "ERROR"), ("SIGNUP ", "SIGNUP"), ("purchase", "PURCHASE")]


@register
def alias_join(spark: SparkSession, sf: str) -> DataFrame:
    """Free-text names normalised (case, blanks, '*') and joined to canonical codes."""
    aliases = spark.createDataFrame(TYPE_ALIASES, "alias string, code string")
    d = _daily_by_type(spark, sf)
    return J.alias_join(d, "event_type", aliases, "alias", "code", "type_code")


@register
def contained_alias(spark: SparkSession, sf: str) -> DataFrame:
    """J8 on free text: places inside customers' descriptions; nations, regions and, where they
    stand together, nation and region are aliases, and the longest one wins."""
    cust = T.read_table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = T.read_table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = T.read_table(spark, sf, "region").select("r_regionkey", "r_name")
    place = nation.join(region, nation.n_regionkey == region.r_regionkey)
    name, odd = F.initcap(F.translate("n_name", "_", "-")), F.col("c_custkey") % 3
    text = (
        F.when(odd == 0, F.concat(F.lit("The Former "), name, F.lit(" ("), F.col("r_name"), F.lit("), "), F.col("c_mktsegment")))
        .when(odd == 1, F.concat(F.col("c_mktsegment"), F.lit(" of "), F.col("r_name"), F.lit("; rep. of*"), name))
        .otherwise(F.concat(F.col("r_name"), F.lit(" & "), F.col("c_mktsegment")))
    )
    described = cust.join(place, cust.c_nationkey == place.n_nationkey, "left").select("c_custkey", text.alias("description"))
    code = F.col("n_nationkey").cast("string")
    aliases = (
        place.select(F.col("n_name").alias("alias"), code.alias("code"))
        .unionByName(region.select(F.col("r_name").alias("alias"), F.concat(F.lit("R"), "r_regionkey").alias("code")))
        .unionByName(place.select(F.concat_ws(" ", "n_name", "r_name").alias("alias"), F.concat_ws("-", code, F.concat(F.lit("R"), "n_regionkey")).alias("code")))
    )
    return NM.contained_alias_join(described, "description", aliases, "alias", "code", "place", "matched")


@register
def stack_sources(spark: SparkSession, sf: str) -> DataFrame:
    """U1 + P6: per-source tables tagged and unioned by name, with a match key."""
    d = T.daily_counts(spark, sf)
    parts = {s: d.filter(F.col("source") == s).drop("source") for s in T.SOURCES}
    out = U.stack_sources(parts, "data_source")
    return out.withColumn("ou_date_src_match", N.paste_na("entity", "date", "data_source", sep="_"))


@register
def ragged_union(spark: SparkSession, sf: str) -> DataFrame:
    """Customers and suppliers stacked by name, missing columns null."""
    cust = T.read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nationkey"), "c_mktsegment"
    )
    supp = T.read_table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nationkey"), "s_acctbal"
    )
    return U.ragged_union(cust, supp)


# ------------------------------------------------------------------ aggregations / filters


def _calendar_counts(spark, sf):
    # the bounds come from the raw scan, so the daily aggregation runs once
    return R.complete_calendar(_daily_by_type(spark, sf), ["user_id", "event_type"], "date", ["n"], bounds=T.event_bounds(spark, sf))


@register
def strict_sum(spark: SparkSession, sf: str) -> DataFrame:
    """G1: per user-day sum over types, null when any type is missing that day."""
    return AG.group_sum(_calendar_counts(spark, sf), ["user_id", "date"], ["n"], strict=True)


@register
def zero_sum(spark: SparkSession, sf: str) -> DataFrame:
    """Per user-day sum over types, nulls ignored, all-null -> 0."""
    return AG.group_sum(_calendar_counts(spark, sf), ["user_id", "date"], ["n"], strict=False)


@register
def group_by_types(spark: SparkSession, sf: str) -> DataFrame:
    """Group by every text column, sum every numeric column."""
    o = T.read_table(spark, sf, "orders").select(
        "o_orderstatus", "o_orderpriority", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice")
    )
    return AG.group_by_types(o)


@register
def not_in_keep_null(spark: SparkSession, sf: str) -> DataFrame:
    """``!(n %in% c(1))`` keeps rows whose n is null."""
    return _calendar_counts(spark, sf).filter(N.not_in_keep_null("n", [1]))


@register
def numeric_null_to_zero(spark: SparkSession, sf: str) -> DataFrame:
    """Every numeric null to 0."""
    return AG.numeric_null_to_zero(_calendar_counts(spark, sf))


@register
def warmup_trim(spark: SparkSession, sf: str) -> DataFrame:
    """Keep days at least 6 after each series' first day."""
    return S.warmup_trim(_daily_by_type(spark, sf), ["user_id", "event_type"], "date", 6)


@register
def latest_day_only(spark: SparkSession, sf: str) -> DataFrame:
    """Rows on the global max date (max taken from the raw scan)."""
    ev = T.read_table(spark, sf, "events").select(F.to_date("ts").alias("date"))
    return J.at_global_max(_daily_by_type(spark, sf), "date", ev, "date")


# ------------------------------------------------------------------ series windows


def _balance(spark, sf):
    """Dense per-user running balance (signups/purchases +1, errors -1): it can fall."""
    ev = T.read_table(spark, sf, "events")
    delta = F.when(F.col("event_type").isin("signup", "purchase"), 1).when(F.col("event_type") == "error", -1).otherwise(0)
    daily = ev.groupBy("user_id", F.to_date("ts").alias("date")).agg(F.sum(delta).cast("long").alias("delta"))
    dense = R.complete_calendar(daily, ["user_id"], "date", ["delta"], bounds=T.event_bounds(spark, sf)).fillna(0, subset=["delta"])
    return S.running_sum(dense, ["user_id"], "date", {"delta": "cum"})


@register
def increments(spark: SparkSession, sf: str) -> DataFrame:
    """First difference of a cumulative series, first row null."""
    return S.increments(_balance(spark, sf), ["user_id"], "date", {"cum": "new"})


@register
def increments_clamped(spark: SparkSession, sf: str) -> DataFrame:
    """W1 + W2: negatives clamped to 0, nulls kept."""
    return S.increments(_balance(spark, sf), ["user_id"], "date", {"cum": "new"}, clamp=True)


@register
def restore_first(spark: SparkSession, sf: str) -> DataFrame:
    """Clamped increments with each series' first day restored to the cumulative."""
    inc = S.increments(_balance(spark, sf), ["user_id"], "date", {"cum": "new"}, clamp=True)
    return S.restore_first(inc, ["user_id"], "date", {"new": "cum"})


@register
def inc_from_cum(spark: SparkSession, sf: str) -> DataFrame:
    """Increments keeping the first value, lag 1 and lag 7, no clamp."""
    b = _balance(spark, sf)
    b = S.inc_from_cum(b, ["user_id"], "date", ["cum"], 1, "_inc1")
    return S.inc_from_cum(b, ["user_id"], "date", ["cum"], 7, "_inc7")


@register
def rollout_diff(spark: SparkSession, sf: str) -> DataFrame:
    """Value minus previous, or the value itself when the previous is null."""
    return S.rollout_diff(_calendar_counts(spark, sf), ["user_id", "event_type"], "date", "n", "daily")


@register
def period_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and rates for every period on every date (not only the last)."""
    panel = T.cumulative_panel(spark, sf)
    return TR.snapshot_values(panel, at_max=False)


@register
def rolling_mean_7(spark: SparkSession, sf: str) -> DataFrame:
    """A8 rates overlay: W9 7-row mean of D2 incidence / mortality, P18 trim, R2 unpivot."""
    from . import overlays as OV

    panel = T.cumulative_panel(spark, sf)
    names = _names(spark, sf)
    named = J.lookup_join(panel, "country_code", names, "country_code", ["country"])
    return OV.overlay_rates(named, digits=6)  # so that two engines' sums compare equal


@register
def latest_with_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Every event on the latest day of each (user, type), ties kept."""
    ev = T.read_table(spark, sf, "events").select("event_id", "user_id", "event_type", F.to_date("ts").alias("date"), "value")
    return S.latest_with_ties(ev, ["user_id", "event_type"], "date", non_null="value")


@register
def latest_one(spark: SparkSession, sf: str) -> DataFrame:
    """The single latest event of each (user, type), event id as tiebreaker."""
    ev = T.read_table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts", "value")
    return S.latest_one(ev, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()])


@register
def first_last_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Latest / first flags of each (user, type) daily series."""
    return S.first_last_flags(_daily_by_type(spark, sf), ["user_id", "event_type"], "date")


def _sparse_counts(spark, sf):
    """Every (user, type) series on the event calendar, null on days without events."""
    return R.complete_calendar(_daily_by_type(spark, sf), ["user_id", "event_type"], "date", ["n"], bounds=T.event_bounds(spark, sf))


@register
def fill_down(spark: SparkSession, sf: str) -> DataFrame:
    """Last observation carried forward without limit."""
    d = _sparse_counts(spark, sf).withColumn("filled", F.col("n"))
    return S.fill_down(d, ["user_id", "event_type"], "date", ["filled"])


@register
def fill_downup(spark: SparkSession, sf: str) -> DataFrame:
    """Fill down, then up, within each user and type."""
    d = _sparse_counts(spark, sf).withColumn("filled", F.col("n"))
    return S.fill_downup(d, ["user_id", "event_type"], ["date"], ["filled"])


@register
def locf_maxgap(spark: SparkSession, sf: str) -> DataFrame:
    """Carry forward only across null runs of at most 2 rows."""
    return S.locf_maxgap(_sparse_counts(spark, sf), ["user_id", "event_type"], "date", "n", "carry_fwd_value", 2)


_ORDER_SERIES = ["country_code", "data_source"]


def _order_days(spark, sf):
    """Orders per nation, source and day on the whole order calendar of 2,399 days, null where none."""
    daily = T.order_daily(spark, sf).select(*_ORDER_SERIES, "Date", F.col("cases_new").alias("n"))
    return R.complete_calendar(daily, _ORDER_SERIES, "Date", ["n"], bounds=T.order_bounds(spark, sf))


@register
def fill_down_segmented(spark: SparkSession, sf: str) -> DataFrame:
    """W13 as a segmented scan: each series of 2,399 days in segments of 30."""
    d = _order_days(spark, sf).withColumn("filled", F.col("n"))
    return S.fill_down(d, _ORDER_SERIES, "Date", ["filled"], segment_days=30)


@register
def increments_segmented(spark: SparkSession, sf: str) -> DataFrame:
    """W1 and W4 on running sums (W13's carry-in is a sum), in segments of 30 days."""
    cum = S.running_sum(_order_days(spark, sf), _ORDER_SERIES, "Date", {"n": "cum"}, segment_days=30)
    both = S.increments(cum, _ORDER_SERIES, "Date", {"cum": "new"}, segment_days=30)
    return S.inc_from_cum(both, _ORDER_SERIES, "Date", ["cum"], suffix="_back", segment_days=30)


@register
def locf_maxgap_segmented(spark: SparkSession, sf: str) -> DataFrame:
    """W15 in segments of 30 days: runs of nulls that span segments keep their length."""
    return S.locf_maxgap(_order_days(spark, sf), _ORDER_SERIES, "Date", "n", "carry_fwd_value", 2, segment_days=30)


# ------------------------------------------------------------------ classification


@register
def number_text(spark: SparkSession, sf: str) -> DataFrame:
    """N8 + N7: order prices over nine powers of ten as R writes them, and rounded half to even."""
    o = T.read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    # every second price is a round number, so that short scientific forms occur
    base = F.when(F.col("o_orderkey") % 2 == 0, F.round(F.col("o_totalprice"), -3)).otherwise(F.col("o_totalprice"))
    x = base.cast("double") * F.col("p")
    powers = F.array(*[F.lit(float(f"1e{k}")) for k in range(-8, 9, 2)])
    out = o.select("*", F.explode(powers).alias("p")).withColumn("x", x)
    return out.select("o_orderkey", "p", number.number_text("x").alias("text"), number.round_even("x", 1).alias("rounded"))


@register
def fixed_break_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Right-closed fixed-break bins of every family applied to order prices."""
    o = T.read_table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("value"))
    cells = [
        F.struct(F.lit(fam).alias("family"), CL.cut_right_closed(F.col("value"), br).alias("data_cat_num"))
        for fam, (_, br, _) in CL.BREAK_FAMILIES.items()
    ]
    out = o.select("o_orderkey", "value", F.inline(F.array(*cells)))
    return out.withColumn("data_cat", F.when(F.col("data_cat_num").isNotNull(), F.concat(F.lit("cat "), F.col("data_cat_num").cast("string"))))


@register
def coverage_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Coverage label and order code (part size x 2 as a percentage)."""
    p = T.read_table(spark, sf, "part").select("p_partkey", (F.col("p_size") * 2).cast("double").alias("pct"))
    label, order = CL.coverage_bin("pct")
    return p.select("p_partkey", "pct", label.alias("pct_bin"), order.alias("pct_binorder"))


@register
def dimension_codes(spark: SparkSession, sf: str) -> DataFrame:
    """A15 second dimension from the nations' attributes: defaults where one is missing,
    display order codes (D17), plus the literal "Other" row (S9, U2)."""
    from . import dashboard as DB

    return DB.entity_dimension(T.nation_attributes(spark, sf))


@register
def cases_deaths(spark: SparkSession, sf: str) -> DataFrame:
    """A15 / A8 cases and deaths: relabel by source, id from the dimension, match key."""
    from . import dashboard as DB

    dim = T.nation_dim(spark, sf).select(F.col("iso3code").alias("__k"), "iso2code", F.col("country").alias("__name"))
    daily = T.daily_counts(spark, sf, "nation")
    named = daily.join(dim, daily["entity"].cast("string") == F.col("__k"), "left")
    # stand-ins for the places that carry their source, and for "Other"
    name = CL.lookup("__name", {"NATION_1": "China", "NATION_2": "Hong Kong", "NATION_3": "Taiwan", "NATION_4": "Macau", "NATION_5": "Other"})
    panel = named.select(
        F.coalesce(name, "__name").alias("country"), "iso2code", "date",
        F.when(F.col("source") == "A", "JHU").otherwise("WHO").alias("source"), "cases_new", "deaths_new",
    )
    return DB.cases_deaths(panel, DB.entity_dimension(T.nation_attributes(spark, sf)))


# ------------------------------------------------------------------ subnational snapshots


# Event types behind the counts that an update carries.
_PLACE_COUNTS = {"city_confirmed": T.CASE_TYPES, "city_suspected": ["signup"], "city_recovered": ["purchase"], "city_deaths": T.DEATH_TYPES}


def _snapshots(spark, sf):
    """Events as intra-day updates of a place (user within nation within region): per user and
    day the latest update's time and the cumulative counts through that day.

    One scan and one aggregation give both the day's counts and its latest update (the largest
    time and event id, combined map-side), then a running sum over at most one row per day; a
    place with a third of all updates is spread over every map task.
    """
    from pyspark.sql import Window

    ev = T.read_table(spark, sf, "events")
    daily = ev.groupBy("user_id", F.to_date("ts").alias("date")).agg(
        F.max(F.struct("ts", "event_id")).alias("__latest"),
        *[F.count(F.when(F.col("event_type").isin(v), 1)).alias(k) for k, v in _PLACE_COUNTS.items()],
    )
    w = Window.partitionBy("user_id").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.select("user_id", "date", F.col("__latest.ts").alias("last_update"), *[F.sum(k).over(w).alias(k) for k in _PLACE_COUNTS])


def _places(spark, sf):
    cust = T.read_table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = T.read_table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = T.read_table(spark, sf, "region").select("r_regionkey", "r_name")
    return (
        cust.join(nation, cust.c_nationkey == nation.n_nationkey, "left")
        .join(region, nation.n_regionkey == region.r_regionkey, "left")
        .select(F.col("c_custkey").alias("user_id"), F.col("r_name").alias("country"), F.col("n_name").alias("province_en"), F.col("c_name").alias("city_en"))
    )


@register
def snapshot_cumulative(spark: SparkSession, sf: str) -> DataFrame:
    """A16 output 1 (W12): latest update per place and day with cumulative counts."""
    named = _snapshots(spark, sf).join(_places(spark, sf), "user_id", "left")
    return named.select("date", "last_update", "country", "province_en", "city_en", *_PLACE_COUNTS)


@register
def snapshot_to_daily(spark: SparkSession, sf: str) -> DataFrame:
    """A16 output 2 (W12 -> R8 -> W13 -> W4): per-place days, filled down, increments.

    Places are told apart by user id; names are attached last, so places of one name, or
    without one, never merge.  The country stays null on added days, as the update time does."""
    from . import subnational as SN

    daily = SN.daily_from_snapshots(_snapshots(spark, sf), keys=["user_id"]).join(_places(spark, sf), "user_id", "left")
    country = F.when(F.col("last_update").isNotNull(), F.col("country")).alias("country")
    return daily.select("date", "last_update", country, "province_en", "city_en", *_PLACE_COUNTS)


@register
def subnational_full(spark: SparkSession, sf: str) -> DataFrame:
    """A16 with its first-pass filters and both branches (P9, P10, P12, N5, U2, W12): every event
    is an update of a city (customer) in a province (nation) of a country (region)."""
    from . import subnational as SN

    ev = T.read_table(spark, sf, "events").select("event_id", "ts", "user_id", F.col("value").alias("v"), "event_type")
    city = {m: F.when(F.col("event_type").isin(t), F.col("event_id")).otherwise(0).cast("long") for m, t in _PLACE_COUNTS.items()}
    counts = [x for m, c in city.items() for x in (c.alias(m), (c + F.col("c_nationkey")).alias(m.replace("city_", "province_", 1)))]
    places = T.read_table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("long").alias("c_nationkey"), "c_mktsegment")
    updates = ev.join(places, "user_id", "left").join(_places(spark, sf), "user_id", "left").select(
        "ts", "event_id", "country", "province_en",
        F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("city_en")).alias("city_en"), *counts,
    )
    return SN.subnational_updates(updates, "ASIA", ["NATION_2", "NATION_7"], ["NATION_12", "NATION_17"], tiebreak="event_id")


# ------------------------------------------------------------------ indicator tables


def _amounts_wide(spark, sf):
    """Wide per (user, day): one amount column per event type (null when none that day)."""
    ev = T.read_table(spark, sf, "events")
    d = ev.groupBy("user_id", F.to_date("ts").alias("date"), "event_type").agg(F.round(F.sum("value"), 2).alias("v"))
    return R.long_to_wide(d, ["user_id", "date"], "event_type", "v", TYPES)


# Binding of the event types onto indicator metadata and one break family.
TYPE_META = {t: (TYPE_LABELS[t], " ", "Count") for t in TYPES}
TYPE_FAMILIES = {"count_daily": (TYPES, CL.BREAK_FAMILIES["count_daily"][1], CL.BREAK_FAMILIES["count_daily"][2])}


@register
def indicator_long(spark: SparkSession, sf: str) -> DataFrame:
    """A9 ``all`` (R3, W10, J7, D10, D8): gathered indicators with flags, labels and bins."""
    from . import indicators as IND

    return IND.indicator_long(_amounts_wide(spark, sf), "user_id", "date", TYPES, TYPE_META, TYPE_FAMILIES)


@register
def rollout(spark: SparkSession, sf: str) -> DataFrame:
    """A9 ``rollout`` (P13, P14, W5, J4): per (location, product) daily from running totals; some
    events name no place or an aggregate one, and those go.  A place has its customer's code."""
    from pyspark.sql import Window

    from . import indicators as IND

    u = F.col("user_id") % 40
    place = F.when(u == 0, F.lit(None)).when(u == 1, "Wales").when(u == 2, "European Union").when(u == 3, "").otherwise(F.col("user_id").cast("string"))
    ev = T.read_table(spark, sf, "events")
    d = ev.groupBy(place.alias("location"), F.col("event_type").alias("vaccine"), F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("location", "vaccine").orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    man = d.select("location", "vaccine", "date", F.sum("n").over(w).alias("total_vaccinations"))
    cust = T.read_table(spark, sf, "customer")
    codes = cust.select(F.col("c_custkey").cast("string").alias("location"), F.col("c_nationkey").cast("string").alias("iso_code"))
    return IND.rollout(man, codes=codes)


@register
def ages_long(spark: SparkSession, sf: str) -> DataFrame:
    """A9 ``ages`` (R10, J7, R3, W10, D10, D8): nation and order priority as entity and age group,
    with the published age metadata."""
    from . import indicators as IND

    o = T.read_table(spark, sf, "orders").select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    cust = T.read_table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("iso_code"))
    price = F.col("o_totalprice")
    names = T.read_table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("iso_code"), F.col("n_name").alias("location"))
    ages = o.join(cust, o.o_custkey == cust.c_custkey, "left").groupBy(
        "iso_code", F.col("o_orderpriority").alias("age_group"), F.to_date("o_orderdate").alias("date")
    ).agg(
        F.max(F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("place "), "iso_code"))).alias("location"),
        (F.max(price) / 5000).alias("people_vaccinated_per_hundred"),
        (F.min(price) / 20000).alias("people_fully_vaccinated_per_hundred"),
        F.when(F.count(F.lit(1)) > 1, F.min(price) / 50000).alias("people_with_booster_per_hundred"),
    )
    return IND.ages_long(ages, names, bounds=T.order_bounds(spark, sf))


@register
def manufacturers(spark: SparkSession, sf: str) -> DataFrame:
    """A9 ``manufacturers`` (P13, P8, P14, R11): rows with a real place code, one manufacturer
    each; a part's brand is its place, its name the list."""
    from . import indicators as IND

    p = T.read_table(spark, sf, "part")
    code = F.when(F.col("p_size") == 9, F.lit(None)).when(F.col("p_size") == 7, "OWID_KOS").when(F.col("p_size") % 10 == 0, "OWID_WRL").otherwise(F.col("p_brand"))
    loc = p.select("p_partkey", code.alias("iso_code"), F.replace("p_name", F.lit(" "), F.lit(", ")).alias("vaccine_manufacturer_list"))
    return IND.manufacturers(IND.clean_codes(loc, recode={"OWID_KOS": "XKX"}))


# ------------------------------------------------------------------ hospital


def _hospital(spark, sf):
    from . import hospital as H

    return H.combine(*T.hospital_feeds(spark, sf))


@register
def hospital_latest(spark: SparkSession, sf: str) -> DataFrame:
    """A10 + A11 (U2, P6, W11): combined sources, latest non-null row(s) per series."""
    from . import hospital as H

    return H.latest(_hospital(spark, sf))


@register
def hospital_fill(spark: SparkSession, sf: str) -> DataFrame:
    """A12 (R6, W15 maxgap 14, J6): completed grid, gap-limited carry-forward."""
    from . import hospital as H

    return H.fill(_hospital(spark, sf), 14)


# ------------------------------------------------------------------ overlays / dashboard


@register
def overlay_policy(spark: SparkSession, sf: str) -> DataFrame:
    """A8 policy index (P4, P10, S3 int yyyymmdd dates, N5 key): orders as a national /
    sub-national index feed with mixed-case headers."""
    from . import overlays as OV

    raw = T.policy_feed(spark, sf)
    return OV.overlay_policy(raw)


@register
def vax_wide(spark: SparkSession, sf: str) -> DataFrame:
    """A15 wide indicator table: complete(id, date = calendar) (R7), carry every indicator
    forward (W16), coverage bins and order codes on two indicators (D11)."""
    wide = R.long_to_wide(_daily_by_type(spark, sf), ["user_id", "date"], "event_type", "n", TYPES)
    dense = R.complete_calendar(wide, ["user_id"], "date", TYPES, bounds=T.event_bounds(spark, sf))
    filled = S.fill_down(dense, ["user_id"], "date", TYPES)
    vb, vo = CL.coverage_bin("view")
    cb, co = CL.coverage_bin("click")
    return filled.withColumns({"view_bin": vb, "view_binorder": vo, "click_bin": cb, "click_binorder": co})


# ------------------------------------------------------------------ named views of the tracker grid


@register
def period_rates(spark: SparkSession, sf: str) -> DataFrame:
    """Rates per 100k for every period on every date (null when pop <= 0)."""
    return period_counts(spark, sf).filter(F.col("Metric") == "Rate")


@register
def change_labels(spark: SparkSession, sf: str) -> DataFrame:
    """D4 + D20: percent-change labels and the current / previous date-range captions."""
    return period_change(spark, sf).select(
        "Indicator", "periodval", "data_source", "country_code", "Date", "perc_changex", "curr_range", "prev_range"
    )


@register
def legend_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """G8 + D7: per-group class lower bounds with fallbacks, and the legend labels."""
    snap = TR.snapshot_values_from_daily(T.event_rows(spark, sf), T.event_bounds(spark, sf), pop=T.population_table(spark, sf))
    return TR.legend_bounds(cut_lineage(snap))


@register
def titles_and_codes(spark: SparkSession, sf: str) -> DataFrame:
    """D18 + D19: the title and period code of every grid cell present in the snapshot."""
    return tracker_snapshot(spark, sf).select("Indicator", "Metric", "periodval", "periodvalx", "maptitle", "tabtitle").distinct()


@register
def suppress_sparse(spark: SparkSession, sf: str) -> DataFrame:
    """P21 + N11 on the nation panel: below 10 counts the class becomes the sparse text,
    the ratio is nulled, the label is "N/A" and the order code is null."""
    return trajectory_classes(spark, sf).select(
        "Indicator", "periodval", "data_source", "country_code", "Date", "curr_val",
        "changecat", "changecat_order", "perc_change", "perc_changex",
    )
