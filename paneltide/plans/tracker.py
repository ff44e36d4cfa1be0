"""Tracker pipeline: period snapshot with quantile map classes, and period-over-period
change with trajectory classes (A6, A7, A14).

The reference loops a parameter grid (indicator x metric x period x source, 40 passes;
indicator x period x source x mode, 24 passes) and re-sorts the panel in every pass.  Here
each grid is one pass: a single window over (entity, source) ordered by date computes every
``lag`` the grid needs as separate columns, and the grid axes are then produced by an
``inline`` of an array of structs - a narrow generator, not a union of 40 plans.

The cross-sections at the last day (snapshot, change classes) also have an aggregation
form (``*_from_daily``).  It reads sparse daily counts or raw event rows and needs no
densify and no window; see the section at the end of this module.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.classify import (
    DIRECTION_NA,
    QCLASS_ABSENT,
    QCLASS_NOT_ESTIMATED,
    change_class_code,
    change_class_index,
    change_class_label,
    direction_class,
    direction_simple,
    incidence_class,
    incidence_simple,
    quantile_class_index,
    sparse_label,
    trajectory_class,
)
from ..functions.measures import (
    CUMULATIVE_PERIOD,
    map_title,
    pct_capped,
    pct_change,
    pct_label,
    period_code,
    period_label,
    range_caption,
    rate_per,
    tab_title,
)
from ..functions.nulls import clamp_negative, fill_zero, num_text, num_text_grouped
from ..operators.aggregate import class_lower_bounds, quantile_cuts
from ..operators.joins import attach_row, checked_broadcast, join_null_safe
from ..operators.reshape import complete_nested, long_to_wide
from ..operators.series import fill_downup
from ..session import cut_lineage

# Parameter grids of the published tables.
SNAPSHOT_PERIODS = (1, 7, 14, 30, CUMULATIVE_PERIOD)
CHANGE_PERIODS = (7, 14, 30)
INDICATORS = {"Cases": "cases_cum", "Deaths": "deaths_cum"}
METRICS = {"Counts": "countsx", "Rate": "ratesx"}
SPARSE_THRESHOLD = 10

KEY, DATE, SOURCE, POP = "country_code", "Date", "data_source", "pop"


def _max_date(panel: DataFrame, as_of: DataFrame | None) -> DataFrame:
    """1-row ``(__max)``: the global max date over all sources."""
    if as_of is not None:
        return as_of.select(F.col(as_of.columns[0]).alias("__max"))
    return panel.agg(F.max(DATE).alias("__max"))


# ------------------------------------------------------------------ snapshot


def snapshot_values(
    panel: DataFrame,
    periods: Sequence[int] = SNAPSHOT_PERIODS,
    indicators: dict = INDICATORS,
    as_of: DataFrame | None = None,
    at_max: bool = True,
) -> DataFrame:
    """Counts and rates for every period at the global max date, one row per
    (entity, source, Indicator, Metric, period) (W6, W2, D1, R4, P16).

    Lags count rows of a series, whatever days it lacks.  ``at_max=False`` keeps every date.

    ``countsx = cum - lag(cum, p)`` (``p = 999`` -> ``cum``), negatives -> 0;
    ``ratesx = round(countsx / pop * 1e5, 1)`` when ``pop > 0``.
    """
    mx = _max_date(panel, as_of)
    lags = [p for p in periods if p != CUMULATIVE_PERIOD]
    w = Window.partitionBy(KEY, SOURCE).orderBy(F.col(DATE).asc_nulls_last())
    lagged = panel.select(
        KEY, SOURCE, DATE, POP,
        *[F.col(c).alias(f"__cum_{i}") for i, c in enumerate(indicators.values())],
        *[F.lag(c, p).over(w).alias(f"__lag_{i}_{p}") for i, c in enumerate(indicators.values()) for p in lags],
    )
    rows = lagged.join(F.broadcast(mx), F.col(DATE) == F.col("__max"), "left_semi") if at_max else lagged
    cells = []
    for i, ind in enumerate(indicators):
        for p in periods:
            cum = F.col(f"__cum_{i}")
            counts = cum if p == CUMULATIVE_PERIOD else cum - F.col(f"__lag_{i}_{p}")
            counts = clamp_negative(counts).cast("double")
            rates = rate_per(counts, F.col(POP), 100000, 1)
            for metric, v in (("Counts", counts), ("Rate", rates)):
                cells.append(
                    F.struct(
                        F.lit(ind).alias("Indicator"),
                        F.lit(metric).alias("Metric"),
                        F.lit(period_label(p)).alias("periodval"),
                        v.alias("valuex"),
                    )
                )
    return rows.select(KEY, SOURCE, DATE, POP, F.inline(F.array(*cells))).select(
        "Indicator", "Metric", "periodval", SOURCE, KEY, DATE, POP, "valuex"
    )


GROUP = ["Indicator", "Metric", "periodval", SOURCE]


def quantile_classes(df: DataFrame, groups: Sequence[str] = GROUP, value: str = "valuex", spill_safe: bool = False) -> DataFrame:
    """Sextile map classes and legend labels per group.

    Cut points and class bounds are per-group aggregates (partial aggregation, one row
    per group).  They are stored, counted and broadcast when small (one row per indicator x
    metric x period x source), so the rows are not shuffled on a few group keys; beyond the
    bound they meet in a sort-merge join.
    """
    groups = list(groups)
    cuts = checked_broadcast(quantile_cuts(df, groups, value, spill_safe=spill_safe))
    with_cuts = join_null_safe(df, cuts, groups, "left")
    idx = quantile_class_index(F.col(value), [F.col(f"q{i}") for i in range(1, 6)])
    classed = with_cuts.withColumn("__cls", F.when(F.col(value).isNotNull(), idx)).drop(*[f"q{i}" for i in range(1, 6)])
    bounds = checked_broadcast(class_lower_bounds(classed, groups, value, "__cls"))
    labelled = join_null_safe(classed, bounds, groups, "left")
    cls = F.col("__cls")
    qcats = (
        F.when(cls.isNull(), F.lit(QCLASS_NOT_ESTIMATED))
        .when(cls == 6, F.concat(num_text(F.col("lw6")), F.lit("+")))
        .otherwise(num_text_grouped(F.element_at(F.array(*[F.col(f"lw{k}") for k in range(2, 7)]), cls)))
    )
    qvals = F.when(cls.isNull(), F.lit(QCLASS_ABSENT)).otherwise(F.concat(F.lit("cat"), cls.cast("string")))
    return labelled.withColumn("qcats", qcats).withColumn("qvals", qvals).drop("__cls", *[f"lw{k}" for k in range(2, 7)])


def legend_bounds(snap: DataFrame, groups: Sequence[str] = GROUP, value: str = "valuex") -> DataFrame:
    """Per group: class lower bounds ``lw2..lw6`` (G8) and the six legend labels (D7):
    label k (k = 1..5) is the formatted lower bound of class k+1, label 6 is ``lw6 + "+"``."""
    groups = list(groups)
    cuts = checked_broadcast(quantile_cuts(snap, groups, value))
    with_cuts = join_null_safe(snap, cuts, groups, "left")
    idx = quantile_class_index(F.col(value), [F.col(f"q{i}") for i in range(1, 6)])
    classed = with_cuts.withColumn("__cls", F.when(F.col(value).isNotNull(), idx))
    b = class_lower_bounds(classed, groups, value, "__cls")
    labels = {f"label{k - 1}": num_text_grouped(F.col(f"lw{k}")) for k in range(2, 7)}
    labels["label6"] = F.concat(num_text(F.col("lw6")), F.lit("+"))
    return b.withColumns(labels)


def period_snapshot(
    panel: DataFrame,
    periods=SNAPSHOT_PERIODS,
    as_of: DataFrame | None = None,
    materialize: bool = True,
) -> DataFrame:
    """A6 on a cumulative panel: snapshot values + classes + titles, one row per grid cell
    and entity.

    The snapshot rows feed the cut points, the class bounds and the labelled rows; with
    ``materialize`` they are checkpointed once to the shared checkpoint folder, so the
    panel (the expensive part: scan, aggregation, densify, windows) is built once and a lost
    executor recomputes from the checkpoint.
    """
    return classify_snapshot(snapshot_values(panel, periods, INDICATORS, as_of), materialize)


def period_snapshot_from_daily(daily: DataFrame, bounds: DataFrame, periods=SNAPSHOT_PERIODS, materialize: bool = True,
                               pop: DataFrame | None = None) -> DataFrame:
    """A6 from sparse daily counts (or raw event rows + ``pop``) on a common calendar:
    one aggregation, no densify."""
    return classify_snapshot(snapshot_values_from_daily(daily, bounds, periods, pop=pop), materialize)


def classify_snapshot(snap: DataFrame, materialize: bool = True, spill_safe: bool = False) -> DataFrame:
    """Classes, legend labels and titles of snapshot rows."""
    if materialize:
        snap = cut_lineage(snap)
    classed = quantile_classes(snap, spill_safe=spill_safe).withColumn("dftype", F.lit("cross"))
    return classed.select(
        "Indicator", "Metric", "periodval", SOURCE, KEY, DATE, POP, "valuex", "dftype", "qcats", "qvals",
        map_title("periodval", "Indicator", "Metric").alias("maptitle"),
        tab_title("periodval", "Indicator", "Metric").alias("tabtitle"),
    )


def complete_snapshot(cross: DataFrame, materialize: bool = True) -> DataFrame:
    """A14 step 7-8: every entity x every observed (source, Indicator, Metric, period,
    dftype, Date) tuple (R9), down-up fill of pop and titles across sources (W14), zero
    value and "absent" class on added rows, and the period order code (D18)."""
    if materialize:
        cross = cut_lineage(cross)
    nested = [SOURCE, "Indicator", "Metric", "periodval", "dftype", DATE]
    full = complete_nested(cross, KEY, nested)
    filled = fill_downup(full, [KEY, "Indicator", "Metric", "periodval", "dftype", DATE], [SOURCE], [POP, "maptitle", "tabtitle"])
    out = filled.withColumn("valuex", F.when(F.col("qvals").isNull(), fill_zero("valuex")).otherwise(F.col("valuex"))).withColumn(
        "qvals", F.coalesce(F.col("qvals"), F.lit(QCLASS_ABSENT))
    )
    return out.select(*cross.columns, period_code(F.col("periodval")).alias("periodvalx"))


def snapshot_table(cross_complete: DataFrame) -> DataFrame:
    """A14 step 8: spread Metric into Counts / Rate columns (R5) + table title."""
    keys = ["Indicator", "periodval", SOURCE, KEY, DATE, POP, "dftype"]
    base = cross_complete.filter(F.col(KEY).isNotNull()).select(*keys, "Metric", "valuex")
    wide = long_to_wide(base, keys, "Metric", "valuex", list(METRICS))
    return wide.withColumn("tabtitlex", tab_title("periodval", "Indicator"))


# ------------------------------------------------------------------ change


def change_series(
    panel: DataFrame,
    periods: Sequence[int] = CHANGE_PERIODS,
    indicators: dict = INDICATORS,
    entity_names: DataFrame | None = None,
) -> DataFrame:
    """Period-over-period change for every row.

    ``curr = cum - lag(cum, p)``, ``prev = lag(cum, p) - lag(cum, 2p)`` (nulls -> 0), window
    dates ``lag(date, p-1)``, ``lag(date, p)``, ``lag(date, 2p-1)``.  One window pass for the
    whole grid; lags count rows of a series, whatever days it lacks.  ``entity_names``
    ``(country, country_code)`` is natural-joined (J3) before the grid multiplies the rows.
    """
    w = Window.partitionBy(KEY, SOURCE).orderBy(F.col(DATE).asc_nulls_last())
    need_date = sorted({k for p in periods for k in (p - 1, p, 2 * p - 1)})
    need_cum = sorted({k for p in periods for k in (p, 2 * p)})
    lagged = panel.select(
        KEY, SOURCE, DATE, POP,
        *[F.col(c).alias(f"__c_{i}_0") for i, c in enumerate(indicators.values())],
        *[F.lag(c, k).over(w).alias(f"__c_{i}_{k}") for i, c in enumerate(indicators.values()) for k in need_cum],
        *[(F.col(DATE) if k == 0 else F.lag(DATE, k).over(w)).alias(f"__d_{k}") for k in need_date],
    )
    cells = []
    for i, ind in enumerate(indicators):
        for p in periods:
            c0, cp, c2p = F.col(f"__c_{i}_0"), F.col(f"__c_{i}_{p}"), F.col(f"__c_{i}_{2 * p}")
            cells.append(
                F.struct(
                    F.lit(ind).alias("Indicator"),
                    F.lit(period_label(p)).alias("periodval"),
                    fill_zero(c0 - cp).alias("curr_val"),
                    fill_zero(cp - c2p).alias("prev_val"),
                    F.col(DATE).alias("curr_date"),
                    F.col(f"__d_{p - 1}").alias("curr_datex"),
                    F.col(f"__d_{p}").alias("prev_date"),
                    F.col(f"__d_{2 * p - 1}").alias("prev_datex"),
                )
            )
    name = []
    if entity_names is not None:
        lagged = join_null_safe(lagged, entity_names.select("country", KEY).distinct(), [KEY], "left")
        name = ["country"]
    long = lagged.select(KEY, SOURCE, DATE, POP, *name, F.inline(F.array(*cells)))
    change = F.col("curr_val") - F.col("prev_val")
    pc = pct_change(F.col("curr_val"), F.col("prev_val"))
    return long.select(
        "Indicator", "periodval", SOURCE, KEY, DATE, POP,
        change.alias("change_val"),
        pc.alias("perc_change"),
        pct_label(pc).alias("perc_changex"),
        "curr_val", "prev_val", "prev_date", "curr_date", "prev_datex", "curr_datex",
        range_caption(F.col("Indicator"), F.col("curr_datex"), F.col("curr_date")).alias("curr_range"),
        range_caption(F.col("Indicator"), F.col("prev_datex"), F.col("prev_date")).alias("prev_range"),
        *name,
    )


CHANGE_COLS = [
    "Indicator", "periodval", SOURCE, KEY, DATE, POP, "changecat", "changecatx",
    "change_val", "perc_change", "perc_changex", "curr_val", "prev_val",
    "prev_date", "curr_date", "prev_datex", "curr_datex", "curr_range", "prev_range", "dftype",
]


def period_change(
    panel: DataFrame,
    mode: str = "cross",
    periods: Sequence[int] = CHANGE_PERIODS,
    as_of: DataFrame | None = None,
    entity_names: DataFrame | None = None,
    indicators: dict = INDICATORS,
) -> DataFrame:
    """``cross`` = change classes at the global max date (D5); ``series`` = every date
    (classes null).  ``entity_names`` ``(country, country_code)`` is natural-joined (J3)."""
    if mode == "cross":
        mx = _max_date(panel, as_of)
        s = change_series(panel, periods, indicators, entity_names)
        s = s.join(F.broadcast(mx), F.col(DATE) == F.col("__max"), "left_semi")
        s = s.withColumn("changecat", change_class_label("perc_change")).withColumn("changecatx", change_class_code("perc_change"))
    elif mode == "series":
        s = change_series(panel, periods, indicators, entity_names)
        s = s.withColumn("changecat", F.lit(None).cast("string")).withColumn("changecatx", F.lit(None).cast("string"))
    else:
        raise ValueError(f"mode must be 'cross' or 'series', not {mode!r}")
    return s.withColumn("dftype", F.lit(mode)).select(*CHANGE_COLS, *(["country"] if entity_names is not None else []))


def trajectory_columns(df: DataFrame, daily_rate: bool = False, threshold: float = SPARSE_THRESHOLD) -> DataFrame:
    """Incidence, capped percent change and the trajectory ladders."""
    curr, ind, per = F.col("curr_val"), F.col("Indicator"), F.col("periodval")
    out = df.withColumn("incidence_7days", F.when(F.col(POP) > 0, F.try_divide(F.lit(100000.0) * curr, F.col(POP))))
    if daily_rate:
        out = out.withColumn("incidence_7days_daily", F.col("incidence_7days") / F.lit(7.0))
    out = out.withColumns(
        {"perc_change_clean": pct_capped("perc_change"), "inc_cat": incidence_class(curr, F.col("incidence_7days"), ind, per, threshold)}
    )
    out = out.withColumns(
        {
            "perc_change_cat": direction_class(curr, F.col("perc_change_clean"), threshold),
            "inc_cat_simple": incidence_simple(curr, F.col("inc_cat"), ind, per, threshold),
        }
    )
    out = out.withColumn("perc_change_cat_simple", direction_simple(F.col("perc_change_cat")))
    return out.withColumns(
        {
            "traj_cat_simple": trajectory_class(curr, F.col("inc_cat_simple"), F.col("perc_change_cat_simple"), ind, per, threshold),
            # paste0(a, b, sep = " ") appends the separator as a third piece.
            "country_code_and_data_source": F.concat(F.col(KEY).cast("string"), F.col(SOURCE), F.lit(" ")),
        }
    )


def tracker_change(
    panel: DataFrame,
    entity_names: DataFrame,
    periods: Sequence[int] = CHANGE_PERIODS,
    as_of: DataFrame | None = None,
    threshold: float = SPARSE_THRESHOLD,
) -> DataFrame:
    """A14 step 9 on a cumulative panel (see :func:`complete_change`)."""
    return complete_change(period_change(panel, "cross", periods, as_of, entity_names), threshold)


def change_cross_table(daily: DataFrame, bounds: DataFrame, entity_names: DataFrame | None = None,
                       periods: Sequence[int] = CHANGE_PERIODS, pop: DataFrame | None = None) -> DataFrame:
    """A7 cross mode from sparse daily counts (one aggregation), published columns."""
    out = change_cross_from_daily(daily, bounds, periods, pop=pop).withColumn("dftype", F.lit("cross")).select(*CHANGE_COLS)
    if entity_names is not None:
        out = join_null_safe(out, entity_names.select("country", KEY).distinct(), [KEY], "left")
    return out


def tracker_change_from_daily(daily: DataFrame, bounds: DataFrame, entity_names: DataFrame,
                              periods: Sequence[int] = CHANGE_PERIODS, threshold: float = SPARSE_THRESHOLD,
                              pop: DataFrame | None = None) -> DataFrame:
    """A14 step 9 from sparse daily counts: the cross-section is one aggregation."""
    return complete_change(change_cross_table(daily, bounds, entity_names, periods, pop), threshold)


def complete_change(cross: DataFrame, threshold: float = SPARSE_THRESHOLD, materialize: bool = True) -> DataFrame:
    """A14 step 9: cross change completed over entity x observed tuples (R9), down-up fill
    within (entity, Indicator, period, dftype, Date) (W14), nulls -> 0, sparse-count
    suppression (P21, N11) and trajectory classes (D12-D16)."""
    if materialize:
        cross = cut_lineage(cross)
    nested = [SOURCE, "Indicator", "periodval", "dftype", DATE]
    full = complete_nested(cross, KEY, nested)
    fill_cols = ["country", POP, "prev_date", "curr_date", "prev_datex", "curr_datex", "curr_range", "prev_range"]
    filled = fill_downup(full, [KEY, "Indicator", "periodval", "dftype", DATE], [SOURCE], fill_cols)
    filled = filled.withColumn("curr_val", fill_zero("curr_val")).withColumn("prev_val", fill_zero("prev_val"))
    sparse = F.col("curr_val") < threshold
    sparse_text = sparse_label(F.col("Indicator"), F.col("periodval"))
    suppressed = filled.withColumns(
        {
            "changecat": F.when(sparse, sparse_text).otherwise(F.col("changecat")),
            # ifelse() on a factor returns its integer codes (N11): published as an order code.
            "changecat_order": F.when(~sparse, change_class_index("perc_change")),
            "perc_change": F.when(~sparse, F.col("perc_change")),
            "perc_changex": F.when(sparse, F.lit(DIRECTION_NA)).otherwise(F.col("perc_changex")),
        }
    )
    cols = [c if c != "changecatx" else "changecat_order" for c in CHANGE_COLS] + ["country"]
    return trajectory_columns(suppressed.select(*cols), threshold=threshold)


def change_series_trajectory(panel: DataFrame, entity_names: DataFrame, threshold: float = SPARSE_THRESHOLD) -> DataFrame:
    """A14 step 10: 7-day case series with trajectory classes (daily incidence too)."""
    cases = {"Cases": INDICATORS["Cases"]}
    s = period_change(panel, "series", (7,), None, entity_names, cases)
    return trajectory_columns(s, daily_rate=True, threshold=threshold)


# ------------------------------------------------------------------ cross-sections from daily counts
#
# On a panel that is dense over one calendar lo..hi, the cumulative value at day d is the
# sum of the daily counts up to d, so ``cum(hi) - lag(cum, p)`` at the last day is the sum
# of the last p days, and it is null exactly when ``hi - p < lo``.  The cross-sections of A6
# and A7 therefore need no densify, sort or window over the whole history: one grouped
# aggregation of the sparse daily table (partial aggregation map-side, one shuffle on
# entity and source) gives every period at once.  Results equal the window form on the
# densified panel (checked against the SQL oracle, which uses the window form).


def _recent(x: str, days) -> Column:
    return F.sum(F.when(F.col("__d") > F.date_sub(F.col("__hi"), days), F.col(x)).otherwise(F.lit(0)))


def _daily_cross(daily: DataFrame, bounds: DataFrame, windows: dict[str, tuple[str, int]], pop: DataFrame | None = None) -> DataFrame:
    """Per (entity, source): ``name -> sum of column over the last k days`` (k None: all).

    ``daily`` may be the daily table or the raw per-event rows (counts 0/1): the sums are
    the same, and on raw rows the daily aggregation and this one fuse into a single
    aggregation with map-side combine.  ``pop`` ``(country_code, pop)`` is joined after
    the aggregation, on one row per entity and source, instead of on every input row.
    """
    staged = attach_row(daily, bounds.select("__lo", "__hi")).withColumnRenamed(DATE, "__d")
    aggs = []
    for name, (x, k) in windows.items():
        aggs.append((F.sum(F.col(x)) if k is None else _recent(x, k)).alias(name))
    if pop is None:
        return staged.groupBy(KEY, SOURCE, POP, "__lo", "__hi").agg(*aggs)
    out = staged.groupBy(KEY, SOURCE, "__lo", "__hi").agg(*aggs)
    return join_null_safe(out, pop.select(KEY, POP), [KEY], "left")


def snapshot_values_from_daily(
    daily: DataFrame,
    bounds: DataFrame,
    periods: Sequence[int] = SNAPSHOT_PERIODS,
    indicators: dict = None,
    pop: DataFrame | None = None,
) -> DataFrame:
    """A6 values at the last calendar day from sparse daily counts (same output as
    :func:`snapshot_values` on the densified cumulative panel).

    ``daily``: (country_code, Date, data_source, pop, <daily count columns>);
    ``bounds``: 1-row (``__lo``, ``__hi``) calendar of the panel.
    """
    indicators = indicators or {"Cases": "cases_new", "Deaths": "deaths_new"}
    wins = {}
    for i, x in enumerate(indicators.values()):
        wins[f"__tot_{i}"] = (x, None)
        for p in periods:
            if p != CUMULATIVE_PERIOD:
                wins[f"__r_{i}_{p}"] = (x, p)
    agg = _daily_cross(daily, bounds, wins, pop)
    cells = []
    for i, ind in enumerate(indicators):
        for p in periods:
            if p == CUMULATIVE_PERIOD:
                counts = F.col(f"__tot_{i}")
            else:
                counts = F.when(F.date_sub(F.col("__hi"), p) >= F.col("__lo"), F.col(f"__r_{i}_{p}"))
            counts = clamp_negative(counts).cast("double")
            rates = rate_per(counts, F.col(POP), 100000, 1)
            for metric, v in (("Counts", counts), ("Rate", rates)):
                cells.append(F.struct(F.lit(ind).alias("Indicator"), F.lit(metric).alias("Metric"),
                                      F.lit(period_label(p)).alias("periodval"), v.alias("valuex")))
    out = agg.select(KEY, SOURCE, F.col("__hi").alias(DATE), POP, F.inline(F.array(*cells)))
    return out.select("Indicator", "Metric", "periodval", SOURCE, KEY, DATE, POP, "valuex")


def change_cross_from_daily(
    daily: DataFrame,
    bounds: DataFrame,
    periods: Sequence[int] = CHANGE_PERIODS,
    indicators: dict = None,
    pop: DataFrame | None = None,
) -> DataFrame:
    """A7 cross-section at the last calendar day from sparse daily counts (same rows as
    :func:`change_series` on the densified panel, restricted to the last day)."""
    indicators = indicators or {"Cases": "cases_new", "Deaths": "deaths_new"}
    wins = {}
    for i, x in enumerate(indicators.values()):
        for p in periods:
            wins[f"__c_{i}_{p}"] = (x, p)
            wins[f"__c_{i}_{2 * p}"] = (x, 2 * p)
    agg = _daily_cross(daily, bounds, wins, pop)
    hi, lo = F.col("__hi"), F.col("__lo")

    def back(k):  # the date k rows before the last day, null before the calendar start
        return F.when(F.date_sub(hi, k) >= lo, F.date_sub(hi, k))

    cells = []
    for i, ind in enumerate(indicators):
        for p in periods:
            last_p = F.when(F.date_sub(hi, p) >= lo, F.col(f"__c_{i}_{p}"))
            last_2p = F.when(F.date_sub(hi, 2 * p) >= lo, F.col(f"__c_{i}_{2 * p}"))
            cells.append(F.struct(
                F.lit(ind).alias("Indicator"),
                F.lit(period_label(p)).alias("periodval"),
                fill_zero(last_p).alias("curr_val"),
                fill_zero(last_2p - last_p).alias("prev_val"),
                hi.alias("curr_date"),
                (hi if p - 1 == 0 else back(p - 1)).alias("curr_datex"),
                back(p).alias("prev_date"),
                back(2 * p - 1).alias("prev_datex"),
            ))
    long = agg.select(KEY, SOURCE, F.col("__hi").alias(DATE), POP, F.inline(F.array(*cells)))
    change = F.col("curr_val") - F.col("prev_val")
    pc = pct_change(F.col("curr_val"), F.col("prev_val"))
    out = long.select(
        "Indicator", "periodval", SOURCE, KEY, DATE, POP,
        change.alias("change_val"), pc.alias("perc_change"), pct_label(pc).alias("perc_changex"),
        "curr_val", "prev_val", "prev_date", "curr_date", "prev_datex", "curr_datex",
        range_caption(F.col("Indicator"), F.col("curr_datex"), F.col("curr_date")).alias("curr_range"),
        range_caption(F.col("Indicator"), F.col("prev_datex"), F.col("prev_date")).alias("prev_range"),
    )
    return out.withColumns({"changecat": change_class_label("perc_change"), "changecatx": change_class_code("perc_change")})
