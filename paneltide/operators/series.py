"""Per-series window operators.

Every window is ``partitionBy(series keys).orderBy(date)`` - never a global window - so the
work is spread over the series and all windows with the same keys share one exchange and
one sort.  Lags count rows, as in R: densify first (``operators.reshape``) when a row lag
must mean a day lag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import clamp_negative
from . import segments


def series_window(keys: Sequence[str], date_col: str, desc: bool = False):
    order = F.col(date_col).desc_nulls_last() if desc else F.col(date_col).asc_nulls_last()
    return Window.partitionBy(*keys).orderBy(order)


def _running(w):
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


# ------------------------------------------------------------------ differences


def increments(
    df: DataFrame, keys, date_col: str, cols: dict, clamp: bool = False, order: Sequence[str] | None = None, segment_days: int | None = None
) -> DataFrame:
    """``new = cum - lag(cum)``; first row null (W1); ``clamp`` turns negatives to 0.

    ``cols`` maps cumulative column -> output column.  ``order`` replaces the date as the
    row order (nulls last), e.g. the full sort key a preceding ``merge`` left behind.
    ``segment_days`` cuts long series into segments (``segments.py``), here and below.
    """
    if segment_days:
        if order:
            raise ValueError("segments are cut by date: give no other order")
        return segments.increments(df, keys, date_col, cols, segment_days, clamp)
    w = (
        Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
        if order
        else series_window(keys, date_col)
    )
    out = df
    for src, dst in cols.items():
        d = F.col(src) - F.lag(src).over(w)
        out = out.withColumn(dst, clamp_negative(d) if clamp else d)
    return out


def restore_first(df: DataFrame, keys, date_col: str, cols: dict) -> DataFrame:
    """On each series' first date the increment is the cumulative value itself.

    ``cols`` maps increment column -> cumulative column.
    """
    w = Window.partitionBy(*keys)
    first = F.col(date_col) == F.min(date_col).over(w)
    out = df
    for new, cum in cols.items():
        out = out.withColumn(new, F.when(first, F.col(cum).cast("long")).otherwise(F.col(new).cast("long")))
    return out


def inc_from_cum(
    df: DataFrame, keys, date_col: str, cols: Sequence[str], n: int = 1, suffix: str = "", segment_days: int | None = None
) -> DataFrame:
    """``c(x[1], (x - lag(x, n))[-1])``: first value kept, no clamp.

    For ``n > 1`` rows 2..n are null, as the shifted vector is.
    """
    if segment_days:
        if n != 1:
            raise ValueError("segments hand on one row: n must be 1")
        return segments.inc_from_cum(df, keys, date_col, cols, segment_days, suffix)
    w = series_window(keys, date_col)
    rn = F.row_number().over(w)
    out = df
    for c in cols:
        out = out.withColumn(c + suffix, F.when(rn == 1, F.col(c)).otherwise(F.col(c) - F.lag(c, n).over(w)))
    return out


def rollout_diff(df: DataFrame, keys, date_col: str, col: str, out: str) -> DataFrame:
    """``case_when(is.na(lag(x)) ~ x, TRUE ~ x - lag(x))``."""
    w = series_window(keys, date_col)
    prev = F.lag(col).over(w)
    return df.withColumn(out, F.when(prev.isNull(), F.col(col)).otherwise(F.col(col) - prev))


def running_sum(df: DataFrame, keys, date_col: str, cols: dict, segment_days: int | None = None) -> DataFrame:
    """Cumulative series from daily counts (``cumsum``); nulls add nothing."""
    if segment_days:
        return segments.running_sum(df, keys, date_col, cols, segment_days)
    w = _running(series_window(keys, date_col))
    out = df
    for src, dst in cols.items():
        out = out.withColumn(dst, F.sum(src).over(w))
    return out


def lag_columns(keys, date_col: str, col: str, lags: Sequence[int]) -> dict[int, Column]:
    """``{k: lag(col, k)}`` over one series window; k = 0 is the row itself."""
    w = series_window(keys, date_col)
    return {k: (F.col(col) if k == 0 else F.lag(col, k).over(w)) for k in sorted(set(lags))}


# ------------------------------------------------------------------ rolling / fill


def rolling_mean(df: DataFrame, keys, date_col: str, cols: dict, n: int = 7) -> DataFrame:
    """Right-aligned ``n``-row mean, null until ``n`` non-null values are in the frame."""
    w = series_window(keys, date_col).rowsBetween(-(n - 1), Window.currentRow)
    out = df
    for src, dst in cols.items():
        out = out.withColumn(dst, F.when(F.count(src).over(w) == n, F.avg(src).over(w)))
    return out


def fill_down(
    df: DataFrame, keys, date_col: str, cols: Sequence[str], order: Sequence[str] | None = None, segment_days: int | None = None
) -> DataFrame:
    """Last observation carried forward, unbounded."""
    if segment_days:
        if order:
            raise ValueError("segments are cut by date: give no other order")
        return segments.fill_down(df, keys, date_col, cols, segment_days)
    w = _running(Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in (order or [date_col])]))
    out = df
    for c in cols:
        out = out.withColumn(c, F.last(c, ignorenulls=True).over(w))
    return out


def fill_downup(df: DataFrame, keys, order: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``fill(.direction = "downup")`` within a group."""
    base = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    down = base.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    up = base.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = df
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.last(c, ignorenulls=True).over(down), F.first(c, ignorenulls=True).over(up)))
    return out


def locf_maxgap(
    df: DataFrame, keys, date_col: str, col: str, out: str, maxgap: int, segment_days: int | None = None
) -> DataFrame:
    """``zoo::na.locf(x, na.rm = FALSE, maxgap = k)``.

    A run of nulls is filled with the last value only when the run has at most ``maxgap``
    rows; longer runs stay wholly null, leading nulls stay null.  Islands: a running
    count of non-nulls numbers the runs, and a second window over (keys, run) - same
    exchange, one extra sort - measures each run.
    """
    if segment_days:
        return segments.locf_maxgap(df, keys, date_col, col, out, maxgap, segment_days)
    keys = list(keys)
    w = _running(series_window(keys, date_col))
    run_id = "__run"
    staged = df.withColumn(run_id, F.count(col).over(w)).withColumn("__carry", F.last(col, ignorenulls=True).over(w))
    wr = Window.partitionBy(*keys, run_id)
    gap = F.sum(F.when(F.col(col).isNull(), 1).otherwise(0)).over(wr)
    filled = F.when(F.col(col).isNotNull(), F.col(col)).when(gap <= maxgap, F.col("__carry"))
    return staged.withColumn(out, filled).drop(run_id, "__carry")


def warmup_trim(df: DataFrame, keys, date_col: str, days: int) -> DataFrame:
    """Keep ``date >= min(date) + days`` per group."""
    w = Window.partitionBy(*keys)
    staged = df.withColumn("__first", F.min(date_col).over(w))
    return staged.filter(F.col(date_col) >= F.date_add(F.col("__first"), days)).drop("__first")


# ------------------------------------------------------------------ latest / flags


def latest_with_ties(df: DataFrame, keys, date_col: str, non_null: str | None = None) -> DataFrame:
    """Rows on each group's latest date, ties kept (``slice_max``)."""
    src = df.filter(F.col(non_null).isNotNull()) if non_null else df
    w = Window.partitionBy(*keys).orderBy(F.col(date_col).desc_nulls_last())
    return src.withColumn("__rk", F.rank().over(w)).filter(F.col("__rk") == 1).drop("__rk")


def latest_one(df: DataFrame, keys, order: Sequence[Column]) -> DataFrame:
    """One row per group, the first in ``order`` (W12; ``arrange(desc) %>% slice(1)``).

    Give a total order (add a tiebreaker) for a deterministic pick.  Spark plans the
    ``row_number() == 1`` filter as a partial + final ``WindowGroupLimit``, so each map task
    forwards at most one row per group before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def first_last_flags(df: DataFrame, keys, date_col: str, latest: str = "is_latest", first: str = "is_first") -> DataFrame:
    """``row_number`` over date desc == 1 -> latest; == ``n()`` -> first."""
    w = Window.partitionBy(*keys).orderBy(F.col(date_col).desc_nulls_last())
    rn = F.row_number().over(w)
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return df.withColumn(latest, rn == 1).withColumn(first, rn == n)
