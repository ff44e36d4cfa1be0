"""Series longer than one task: window operators as a segmented scan.

A plain window works a whole series in one task.  Here a series is cut into segments of so many
days; rows are dealt by (series, segment).  Every segment is summed up in one row, a window over
these few rows carries what earlier (or later) segments hand on, and a window within the segment
does the rest.  No task sees more of a series than one segment, and the window over summaries
sees one row for each segment.  Results equal those of the plain operators in ``series.py``, which
call these when ``segment_days`` is given.

Rows without a date form the last segment of their series, as they come last in its order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import clamp_negative
from .joins import join_null_safe

_SEG = "__seg"


class _Scan:
    """Rows numbered within their segments, and the windows of both levels."""

    def __init__(self, df: DataFrame, keys: Sequence[str], date_col: str, days: int):
        if days < 1:
            raise ValueError("a segment has at least one day")
        self.keys, self.columns = list(keys), df.columns
        segment = F.floor(F.datediff(F.col(date_col), F.lit("1970-01-01").cast("date")) / days)
        self.own = Window.partitionBy(*self.keys, _SEG).orderBy(F.col(date_col).asc_nulls_last())
        self.running = self.own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        self.rest = self.own.rowsBetween(Window.currentRow, Window.unboundedFollowing)
        over = Window.partitionBy(*self.keys).orderBy(F.col(_SEG).asc_nulls_last())
        self.before = over.rowsBetween(Window.unboundedPreceding, -1)
        self.after = over.rowsBetween(1, Window.unboundedFollowing)
        self.segments, self.series = over, Window.partitionBy(*self.keys)
        self.rows = df.withColumn(_SEG, segment).withColumn("__at", F.row_number().over(self.own))

    def summed(self, **aggregates: Column) -> DataFrame:
        return self.rows.groupBy(*self.keys, _SEG).agg(*(a.alias(n) for n, a in aggregates.items()))

    def with_carry(self, summary: DataFrame, **carried: Column) -> DataFrame:
        """Rows beside what their segment is handed."""
        handed = summary.select(*self.keys, _SEG, *(c.alias(n) for n, c in carried.items()))
        return join_null_safe(self.rows, handed, [*self.keys, _SEG], "left")


def _at(value: Column, place: Column) -> Column:
    """The value in the row with the largest place; rows without a place do not count."""
    return F.max_by(F.struct(value.alias("v")), place)["v"]


def fill_down(df: DataFrame, keys: Sequence[str], date_col: str, cols: Sequence[str], days: int) -> DataFrame:
    """Last observation carried forward."""
    s = _Scan(df, keys, date_col, days)
    known = {c: F.when(F.col(c).isNotNull(), F.col("__at")) for c in cols}
    summary = s.summed(**{f"__last_{i}": _at(F.col(c), known[c]) for i, c in enumerate(cols)})
    carry = {f"__carry_{i}": F.last(f"__last_{i}", ignorenulls=True).over(s.before) for i in range(len(cols))}
    out = s.with_carry(summary, **carry)
    filled = {c: F.coalesce(F.last(c, ignorenulls=True).over(s.running), F.col(f"__carry_{i}")) for i, c in enumerate(cols)}
    return out.select(*(filled[c].alias(c) if c in filled else F.col(c) for c in s.columns))


def _previous(df: DataFrame, keys: Sequence[str], date_col: str, cols: Sequence[str], days: int) -> tuple[_Scan, DataFrame]:
    """Rows with ``__prev_i``, each column's value in the row before, and ``__first``, whether it
    is the series' first row."""
    s = _Scan(df, keys, date_col, days)
    summary = s.summed(**{f"__last_{i}": _at(F.col(c), F.col("__at")) for i, c in enumerate(cols)})
    carry = {f"__carry_{i}": F.lag(f"__last_{i}").over(s.segments) for i in range(len(cols))}
    out = s.with_carry(summary, __head=F.row_number().over(s.segments) == 1, **carry)
    starts = F.col("__at") == 1
    previous = {f"__prev_{i}": F.when(starts, F.col(f"__carry_{i}")).otherwise(F.lag(c).over(s.own)) for i, c in enumerate(cols)}
    return s, out.select("*", (F.col("__head") & starts).alias("__first"), *(p.alias(n) for n, p in previous.items()))


def increments(df: DataFrame, keys: Sequence[str], date_col: str, cols: dict, days: int, clamp: bool = False) -> DataFrame:
    """First differences, the first row null (W1); ``clamp`` turns negatives to 0."""
    s, out = _previous(df, keys, date_col, list(cols), days)
    gaps = [F.col(c) - F.col(f"__prev_{i}") for i, c in enumerate(cols)]
    new = [(clamp_negative(g) if clamp else g).alias(n) for g, n in zip(gaps, cols.values(), strict=True)]
    return out.select(*(c for c in s.columns if c not in cols.values()), *new)


def inc_from_cum(df: DataFrame, keys: Sequence[str], date_col: str, cols: Sequence[str], days: int, suffix: str = "") -> DataFrame:
    """First differences, the first row keeping its value."""
    s, out = _previous(df, keys, date_col, cols, days)
    new = {c + suffix: F.when(F.col("__first"), F.col(c)).otherwise(F.col(c) - F.col(f"__prev_{i}")) for i, c in enumerate(cols)}
    names = [*s.columns, *(n for n in new if n not in s.columns)]
    return out.select(*(new[c].alias(c) if c in new else F.col(c) for c in names))


def running_sum(df: DataFrame, keys: Sequence[str], date_col: str, cols: dict, days: int) -> DataFrame:
    """Running sums; nulls add nothing, and the sum is null before the first value."""
    s = _Scan(df, keys, date_col, days)
    summary = s.summed(**{f"__sum_{i}": F.sum(c) for i, c in enumerate(cols)})
    out = s.with_carry(summary, **{f"__carry_{i}": F.sum(f"__sum_{i}").over(s.before) for i in range(len(cols))})
    new = {}
    for i, (c, n) in enumerate(cols.items()):
        own, carry = F.sum(c).over(s.running), F.col(f"__carry_{i}")
        new[n] = F.coalesce(own + carry, own, carry)
    names = [*s.columns, *(n for n in new if n not in s.columns)]
    return out.select(*(new[c].alias(c) if c in new else F.col(c) for c in names))


def locf_maxgap(df: DataFrame, keys: Sequence[str], date_col: str, col: str, out: str, maxgap: int, days: int) -> DataFrame:
    """Carry forward over runs of at most ``maxgap`` nulls (W15).  A run may span segments: its
    length is the distance between the known rows around it, counted over the whole series."""
    s = _Scan(df, keys, date_col, days)
    known = F.when(F.col(col).isNotNull(), F.col("__at"))
    summary = s.summed(__n=F.count(F.lit(1)), __lo=F.min(known), __hi=F.max(known), __last=_at(F.col(col), known))
    offset = F.coalesce(F.sum("__n").over(s.before), F.lit(0))
    placed = summary.withColumn("__offset", offset).withColumn("__total", F.sum("__n").over(s.series))
    rows = s.with_carry(
        placed,
        __offset=F.col("__offset"),
        __total=F.col("__total"),
        __carry=F.last("__last", ignorenulls=True).over(s.before),
        __prev=F.last(F.col("__offset") + F.col("__hi"), ignorenulls=True).over(s.before),
        __next=F.first(F.col("__offset") + F.col("__lo"), ignorenulls=True).over(s.after),
    )
    place = F.when(F.col(col).isNotNull(), F.col("__offset") + F.col("__at"))
    before = F.coalesce(F.max(place).over(s.running), F.col("__prev"))
    after = F.coalesce(F.min(place).over(s.rest), F.col("__next"), F.col("__total") + 1)
    value = F.coalesce(F.last(col, ignorenulls=True).over(s.running), F.col("__carry"))
    filled = F.when(F.col(col).isNotNull(), F.col(col)).when(after - before - 1 <= maxgap, value)
    return rows.select(*(c for c in s.columns if c != out), filled.alias(out))
