"""Wide files of any width as (ids, array of values) rows and one row of headers.

A file with a column for each day has as many columns as days.  Held as columns, every day is
an attribute, a literal and a struct of the plan, which passes code generation's limits after a
few years.  Here a row keeps its values in one array, and the headers are data: one row with an
array of labels.  Parsing, matching and sorting of labels, alignment of two files and the
increments are array functions, so the plan of a file of 4,000 days is that of one of 30.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import US_SHORT, parse_date
from ..functions.nulls import clamp_negative
from .joins import attach_row, join_null_safe


class WideTable(NamedTuple):
    """``rows``: id columns, then ``values`` (an array in header order).  ``header``: one row
    with ``labels``, the array of headers."""

    rows: DataFrame
    header: DataFrame

    @property
    def ids(self) -> list[str]:
        return [c for c in self.rows.columns if c != "values"]


def pack_columns(df: DataFrame, n_ids: int) -> WideTable:
    """A table with one column for each label, its first ``n_ids`` columns being the ids."""
    ids, labels = df.columns[:n_ids], df.columns[n_ids:]
    rows = df.toDF(*ids, *(f"__v{i}" for i in range(len(labels))))
    header = df.sparkSession.createDataFrame([(labels,)], "labels array<string>")
    return WideTable(rows.select(*ids, F.array(*(f"__v{i}" for i in range(len(labels)))).alias("values")), header)


def pack_arrays(df: DataFrame, ids: list[str], order: str, values: list[str], header: DataFrame) -> DataFrame:
    """(ids, one array for each of ``values``) from a long table that has a row for every label
    of ``header``, in the order of column ``order`` (R5).  A series' rows meet in one array, as
    long as the header; a series with another number of rows is an error."""
    got = df.groupBy(*ids).agg(F.sort_array(F.collect_list(F.struct(order, *values))).alias("__rows"))
    counted = attach_row(got, header.select(F.size("labels").alias("__n")))
    wrong = F.raise_error(F.lit("a series does not have one row for each label")).cast(got.schema["__rows"].dataType)
    whole = counted.withColumn("__rows", F.when(F.size("__rows") == F.col("__n"), F.col("__rows")).otherwise(wrong))
    return whole.select(*ids, *(F.col(f"__rows.{v}").alias(v) for v in values))


def unpivot_wide(wide: WideTable, name_col: str = "name", value_col: str = "value", drop_nulls: bool = False) -> DataFrame:
    """One row for each id row and label."""
    cells = attach_row(wide.rows, wide.header.select("labels"))
    pairs = F.arrays_zip(F.col("labels").alias(name_col), F.col("values").alias(value_col))
    out = cells.select(*wide.ids, F.inline(pairs).alias(name_col, value_col))
    return out.where(F.col(value_col).isNotNull()) if drop_nulls else out


def _places(first: WideTable, second: WideTable, date_format: str) -> DataFrame:
    """One row: the days of both headers in ascending order, labels that are no date last, and
    where either file has them (0: nowhere)."""
    both = attach_row(first.header.select(F.col("labels").alias("__a")), second.header.select(F.col("labels").alias("__b")))
    days = both.select("__a", "__b", F.array_distinct(F.concat("__a", "__b")).alias("__days"))

    def place(label: Column, i: Column) -> Column:
        day = parse_date(label, date_format)
        return F.struct(
            day.isNull().alias("odd"), day.alias("day"), i.alias("i"),
            F.array_position("__a", label).cast("int").alias("a"), F.array_position("__b", label).cast("int").alias("b"),
        )

    return days.select(F.array_sort(F.transform("__days", place)).alias("__places"))


def paired_days(
    first: WideTable,
    second: WideTable,
    names: tuple[str, str],
    new_names: tuple[str, str],
    series: list[str],
    order: list[str],
    date_col: str = "Date",
    date_format: str = US_SHORT,
    clamp: bool = True,
) -> DataFrame:
    """Two wide cumulative files as days with increments.

    The files meet in a null-safe full outer join of their ids, one row for each; a day that
    only one file has is null in the other.  Increments are taken inside the arrays; the first
    day's follows the last value of the row before it in its ``series``, by ``order`` (nulls
    last), so the window sees one row for each id row.  Result: ids, ``date_col``, both values
    (``names``) and both increments (``new_names``); negative ones are 0 with ``clamp``.
    """
    ids = first.ids
    other = second.rows.toDF(*ids, "__second")
    joined = join_null_safe(first.rows.withColumnRenamed("values", "__first"), other, ids, "full")
    placed = attach_row(joined, _places(first, second, date_format))
    at = lambda values, field: F.transform("__places", lambda p: F.get(F.col(values), p[field] - 1))
    lined = placed.select(
        *ids, F.transform("__places", lambda p: p["day"]).alias("__days"), at("__first", "a").alias("__c0"), at("__second", "b").alias("__c1")
    )
    w = Window.partitionBy(*series).orderBy(*(F.col(c).asc_nulls_last() for c in order))
    last = lambda c: F.lag(F.get(F.col(c), F.size(c) - 1)).over(w)
    carried = lined.select("*", last("__c0").alias("__l0"), last("__c1").alias("__l1"))

    def increments(c: str, before: str) -> Column:
        shifted = F.slice(F.concat(F.array(before), F.col(c)), F.lit(1), F.size(c))
        return F.zip_with(F.col(c), shifted, lambda x, y: clamp_negative(x - y) if clamp else x - y)

    with_new = carried.select(
        *ids, "__days", "__c0", "__c1", increments("__c0", "__l0").alias("__n0"), increments("__c1", "__l1").alias("__n1")
    )
    return with_new.select(*ids, F.inline(F.arrays_zip("__days", "__c0", "__c1", "__n0", "__n1")).alias(date_col, *names, *new_names))
