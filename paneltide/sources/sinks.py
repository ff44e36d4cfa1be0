"""Sinks (K1-K3): tidy tables as CSV (header, null -> empty) or Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "csv", partition_by: str | None = None, mode: str = "overwrite") -> None:
    """Write one table (K1, K2).

    CSV gets a header and writes null as the empty field, as the published files do; the
    default Parquet keeps types.  ``partition_by`` splits the output by a low-cardinality
    column (e.g. Count / Rate), which later readers prune on.
    """
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    if fmt == "csv":
        w.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)
    else:
        w.format(fmt).save(path)


def write_filtered(df: DataFrame, path: str, column: str, value, fmt: str = "csv") -> None:
    """Filtered sink: one source only, or one of Count / Rate (K3)."""
    write_table(df.filter(F.col(column) == F.lit(value)), path, fmt)


def write_split(df: DataFrame, base: str, column: str, values, fmt: str = "csv") -> dict[str, str]:
    """One table per value of ``column`` (K3), e.g. counts and rates in separate files."""
    out = {}
    for v in values:
        p = f"{base.rstrip('/')}/{column}={v}"
        write_filtered(df, p, column, v, fmt)
        out[str(v)] = p
    return out


def write_days(df: DataFrame, path: str, date_col: str, order: Sequence[str] = (), fmt: str = "parquet") -> None:
    """Sorted, restartable sink: one folder a day, its rows in ``order``.

    Rows are range-partitioned by (day, order), so a day of any size is spread over tasks, and
    sorted within each file.  Only the days that ``df`` holds are replaced, at the job's commit: a
    write that fails leaves all days as they were, and a repeated one gives the same files' rows.
    """
    by = [date_col, *order]
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by)
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col)
    writer.format(fmt).save(path)
