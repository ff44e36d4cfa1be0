"""Column selection and naming by position, range, function and pattern.

Wide feeds address columns by position and by ranges of names; these helpers read the
names from ``df.columns`` (the schema), never from the data, so they cost no job.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def column_range(df: DataFrame, first: str, last: str) -> list[str]:
    """Names from ``first`` to ``last`` inclusive, in schema order (R ``a:b``)."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    return cols[i: j + 1]


def select_range(df: DataFrame, first: str, last: str, keep: Sequence[str] = ()) -> DataFrame:
    """``select(keep..., a:b)``."""
    return df.select(*keep, *column_range(df, first, last))


def drop_range(df: DataFrame, first: str, last: str) -> DataFrame:
    """``select(-a:-b)``."""
    return df.drop(*column_range(df, first, last))


def rename_with(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """``rename_with(fn)`` / ``rename_all(tolower)``."""
    return df.toDF(*[fn(c) for c in df.columns])


def rename_regex(df: DataFrame, pattern: str, replacement: str) -> DataFrame:
    """``rename_with(~gsub(pattern, replacement, .x))``."""
    rx = re.compile(pattern)
    return rename_with(df, lambda c: rx.sub(replacement, c))


def move_first(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """``select(a, b, everything())`` (P5)."""
    first = list(first)
    return df.select(*first, *[c for c in df.columns if c not in first])


def duplicate_as(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep a column and add copies under other (legacy) names."""
    return df.select("*", *[F.col(f"`{src}`").alias(dst) for src, dst in mapping.items()])
