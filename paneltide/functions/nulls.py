"""R-style null rules expressed as Spark Columns (rules N2, N4, N5, N6, N8, N12).

R and SQL disagree on nulls in a handful of places; each helper here pins down one rule so
operators never have to reason about it inline.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of


def strict_sum(c) -> Column:
    """Aggregate sum that is null when any input is null (R ``sum`` without ``na.rm``)."""
    c = col_of(c)
    return F.when(F.count(c) == F.count(F.lit(1)), F.sum(c))


def zero_sum(c) -> Column:
    """Aggregate sum that ignores nulls and gives 0 for an all-null group (``na.rm=TRUE``)."""
    c = col_of(c)
    return F.coalesce(F.sum(c), F.lit(0))


def not_in_keep_null(c, values: Iterable) -> Column:
    """``!(x %in% values)``: R's ``%in%`` is never null, so a null ``x`` is kept."""
    c = col_of(c)
    return c.isNull() | ~c.isin(list(values))


def in_never_null(c, values: Iterable) -> Column:
    """``x %in% values`` that is false (never null) for a null ``x``."""
    c = col_of(c)
    return c.isNotNull() & c.isin(list(values))


def text_na(c) -> Column:
    """Render a value as R ``paste`` does: null becomes the text ``NA``."""
    return F.coalesce(col_of(c).cast("string"), F.lit("NA"))


def paste_na(*cols, sep: str = " ") -> Column:
    """R ``paste(..., sep=)``: nulls render as ``NA`` (``concat_ws`` would drop them).

    Strings are column names; pass literal text as ``F.lit("...")``.
    """
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(text_na(c))
    return F.concat(*parts)


def paste0_na(*cols) -> Column:
    """R ``paste0``: concatenation with no separator, nulls rendered as ``NA``."""
    return paste_na(*cols, sep="")


def num_text(c, scale: int = 1) -> Column:
    """Number -> text as R prints a value already rounded to ``scale`` decimals.

    ``12.0`` -> ``12``, ``12.5`` -> ``12.5``, null -> null.  Spark would print ``12.0`` and
    ``1.0E7``; going through a DECIMAL avoids both.  R's scientific form (``1e+05``) is not
    reproduced.
    """
    d = col_of(c).cast(f"decimal(38,{scale})").cast("string")
    return F.regexp_replace(d, r"\.?0+$" if scale > 1 else r"\.0$", "")


def num_text_grouped(c) -> Column:
    """R ``format(x, big.mark=",")`` for values with at most one decimal: ``1,234`` / ``12.5``."""
    return F.regexp_replace(F.format_number(col_of(c), 1), r"\.0$", "")


def clamp_negative(c, floor=0) -> Column:
    """``if_else(x < 0, 0, x)``: negatives become ``floor``, nulls stay null.

    ``greatest(x, 0)`` would turn a null into 0, which R does not.
    """
    c = col_of(c)
    return F.when(c < floor, F.lit(floor)).otherwise(c)


def if_else(cond: Column, yes, no) -> Column:
    """dplyr ``if_else``: a null condition yields null (``F.when`` would take ``no``)."""
    yes_c = yes if isinstance(yes, Column) else F.lit(yes)
    no_c = no if isinstance(no, Column) else F.lit(no)
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes_c).otherwise(no_c)


def fill_zero(c) -> Column:
    """``replace_na(x, 0)``."""
    return F.coalesce(col_of(c), F.lit(0))
