"""Date parsing and calendar helpers (S6, §2.11 date family, R12)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

# Formats seen in the sources: US short (m/d/yy), ISO, and integer yyyymmdd.
US_SHORT = "M/d/yy"
ISO = "yyyy-MM-dd"
COMPACT = "yyyyMMdd"


def parse_date(c, *formats: str) -> Column:
    """First format that parses wins; unparseable text -> null (R ``as.Date`` semantics).

    ``to_date`` under ANSI mode raises on bad text, so ``try_to_date`` is used.
    """
    c = col_of(c).cast("string")
    fmts = formats or (ISO,)
    return F.coalesce(*[F.try_to_date(c, f) for f in fmts])


def day_of(ts) -> Column:
    """Truncate a timestamp to its calendar day."""
    return F.to_date(col_of(ts))


def local_day_text(ts, zone: str = "Asia/Shanghai", fmt: str = "yyyy.MM.dd") -> Column:
    """Day of a UTC timestamp in another zone as text, e.g. a date-templated file name."""
    return F.date_format(F.from_utc_timestamp(col_of(ts), zone), fmt)


def daily_sequence(start, end) -> Column:
    """Array of every day from ``start`` to ``end`` inclusive (R ``seq(by=1)``)."""
    return F.sequence(col_of(start), col_of(end), F.expr("interval 1 day"))
