"""Derived measures, labels and titles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of
from .nulls import num_text, text_na

# ---------------------------------------------------------------------------------------
# Published sentinels, labels and period codes.
# ---------------------------------------------------------------------------------------
ZERO_DENOMINATOR_SENTINEL = 99999.0
ZERO_DENOMINATOR_LABEL = "Zero denominator"
CUMULATIVE_PERIOD = 999
PERIOD_CODES = {"24 hours": "x1", "7 days": "x2", "14 days": "x3", "30 days": "x4", "Cumulative": "x5"}
PCT_CAP = 5  # percent change is capped at 5 (= 500%) for trajectory classes
# Title fragments of the published map and table titles.
TITLE = {
    "map_cumulative": "Global cumulative ",
    "map_period": "Global ",
    "map_cases": "cases of ",
    "map_deaths": "deaths from ",
    "map_subject": "COVID-19 reported ",
    "rate": "per 100,000 population ",
    "past": "in the past ",
    "tab_cumulative": "Cumulative ",
    "tab_cases": "Cases reported ",
    "tab_deaths": "Deaths reported ",
    "caption_middle": " reported from ",
    "caption_to": " to ",
}
# ---------------------------------------------------------------------------------------


def rate_per(count, pop, per: float = 100000, digits: int | None = 1) -> Column:
    """``if_else(pop > 0, round(count / pop * per, digits), NA)``.

    A null or non-positive population gives null; ``try_divide`` keeps ANSI mode from
    raising on a zero denominator.
    """
    count, pop = col_of(count), col_of(pop)
    r = F.try_divide(count.cast("double"), pop.cast("double")) * F.lit(float(per))
    if digits is not None:
        r = F.round(r, digits)
    return F.when(pop > 0, r)


def scaled_ratio(num, den, per: float) -> Column:
    """``per * num / den`` without rounding (D2, D12); null when den is 0 or null."""
    return F.try_divide(F.lit(float(per)) * col_of(num).cast("double"), col_of(den).cast("double"))


def pct_change(curr, prev) -> Column:
    """(D3) prev > 0 -> (curr - prev) / prev; else change > 0 -> 99999; else 0."""
    curr, prev = col_of(curr), col_of(prev)
    change = curr - prev
    return (
        F.when(prev > 0, F.try_divide(change.cast("double"), prev.cast("double")))
        .when(change > 0, F.lit(ZERO_DENOMINATOR_SENTINEL))
        .otherwise(F.lit(0.0))
    )


def pct_label(p) -> Column:
    """(D4) ``"Zero denominator"`` for the sentinel, else ``round(100 p, 1)`` + ``%``."""
    p = col_of(p)
    return F.when(p == ZERO_DENOMINATOR_SENTINEL, F.lit(ZERO_DENOMINATOR_LABEL)).otherwise(
        F.concat(text_na(num_text(F.round(p * 100, 1))), F.lit("%"))
    )


def pct_capped(p) -> Column:
    """(D13) percent change in %, capped at 500; null stays null."""
    p = col_of(p)
    return F.when(p > PCT_CAP, F.lit(PCT_CAP * 100.0)).when(p <= PCT_CAP, p * 100)


def period_label(p: int) -> str:
    """(D18) ``999`` -> Cumulative, ``1`` -> 24 hours, else ``<p> days``."""
    if p == CUMULATIVE_PERIOD:
        return "Cumulative"
    if p == 1:
        return "24 hours"
    return f"{p} days"


def period_code(label) -> Column:
    from .classify import lookup

    return lookup(label, PERIOD_CODES)


def map_title(period, indicator, metric) -> Column:
    """(D19) map title; cumulative titles keep the trailing space."""
    period, indicator, metric = col_of(period), col_of(indicator), col_of(metric)
    return F.concat(
        F.when(period == "Cumulative", F.lit(TITLE["map_cumulative"])).otherwise(F.lit(TITLE["map_period"])),
        F.when(indicator == "Cases", F.lit(TITLE["map_cases"])).otherwise(F.lit(TITLE["map_deaths"])),
        F.lit(TITLE["map_subject"]),
        F.when(metric == "Rate", F.lit(TITLE["rate"])).otherwise(F.lit("")),
        F.when(period == "Cumulative", F.lit("")).otherwise(F.concat(F.lit(TITLE["past"]), period)),
    )


def tab_title(period, indicator, metric=None) -> Column:
    """(D19) table title; without ``metric`` it is the pivoted-table title."""
    period, indicator = col_of(period), col_of(indicator)
    parts = [
        F.when(period == "Cumulative", F.lit(TITLE["tab_cumulative"])).otherwise(F.lit("")),
        F.when(indicator == "Cases", F.lit(TITLE["tab_cases"])).otherwise(F.lit(TITLE["tab_deaths"])),
    ]
    if metric is not None:
        parts.append(F.when(col_of(metric) == "Rate", F.lit(TITLE["rate"])).otherwise(F.lit("")))
    parts.append(F.when(period == "Cumulative", F.lit("")).otherwise(F.concat(F.lit(TITLE["past"]), period)))
    return F.concat(*parts)


def range_caption(indicator, start, end) -> Column:
    """(D20) ``"<Indicator> reported from <start> to <end>"``, nulls as ``NA``."""
    return F.concat(col_of(indicator), F.lit(TITLE["caption_middle"]), text_na(start), F.lit(TITLE["caption_to"]), text_na(end))
