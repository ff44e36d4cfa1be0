"""Overlay tables: 7-day mean incidence / mortality and the policy index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import COMPACT, parse_date
from ..functions.measures import scaled_ratio
from ..functions.nulls import paste_na
from ..operators.series import rolling_mean, warmup_trim


def overlay_rates(
    df: DataFrame,
    entity: str = "country_code",
    date_col: str = "Date",
    source: str = "data_source",
    new_cases: str = "cases_new",
    new_deaths: str = "deaths_new",
    pop: str = "pop",
    name: str = "country",
    window: int = 7,
    digits: int | None = None,
) -> DataFrame:
    """A8 cases/deaths overlay.

    Daily incidence per 100k and mortality per 1M (D2; ``try_divide`` so a zero population
    cannot raise), rows with ``pop > 0`` only (P10), a right-aligned ``window``-row mean per
    (entity, source) that is null until the frame is full (W9), the warm-up days trimmed
    (P18) and the two means unpivoted (R2).  The means are not rounded unless ``digits`` is
    given.  Series are told apart by code, so places of one name never merge.
    """
    rates = df.withColumns(
        {
            "mort": scaled_ratio(new_deaths, pop, 1_000_000),
            "inc": scaled_ratio(new_cases, pop, 100_000),
            "ou_date_match": paste_na(entity, date_col, sep="_"),
        }
    ).filter(F.col(pop) > 0)
    keys = [entity, source]
    rolled = rolling_mean(rates, keys, date_col, {"inc": "inc_ma7", "mort": "mort_ma7"}, window)
    trimmed = warmup_trim(rolled, keys, date_col, window - 1)
    if digits is not None:
        trimmed = trimmed.withColumns({c: F.round(c, digits) for c in ("inc_ma7", "mort_ma7")})
    out = trimmed.select(F.col(date_col).alias("date"), name, F.col(entity).alias("country_code"), "ou_date_match",
                         F.col(source).alias("data_source"), "inc_ma7", "mort_ma7")
    return out.unpivot(
        ["date", name, "country_code", "ou_date_match", "data_source"], ["inc_ma7", "mort_ma7"], "cases_death_type", "cases_death_value"
    )


def overlay_policy(raw: DataFrame, jurisdiction_value: str = "NAT_TOTAL") -> DataFrame:
    """A8 policy index: names lower-cased (P4), national rows only (P10), integer
    ``yyyymmdd`` dates parsed (S3), match key built (N5)."""
    low = raw.toDF(*[c.lower() for c in raw.columns])
    nat = low.filter(F.col("jurisdiction") == jurisdiction_value).select("countryname", "countrycode", "date", "stringencyindex")
    parsed = nat.withColumn("date", parse_date(F.col("date").cast("string"), COMPACT))
    return parsed.withColumn("ou_date_match", paste_na("countrycode", "date", sep="_")).withColumnsRenamed(
        {"countryname": "country_name", "countrycode": "country_code"}
    )
