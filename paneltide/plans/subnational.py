"""Timestamped cumulative snapshots -> one row per place and day -> daily increments.

Input: intra-day updates, each carrying cumulative counts for a place at an update time.
Output 1 (cumulative): the latest update of each place per calendar day (W12).
Output 2 (new): each place's days completed from its own first to last day (R8), the
counts filled down across the added days (W13) and turned into increments that keep the
first value (W4) - filled days therefore get 0; columns that are not filled (country,
last update) stay null on added days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.nulls import in_never_null, not_in_keep_null, paste_na
from ..operators.reshape import complete_per_group
from ..operators.series import fill_down, inc_from_cum, latest_one
from ..operators.setops import ragged_union

MEASURES = ["city_confirmed", "city_suspected", "city_recovered", "city_deaths"]
PLACE = ["province_en", "city_en"]


def latest_per_day(updates: DataFrame, ts_col: str, keys: Sequence[str], tiebreak: str | None = None) -> DataFrame:
    """Latest update of each place per calendar day (W12): ``date`` = day of ``ts_col``,
    ``last_update`` = its time.  ``row_number() == 1`` is planned as a map-side top-1 per
    group, so a place with very many updates forwards one row per task to the shuffle."""
    staged = updates.withColumn("__day", F.to_date(ts_col))
    order = [F.col(ts_col).desc()] + ([F.col(tiebreak).desc()] if tiebreak else [])
    top = latest_one(staged, ["__day", *keys], order)
    rest = [c for c in updates.columns if c not in (ts_col, tiebreak) and c not in keys]
    return top.select(F.col("__day").alias("date"), F.col(ts_col).alias("last_update"), *keys, *rest)


def promote_places(df: DataFrame, promoted: Sequence[str], province: str = "province_en", city: str = "city_en",
                   pairs: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """For provinces in ``promoted`` the place becomes the province itself.

    Applied in order, like the sequential ``mutate``: the city name is overwritten first and
    the later count overrides test the *overwritten* city name.  ``pairs`` are
    (city column, province column) count pairs.
    """
    out = df.withColumn(city, F.when(in_never_null(province, promoted), F.col(province)).otherwise(F.col(city)))
    for c_col, p_col in pairs:
        out = out.withColumn(c_col, F.when(in_never_null(city, promoted), F.col(p_col)).otherwise(F.col(c_col)))
    return out


def municipality_names(df: DataFrame, city: str = "city_en", suffix: str = "Municipality") -> DataFrame:
    """Branch B naming: ``paste(city, "Municipality")`` (N5: null city -> ``NA ...``)."""
    return df.withColumn(city, paste_na(city, F.lit(suffix), sep=" "))


def subnational_updates(
    updates: DataFrame,
    country: str,
    promoted: Sequence[str],
    municipalities: Sequence[str],
    ts_col: str = "ts",
    tiebreak: str | None = None,
) -> DataFrame:
    """Output 1 from raw updates.

    ``updates`` has country, province_en, city_en, ``province_*`` and ``city_*`` counts and the
    update time.  Rows of ``country`` only.  Branch A: provinces in ``promoted`` are their own
    place, rows without a city and provinces in ``municipalities`` go.  Branch B: the latter at
    province level, each one place named "<province> Municipality".  Of every place and day the
    latest update stays; the branches are stacked by name."""
    own = updates.filter(F.col("country") == country)
    pairs = [(m, m.replace("city_", "province_", 1)) for m in MEASURES]
    extra = [p for _, p in pairs]
    a = promote_places(own, promoted, pairs=pairs).drop(*extra)
    a = a.filter(F.col("city_en") != "").filter(not_in_keep_null("province_en", municipalities))
    b = own.filter(in_never_null("province_en", municipalities)).drop("city_en", *MEASURES).distinct()
    b = municipality_names(b.withColumnsRenamed({"province_en": "city_en", **{p: m for m, p in pairs}}))
    b = b.withColumn("province_en", F.col("city_en"))
    keys = ["country", *PLACE]
    return ragged_union(latest_per_day(a, ts_col, keys, tiebreak), latest_per_day(b, ts_col, keys, tiebreak))


def daily_from_snapshots(cumulative: DataFrame, keys: Sequence[str] = PLACE, date_col: str = "date",
                         measures: Sequence[str] = MEASURES) -> DataFrame:
    """Output 2: per-place daily completion (R8), fill down (W13), increments."""
    keys = list(keys)
    others = [c for c in cumulative.columns if c not in keys and c != date_col]
    dense = complete_per_group(cumulative, keys, date_col, others)
    filled = fill_down(dense, keys, date_col, list(measures))
    return inc_from_cum(filled, keys, date_col, list(measures), 1)
