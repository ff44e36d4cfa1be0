"""Country-level daily totals from a wide cumulative feed and from a long daily feed, the
entity x date frame they are joined onto, and the stacking of sources (A2-A5).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import lookup
from ..functions.dates import US_SHORT, daily_sequence, parse_date
from ..functions.nulls import in_never_null, not_in_keep_null, paste_na, strict_sum
from ..operators.aggregate import group_by_types, numeric_null_to_zero
from ..operators.joins import alias_join, attach_row, join_null_safe
from ..operators.series import restore_first
from ..operators.setops import stack_sources
from ..operators.wide import WideTable, pack_columns, paired_days
from ..session import cut_lineage

TOTALS_COLS = [
    "country", "date", "cases_new", "cases_cum", "deaths_new", "deaths_cum",
    "who_region", "pop_2020yr", "iso3code", "ou_date_match", "iso2code",
]


def entity_date_frame(dim: DataFrame, bounds: DataFrame) -> DataFrame:
    """Entity dimension x every day of ``bounds`` (1-row ``__lo``, ``__hi``).

    The calendar is generated inside each dimension row (``explode(sequence)``) after a
    broadcast of the 1-row bounds, so there is no cross join against a date table.
    """
    places = dim.select("country", "iso3code", "iso2code", "who_region", "pop_2020yr", "Continent_Name").distinct()
    framed = attach_row(places, bounds.select("__lo", "__hi")).select(
        "*", F.explode(daily_sequence(F.col("__lo"), F.col("__hi"))).alias("date")
    )
    return framed.select(
        paste_na("iso3code", "date", sep="_").alias("ou_date_match"),
        "country", "date", "iso3code", "iso2code", "who_region", "pop_2020yr", "Continent_Name",
    )


def _clip_frame(frame: DataFrame, df: DataFrame, date_col: str, key_frame: str, key_df: str) -> DataFrame:
    """Frame rows inside ``df``'s observed date range whose key occurs in ``df``."""
    b = df.agg(F.min(date_col).alias("__lo"), F.max(date_col).alias("__hi"))
    clipped = attach_row(frame, b).filter((F.col("date") <= F.col("__hi")) & (F.col("date") >= F.col("__lo")))
    keys = df.select(F.col(key_df).alias(key_frame)).distinct()
    return join_null_safe(clipped.drop("__lo", "__hi"), keys, [key_frame], "left_semi")


def panel_from_wide_cumulative(
    cases_wide: DataFrame | WideTable,
    deaths_wide: DataFrame | WideTable,
    frame: DataFrame,
    aliases: DataFrame,
    alias_col: str = "alias",
    code_col: str = "iso3code",
    n_ids: int = 4,
    date_format: str = US_SHORT,
    materialize: bool = True,
    promote: Sequence[str] = (),
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """A3: wide cumulative files -> cleaned daily panel on the entity x date frame.

    The ``n_ids`` id columns (province, country, lat, long) identify a series; every
    other header is a date, however many there are (``operators/wide.py``).  Steps: full outer
    join of the two files on the ids (J2) -> header dates parsed, values aligned and per-series
    increments with negatives clamped, as arrays (W1, W2) -> one row per day (R1) -> strict sum per (country, date) (G1) -> names to codes through an alias
    table (J8), unmatched dropped (P13); provinces in ``promote`` count as countries of their
    own, and ``rename`` maps countries to one entity before the codes are looked up (P8)
    -> first-day restore (W3) -> strict sum per
    (code, date) -> clip the frame to the observed range and codes (P15, J5) -> left join
    (J3) -> numeric nulls to 0 (P19).

    The per-(code, date) table is read three times (range, codes, join); with
    ``materialize`` it is checkpointed once so the feed is not re-read and re-aggregated.
    """
    cases, deaths = (x if isinstance(x, WideTable) else pack_columns(x, n_ids) for x in (cases_wide, deaths_wide))
    prov, ctry, lat, lon = cases.ids

    # The files meet on their id columns, one row per series; merge() sorts by its keys, so the
    # order within a (country, province) is (lat, long, date), nulls last.
    inc = paired_days(cases, deaths, ("cum_cases", "cum_deaths"), ("new_cases", "new_deaths"), [ctry, prov], [lat, lon],
                      date_format=date_format)
    country = F.when(in_never_null(prov, promote), F.col(prov)).otherwise(F.col(ctry)) if promote else F.col(ctry)
    inc = inc.withColumn("Country", F.translate(country, "*", ""))
    # base aggregate() drops rows whose grouping variables are NA
    inc = inc.filter(F.col("Country").isNotNull() & F.col("Date").isNotNull())
    by_country = inc.groupBy("Country", "Date").agg(
        strict_sum("new_cases").alias("cases_new"),
        strict_sum("new_deaths").alias("deaths_new"),
        strict_sum("cum_cases").alias("cases_cum"),
        strict_sum("cum_deaths").alias("deaths_cum"),
    )
    if rename:
        by_country = by_country.withColumn("Country", F.coalesce(lookup("Country", rename), F.col("Country")))
    coded = alias_join(by_country, "Country", aliases, alias_col, code_col, "iso3code").filter(F.col("iso3code").isNotNull())
    restored = restore_first(coded, ["iso3code"], "Date", {"cases_new": "cases_cum", "deaths_new": "deaths_cum"})
    df = restored.groupBy("iso3code", F.col("Date").alias("date")).agg(
        strict_sum("cases_new").alias("cases_new"),
        strict_sum("deaths_new").alias("deaths_new"),
        strict_sum("cases_cum").alias("cases_cum"),
        strict_sum("deaths_cum").alias("deaths_cum"),
    )
    if materialize:
        df = cut_lineage(df)
    clipped = _clip_frame(frame, df, "date", "iso3code", "iso3code")
    base = join_null_safe(clipped, df, ["iso3code", "date"], "left").select(*TOTALS_COLS)
    return numeric_null_to_zero(base)


def panel_from_long_daily(
    long_daily: DataFrame,
    frame: DataFrame,
    date_text: str,
    drop_date=None,
    exclude_codes: Sequence[str] = (),
    materialize: bool = True,
    rename: dict[str, str] | None = None,
    recode: dict[str, str] | None = None,
) -> DataFrame:
    """A4: long daily file -> cleaned daily panel on the entity x date frame.

    Countries in ``rename`` take another's name, and those in ``recode`` a code (P8), so that
    places collapse when the rows are grouped by every text column and every numeric one is
    summed, nulls as 0 (G3, G2) -> parse the
    date column (first column, S5) -> clip the frame to the observed range and codes (P15,
    J5) -> left join on (iso2code, date) (J3) -> numeric nulls to 0 (P19) -> drop the
    incomplete day ``drop_date`` (P17) -> drop excluded codes keeping nulls (P12).
    """
    first = long_daily.columns[0]
    w = long_daily.withColumnRenamed(first, date_text) if first != date_text else long_daily
    if rename:
        w = w.withColumn("Country", F.coalesce(lookup("Country", rename), F.col("Country")))
    if recode:
        w = w.withColumn("Country_code", F.coalesce(lookup("Country", recode), F.col("Country_code")))
    summed = group_by_types(w, strict=False)
    w2 = summed.withColumn("date", parse_date(date_text)).withColumn("iso2code", F.col("Country_code"))
    wx = w2.select(
        "iso2code", "date",
        F.col("New_cases").alias("cases_new"), F.col("New_deaths").alias("deaths_new"),
        F.col("Cumulative_cases").alias("cases_cum"), F.col("Cumulative_deaths").alias("deaths_cum"),
    )
    if materialize:
        wx = cut_lineage(wx)
    clipped = _clip_frame(frame, wx, "date", "iso2code", "iso2code")
    base = join_null_safe(clipped, wx, ["iso2code", "date"], "left").select(*TOTALS_COLS)
    out = numeric_null_to_zero(base)
    if isinstance(drop_date, DataFrame):
        # a 1-row table holding the day to drop: broadcast anti join, nothing collected
        day = drop_date.select(F.col(drop_date.columns[0]).alias("__drop"))
        out = out.join(F.broadcast(day), F.col("date") == F.col("__drop"), "left_anti")
    elif drop_date is not None:
        out = out.filter(F.col("date") != F.lit(drop_date).cast("date"))
    if exclude_codes:
        out = out.filter(not_in_keep_null("iso3code", exclude_codes))
    return out


def stack_two_sources(first: DataFrame, second: DataFrame, names: tuple[str, str] = ("JHU", "WHO")) -> DataFrame:
    """A5: tag and stack two daily panels, published column names and match keys."""
    df = numeric_null_to_zero(stack_sources({names[0]: first, names[1]: second}))
    return df.select(
        F.col("country").alias("Country"),
        F.col("date").alias("Date"),
        F.col("cases_new").alias("New Cases"),
        F.col("cases_cum").alias("Cumulative Cases"),
        F.col("deaths_new").alias("New Deaths"),
        F.col("deaths_cum").alias("Cumulative Deaths"),
        F.col("who_region").alias("WHO Region"),
        F.col("pop_2020yr").alias("Population 2020"),
        F.col("pop_2020yr").alias("Population 2018.x"),
        F.col("iso3code").alias("Country Code"),
        F.col("iso3code").alias("country_code"),
        "ou_date_match",
        paste_na("ou_date_match", "data_source", sep="_").alias("ou_date_src_match"),
        "data_source",
        "iso2code",
    )

