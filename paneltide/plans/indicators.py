"""Indicator tables: long indicator table with latest/first flags, metadata lookups and
fixed-break bins; legend table; manufacturer lists; rollout increments (A9, D8-D10).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import BREAK_FAMILIES, cut_right_closed, lookup
from ..functions.nulls import paste_na
from ..operators.joins import lookup_join
from ..operators.reshape import complete_calendar, explode_list, wide_to_long
from ..operators.series import first_last_flags, rollout_diff

# ---------------------------------------------------------------------------------------
# Indicator metadata (display field, suffix, Count/Rate).  The published
# table misspells one key and one display text; both are corrected here (see README).
# ---------------------------------------------------------------------------------------
INDICATOR_META = {
    "total_vaccinations": ("Cumulative Doses Administered", " ", "Count"),
    "total_vaccinations_per_hundred": ("Cumulative Doses Administered", "Per 100 people", "Rate"),
    "people_vaccinated": ("Cumulative People Vaccinated (1 or more)", " ", "Count"),
    "people_vaccinated_per_hundred": ("Cumulative People Vaccinated (1 or more)", "Per 100 people", "Rate"),
    "people_fully_vaccinated": ("Cumulative People Vaccinated (Fully)", " ", "Count"),
    "people_fully_vaccinated_per_hundred": ("Cumulative People Vaccinated (Fully)", "Per 100 people", "Rate"),
    "daily_vaccinations": ("Daily Doses Administered (7-day average)", " ", "Count"),
    "daily_vaccinations_per_million": ("Daily Doses Administered (7-day average)", "Per 1M people", "Rate"),
    "daily_people_vaccinated": ("Daily People Vaccinated (7-day average)", " ", "Count"),
    "daily_people_vaccinated_per_hundred": ("Daily People Vaccinated (7-day average)", "Per 100 people", "Rate"),
    "total_boosters": ("Cumulative Booster Doses Administered", " ", "Count"),
    "total_boosters_per_hundred": ("Cumulative Booster Doses Administered", "Per 100 people", "Rate"),
}
AGE_META = {
    "people_vaccinated_per_hundred": ("Cumulative People Vaccinated (1 or more)", "Per 100 people", "Rate"),
    "people_fully_vaccinated_per_hundred": ("Cumulative People Vaccinated (Fully)", "Per 100 people", "Rate"),
    "people_with_booster_per_hundred": ("Cumulative People With Booster", "Per 100 people", "Rate"),
}
AGGREGATE_MARKER = "OWID"
# ---------------------------------------------------------------------------------------


def _family_of(fields_by_family: dict) -> dict:
    return {f: fam for fam, (fields, _, _) in fields_by_family.items() for f in fields}


def family_bins(field, value, families: dict = BREAK_FAMILIES):
    """(D8) bin number from the break set of the field's family; fields in no family -> null."""
    field = F.col(field) if isinstance(field, str) else field
    expr = None
    for _, (fields, breaks, _) in families.items():
        hit = field.isin(list(fields))
        b = cut_right_closed(value, breaks)
        expr = F.when(hit, b) if expr is None else expr.when(hit, b)
    return expr.cast("int") if expr is not None else F.lit(None).cast("int")


def indicator_long(
    wide: DataFrame,
    id_col: str,
    date_col: str,
    measures: Sequence[str],
    meta: dict = INDICATOR_META,
    families: dict = BREAK_FAMILIES,
    value_col: str = "data_value",
) -> DataFrame:
    """A9 ``all`` table: gather the measures dropping nulls (R3), latest / first flags per
    (id, field) (W10), display field / suffix / Count-Rate lookups (J7, D10), fixed-break
    bin and label (D8) and the match key (N5)."""
    long = wide_to_long(wide, [c for c in wide.columns if c not in measures], list(measures), "raw_field", value_col, drop_nulls=True)
    flagged = first_last_flags(long, [id_col, "raw_field"], date_col)
    num = family_bins("raw_field", F.col(value_col), families)
    return flagged.withColumns(
        {
            "data_field": lookup("raw_field", {k: v[0] for k, v in meta.items()}),
            "data_suffix": lookup("raw_field", {k: v[1] for k, v in meta.items()}),
            "count_or_rate": lookup("raw_field", {k: v[2] for k, v in meta.items()}),
            "ou_date_match": paste_na(id_col, date_col, sep="_"),
            "data_cat_num": num,
            "data_cat": F.when(num.isNotNull(), F.concat(F.lit("cat "), num.cast("string"))),
        }
    )


def ages_long(
    ages: DataFrame,
    locations: DataFrame,
    measures: Sequence[str] = tuple(AGE_META),
    meta: dict = AGE_META,
    families: dict = BREAK_FAMILIES,
    id_col: str = "iso_code",
    group_col: str = "age_group",
    date_col: str = "date",
    bounds: DataFrame | None = None,
) -> DataFrame:
    """A9 ``ages`` table: every (entity, age group) on every day of the table's calendar (R10),
    missing location names from ``locations`` (iso_code, location) (J7), measures gathered
    without nulls (R3), latest / first flags per (entity, measure, group) (W10), metadata
    lookups (D10) and the coverage bin (D8)."""
    groups = [id_col, group_col]
    dense = complete_calendar(ages, groups, date_col, ["location", *measures], bounds=bounds)
    named = lookup_join(dense.withColumnRenamed("location", "__own"), id_col, locations, id_col, ["location"])
    named = named.withColumn("location", F.coalesce("__own", "location")).drop("__own")
    long = wide_to_long(named, [c for c in named.columns if c not in measures], list(measures), "raw_field", "Value", drop_nulls=True)
    flagged = first_last_flags(long, [id_col, "raw_field", group_col], date_col)
    num = family_bins("raw_field", F.col("Value"), families)
    return flagged.withColumns(
        {
            "data_field": lookup("raw_field", {k: v[0] for k, v in meta.items()}),
            "data_suffix": lookup("raw_field", {k: v[1] for k, v in meta.items()}),
            "count_or_rate": lookup("raw_field", {k: v[2] for k, v in meta.items()}),
            "data_cat_num": num,
            "data_cat": F.when(num.isNotNull(), F.concat(F.lit("cat "), num.cast("string"))),
        }
    )


# Aggregate places that the manufacturer table leaves out.
ROLLOUT_LEFT_OUT = ("European Union", "Wales", "Scotland", "")


def rollout_places(man: DataFrame, location: str = "location", left_out: Sequence[str] = ROLLOUT_LEFT_OUT) -> DataFrame:
    """A9 ``rollout`` input: rows with a location that is no aggregate place."""
    return man.filter(F.col(location).isNotNull() & ~F.col(location).isin(list(left_out)))


def clean_codes(df: DataFrame, code: str = "iso_code", recode: dict | None = None) -> DataFrame:
    """Drop rows without a code (P13), recode (P8), drop aggregate pseudo-entities."""
    out = df.filter(F.col(code).isNotNull())
    if recode:
        out = out.withColumn(code, F.coalesce(lookup(code, recode), F.col(code)))
    return out.filter(~F.col(code).contains(AGGREGATE_MARKER))


def legend_table(spark: SparkSession, meta: dict = INDICATOR_META, families: dict = BREAK_FAMILIES, n: int = 6) -> DataFrame:
    """(D9) class x field legend: display field, suffix, Count/Rate and tick value.

    A literal grid (classes x fields, bounded by the metadata), looked up by field name.
    """
    fam = _family_of(families)
    rows = []
    for field, (disp, suffix, kind) in meta.items():
        ticks = families[fam[field]][2] if field in fam else None
        for k in range(1, n + 1):
            rows.append((k, field, disp, suffix, kind, float(ticks[k - 1]) if ticks else 0.0))
    return spark.createDataFrame(rows, "cat_num int, raw_field string, data_field string, data_suffix string, count_or_rate string, tick_value double")


def manufacturers(locations: DataFrame, list_col: str = "vaccine_manufacturer_list", out: str = "vaccine_manufacturer") -> DataFrame:
    """A9 ``manufacturers``: one trimmed manufacturer per row, list column kept."""
    return explode_list(locations, list_col, out, sep=",")


def rollout(man: DataFrame, keys: Sequence[str] = ("location", "vaccine"), date_col: str = "date",
            total: str = "total_vaccinations", out: str = "daily_vaccinations", codes: DataFrame | None = None) -> DataFrame:
    """A9 ``rollout``: rows of real places (P13, P14), per-series daily doses, the first row
    keeping its total (W5), and with ``codes`` (location, iso_code) the place's code (J4)."""
    daily = rollout_diff(rollout_places(man), list(keys), date_col, total, out)
    return lookup_join(daily, "location", codes, "location", ["iso_code"]) if codes is not None else daily
