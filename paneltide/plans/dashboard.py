"""Dashboard tables: the second entity dimension with display codes."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import (
    INCOME_ORDER,
    INCOME_ORDER_DEFAULT,
    STATE_REGION_ORDER,
    STATE_REGION_ORDER_DEFAULT,
    WHO_REGION_ORDER,
    WHO_REGION_ORDER_DEFAULT,
    order_code,
)
from ..functions.nulls import paste_na
from ..operators.joins import lookup_join
from ..operators.setops import ragged_union

# The literal "Other" row appended to the dimension.
OTHER_ROW = {
    "id": "OTH", "iso2code": "OT", "state_region": "Other", "who_region": "Other", "Country": "Other",
    "incomelevel_value": "Other", "WHO_R_Order": 109, "STATE_R_Order": 8, "Income_L_Order": 205,
}
KOSOVO_MAP_ISO = ("Kosovo", "CS-KM")


ATTRIBUTES = {"state_region": "string", "incomelevel_value": "string", "eighteenplus": "double"}


def entity_dimension(dim: DataFrame) -> DataFrame:
    """Second entity dimension with defaults, map key and display order codes.

    ``dim`` has (country, iso3code, iso2code, who_region, pop_2020yr) and any of
    ``state_region``, ``incomelevel_value`` and ``eighteenplus``; those that it lacks are null,
    so their defaults apply.
    """
    base = dim.select(
        F.col("iso3code").alias("id"),
        "iso2code",
        "who_region",
        F.col("country").alias("Country"),
        F.col("pop_2020yr").alias("population"),
        *((F.col(c) if c in dim.columns else F.lit(None)).cast(kind).alias(c) for c, kind in ATTRIBUTES.items()),
    )
    coded = base.withColumns(
        {
            "state_region": F.coalesce(F.col("state_region"), F.lit("Non-State Region")),
            "who_region": F.coalesce(F.col("who_region"), F.lit("Other")),
            "Country": F.when(F.col("Country") == "", F.lit("Other")).otherwise(F.col("Country")),
        }
    )
    coded = coded.withColumns(
        {
            "map_iso": F.when(F.col("Country") == KOSOVO_MAP_ISO[0], F.lit(KOSOVO_MAP_ISO[1])).otherwise(F.col("id")),
            "WHO_R_Order": order_code("who_region", WHO_REGION_ORDER, WHO_REGION_ORDER_DEFAULT),
            "STATE_R_Order": order_code("state_region", STATE_REGION_ORDER, STATE_REGION_ORDER_DEFAULT),
            "Income_L_Order": order_code("incomelevel_value", INCOME_ORDER, INCOME_ORDER_DEFAULT),
        }
    ).distinct()
    spark = dim.sparkSession
    other = spark.createDataFrame(
        [tuple(OTHER_ROW.values())],
        "id string, iso2code string, state_region string, who_region string, Country string, "
        "incomelevel_value string, WHO_R_Order int, STATE_R_Order int, Income_L_Order int",
    )
    return ragged_union(coded, other)


# Places whose name carries its source (both sources report them apart).
SOURCE_NAMED = {"JHU": ("China", "Hong Kong", "Taiwan", "Macau"), "WHO": ("China",)}


def cases_deaths(panel: DataFrame, onetable: DataFrame, source_named: dict = SOURCE_NAMED) -> DataFrame:
    """A15 / A8 cases and deaths (P8, J4, N5): the entity "Other" gets the code of the dimension's
    "Other" row, places in ``source_named`` carry their source in the name, and the match key is
    rebuilt from the id that the dimension has for the code (``NA`` where it has none).

    ``panel`` has (country, iso2code, date, source, ...)."""
    renamed = panel.withColumn("iso2code", F.when(F.col("country") == "Other", F.lit(OTHER_ROW["iso2code"])).otherwise(F.col("iso2code")))
    name = F.col("country")
    for source, places in source_named.items():
        hit = F.col("country").isin(list(places)) & (F.col("source") == source)
        name = F.when(hit, F.concat(F.col("country"), F.lit(f"-{source}"))).otherwise(name)
    keyed = lookup_join(renamed.withColumn("country", name), "iso2code", onetable, "iso2code", ["id"])
    return keyed.withColumn("ou_date_match", paste_na("id", "date", sep="_")).drop("id")


def dashboard_tables(
    dim: DataFrame,
    cases_panel: DataFrame,
    indicator_wide: DataFrame,
    indicator_id: str,
    indicator_measures,
    indicator_meta: dict,
    indicator_families: dict,
    hosp_first: DataFrame,
    hosp_second: DataFrame,
    policy_raw: DataFrame,
    prepared: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The dashboard's tables from its inputs, as DataFrames (nothing written).

    ``prepared`` are tables built from feeds of their own (cases and deaths, ages,
    manufacturers, rollout, the wide indicators); a name of the job's own is refused.

    * ``onetable``: second entity dimension with order codes and the "Other" row
    * ``overlay_cases_deaths`` / ``overlay_stringency``: A8 overlays
    * ``vaccinations_all_counts`` / ``..._rates``: the A9 long table split by Count / Rate (K3)
    * ``vaccinations_categories``: the legend table (D9)
    * ``hosp_data_latest`` / ``hosp_data_long``: A11 / A12
    """
    from pyspark.sql import functions as F

    from . import hospital as H
    from . import indicators as IND
    from . import overlays as OV

    long = IND.indicator_long(indicator_wide, indicator_id, "date", list(indicator_measures), indicator_meta, indicator_families)
    hosp = H.combine(hosp_first, hosp_second)
    own = {
        "onetable": entity_dimension(dim),
        "overlay_cases_deaths": OV.overlay_rates(cases_panel),
        "overlay_stringency": OV.overlay_policy(policy_raw),
        "vaccinations_all_counts": long.filter(F.col("count_or_rate") == "Count"),
        "vaccinations_all_rates": long.filter(F.col("count_or_rate") == "Rate"),
        "vaccinations_categories": IND.legend_table(dim.sparkSession, indicator_meta, indicator_families),
        "hosp_data_latest": H.latest(hosp),
        "hosp_data_long": H.fill(hosp),
    }
    if taken := own.keys() & (prepared or {}).keys():
        raise ValueError(f"tables of the job itself: {sorted(taken)}")
    return own | dict(prepared or {})
