"""The tracker job (A14): every published tracker table from one read of the inputs.

The daily table (sparse counts per entity, day and source, with population) feeds the
snapshot, the change cross-section and the series; it is checkpointed once into the shared
checkpoint folder, so the raw events are scanned and aggregated once for all five sinks
(O5).  The cross-sections come from one aggregation of it; only the series output
densifies.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.reshape import complete_calendar
from ..operators.series import running_sum
from ..session import cut_lineage
from ..sources.sinks import write_filtered, write_table
from . import tracker as TR

PUBLISHED_SOURCE_COL = "data_source"


def dense_panel(daily: DataFrame, bounds: DataFrame) -> DataFrame:
    """Dense cumulative panel from the sparse daily table (R7, P19, running sums)."""
    dense = complete_calendar(daily, [TR.KEY, TR.SOURCE], TR.DATE, ["cases_new", "deaths_new"], bounds=bounds)
    dense = dense.fillna(0, subset=["cases_new", "deaths_new"])
    return running_sum(dense, [TR.KEY, TR.SOURCE], TR.DATE, {"cases_new": "cases_cum", "deaths_new": "deaths_cum"})


def tracker_tables(daily: DataFrame, bounds: DataFrame, names: DataFrame, frame: DataFrame | None = None) -> dict[str, DataFrame]:
    """The A14 tables as DataFrames (nothing written)."""
    daily = cut_lineage(daily)
    cross = TR.complete_snapshot(TR.period_snapshot_from_daily(daily, bounds))
    tables = {
        "cross_cases_deaths": cross,
        "cross_cases_deaths_table": TR.snapshot_table(cross),
        "cross_delta_cases_deaths": TR.tracker_change_from_daily(daily, bounds, names),
        "series_delta_cases_deaths": TR.change_series_trajectory(dense_panel(daily, bounds), names),
    }
    if frame is not None:
        tables["lookup_country_date"] = frame
    return tables


def write_tracker_outputs(tables: dict[str, DataFrame], out_dir: str, source: str | None = None, fmt: str = "csv") -> dict[str, str]:
    """Write each table (K1); with ``source`` only that source's rows (K3), as published."""
    paths = {}
    for name, df in tables.items():
        path = os.path.join(out_dir, name)
        if source is not None and PUBLISHED_SOURCE_COL in df.columns:
            write_filtered(df, path, PUBLISHED_SOURCE_COL, source, fmt)
        else:
            write_table(df, path, fmt)
        paths[name] = path
    return paths


def source_rows(df: DataFrame, source: str) -> DataFrame:
    return df.filter(F.col(PUBLISHED_SOURCE_COL) == source)
