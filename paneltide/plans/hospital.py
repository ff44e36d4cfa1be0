"""Hospital indicator tables from two long sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import semi_join
from ..operators.reshape import complete_grid
from ..operators.series import latest_with_ties, locf_maxgap
from ..operators.setops import ragged_union
from ..session import cut_lineage

KEYS = ["iso_code", "indicator", "source"]


def combine(first: DataFrame, second: DataFrame, names=("ECDC", "OWID")) -> DataFrame:
    """A10: tag each long source and stack them, ragged columns -> null."""
    return ragged_union(first.withColumn("source", F.lit(names[0])), second.withColumn("source", F.lit(names[1])))


def latest(hosp: DataFrame) -> DataFrame:
    """Latest non-null row(s) per (iso, indicator, source), ties kept."""
    return latest_with_ties(hosp, KEYS, "date", non_null="value")


def fill(hosp: DataFrame, maxgap: int = 14, materialize: bool = True) -> DataFrame:
    """Complete the grid of observed iso x indicator x source x date (R6), carry
    values forward across null runs of at most ``maxgap`` rows (W15), and keep only the
    (source, indicator) pairs each source actually reports (J6 - a semi join on the
    observed pairs, no driver-side lists).  The combined input is read four times, so it
    is checkpointed once (``materialize``)."""
    if materialize:
        hosp = cut_lineage(hosp)
    grid = complete_grid(hosp.select(*KEYS, "date", "value"), KEYS + ["date"])
    filled = locf_maxgap(grid, KEYS, "date", "value", "carry_fwd_value", maxgap)
    return semi_join(filled, hosp, ["source", "indicator"])
