"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_sources(frames: dict[str, DataFrame], tag_col: str = "data_source") -> DataFrame:
    """Tag each frame with its source name and union them by name."""
    out = None
    for name, df in frames.items():
        tagged = df.withColumn(tag_col, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    if out is None:
        raise ValueError("no frames to stack")
    return out


def ragged_union(*frames: DataFrame) -> DataFrame:
    """``bind_rows``: union by name, columns missing from a frame are null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
