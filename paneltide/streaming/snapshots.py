"""Structured Streaming form of the snapshot feed's first stage.

The reference recomputes everything in a scheduled batch; it has no streaming operator.
When the intra-day updates arrive as a stream, the per-place daily row (latest update time
and the day's counts) is a windowed aggregation with a watermark: late updates within the
watermark still land in their day, and in append mode a day is emitted once the watermark
has passed it.  Cumulative totals and the day completion of
:func:`paneltide.plans.subnational.daily_from_snapshots` then run as a batch over the
emitted days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def daily_updates(
    updates: DataFrame,
    ts_col: str,
    keys: Sequence[str],
    kind_col: str,
    kinds: dict[str, Sequence[str]],
    watermark: str = "2 days",
) -> DataFrame:
    """Streaming (or batch) per-key daily rows: ``date``, ``last_update`` and one count per
    output column in ``kinds`` (output name -> values of ``kind_col``)."""
    # Watermarks need a zone-aware TIMESTAMP; a zone-less column is read in the session zone.
    staged = updates.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    agg = (
        staged.withWatermark(ts_col, watermark)
        .groupBy(F.window(ts_col, "1 day").alias("__day"), *keys)
        .agg(
            F.max(ts_col).alias("last_update"),
            *[F.count(F.when(F.col(kind_col).isin(list(v)), 1)).alias(k) for k, v in kinds.items()],
        )
    )
    return agg.select(F.to_date(F.col("__day.start")).alias("date"), "last_update", *keys, *kinds)


def event_stream(spark, path: str, schema: T.StructType, max_files_per_trigger: int | None = None) -> DataFrame:
    """A file-source stream over a folder of Parquet files with an explicit schema."""
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def start_daily_sink(daily: DataFrame, sink_path: str, checkpoint: str, trigger_once: bool = True):
    """Append finalised days to a Parquet table; the checkpoint (in the shared folder)
    makes the query restartable after a lost driver or executor."""
    w = daily.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start(sink_path)


def running_totals(
    daily: DataFrame,
    keys: Sequence[str],
    date_col: str,
    measures: Sequence[str],
) -> DataFrame:
    """Per-key running totals over a stream of finalised daily rows (stateful).

    The state per key is one number per measure (the totals so far), so it stays small
    whatever the volume.  Days of a key arrive in order when the input is the append-mode
    output of :func:`daily_updates` (a day is emitted only after the watermark passed
    it); within a micro-batch the rows of a key are sorted by day.
    """
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    keys, measures = list(keys), list(measures)
    out_fields = [daily.schema[c] for c in daily.columns] + [T.StructField(f"{m}_cum", T.LongType()) for m in measures]
    out_schema = T.StructType(out_fields)
    state_schema = T.StructType([T.StructField(m, T.LongType()) for m in measures])
    cols = list(daily.columns)

    def step(key, pdfs, state):
        totals = list(state.get) if state.exists else [0] * len(measures)
        parts = []
        for pdf in pdfs:
            parts.append(pdf)
        if not parts:
            return
        pdf = pd.concat(parts).sort_values(date_col)
        for i, m in enumerate(measures):
            c = pdf[m].fillna(0).astype("int64").cumsum() + totals[i]
            pdf[f"{m}_cum"] = c
            totals[i] = int(c.iloc[-1])
        state.update(tuple(totals))
        yield pdf[cols + [f"{m}_cum" for m in measures]]

    return daily.groupBy(*keys).applyInPandasWithState(step, out_schema, state_schema, "append", GroupStateTimeout.NoTimeout)
