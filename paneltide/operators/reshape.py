"""Reshape and densify operators.

Densify ("complete") multiplies rows, so the operators are written to keep the work
narrow: a calendar is never materialised as a table and joined back.  Instead each
observed row emits itself plus the missing days up to the next observed row of its group
(``lead`` + ``explode(sequence)``): one exchange on the group keys and one sort, after
which later windows on the same keys reuse the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import daily_sequence
from .joins import attach_row, join_null_safe


def _checkpoint(df: DataFrame) -> DataFrame:
    from ..session import cut_lineage

    return cut_lineage(df)


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# ------------------------------------------------------------------ wide <-> long


def wide_to_long(
    df: DataFrame,
    ids: Sequence[str] | int,
    values: Sequence[str] | None = None,
    name_col: str = "name",
    value_col: str = "value",
    drop_nulls: bool = False,
) -> DataFrame:
    """Unpivot (``gather`` / ``pivot_longer``).

    ``ids`` may be an int: the first ``ids`` columns are identifiers and every other column
    is a measure (positional wide files whose date headers are not known in advance).
    ``drop_nulls`` drops rows whose value is null (``UNPIVOT EXCLUDE NULLS``).
    """
    cols = df.columns
    id_cols = cols[:ids] if isinstance(ids, int) else list(ids)
    val_cols = list(values) if values is not None else [c for c in cols if c not in id_cols]
    out = df.unpivot(id_cols, val_cols, name_col, value_col)
    if drop_nulls:
        out = out.filter(F.col(value_col).isNotNull())
    return out


def long_to_wide(
    df: DataFrame,
    keys: Sequence[str],
    name_col: str,
    value_col: str,
    names: Sequence[str],
    check_unique: bool = True,
) -> DataFrame:
    """Spread ``name_col`` into columns (R5; ``spread`` / ``pivot_wider``).

    Two phases: an aggregation per (keys, name) that keeps the value and counts the rows,
    then Spark's ``pivot`` over the listed names (planned as ``PivotFirst``).  Work is
    linear in the rows plus groups x names - not rows x names as one conditional aggregate
    per name would be - and listing the names spends no job on discovering them.  As in
    R, two rows for one key and name are an error; it is raised at execution time by the
    guard on the per-(key, name) count, without an extra pass.
    """
    per_name = df.groupBy(*keys, name_col).agg(F.max(value_col).alias("__v"), F.count(F.lit(1)).alias("__n"))
    if check_unique:
        guard = F.when(F.col("__n") > 1, F.raise_error(F.lit("duplicate key in long_to_wide")))
        per_name = per_name.filter(F.coalesce(guard.cast("boolean"), F.lit(True)))
    return per_name.groupBy(*keys).pivot(name_col, list(names)).agg(F.first("__v"))


def explode_list(df: DataFrame, c: str, out: str, sep: str = ",") -> DataFrame:
    """Delimited cell -> one trimmed value per row, keeping the list column."""
    parts = F.transform(F.split(F.col(c), sep), lambda x: F.trim(x))
    return df.withColumn(out, F.explode(parts))


# ------------------------------------------------------------------ densify


def _fill_days(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    value_cols: Sequence[str],
    start: Column | None,
    end: Column | None,
) -> DataFrame:
    """Each row emits itself and the days until the next row of its group.

    ``start`` / ``end`` (Columns, typically from a broadcast 1-row table) extend the first
    and last row of each group to a common calendar; ``None`` keeps the group's own range.
    Rows emitted for added days carry null in ``value_cols``.
    """
    w = Window.partitionBy(*keys).orderBy(F.col(date_col).asc_nulls_last())
    d = F.col(date_col)
    nxt = F.lead(d).over(w)
    first = F.row_number().over(w) == 1
    lo = d if start is None else F.when(first, F.least(start, d)).otherwise(d)
    hi_next = F.greatest(F.date_sub(nxt, 1), d)
    hi = F.when(nxt.isNull(), d if end is None else F.greatest(end, d)).otherwise(hi_next)
    tmp_days, tmp_day = "__days", "__day"
    staged = df.withColumn(tmp_days, daily_sequence(lo, hi))
    # The day arrays are never empty (hi >= the row's own date), so explode_outer gives the
    # same rows as explode; it also spares the filter Spark infers for an inner explode,
    # which would build every array twice.
    exploded = staged.select("*", F.explode_outer(tmp_days).alias(tmp_day)).drop(tmp_days)
    same = F.col(tmp_day) == d
    sel = []
    for c in df.columns:
        if c == date_col:
            sel.append(F.col(tmp_day).alias(date_col))
        elif c in value_cols:
            sel.append(F.when(same, F.col(c)).alias(c))
        else:
            sel.append(F.col(c))
    return exploded.select(*sel)


def complete_per_group(df: DataFrame, keys, date_col: str, value_cols=None) -> DataFrame:
    """Every day from each group's own first to last date.

    ``value_cols`` (default: every non-key column) become null on the added days.
    """
    keys = _names(keys)
    vals = list(value_cols) if value_cols is not None else [c for c in df.columns if c not in keys and c != date_col]
    return _fill_days(df, keys, date_col, vals, None, None)


def calendar_bounds(df: DataFrame, date_col: str, start=None, end=None) -> DataFrame:
    """1-row table (``__lo``, ``__hi``): given bounds, or the observed min/max date."""
    lo = F.lit(start).cast("date") if start is not None else F.min(date_col)
    hi = F.lit(end).cast("date") if end is not None else F.max(date_col)
    if start is not None and end is not None:
        return df.sparkSession.range(1).select(lo.alias("__lo"), hi.alias("__hi"))
    return df.agg(lo.alias("__lo"), hi.alias("__hi"))


def complete_calendar(
    df: DataFrame,
    keys,
    date_col: str,
    value_cols=None,
    start=None,
    end=None,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Every group x every day of one calendar (R7, R10; ``complete(id, date = all_dates)``).

    The calendar is ``start..end`` if given, else the observed global min..max of
    ``date_col``.  The bounds are a provably 1-row table, broadcast to every task; the
    fill itself is the narrow ``lead``/``explode`` pass of :func:`_fill_days`.  Rows
    outside the calendar are kept as they are.
    """
    keys = _names(keys)
    vals = list(value_cols) if value_cols is not None else [c for c in df.columns if c not in keys and c != date_col]
    b = bounds if bounds is not None else calendar_bounds(df, date_col, start, end)
    staged = attach_row(df, b.select("__lo", "__hi"))
    out = _fill_days(staged, keys, date_col, vals, F.col("__lo"), F.col("__hi"))
    return out.drop("__lo", "__hi")


#: Values of an axis that one row may hold.
AXIS_ROWS = 50_000


def _small_axes(df: DataFrame, axes: Sequence[Sequence[str]]) -> DataFrame:
    """1-row table: for each axis (a tuple of columns) the array of its observed values.

    ``collect_set`` over a struct keeps nulls as values (R ``complete`` treats NA as a
    value) and is a partial aggregation, so each map task ships only its distinct values.
    """
    aggs = [F.collect_set(F.struct(*[F.col(c) for c in cols])).alias(f"__ax{i}") for i, cols in enumerate(axes)]
    return df.agg(*aggs)


def _explode_axis(df: DataFrame, array: str, cols: Sequence[str]) -> DataFrame:
    out = df.select("*", F.explode(array).alias("__e")).drop(array)
    return out.select(*[c for c in out.columns if c != "__e"], *[F.col("__e")[c].alias(c) for c in cols])


def _expand_large(entities: DataFrame, df: DataFrame, cols: Sequence[str], n: int, most: int) -> DataFrame:
    """Every entity row x every observed tuple of a large axis.  The axis is cut by hash into
    chunks that one row holds; entities ask for every chunk and meet it in an equi-join on the
    chunk, in as many parts as there are shuffle partitions, so that no task holds a chunk's
    entities alone.  No row ever holds the axis, and nothing is broadcast."""
    spark = df.sparkSession
    chunks = -(-2 * n // most)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tuples = df.select(*cols).distinct().withColumn("__chunk", F.pmod(F.xxhash64(*cols), F.lit(chunks)).cast("int"))
    held = tuples.groupBy("__chunk").agg(F.collect_list(F.struct(*cols)).alias("__axis"))
    held = held.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    asked = entities.withColumn("__part", F.pmod(F.xxhash64(*entities.columns), F.lit(parts)).cast("int")).withColumn(
        "__chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    )
    return _explode_axis(asked.join(held.hint("merge"), ["__chunk", "__part"]).drop("__chunk", "__part"), "__axis", cols)


def _expand(entities: DataFrame, df: DataFrame, axes: Sequence[Sequence[str]], most: int) -> DataFrame:
    """Every entity row x every combination of the axes' observed values, by generators.

    The axes' sizes are estimated in one small job.  Axes of up to ``most`` values are
    gathered into one broadcast row; larger ones are expanded by :func:`_expand_large`.
    """
    names = [f"__n{i}" for i in range(len(axes))]
    counts = df.agg(*[F.approx_count_distinct(F.struct(*cols)).alias(n) for n, cols in zip(names, axes, strict=True)]).first()
    small = [cols for n, cols in zip(names, axes, strict=True) if counts[n] <= most]
    out = entities
    if small:
        out = attach_row(out, _small_axes(df, small))  # provably one row
    for i, cols in enumerate(small):
        out = _explode_axis(out, f"__ax{i}", cols)
    for n, cols in zip(names, axes, strict=True):
        if counts[n] > most:
            out = _expand_large(out, df, cols, counts[n], most)
    return out


def complete_grid(df: DataFrame, axes: Sequence[str], materialize: bool = False, axis_rows: int = AXIS_ROWS) -> DataFrame:
    """Full cross product of the observed values of every axis, data left-joined.

    ``tidyr::complete(a, b, c, d)``.  The first axis is the large one (entities) and stays
    distributed; other axes of up to ``axis_rows`` values are gathered into one broadcast row and
    expanded per entity with ``explode``, larger ones meet the entities in chunks.  The data are
    matched null-safely (R matches NA to NA).  The input is read several times (sizes, entities,
    axes, data); ``materialize`` checkpoints it first when it is expensive to recompute.
    """
    axes = list(axes)
    if materialize:
        df = _checkpoint(df)
    entities = df.select(axes[0]).distinct()
    if len(axes) == 1:
        return join_null_safe(entities, df, axes, "left")
    grid = _expand(entities, df, [[a] for a in axes[1:]], axis_rows)
    return join_null_safe(grid, df, axes, "left")


def nested_grid(df: DataFrame, entity: str, nested: Sequence[str], axis_rows: int = AXIS_ROWS) -> DataFrame:
    """Every entity x every observed tuple of ``nested`` (the grid of ``complete_nested``)."""
    return _expand(df.select(entity).distinct(), df, [list(nested)], axis_rows)


def complete_nested(
    df: DataFrame, entity: str, nested: Sequence[str], materialize: bool = False, axis_rows: int = AXIS_ROWS
) -> DataFrame:
    """``complete(entity, nesting(cols...))``: every entity x every observed tuple."""
    nested = list(nested)
    if materialize:
        df = _checkpoint(df)
    return join_null_safe(nested_grid(df, entity, nested, axis_rows), df, [entity] + nested, "left")


def frame_from_dimension(dim: DataFrame, start, end, date_col: str = "date") -> DataFrame:
    """Entity dimension x daily calendar (A2, J1, R12): a generator, not a join.

    Every dimension row explodes ``sequence(start, end)``; the calendar never exists as a
    table, so the frame is built in the scan's own tasks.
    """
    days = daily_sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return dim.select("*", F.explode(days).alias(date_col))
