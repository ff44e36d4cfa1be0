"""Grouped aggregations.

All are ordinary hash aggregations with Spark's partial (map-side) step, so a hot group is
combined in every map task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import strict_sum, zero_sum
from ..session import cut_lineage
from .joins import checked_broadcast, join_null_safe

SEXTILES = [1 / 6, 2 / 6, 3 / 6, 4 / 6, 5 / 6]


def group_sum(df: DataFrame, keys: Sequence[str], cols: Sequence[str], strict: bool = True) -> DataFrame:
    """Group sum; ``strict`` = null if any input is null (G1), else nulls as 0."""
    f = strict_sum if strict else zero_sum
    return df.groupBy(*keys).agg(*[f(c).alias(c) for c in cols])


def group_by_types(df: DataFrame, strict: bool = False) -> DataFrame:
    """Group by every string column and sum every numeric column.

    ``group_by_if(is.character) %>% summarize_all(sum, na.rm=TRUE)``; the split is read
    from the schema, never from the data.  Columns of other types are dropped.
    """
    keys = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    nums = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return group_sum(df, keys, nums, strict=strict)


def numeric_null_to_zero(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """``mutate_if(is.numeric, replace_na, 0)`` - every numeric column, population too."""
    nums = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    return df.fillna(0, subset=nums) if nums else df


def quantile_cuts(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probs: Sequence[float] = SEXTILES,
    positive_only: bool = True,
    prefix: str = "q",
    spill_safe: bool = False,
) -> DataFrame:
    """Per-group cut points, linear interpolation (R type 7), by distributed rank selection.

    The distinct values of every group are counted (map-side combined, so a frequent value is
    one row), range-partitioned by (group, value) and stored.  The counts of each (group,
    partition) pair, at most one row for each group and partition beyond the other's number,
    give every partition's first rank; only partitions that hold a wanted rank are read again,
    each (group, partition) pair in a task of its own.  So no group is worked in one task and
    no task holds more than a partition, however many values a group has.

    The result is that of R's default ``quantile``, and of Spark's ``percentile`` to the bit.  A
    group with no qualifying value gets null cut points.  ``spill_safe`` uses
    :func:`quantile_cuts_sorted` instead, which sorts a group's values in one task and leaves
    such groups out.
    """
    if spill_safe:
        return quantile_cuts_sorted(df, groups, value, probs, positive_only, prefix)
    groups = list(groups)
    v = F.col(value).cast("double")
    if positive_only:
        v = F.when(v > 0, v)
    # a group's null value keeps the group and counts nothing
    hist = df.select(*groups, v.alias("__v")).groupBy(*groups, "__v").agg(F.count("__v").alias("__c"))
    placed = cut_lineage(hist.repartitionByRange(*groups, "__v").withColumn("__part", F.spark_partition_id()))
    sizes = placed.groupBy(*groups, "__part").agg(F.sum("__c").alias("__size"))
    of_group = Window.partitionBy(*groups)
    before = of_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ranks = sizes.withColumns(
        {"__before": F.coalesce(F.sum("__size").over(before), F.lit(0)), "__tot": F.sum("__size").over(of_group)}
    )
    at = [(F.col("__tot") - 1).cast("double") * F.lit(float(p)) for p in probs]
    wanted = F.array(*[f(pos).cast("long") for pos in at for f in (F.floor, F.ceil)])
    holds = F.exists(wanted, lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__size")))
    needed = checked_broadcast(ranks.where(holds | (F.col("__tot") == 0)).select(*groups, "__part", "__before", "__tot"))
    in_part = Window.partitionBy(*groups, "__part").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    staged = join_null_safe(placed, needed, [*groups, "__part"], "inner").withColumn(
        "__start", F.col("__before") + F.sum("__c").over(in_part) - F.col("__c")
    )
    return _interpolated(staged, groups, probs, prefix)


def _interpolated(staged: DataFrame, groups: list[str], probs: Sequence[float], prefix: str) -> DataFrame:
    """Type-7 cut points from rows (groups, ``__v``, ``__start``: the value's first rank,
    ``__tot``): the value at a rank is the largest one that starts at or before it."""
    n = F.col("__tot")
    known = F.col("__v").isNotNull()
    aggs = [F.max(n).alias("__n")]
    for i, p in enumerate(probs):
        pos = (n - 1).cast("double") * F.lit(float(p))
        aggs.append(F.max(F.when(known & (F.col("__start") <= F.floor(pos)), F.col("__v"))).alias(f"__lo{i}"))
        aggs.append(F.max(F.when(known & (F.col("__start") <= F.ceil(pos)), F.col("__v"))).alias(f"__hi{i}"))
    per = staged.groupBy(*groups).agg(*aggs)
    out = []
    for i, p in enumerate(probs):
        pos = (F.col("__n") - 1).cast("double") * F.lit(float(p))
        lo_k, hi_k = F.floor(pos), F.ceil(pos)
        lo_v, hi_v = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        interp = (hi_k - pos) * lo_v + (pos - lo_k) * hi_v
        out.append(F.when(lo_v == hi_v, lo_v).otherwise(interp).alias(f"{prefix}{i + 1}"))
    return per.select(*groups, *out)


def quantile_cuts_sorted(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probs: Sequence[float] = SEXTILES,
    positive_only: bool = True,
    prefix: str = "q",
) -> DataFrame:
    """Exact type-7 cut points without holding a group's values in memory.

    A distributed histogram (group, value) -> count (partial aggregation), running counts
    in a sort-based window per group (which spills to disk instead of needing the whole
    group in memory), then each position's value is the largest value whose first
    position is at or before it.  The interpolation is the same arithmetic as
    ``percentile``, so both give identical doubles.
    """
    groups = list(groups)
    v = F.col(value).cast("double")
    if positive_only:
        v = F.when(v > 0, v)
    hist = df.select(*groups, v.alias("__v")).filter(F.col("__v").isNotNull()).groupBy(*groups, "__v").agg(
        F.count(F.lit(1)).alias("__c")
    )
    w = Window.partitionBy(*groups).orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    staged = hist.withColumns(
        {"__start": F.sum("__c").over(w) - F.col("__c"), "__tot": F.sum("__c").over(Window.partitionBy(*groups))}
    )
    return _interpolated(staged, groups, probs, prefix)


def class_lower_bounds(df: DataFrame, groups: Sequence[str], value: str, cls: str, n: int = 6, prefix: str = "lw") -> DataFrame:
    """Lower bound of classes 2..n: min value per class, empty class -> previous bound.

    The first fallback is 0.  One aggregation with a conditional ``min`` per class.
    """
    v = F.col(value)
    mins = [F.min(F.when(F.col(cls) == k, v)).alias(f"__m{k}") for k in range(2, n + 1)]
    agg = df.groupBy(*groups).agg(*mins)
    prev = F.lit(0.0)
    out = agg
    for k in range(2, n + 1):
        cur = F.coalesce(F.col(f"__m{k}").cast("double"), prev)
        out = out.withColumn(f"{prefix}{k}", cur)
        prev = F.col(f"{prefix}{k}")
    return out.drop(*[f"__m{k}" for k in range(2, n + 1)])
