"""Joins with R semantics.

R's ``merge`` / ``left_join`` match NA keys to NA keys, so every join here is null-safe
(``<=>``), which Spark still plans as a hash or sort-merge join on rewritten keys.  Only
provably small sides are broadcast explicitly (1-row tables, literal parameter grids);
everything else is left to the planner and AQE, which measure the real size at runtime
and fall back to a shuffled join when a side is large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a 1-row table (a global aggregate such as min/max dates) to
    every row.  The side is one row by construction, so it is broadcast; this is a scalar
    lookup, not a cross product."""
    return df.crossJoin(F.broadcast(one_row))


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on ``keys`` with NA = NA; one output column per key (like ``USING``).

    For ``full`` joins the key columns are coalesced from both sides.
    """
    keys = list(keys)
    r_alias = {k: f"__r_{k}" for k in keys}
    r = right.select(*[F.col(c).alias(r_alias[c]) if c in r_alias else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(r_alias[k]))
        cond = c if cond is None else cond & c
    joined = left.join(r, cond, how)
    if how in ("left_semi", "semi", "left_anti", "anti"):
        return joined
    out = []
    for c in left.columns:
        if c in r_alias:
            out.append(F.coalesce(F.col(c), F.col(r_alias[c])).alias(c) if how in ("full", "outer", "full_outer", "right") else F.col(c))
        else:
            out.append(F.col(c))
    out += [F.col(c) for c in right.columns if c not in r_alias and c not in left.columns]
    return joined.select(*out)


def full_outer_split(left: DataFrame, right: DataFrame, keys: Sequence[str], share: float = 1.0, least: int = 1024) -> DataFrame:
    """Null-safe full outer join whose heavy keys are split over many tasks.

    Spark cannot split a skewed partition of a full outer join, as rows of either side may be
    the unmatched ones.  Here both sides' keys are counted first (map-side combined).  A key is
    heavy if one side has more than ``share`` of a task's even share of all rows (``least`` rows at
    the least), so there are at most about 2 / ``share`` heavy keys for each shuffle partition, and their table is
    broadcast.  Whether a heavy key has a match is known from the counts: on one side only, its
    rows just get nulls; on both, they meet in an inner join in which each side is dealt to as
    many parts as its own share asks for and repeated for the other side's parts.  All other keys
    meet in an ordinary full outer join.  No row is dropped or sampled, and null keys (which match
    each other) are keys like any other.

    Both sides are stored first: they are read more than once, and the dealing of rows must not
    change when a task is run again.  Result as :func:`join_null_safe` with ``how="full"``.
    """
    keys = list(keys)
    left, right = cut_lineage(left), cut_lineage(right)
    n_left, n_right = (d.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for d, n in ((left, "__nl"), (right, "__nr")))
    counted = cut_lineage(join_null_safe(n_left, n_right, keys, "full").fillna(0, subset=["__nl", "__nr"]))
    rows = counted.agg(F.sum(F.col("__nl") + F.col("__nr"))).first()[0] or 0
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = max(least, int(share * rows / parts))
    heavy = counted.where((F.col("__nl") > most) | (F.col("__nr") > most))
    if not heavy.limit(1).count():
        return join_null_safe(left, right, keys, "full")
    # parts of an eighth of the bound: parts are dealt by hash, and many small ones fall evenly
    parts_of = lambda n: F.when(F.col(n) > most, F.ceil(8 * F.col(n) / most)).otherwise(F.signum(n)).cast("int")
    heavy = F.broadcast(heavy.select(*keys, parts_of("__nl").alias("__pl"), parts_of("__nr").alias("__pr")))
    light = join_null_safe(*(join_null_safe(d, heavy, keys, "left_anti") for d in (left, right)), keys, "full")
    of_left, of_right = (join_null_safe(d, heavy, keys, "inner") for d in (left, right))
    # on one side only: nothing to meet
    lone = of_left.where("__pr = 0").select(*left.columns).unionByName(
        of_right.where("__pl = 0").select(*right.columns), allowMissingColumns=True
    )

    def dealt(df: DataFrame, own: str, other: str, own_part: str, other_part: str) -> DataFrame:
        part = F.pmod(F.monotonically_increasing_id(), F.col(own)).cast("int").alias(own_part)
        placed = df.where((F.col(own) > 0) & (F.col(other) > 0)).select("*", part)
        return placed.withColumn(other_part, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop(own, other)

    a, b = dealt(of_left, "__pl", "__pr", "__i", "__j"), dealt(of_right, "__pr", "__pl", "__j", "__i")
    met = join_null_safe(a, b, [*keys, "__i", "__j"], "inner").select(*light.columns)
    return light.unionByName(lone.select(*light.columns)).unionByName(met)


def checked_broadcast(df: DataFrame, most: int = 10_000) -> DataFrame:
    """A small table (one row per group, say) stored and marked for broadcast if it has at most
    ``most`` rows; otherwise stored and left to a shuffled join.  The large side then never
    moves to meet a handful of rows."""
    stored = cut_lineage(df)
    return F.broadcast(stored) if stored.limit(most + 1).count() <= most else stored


def natural_left_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """dplyr ``left_join(x, y)`` with no ``by``: every shared column is a key."""
    keys = [c for c in left.columns if c in right.columns]
    if not keys:
        raise ValueError("natural join needs at least one shared column")
    return join_null_safe(left, right, keys, "left")


def semi_join(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df[x %in% unique(other$x)]`` as a null-safe left-semi join."""
    return join_null_safe(df, other.select(*keys).distinct(), keys, "left_semi")


def clip_to_range(df: DataFrame, date_col: str, other: DataFrame, other_date: str | None = None) -> DataFrame:
    """Keep rows inside ``other``'s observed min..max date.

    The bounds are scalar subqueries, known before ``df`` is scanned: of a table that is
    partitioned by the date only the partitions inside them are read.  No value reaches the
    driver's code; without any date in ``other`` no row is kept.
    """
    od = other_date or date_col
    lo, hi = other.agg(F.min(od)).scalar(), other.agg(F.max(od)).scalar()
    return df.filter((F.col(date_col) >= lo) & (F.col(date_col) <= hi))


def at_global_max(df: DataFrame, date_col: str, source: DataFrame | None = None, source_date: str | None = None) -> DataFrame:
    """Rows on the global max date (P16), the max taken from ``source`` (default ``df``).

    Take the max from a small, early table (the raw scan or the date axis), not from a
    densified panel, or the whole densify subtree is planned twice.
    """
    src = source if source is not None else df
    sd = source_date or date_col
    m = src.agg(F.max(sd).alias("__max"))
    return df.join(F.broadcast(m), F.col(date_col) == F.col("__max"), "left_semi")


def lookup_join(df: DataFrame, key: str, table: DataFrame, table_key: str, cols: Sequence[str]) -> DataFrame:
    """Left join of chosen columns of a dimension on one key (J4, J7); missing -> null.

    The dimension is pruned to the key and the wanted columns before the join so the
    scan reads only those columns.
    """
    t = table.select(F.col(table_key).alias("__k"), *cols)
    return df.join(t, F.col(key).eqNullSafe(F.col("__k")), "left").drop("__k")


def normalise_key(c) -> Column:
    """Free-text entity name -> comparison key: lower case, trimmed, ``*`` removed."""
    c = F.col(c) if isinstance(c, str) else c
    return F.lower(F.trim(F.translate(c, "*", "")))


def alias_join(df: DataFrame, name_col: str, aliases: DataFrame, alias_col: str, code_col: str, out: str) -> DataFrame:
    """Standardise free-text names to a code through an alias table.

    Both sides are normalised with :func:`normalise_key`; unmatched names get null.  Two
    spellings that normalise alike must carry one code: otherwise the rows of that name would
    be duplicated, so the query fails with the name.
    """
    a = (
        aliases.select(normalise_key(alias_col).alias("__ak"), F.col(code_col).alias("__code"))
        .groupBy("__ak")
        .agg(F.min("__code").alias("__lo"), F.max("__code").alias("__hi"))
        .select(
            "__ak",
            F.when(F.col("__lo").eqNullSafe(F.col("__hi")), F.col("__lo"))
            .otherwise(F.raise_error(F.concat(F.lit("alias with more than one code: "), F.col("__ak"))))
            .alias(out),
        )
    )
    return df.join(a, normalise_key(name_col) == F.col("__ak"), "left").drop("__ak")
