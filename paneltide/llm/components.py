"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm.shared import Stored


def _large_star(e: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the smallest of the node and its neighbours."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    return both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of these."""
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least.select(F.col("u").alias("w"), "m"), F.col("u") == F.col("w")).where("v > m")
    return moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, store: Stored, name: str, files: int | None = None) -> DataFrame:
    """(node, component) of every node in ``links`` (u, v) that is not its component's smallest;
    a component is named by its smallest node.  Links of a node to itself are left out.  Each
    step is stored as ``files`` files, or as many as tasks made it."""

    def put(df: DataFrame, step: int) -> DataFrame:
        return store.put(df.repartition(files) if files else df, f"{name}-{step}")

    step, last = 0, None
    e = put(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), 0)
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == last or not state[0]:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        last, step = tuple(state), step + 1
        e = put(_small_star(_large_star(e)).distinct(), step)
        store.drop(f"{name}-{step - 1}")
