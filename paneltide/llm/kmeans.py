"""Centroid clustering: exact integer k-means whose assignment is a bisector tournament.

For every pair of centroids the integer normal of the bisecting plane, 2 (b - a), and the
threshold |b|^2 - |a|^2 are computed once a round.  A vector's nearest centroid is then found by
k - 1 sign tests: the winner so far meets the next number, and loses only if the vector lies
strictly on the other's side, so a zero favours the smaller number.  The distance is computed
once, to the centroid that is left.

Vectors are packed into stored blocks.  A round is one pass over the blocks, in which each task
adds up the vectors of every cluster; only k sums of integers reach the driver.

Defined results: vectors of another length than ``dim``, null ones and those with a null or
non-finite component take no part; a row without an id is clustered but starts no centroid while
others can; repeated rows count each; rows with one id start in the order of their components;
with fewer rows than ``k`` every row starts a centroid; without rows the result is empty.  A
component beyond 64 bits counts as the nearest 64-bit integer, and so do distances and their sums.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paneltide.llm.shared import Stored

_MOST = 2**63 - 1
_PAIR_BYTES = 1 << 26
_ROWS = 2048


class Bisectors:
    """The bisecting planes of all pairs of centroids, in exact integers."""

    def __init__(self, centroids: list[list[int]]):
        c = np.array(centroids, dtype=object)
        norms = (c * c).sum(axis=1)
        self.centroids = c
        self.normals = 2 * (c[None, :, :] - c[:, None, :])  # [a, b]: from a to b
        self.thresholds = norms[None, :] - norms[:, None]
        self.most = max((abs(x) for row in centroids for x in row), default=0)
        self.kinds = {}

    def _as(self, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if kind not in self.kinds:
            self.kinds[kind] = tuple(x.astype(kind) for x in (self.normals, self.thresholds, self.centroids))
        return self.kinds[kind]

    def assign(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, exact squared distance) of 64-bit vectors."""
        largest = max(int(np.abs(v.astype(np.float64)).max(initial=0)) + 1, self.most)
        # whatever a test or a distance adds up stays below 16 * dim * largest**2
        bound = 16 * v.shape[1] * largest * largest
        kind = np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object
        normals, thresholds, centroids = self._as(kind)
        x, winner = v.astype(kind), np.zeros(len(v), np.int64)
        for b in range(1, len(centroids)):
            # rows are tested in groups of the same winner, against one plane each
            for a in np.unique(winner):  # the winners before this test; b itself is none of them
                at = np.flatnonzero(winner == a)
                side = x[at] @ normals[a, b] - thresholds[a, b]
                winner[at[side > 0]] = b
        gap = x - centroids[winner]
        distance = (gap * gap).sum(axis=1) if kind is not object else np.array([sum(g * g for g in row) for row in gap], dtype=object)
        return winner, np.minimum(distance, _MOST).astype(np.int64) if kind is not np.float64 else distance.astype(np.int64)


def _blocks(rows: DataFrame, dim: int) -> DataFrame:
    """Blocks of ids and vectors as packed 64-bit integers; ids may be null."""

    def run(batches):
        for b in batches:
            ids, vecs = b.column(0), b.column(1)
            flat = vecs.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            for lo in range(0, len(ids), _ROWS):
                part = ids.slice(lo, _ROWS)
                known = part.is_valid().to_numpy(zero_copy_only=False)
                own = part.fill_null(0).to_numpy()
                columns = [known.astype(np.uint8), own.astype(np.int64), flat[lo : lo + _ROWS].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()]) for x in columns], names=["known", "ids", "vecs"])

    return rows.mapInArrow(run, "known binary, ids binary, vecs binary")


def _vectors(batches, dim: int):
    for b in batches:
        for r in b.to_pylist():
            known, ids = np.frombuffer(r["known"], np.uint8).astype(bool), np.frombuffer(r["ids"], np.int64)
            yield known, ids, np.frombuffer(r["vecs"], np.int64).reshape(-1, dim)


def _exact_sum(v: np.ndarray) -> np.ndarray:
    if float(np.abs(v.astype(np.float64)).max(initial=0)) * len(v) < 2**62:
        return v.sum(axis=0).astype(object)
    return v.astype(object).sum(axis=0)


def _new_centroids(blocks: DataFrame, centroids: list[list[int]], dim: int) -> list[list[int]]:
    """Floor means of the vectors nearest to each centroid; empty clusters keep theirs."""

    def run(batches):
        planes, sums, counts = Bisectors(centroids), {}, {}
        for _, _, v in _vectors(batches, dim):
            winner, _ = planes.assign(v)
            for a in np.unique(winner).tolist():
                own = v[winner == a]
                sums[a] = sums.get(a, 0) + _exact_sum(own)
                counts[a] = counts.get(a, 0) + len(own)
        if sums:
            flat = [(a, j, Decimal(int(x)), counts[a]) for a, total in sums.items() for j, x in enumerate(total)]
            types = (pa.int32(), pa.int32(), pa.decimal128(38, 0), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*flat, strict=True), types, strict=True)], names=["cluster", "j", "s", "n"]
            )

    part = blocks.mapInArrow(run, "cluster int, j int, s decimal(38,0), n long")
    found = part.groupBy("cluster", "j").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()  # k * dim rows
    new = [list(c) for c in centroids]
    for r in found:
        new[r["cluster"]][r["j"]] = int(r["s"]) // r["n"]
    return new


def cluster(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    dim: int = 64,
    k: int = 16,
    rounds: int = 3,
    scale: int = 64,
    salt: str = "1:",
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector of
    ``dim`` finite components, taken as floor(scale * x).  The centroids start as the k vectors
    with the smallest SHA-256 of salt and id, in that order."""
    if dim < 1 or k < 1 or k * k * dim * 8 > _PAIR_BYTES:
        raise ValueError("dim and k must be positive, and the planes of all pairs of centroids fit 64 MB")
    spark = vectors.sparkSession
    x = F.col(vec_col)
    ok = x.isNotNull() & (F.size(x) == dim) & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    rows = vectors.where(ok).select(
        F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("v")
    )
    dice = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    start = rows.orderBy(dice.asc_nulls_last(), "v").limit(k).collect()
    if not start:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = [list(r["v"]) for r in start]
    store = Stored(spark, "kmeans")
    blocks = store.put(_blocks(rows, dim), "blocks")
    for _ in range(rounds):
        centroids = _new_centroids(blocks, centroids, dim)
    final = centroids

    def run(batches):
        planes = Bisectors(final)
        for known, ids, v in _vectors(batches, dim):
            winner, distance = planes.assign(v)
            columns = (pa.array(ids, mask=~known), pa.array(winner.astype(np.int32)), pa.array(distance))
            yield pa.RecordBatch.from_arrays(list(columns), names=["vec_id", "cluster", "distance"])

    assigned = store.put(blocks.mapInArrow(run, "vec_id long, cluster int, distance long"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # k rows
    inertia = min(_MOST, sum(int(r["s"]) for r in sums))
    known = [
        (r["cluster"], min(_MOST, int(r["s"])), inertia, hashlib.sha256(",".join(map(str, final[r["cluster"]])).encode()).hexdigest())
        for r in sums
    ]
    of = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(k: int = 16, rounds: int = 3) -> str:
    """The same result over ``embeddings``: distances to all centroids, round by round."""
    parts = [
        """rows as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings
  where embedding is not null and len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
)""",
        f"""c0 as (
  select cast(row_number() over (order by sha256('1:' || cast(vec_id as varchar)) nulls last, v) - 1 as integer) as cluster, v
  from rows qualify cluster < {k}
)""",
    ]
    for i in range(rounds + 1):
        parts.append(
            f"""a{i} as (
  select r.r, r.vec_id, r.v, c.cluster,
    cast(list_sum(list_transform(range(1, 65), lambda j: (r.v[j] - c.v[j]) * (r.v[j] - c.v[j]))) as bigint) as distance
  from rows r, c{i} c qualify row_number() over (partition by r.r order by distance, c.cluster) = 1
)"""
        )
        if i < rounds:
            parts.append(
                f"""m{i} as (
  select cluster, j, cast(floor_sum as bigint) as x from (
    select cluster, j, (s - ((s % n) + n) % n) // n as floor_sum from (
      select cluster, j, sum(v[j]) as s, count(*) as n from a{i}, range(1, 65) t(j) group by 1, 2))
), c{i + 1} as (
  select cluster, coalesce((select list(x order by j) from m{i} where m{i}.cluster = c{i}.cluster), v) as v from c{i}
)"""
            )
    return f"""with {", ".join(parts)}
select vec_id, a.cluster, distance, cast(sum(distance) over (partition by a.cluster) as bigint) as cluster_inertia,
  cast(sum(distance) over () as bigint) as inertia, sha256(array_to_string(c.v, ',')) as centroid_sha256
from a{rounds} a join c{rounds} c on a.cluster = c.cluster"""


CLUSTER_SQL = _sql()
