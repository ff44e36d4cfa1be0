"""Exact top-k inner products by distributed histogram selection.

Vectors become integers and are packed into blocks.  The queries are a stated subset; their
blocks meet all blocks of rows, a bounded slice of query blocks at a time.  Every round scores
everything and refines, for each query, a histogram of the scores in the interval that holds the
k-th best one, until the interval is a single value.  A last round keeps the scores above the
k-th value and breaks ties at it by the smaller id.

A task keeps a histogram's topmost bins only until they hold k rows: the global k-th score is
never below a task's own, so lower bins cannot hold it.  Of the ties at the k-th value, however
many rows share it, a task passes on as many as are still wanted.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.shared import Stored

_BINS = 1024
_ROWS = 128  # query rows scored at once
_LOW, _HIGH = -(2**63), 2**63 - 1


def _pack(rows: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of rows of one dimension: ids and components as 64-bit integers, and the largest
    squared norm."""

    def run(batches):
        for b in batches:
            ids, vecs = b.column(0).to_numpy(), b.column(1)
            dims = np.diff(vecs.offsets.to_numpy())
            flat, first = vecs.values.to_numpy(zero_copy_only=False), vecs.offsets.to_numpy()[:-1]
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                for lo in range(0, len(own), block_rows):
                    at = own[lo : lo + block_rows]
                    m = flat[first[at][:, None] + np.arange(dim)].astype(np.int64)
                    norm = (m.astype(np.float64) ** 2).sum(axis=1).max(initial=0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), pa.array([float(norm)]), pa.array([ids[at].astype(np.int64).tobytes()]), pa.array([m.tobytes()])],
                        names=["dim", "norm", "ids", "vecs"],
                    )

    return rows.mapInArrow(run, "dim int, norm double, ids binary, vecs binary")


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products; those outside 64 bits become the nearest 64-bit value."""
    most = float(np.abs(q.astype(np.float64)).max(initial=0)) * float(np.abs(c.astype(np.float64)).max(initial=0)) * max(1, q.shape[1])
    if most < 2**53:
        return np.rint(q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return q @ c.T
    return np.clip(q.astype(object) @ c.astype(object).T, _LOW, _HIGH).astype(np.int64)


def _units(batches):
    """(query block, query ids, row of the first, scores, candidate ids, is own) for each pair of
    blocks and each run of query rows."""
    for b in batches:
        for r in b.to_pylist():
            c = np.frombuffer(r["vecs"], np.int64).reshape(-1, r["dim"]) if r["dim"] else np.zeros((len(r["ids"]) // 8, 0), np.int64)
            q = np.frombuffer(r["qvecs"], np.int64).reshape(-1, r["dim"]) if r["dim"] else np.zeros((len(r["qids"]) // 8, 0), np.int64)
            ids, qids = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["qids"], np.int64)
            for lo in range(0, len(q), _ROWS):
                part = slice(lo, lo + _ROWS)
                yield r, qids[part], lo, _products(q[part], c), ids, qids[part][:, None] == ids[None, :]


def _histograms(batches):
    """Sparse top bins (qblock, row, bin, n) of what one task scores."""
    total: dict[tuple[int, int], np.ndarray] = {}
    wanted: dict[tuple[int, int], np.ndarray] = {}
    for r, _, lo, score, _, own in _units(batches):
        key, n = (r["qblock"], lo), len(score)
        part = slice(lo, lo + n)
        low, high, width, need = (np.frombuffer(r[x], np.int64)[part] for x in ("low", "high", "width", "need"))
        # distances in unsigned arithmetic, so a range over all 64-bit values does not overflow
        place = (score.view(np.uint64) - low.view(np.uint64)[:, None]) // width.view(np.uint64)[:, None]
        # a settled row (low = high) needs no counts
        inside = ~own & (score >= low[:, None]) & (score <= high[:, None]) & (low < high)[:, None]
        cell = (place.astype(np.int64) + np.arange(n)[:, None] * _BINS)[inside]
        count = np.bincount(cell, minlength=n * _BINS).reshape(n, _BINS)
        total[key] = total[key] + count if key in total else count
        wanted[key] = need
    for (block, lo), count in total.items():
        above = np.cumsum(count[:, ::-1], axis=1)[:, ::-1] - count
        row, at = np.nonzero((count > 0) & (above < wanted[block, lo][:, None]))
        columns = (np.full(len(row), block), row + lo, at, count[row, at])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["qblock", "row", "bin", "n"])


def _best(batches):
    """Rows above the k-th value, and the smallest ids at it, of what one task scores."""
    ties: dict[tuple[int, int], tuple[int, np.ndarray, int, int]] = {}
    names = ["qblock", "row", "query_id", "vec_id", "score"]
    for r, qids, lo, score, ids, own in _units(batches):
        n = len(score)
        part = slice(lo, lo + n)
        low, need = (np.frombuffer(r[x], np.int64)[part] for x in ("low", "need"))
        row, at = np.nonzero(~own & (score > low[:, None]))
        columns = (np.full(len(row), r["qblock"]), row + lo, qids[row], ids[at], score[row, at])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=names)
        for i in np.flatnonzero((~own & (score == low[:, None])).any(axis=1)):
            equal = ids[~own[i] & (score[i] == low[i])]
            key = (r["qblock"], lo + int(i))
            known = ties[key][1] if key in ties else equal[:0]
            ties[key] = (int(qids[i]), np.sort(np.concatenate((known, equal)))[: int(need[i])], int(low[i]), 0)
    flat = [(block, row, q, int(v), s) for (block, row), (q, found, s, _) in ties.items() for v in found]
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*flat, strict=True) if flat else [[]] * 5)], names=names)


def top_k(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = 5,
    every: int = 50,
    scale: int = 256,
    block_rows: int = 4096,
    slice_bytes: int = 1 << 26,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best rows of every query: the rows whose id
    is divisible by ``every``, against all rows.  Components count as floor(scale * x).

    Defined results: a null vector, one with a null or non-finite component, and a row without
    an id take no part; a row with the query's own id is no candidate; a query with fewer than k
    candidates returns all; a query meets only vectors of its own dimension; repeated rows are
    candidates, and queries, of their own; products beyond 64 bits count as the nearest 64-bit value.
    """
    spark = vectors.sparkSession
    store = Stored(spark, "topk")
    x = F.col(vec_col)
    rows = vectors.where(
        F.col(id_col).isNotNull()
        & x.isNotNull()
        & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    ).select(F.col(id_col).cast("long").alias("id"), F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("v"))
    blocks = store.put(_pack(rows, block_rows), "blocks")
    queries = rows.where(F.col("id") % every == 0)
    n, dim = queries.agg(F.count("*"), F.max(F.size("v"))).first()
    per_block = max(_ROWS, min(2048, slice_bytes // (8 * (dim or 1) + 8)))
    packed = store.put(
        _pack(queries.repartition(max(1, math.ceil(n / per_block))), per_block).withColumn("qblock", F.monotonically_increasing_id()), "queries"
    )
    # block numbers and bounds: one small row for each few thousand queries
    known = packed.select("qblock", "dim", "norm", (F.length("ids") / 8).cast("long").alias("n"), (F.length("vecs") + F.length("ids")).alias("b"))
    of = known.orderBy("qblock").collect()
    largest = {r["dim"]: r["norm"] for r in blocks.groupBy("dim").agg(F.max("norm").alias("norm")).collect()}
    slices, size = [[]], 0
    for r in of:
        if slices[-1] and size + r["b"] > slice_bytes:
            slices, size = [*slices, []], 0
        slices[-1].append(r)
        size += r["b"]
    done: DataFrame | None = None
    for s, chosen in enumerate(x for x in slices if x):
        found = _select(store, s, blocks, packed, chosen, largest, k)
        done = found if done is None else done.unionByName(found)
    if done is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return done


def _select(store: Stored, s: int, blocks: DataFrame, packed: DataFrame, chosen, largest: dict[int, float], k: int) -> DataFrame:
    """The result of the query blocks ``chosen``."""
    spark = blocks.sparkSession
    state = {}
    for r in chosen:
        most = min(2.0**63, math.sqrt(r["norm"]) * math.sqrt(largest[r["dim"]]) * (1 + 1e-9) + 1)
        low, high = max(_LOW, -int(most)), min(_HIGH, int(most))
        width = -(-(high - low + 1) // _BINS)
        state[r["qblock"]] = [np.full(r["n"], x, np.int64) for x in (low, high, width, k)]
    slice_ = packed.where(F.col("qblock").isin(list(state))).select(
        "qblock", "dim", F.col("ids").alias("qids"), F.col("vecs").alias("qvecs")
    )

    def units(of: list[int]) -> DataFrame:
        """Pairs of blocks; the broadcast side has at most ``slice_bytes`` and its state."""
        at = spark.createDataFrame(
            [(b, *(bytearray(a.tobytes()) for a in state[b])) for b in of], "qblock long, low binary, high binary, width binary, need binary"
        )
        return blocks.select("dim", "ids", "vecs").join(F.broadcast(slice_.join(F.broadcast(at), "qblock")), "dim")

    while unsettled := [b for b, (low, high, *_) in state.items() if (low < high).any()]:
        bins = units(unsettled).mapInArrow(_histograms, "qblock long, row long, bin long, n long")
        mine = Window.partitionBy("qblock", "row").orderBy(F.desc("bin"))
        summed = bins.groupBy("qblock", "row", "bin").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(mine))
        # the topmost bin that completes the wanted number, or the lowest known one
        got = (
            summed.groupBy("qblock", "row")
            .agg(F.sort_array(F.collect_list(F.struct("upto", "bin", "n"))).alias("x"))
            .toArrow()  # bounds of the slice's queries: a few numbers for each of them
        )
        # rows without any candidate have no bins
        idle = {b: state[b][0] < state[b][1] for b in unsettled}
        for block, row, x in zip(*(got.column(c).to_pylist() for c in ("qblock", "row", "x")), strict=True):
            low, high, width, need = state[block]
            hit = next((y for y in x if y["upto"] >= need[row]), None)
            idle[block][row] = False
            if hit is None:  # fewer candidates than wanted: all of them
                low[row] = high[row] = _LOW
                continue
            least = int(low[row]) + hit["bin"] * int(width[row])
            # the bin's own upper end: the next round's bins, rounded up, may reach beyond it
            low[row], high[row] = least, min(int(high[row]), least + int(width[row]) - 1)
            need[row] -= hit["upto"] - hit["n"]
            width[row] = -(-int(width[row]) // _BINS)
        for block, rows in idle.items():
            state[block][0][rows] = state[block][1][rows] = _LOW
    best = units(list(state)).mapInArrow(_best, "qblock long, row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("qblock", "row").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return store.put(ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"), f"best-{s}")


#: The same result over ``embeddings``.
TOP_K_SQL = """
with rows as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
  from rows q, rows c where q.vec_id % 50 = 0 and c.vec_id <> q.vec_id and len(q.v) = len(c.v)
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from scored qualify rank <= 5
"""
