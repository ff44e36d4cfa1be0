import math
import random

import duckdb
import numpy as np

from paneltide.llm import topk
from paneltide.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def _brute(rows, k=5, every=50):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every == 0:
            scored = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=True)))), i) for i, b in ok if i != q and len(b) == len(a))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(f"select query_id, rank, vec_id, score from ({ORACLES['op9_top_k']}) order by 1, 2").fetchall()
    got = QUERIES["op9_top_k"](spark, SF).select("query_id", "rank", "vec_id", "score")
    assert sorted(tuple(r) for r in got.collect()) == want


def test_ties_sparse_dimensions_and_bad_vectors(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-1.0, 0.5, 0.25]) for _ in range(3)]) for i in range(300)]
    rows += [(i, [0.5, 0.5, 0.5]) for i in range(300, 500)]  # many rows share one score
    rows += [(600, [1.0, 2.0]), (601, [3.0, 4.0]), (650, []), (700, [9.0] * 7)]
    rows += [(50, None), (1000, [1.0, None, 2.0]), (1050, [1.0, float("nan"), 2.0]), (1100, [1.0, float("inf"), 2.0]), (None, [1.0, 1.0, 1.0])]
    rows += [(750, [1e6, -3e7]), (751, [1e15, 1e15]), (752, [-1e15, 1e12])]
    docs = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, rank string")
    for options in ({}, {"block_rows": 16, "slice_bytes": 4096}):
        got = topk.top_k(docs, **options).collect()
        assert sorted(tuple(r) for r in got) == _brute(rows)
    assert topk.top_k(docs.limit(0)).count() == 0


def test_products_are_exact_beyond_doubles():
    q, c = np.array([[2**31 + 1, 3]]), np.array([[2**30 + 1, 5], [2**61, 2**61]])
    assert topk._products(q, c).tolist() == [[(2**31 + 1) * (2**30 + 1) + 15, 2**63 - 1]]


def test_unnormalised_vectors_need_several_rounds(spark):
    rnd = np.random.default_rng(7)
    for scale, options in ((1.0, {}), (30.0, {"block_rows": 64, "slice_bytes": 8192}), (1e5, {}), (0.01, {})):
        rows = [(i, [float(x) for x in v]) for i, v in enumerate(rnd.normal(size=(400, 6)) * scale)]
        rows += [(1000 + i, [float(x) for x in v]) for i, v in enumerate(rnd.normal(size=(200, 3)) * 0.05)]  # settled in fewer rounds
        rows += [(2000 + i, rows[i % 7][1]) for i in range(30)]
        docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert sorted(tuple(r) for r in topk.top_k(docs, **options).collect()) == _brute(rows)
