import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from paneltide.llm import kmeans
from paneltide.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
MOST = 2**63 - 1


def _brute(rows, dim, k, rounds, scale=64):
    clip = lambda x: max(-(2**63), min(MOST, x))
    ok = [
        (i, [clip(math.floor(scale * x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)
    ]
    dice = lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(ok, key=dice)[:k]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (gap(v, centroids[c]), c))
    for _ in range(rounds):
        of = [nearest(v) for _, v in ok]
        for c in range(len(centroids)):
            own = [v for (_, v), w in zip(ok, of, strict=True) if w == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, c, min(MOST, gap(v, centroids[c]))) for (i, v) in ok for c in [nearest(v)]]
    total = min(MOST, sum(d for *_, d in found))
    sums = {c: min(MOST, sum(d for _, w, d in found if w == c)) for _, c, _ in found}
    names = {c: hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest() for c in sums}
    return sorted(((i, c, d, sums[c], total, names[c]) for i, c, d in found), key=str)


def _run(df, **options):
    return sorted((tuple(r) for r in kmeans.cluster(df, **options).collect()), key=str)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(ORACLES["op13_bisector_clusters"]).fetchall()
    assert sorted(tuple(r) for r in QUERIES["op13_bisector_clusters"](spark, SF).collect()) == sorted(want)


def test_ties_repeats_empty_clusters_and_bad_vectors(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([-0.5, 0.25, 0.26, 1.0]) for _ in range(3)]) for i in range(200)]
    rows += [(i, [0.25, 0.25, 0.25]) for i in range(200, 400)]  # centroids that are equal leave clusters empty
    rows += [(7, [9.0, 9.0, 9.0]), (7, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 3.0]), (None, [5.0, 5.0, 5.0]), (None, [5.0, 5.0, 5.0])]
    rows += [(900, None), (901, []), (902, [1.0, 2.0]), (903, [1.0, None, 2.0]), (904, [1.0, float("nan"), 2.0]), (905, [float("inf"), 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, distance string")
    for options in ({"k": 16, "rounds": 3}, {"k": 40, "rounds": 2}, {"k": 1, "rounds": 1}, {"k": 5, "rounds": 0}):
        assert _run(df.repartition(5), dim=3, **options) == _brute(rows, 3, **options)
    few = df.where("vec_id between 3 and 8")
    assert _run(few, dim=3, k=60) == _brute([r for r in rows if r[0] is not None and 3 <= r[0] <= 8], 3, 60, 3)
    assert _run(df.limit(0), dim=3) == [] and _run(df, dim=64) == []


def test_exact_beyond_doubles_and_64_bits(spark):
    rnd = np.random.default_rng(1)
    for size in (1e5, 1e8, 1e16, 1e200):
        rows = [(i, [float(x) for x in v]) for i, v in enumerate(rnd.normal(size=(60, 2)) * size)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert _run(df, dim=2, k=4) == _brute(rows, 2, 4, 3)


def test_tournament_equals_all_distances():
    rnd = np.random.default_rng(2)
    centroids = rnd.integers(-3, 4, size=(20, 4))
    v = rnd.integers(-4, 5, size=(500, 4))
    gaps = ((v[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    winner, distance = kmeans.Bisectors(centroids.tolist()).assign(v)
    assert winner.tolist() == gaps.argmin(axis=1).tolist() and distance.tolist() == gaps.min(axis=1).tolist()


def test_planes_are_bounded(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64 MB"):
        kmeans.cluster(df, dim=64, k=5000)
