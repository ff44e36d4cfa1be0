import random
import re
from collections import Counter

import numpy as np

from paneltide.llm import decontaminate as D

SF = "/root/testdata/sf0.001"


def _bag(w, size=5):
    size = min(size, len(w))
    return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if w else Counter()


def _sim(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def _words(t):
    return re.findall(r"\w+", (t or "").lower())


def _brute(docs, items):
    """Best similarity of every (document, item) over all windows of the item's size."""
    out = {}
    for i, t in docs:
        w = _words(t)
        for k, x in items:
            v = _words(x)
            if not v or not w:
                continue
            n = min(5, len(v))
            bag = _bag(v)
            best = max((_sim(bag, _bag(w[b : b + len(v)], n)) for b in range(max(1, len(w) - len(v) + 1)) if len(w[b:]) >= n), default=0)
            if best >= 0.8:
                out[i, k] = round(best, 9)
    return out


def _found(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = D.find_leaks(d, b, keep=["doc_id"], **options).collect()
    return {(r["doc_id"], x["item_id"]): x for r in rows for x in r["leaks"]}


def test_against_brute_force_on_the_tables_and_edited_passages(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() if len(r["text"]) < 4000]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rnd = random.Random(1)
    for j, (_, t) in enumerate(items[:30]):
        w = _words(t)
        if j % 3 == 0:
            w[rnd.randrange(len(w))] = "changed"
        if j % 3 == 1:
            w = w[1:]
        docs.append((5000 + j, "Some words BEFORE it. " + ",  ".join(w).upper() + " and after it"))
    want = _brute(docs, items)
    got = _found(spark, docs, items)
    assert {k: round(v["similarity"], 9) for k, v in got.items()} == want
    assert len(want) > 20
    assert _found(spark, docs, items, items_per_slice=32).keys() == want.keys()
    texts = dict(docs)
    (i, _), hit = next((k, v) for k, v in got.items() if k[0] >= 5000)
    assert "BEFORE" not in texts[i][hit["start"] : hit["end"]]


def test_index_returns_all_within_the_radius():
    rng = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 500, 30)) for _ in range(40)]
    index = D.build(list(range(40)), texts, 5)
    prints = np.concatenate([index.prints ^ (rng.random(index.prints.shape) < p) for p in (0.1, 0.25, 0.31, 0.5)])
    for p, items in zip(prints, D.within_radius(prints, index), strict=True):
        assert items.tolist() == np.flatnonzero((index.prints != p).sum(axis=1) <= D.RADIUS).tolist()


def test_edge_rows(spark):
    docs = [(1, None), (2, ""), (3, "alpha beta"), (3, "alpha beta"), (None, "x alpha, Beta y"), (4, "q " * 150_000 + "alpha beta")]
    items = [(1, "alpha beta"), (2, None), (3, "!!"), (None, "alpha beta"), (4, "alpha beta")]
    d = spark.createDataFrame([(i, t, 7) for i, t in docs], "doc_id long, text string, leaks int")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = D.find_leaks(d, b).collect()
    assert len(rows) == 6 and rows[0]["text"] is None
    assert [sorted(x["item_id"] for x in r["leaks"]) for r in rows] == [[], [], [1, 4], [1, 4], [1, 4], [1, 4]]
    assert D.find_leaks(d.limit(0), b).count() == 0
    assert all(not r["leaks"] for r in D.find_leaks(d, b.limit(0)).collect())
