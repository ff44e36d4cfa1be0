import random
import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from paneltide.llm import minhash
from paneltide.llm.components import components
from paneltide.llm.shared import Stored

SF = "/root/testdata/sf0.001"


def _set(text, size=5):
    w = re.findall(r"\w+", (text or "").lower())
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def _classes(rows, similarity=0.8):
    """Brute force: links of similar sets, and their components."""
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(_set(t))
    boss = {i: i for i in sets}

    def find(x):
        while boss[x] != x:
            x = boss[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            if any(x and y and len(x & y) >= similarity * len(x | y) for x in sets[a] for y in sets[b]):
                u, v = sorted((find(a), find(b)))
                boss[v] = u
    return {i: find(i) for i in ids}


def test_signature_agreement_is_weighted_jaccard():
    rng = np.random.default_rng(5)
    e = rng.integers(1, 1 << 62, 90).astype(np.uint64)
    x, y = rng.uniform(0.2, 6, 90), rng.uniform(0.2, 6, 90)
    x[:20], y[-20:] = 0, 0
    elements = np.concatenate((e[x > 0], e[y > 0]))
    owner = np.repeat([0, 1], [(x > 0).sum(), (y > 0).sum()])
    sig = minhash.signatures(elements, np.concatenate((x[x > 0], y[y > 0])), owner, 2, 4000)
    want = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.035
    assert (sig != 0).all()
    alone = minhash.signatures(e[x > 0], x[x > 0], np.zeros((x > 0).sum(), int), 1, 4000)
    assert (alone[0] == sig[0]).all()  # a text's signature does not depend on its block


def test_one_element_and_none():
    sig = minhash.signatures(np.array([7], np.uint64), np.array([1.0]), np.array([1]), 3, 160)
    assert (sig[1] != 0).all() and not sig[0].any() and not sig[2].any()


def test_classes_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rnd = random.Random(2)
    texts = [t for _, t in rows if t and len(t.split()) > 60][:8]
    for j, t in enumerate(texts):  # chains of edits: neighbours are similar, the ends need not be
        w = t.split()
        for step in range(4):
            w = list(w)
            w[rnd.randrange(len(w))] = f"edit{step}"
            rows.append((10_000 + 10 * j + step, " ".join(w)))
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _classes(rows)


def test_bucket_in_two_components_loses_no_link(spark, monkeypatch):
    """a is the head of a bucket; b is unlike a but like c, which is like a."""
    w = [f"w{i}" for i in range(104)]
    a, c, b = w[:90], w[7:97], w[14:104]
    rows = [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bands=96, rows=2).collect()}
    assert got == _classes(rows) == {1: 1, 2: 1, 3: 1}


@pytest.mark.parametrize("hubs", [0, 3])
def test_copies_that_are_like_their_origin_only(spark, monkeypatch, hubs):
    """Edits of one text: like it, but mostly not like each other, and it is no bucket's head."""
    monkeypatch.setattr(minhash, "_HUBS", hubs)
    rnd = random.Random(6)
    origin = [f"w{i}" for i in range(120)]
    rows = [(1000, " ".join(origin))]
    for i in range(40):
        at = rnd.randrange(110)
        w = list(origin)
        w[at], w[(at + 40) % 120] = f"x{i}", f"y{i}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == _classes(rows)
    assert len(set(got.values())) == 1


def _join_rows(plan) -> int:
    """The most rows that a join of an executed plan made."""
    inner = {"AdaptiveSparkPlan": "executedPlan", "ShuffleQueryStage": "plan", "BroadcastQueryStage": "plan", "ResultQueryStage": "plan"}
    if plan.getClass().getSimpleName().replace("Exec", "") in inner:
        return _join_rows(getattr(plan, inner[plan.getClass().getSimpleName().replace("Exec", "")])())
    below = [_join_rows(plan.children().apply(i)) for i in range(plan.children().size())]
    made = plan.metrics().apply("numOutputRows").value() if "Join" in plan.nodeName() else 0
    return max([made, *below])


@pytest.mark.parametrize("members", [16, 1024])
def test_large_bucket_of_unlike_texts_makes_no_pairs_of_rows(spark, monkeypatch, members):
    """Edits of one text, most of them too unlike for a link: every bucket holds many components."""
    monkeypatch.setattr(minhash, "_MEMBERS", members, raising=False)
    monkeypatch.setattr(minhash, "_HUBS", 0)
    made, put = [], Stored.put

    def watched(store, df, name):
        if name == "across":
            df.collect()
            made.append(_join_rows(df._jdf.queryExecution().executedPlan()))
        return put(store, df, name)

    monkeypatch.setattr(Stored, "put", watched)
    rnd = random.Random(8)
    rows = []
    for i in range(160):
        w = [f"w{j}" for j in range(120)]
        for at in rnd.sample(range(5, 113, 3), 3):
            w[at] = f"x{at}" if i % 2 else f"x{at}y{i}"
        rows.append((i, " ".join(w)))
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bands=24, rows=2).collect()}
    want = _classes(rows)
    assert got == want
    assert 20 < len(set(want.values())) < 140  # links across components, and many components
    assert made and max(made) < 160 * 159 // 2


def test_small_tables_are_few_files_however_many_the_shuffle_partitions(spark, monkeypatch):
    monkeypatch.setattr(minhash, "_HUBS", 1)
    rnd = random.Random(9)
    rows = []
    for i in range(120):
        w = [f"w{j}" for j in range(120)]
        for at in rnd.sample(range(5, 113, 3), 3):
            w[at] = f"x{at}" if i % 2 else f"x{at}y{i}"
        rows.append((i, " ".join(w)))
    kept = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(kept.glob("minhash-*"))
    held = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), bands=24, rows=2).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == _classes(rows)
    (made,) = set(kept.glob("minhash-*")) - before
    tables = {t.name: len(list(t.glob("*.parquet"))) for t in made.iterdir() if t.name != "sketch"}
    assert {"sets", "heads", "shared", "pairs", "elements", "near", "missed", "hub-links", "left", "across", "blocks"} <= set(tables), tables
    assert set(tables.values()) == {1}, tables


def test_edge_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, "one two", "c"), (4, "One  two!", "c"), (4, "One  two!", "c"), (None, "one two", "d"),
            (5, "x y " * 60_000, "e"), (6, "x y " * 60_000 + "x", "e"), (7, "alpha", None), (4, "beta gamma", None), (9, "gamma! BETA? beta gamma", None), (10, "beta gamma", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    got = sorted(((r["doc_id"], r["class_id"]) for r in minhash.near_duplicates(docs).collect()), key=str)
    want = [(1, 1), (2, 2), (3, 3), (4, 3), (4, 3), (4, 3), (None, None), (5, 5), (6, 5), (7, 7), (9, 9), (10, 3)]
    assert got == sorted(want, key=str)
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_weighted_counts(spark):
    rows = [(1, "a b c d e " * 4), (2, "a b c d e " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["class_id"] for r in minhash.near_duplicates(docs).collect()} == {1}
    assert {r["class_id"] for r in minhash.near_duplicates(docs, weighted=True).collect()} == {1, 2}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(90)] + [(200 + i, 201 + i) for i in range(30)] + [(0, 0)]
    near = defaultdict(set)
    for u, v in links:
        near[u].add(v)
        near[v].add(u)
    want = {}
    for s in sorted(near):
        todo = [s]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = s
                todo.extend(near[x])
    df = spark.createDataFrame(links, "u long, v long")
    got = {r["node"]: r["component"] for r in components(df, Stored(spark, "t"), "c").collect()}
    assert got == {k: v for k, v in want.items() if k != v}
    assert components(df.where(F.lit(False)), Stored(spark, "t"), "c").count() == 0
