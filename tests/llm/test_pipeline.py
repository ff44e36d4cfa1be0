import base64
import hashlib
import random
import re

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from paneltide.llm import bpe

SF = "/root/testdata/sf0.001"


def _words(t):
    return re.findall(r"\w+", (t or "").lower())


def _grams(w, size=5):
    size = min(size, len(w))
    return [tuple(w[i : i + size]) for i in range(len(w) - size + 1)] if w else []


def _line_dedup(docs):
    seen, out = set(), []
    for i, text in sorted(docs):
        lines = text.split("\n")
        at = [j for j, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for a, b in zip(at, at[1:], strict=False):
            if (lines[a], lines[b]) in seen:
                gone |= {a, b}
            seen.add((lines[a], lines[b]))
        for j in at:
            if len(re.findall(r"[^ \t\r]+", lines[j])) >= 40:
                gone |= {j} if lines[j] in seen else set()
                seen.add(lines[j])
        if not gone or len(gone) < len(at):
            out.append((i, "\n".join(x for j, x in enumerate(lines) if j not in gone)))
    return out


def _near_dedup(docs):
    sets, boss = {i: set(_grams(_words(t))) for i, t in docs}, {i: i for i, _ in docs}

    def find(x):
        while boss[x] != x:
            x = boss[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            x, y = sets[a], sets[b]
            if x and y and len(x & y) >= 0.8 * len(x | y):
                u, v = sorted((find(a), find(b)))
                boss[v] = u
    return [(i, t) for i, t in docs if find(i) == i]


def _leaks(text, items):
    w = _words(text)
    for v in items:
        bag, size = _grams(v), min(5, len(v))
        wanted = set(bag)
        if not wanted & set(_grams(w, size)):
            continue
        for b in range(max(1, len(w) - len(v) + 1)):
            own = _grams(w[b : b + len(v)], size)
            both = sum(min(bag.count(g), own.count(g)) for g in set(own))
            if both >= 0.8 * (len(bag) + len(own) - both):
                return True
    return False


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    stages = dict(corpus_pipeline.STAGES)
    pairs = lambda df: sorted((r["doc_id"], r["text"]) for r in df.collect())
    kept = stages["language_id"](spark, docs, SF)
    assert kept.columns == docs.columns
    junk = spark.createDataFrame([(-1, "12 34 !?", "en", "s", 8), (-2, None, "en", "s", 0)], docs.schema)
    assert pairs(stages["language_id"](spark, docs.unionByName(junk), SF)) == pairs(docs) == pairs(kept)
    lines = stages["line_dedup"](spark, docs, SF)
    assert lines.columns == docs.columns and pairs(lines) == sorted(_line_dedup(pairs(docs)))
    assert lines.where("n_chars <> length(text)").count() == 0
    near = stages["minhash_near_dedup"](spark, lines, SF)
    assert near.columns == docs.columns and pairs(near) == sorted(_near_dedup(pairs(lines)))
    clean = stages["benchmark_decontamination"](spark, near, SF)
    items = [_words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert clean.columns == docs.columns and pairs(clean) == [x for x in pairs(near) if not _leaks(x[1], items)]
    with open(P.path(bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [(i, hashlib.sha256(" ".join(map(str, own.encode_ordinary(t))).encode()).hexdigest()) for i, t in pairs(clean)]
    assert sorted((r["doc_id"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()) == want


EDGE = [(1, None, None, None, None), (None, "a small letter", "en", None, 8), (2, "", "en", "s", 0), (3, "a letter", None, "s", 8), (3, "a letter", None, "s", 8)]
TAUGHT = [(10 + i, f"a letter {w} a letter of the small letters and {w}", "en", "s", 9) for i, w in enumerate("one two three four five".split())]


@pytest.mark.parametrize("rows", [[], EDGE, EDGE + TAUGHT])
def test_edge_rows(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        docs = spark.createDataFrame(out.collect(), out.schema)
    # with too little to learn from, no language is known and all documents go
    want = {None, 3, *range(10, 15)} if len(rows) > len(EDGE) else set()
    assert {r["doc_id"] for r in docs.where(F.col("n_tokens") > 0).collect()} == want
    assert docs.where("doc_id = 3").count() == (2 if want else 0)


def test_line_stage_leaves_columns_of_its_counts_names(spark):
    rows = [(1, "a\nb", 77, "x"), (2, "a\nb\nc", 78, "y"), (3, "a\nb", 79, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_lines int, n_removed string")  # and no n_chars
    got = corpus_pipeline.drop_repeated_lines(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a\nb", 77, "x"), (2, "c", 78, "y")]


def test_gibberish_and_untaught_languages_go(spark):
    rnd = random.Random(1)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz     ") for _ in range(n)) for n in (30, 100, 300, 1000, 3000) for _ in range(10)]
    odd += [
        "minun taloni on suuri ja vanha mutta puutarha on kaunis keväällä kun kukat kukkivat ja linnut laulavat aamulla",
        "evim büyük ve eski ama bahçe ilkbaharda çiçekler açtığında çok güzeldir ve kuşlar sabahları öter",
        "мой дом большой и старый но сад красив весной",
        "la mia casa è grande e vecchia ma il giardino è bello in primavera quando i fiori sbocciano",
    ]
    more = spark.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(odd)], docs.schema)
    kept = corpus_pipeline.known_language(spark, docs.unionByName(more), SF)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in docs.collect())
