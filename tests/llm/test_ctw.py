import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from paneltide.llm import ctw
from paneltide.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def _symbols(text):
    return b"\0\0\0" + (text or "").encode().lower() + b"\xff"


def _brute(train, texts):
    """Context-tree weighting by recursion over (bits of the byte so far, context bytes)."""
    counts = defaultdict(lambda: [0, 0])
    deeper = defaultdict(set)
    for t in train:
        s = _symbols(t)
        for i in range(3, len(s)):
            bits = f"{s[i]:08b}"
            for k in range(8):
                for d in range(4):
                    counts[bits[:k], s[i - d : i]][int(bits[k])] += 1
                    if d:
                        deeper[bits[:k], s[i - d + 1 : i]].add(s[i - d : i])

    def own(node):
        z, o = counts[node] if node in counts else (0, 0)
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.log(math.pi) - math.lgamma(z + o + 1), (o + 0.5) / (z + o + 1)

    memo = {}

    def weighted(prefix, context):
        if (prefix, context) not in memo:
            kt = own((prefix, context))[0]
            below = sum(weighted(prefix, c) for c in deeper[prefix, context]) if len(context) < 3 else None
            memo[prefix, context] = kt if below is None else float(np.logaddexp(math.log(0.5) + kt, math.log(0.5) + below))
        return memo[prefix, context]

    def one(prefix, before, d=0):
        context = before[len(before) - d :]
        if (prefix, context) not in counts:
            return 0.5
        kt, p = own((prefix, context))
        if d == 3:
            return p
        w = math.exp(math.log(0.5) + kt - weighted(prefix, context))
        return w * p + (1 - w) * one(prefix, before, d + 1)

    out = []
    for t in texts:
        s, total = _symbols(t), 0.0
        for i in range(3, len(s)):
            bits = f"{s[i]:08b}"
            for k in range(8):
                p = one(bits[:k], s[i - 3 : i])
                total += math.log10(p if bits[k] == "1" else 1 - p)
        out.append(total)
    return out


def _base(docs):
    train = Counter()
    for i, t in docs:
        if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2:
            train.update([*(t or "").encode().lower().split(), None])
    n, v = sum(train.values()), len(train)
    out = []
    for i, t in docs:
        words = [*(t or "").encode().lower().split(), None]
        out.append((i, zlib.crc32(str("" if i is None else i).encode()) % 7 == 2, len(words), sum(train[w] > 0 for w in words), n,
                    round(sum(math.log10((train[w] + 1) / (n + v + 1)) for w in words), 6)))
    return out


def _key(r):
    return tuple((x is None, x or 0) for x in r)


def _rows(df):
    return sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in df.collect()), key=_key)


@pytest.mark.parametrize("split", [False, True])
def test_against_brute_force(spark, monkeypatch, split):
    if split:  # most contexts and tokens take the shuffled way
        monkeypatch.setattr(ctw, "_HEAD_CONTEXTS", 8)
        monkeypatch.setattr(ctw, "_HEAD_TOKENS", 8)
    rnd = random.Random(1)
    docs = [(i, "".join(rnd.choice("ab cdAé.\n\t") for _ in range(rnd.randint(0, 60)))) for i in range(50)]
    docs += [(60, None), (61, ""), (62, "new symbols @#日本"), (3, docs[3][1]), (None, "a b"), (63, "\0\0\0 \0a")]
    got = ctw.score(spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, score double"))
    assert _rows(got) == sorted(_base(docs), key=_key)
    train = [t for i, t in docs if zlib.crc32(str("" if i is None else i).encode()) % 7 != 2]
    want = sorted(zip([-1 if i is None else i for i, _ in docs], _brute(train, [t for _, t in docs]), strict=True))
    have = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["score"]) for r in got.collect())
    assert [i for i, _ in have] == [i for i, _ in want]
    assert [x for _, x in have] == pytest.approx([x for _, x in want], rel=1e-5)


def test_probabilities_sum_to_one(spark):
    text = [("abracadabra",), ("abc",)]
    from paneltide.llm.shared import Stored

    contexts, _, upper, total = ctw.fit(spark.createDataFrame(text, "text string"), Stored(spark, "t"))
    assert total == 16
    for r in contexts.collect():
        assert sum(10**x for x in r["logs"]) == pytest.approx(1, abs=1e-4)
    assert (10**upper.symbols).sum(axis=1) == pytest.approx(1)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 3, 9.99, 10, 1e3, 1e9])
    assert ctw._log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-12, abs=1e-10)


def test_query_beats_its_base_on_held_out_texts(spark):
    rows = QUERIES["op5_ctw_scores"](spark, SF).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = sorted(_base(docs))
    assert sorted(tuple(r[:5]) for r in rows) == [x[:5] for x in want]
    assert [r["base_score"] for r in sorted(rows)] == pytest.approx([x[5] for x in want])
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert np.median([r["bits_per_byte"] for r in held]) < 3


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(11, "ab")], "doc_id long, text string").where("doc_id = 11")
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = ctw.score(docs.selectExpr(f"{held} doc_id", "text")).first()
    assert (r["train_tokens"], r["n_known"], r["base_score"]) == (0, 0, 0) and r["bits_per_byte"] == pytest.approx(12)
    assert ctw.score(docs.limit(0)).count() == 0
