import math
import random
import re
from collections import Counter

import duckdb

from paneltide.llm import lexical
from paneltide.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _terms(text):
    return Counter(t.translate(LOWER) for t in TERM.findall(text or ""))


def _brute(docs, items, k=20):
    bags = [(i, _terms(t)) for i, t in docs]
    n_docs, n_all = sum(1 for _, b in bags if b), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            m = 100 - 25 + (25 * b.total() * n_docs) // n_all if b else 0
            s = sum(
                c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * b[t]) // (1000 * b[t] + 12 * m))
                for t, c in _terms(text).items()
                if t in b
            )
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = con.execute(f"select item_id, rank, doc_id, score from ({ORACLES['op11_lexical_search']})").fetchall()
    got = QUERIES["op11_lexical_search"](spark, SF).select("item_id", "rank", "doc_id", "score")
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_copies_ties_nulls_long_texts_and_slices(spark, monkeypatch):
    rnd = random.Random(5)
    words = ["Ärger", "ärger", "a", "A1", "b", "c'est", "x_y", "数据", "of", "The", "the", "\x85z"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randrange(1, 6)))) for i in range(300)]
    docs += [(1000 - i, "The hot bag, a copy") for i in range(150)]  # a third of the rows, in falling order of ids
    docs += [(2000 + i, "copy A the bag HOT") for i in range(40)]  # the same bag in another order
    docs += [(3000, None), (3001, ""), (3002, " .,;"), (None, "the hot bag"), (None, "of of of"), (5, "twice the id"), (5, "twice the id")]
    docs += [(4000, "the " * 50_000 + "hot"), (4001, "z" * 200_000 + " of")]
    items = [(1, "The hot bag a copy"), (2, "of of the"), (3, None), (4, ""), (5, "absent words only"), (2, "ÄRGER ärger 数据"), (None, "hot a1"), (7, "...")]
    rows = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, score int, item int")
    wanted = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, n int, doc_id int")
    want = _brute(docs, items)
    assert sorted((tuple(r) for r in lexical.rank(rows, wanted).collect()), key=str) == want
    assert {r[1] for r in want if r[0] == 1} == set(range(1, 21))
    monkeypatch.setattr(lexical, "_SLICE_ITEMS", 2)
    monkeypatch.setattr(lexical, "_CELLS", 8)
    assert sorted((tuple(r) for r in lexical.rank(rows, wanted).collect()), key=str) == want
    assert sorted((tuple(r) for r in lexical.rank(rows, wanted, k=3).collect()), key=str) == _brute(docs, items, 3)
    for a, b in ((rows.limit(0), wanted), (rows, wanted.limit(0)), (rows.where("doc_id in (3000, 3001, 3002)"), wanted)):
        assert lexical.rank(a, b).collect() == []


def test_long_texts_are_read_in_pieces(monkeypatch):
    text = "Ab,c é" * 40
    whole = lexical.terms_of(text.encode())
    monkeypatch.setattr(lexical, "_PIECE", 7)
    assert lexical.terms_of(text.encode()) == whole == Counter({t.encode(): n for t, n in _terms(text).items()})


def test_a_hot_class_is_cut_before_the_shuffle(spark):
    bags = spark.createDataFrame([(i, 3, bytearray(8)) for i in range(500)], "doc_id long, n long, bag binary")
    plan = lexical._classes(bags, 500, 1500, 20)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert [r["members"] for r in lexical._classes(bags, 500, 1500, 20).collect()] == [list(range(20))]
