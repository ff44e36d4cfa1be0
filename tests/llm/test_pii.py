import hashlib
import random
import re
from pathlib import Path

from paneltide.llm import pii
from paneltide.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
RX = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _base(text):
    out = []
    for o, (kind, rx) in enumerate(RX.items()):
        for m in re.finditer(rx, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                "card": 14 <= len(digits) <= 19 and _luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((m.start(), o, m.end(), kind))
    return sorted(out)


def _line(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


def _check(rows, texts):
    for r in rows:
        base = _base(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(_line(base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in RX] == [sum(b[3] == k for b in base) for k in RX]
        assert set(_line(base).split(",")) <= set(r["spans"].split(",")) or not base


def test_base_spans_of_the_table(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    df = QUERIES["op7_personal_data"](spark, SF)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())
    rows = df.collect()
    assert len(rows) == len(texts)
    _check(rows, texts)


def test_base_spans_of_odd_texts(spark):
    rnd = random.Random(8)
    parts = ["a", "@", ".", "_", "b.c", "1", "255", "256", "4111 1111 1111 1111", "-", " ", "+1", "(555) 010-99", "é", "", "x@y.z", "10.0.0.1", "\n", "79927398713"]
    texts = {i: "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 40))) for i in range(400)}
    texts |= {500: None, 501: "", 502: "a" * 100_000, 503: "1" * 100_000, 504: "a@" + "b." * 30_000 + "c", 505: "1.1.1.1.1.1.1.1", 506: "a@b.c_d@e.f a@b.c@d.e", 507: "0001.02.255.0000",
              508: "+1" + " " * 50_000, 509: "4111111111111111 " * 3000, 510: "+" * 5000 + "1.2.3.4"}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(0, texts[0], None)], "doc_id long, text string, spans string")
    rows = pii.find(docs).collect()
    assert len(rows) == len(texts) + 1
    _check(rows, texts)
    assert pii.find(docs.limit(0)).count() == 0


def test_patterns_find_unseen_identifiers(spark):
    rows = [(i, f"words before mail: user{i}@site{i}.org and more words") for i in range(12)]
    rows += [(50, "now mail: user77(at)site.org and"), (51, "a clean text with 12 apples and 3 pears"), (52, "mailing 99 and mail 98"), (None, "mail: user78(at)x.org")]
    rows += [(60 + i, f"of {w} the end") for i, w in enumerate(["a1@b.c", "10.0.0.1", "x9y", "b2@c.d", "17", "c3@d.e"])]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[50] == "email:10:28"
    assert got[None] == "email:6:21"
    assert got[51] == got[52] == got[62] == got[64] == ""


def _plain_bootstrap(rows, support=3, sure=0.8):
    """(id, kind, value) found beyond the seeds, from (id, left, value, right, kind or None)."""
    links, known = {}, {}
    for _, left, value, right, kind in rows:
        for p in (left, (left, right)) if left else ():
            links.setdefault(p, set()).add(value)
        if kind and left:
            known[value] = (kind, 1.0)
    seeds = set(known)
    while True:
        patterns = {}
        for p, values in links.items():
            for kind in pii.KINDS:
                s = sum(known[v][1] for v in values if v in known and known[v][0] == kind)
                if s >= support and s / len(values) >= sure:
                    patterns[p, kind] = s / len(values)
        fresh = {}
        for (p, kind), c in patterns.items():
            for v in links[p] - set(known):
                fresh[v, kind] = fresh.get((v, kind), 1.0) * max(1 - c, 1e-12)
        fresh = {v: (kind, 1 - miss) for (v, kind), miss in fresh.items() if 1 - miss >= sure}
        if not fresh:
            break
        known |= fresh
    return {(i, known[v][0], v) for i, left, v, right, _ in rows if v in known and v not in seeds
            for p in (left, (left, right)) if (p, known[v][0]) in patterns}


def test_rounds_go_on_until_nothing_changes(spark):
    rows = [(i, "mail", f"user{i}@site{i}.org", "end", "email") for i in range(9)]
    rows += [(20, "mail", "jane.doe(at)site.org", "end", None)]
    # each found value makes the next context sure: a chain of four rounds
    for k in range(4):
        rows += [(100 + 10 * k + j, f"ctx{chr(97 + k)}", f"v{k}x{j}", "end", None) for j in range(4)]
        before = f"ctx{chr(96 + k)}" if k else "mail"
        rows += [(500 + 10 * k + j, before, f"v{k}x{j}", "end", None) for j in range(4)]
        rows += [(800 + 10 * k + j, before, f"seed{k}u{j}@s.org", "end", "email") for j in range(40)]
    want = _plain_bootstrap(rows)
    assert (20, "email", "jane.doe(at)site.org") in want and (133, "email", "v3x3") in want
    docs = [(i, f"{left} {value} {right}") for i, left, value, right, _ in rows]
    got = pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in got if r["n_spans"] > r["n_email"]} == {i for i, _, _ in want}
    assert all(r["n_spans"] == 1 for r in got)


def test_spaced_digits_are_one_candidate(spark):
    docs = [(i, f"phone +1 (555) 010-99{i:02d} or write") for i in range(12)]
    docs += [(50, "phone 555 010 9999, or write"), (51, "phone (555) 010 99 99"), (52, "scores 10 20 30 of 555 010 9999x"), (53, "phone " + "12 " * 20_000)]
    got = {r["doc_id"]: r["spans"] for r in pii.find(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert (got[50], got[51], got[52]) == ("phone:6:18", "phone:7:21", "")


def test_small_tables_are_few_files_however_many_the_shuffle_partitions(spark):
    kept = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    before = set(kept.glob("pii-*"))
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in held}
    docs = spark.createDataFrame([(i, f"mail: user{i}@site{i % 7}.org or call{i} ext{i}x") for i in range(400)], "doc_id long, text string")
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        found = pii.find(docs)
        assert found.rdd.getNumPartitions() == 1
        assert len(found.collect()) == 400
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    (made,) = set(kept.glob("pii-*")) - before
    tables = {t.name: len(list(t.glob("*.parquet"))) for t in made.iterdir()}
    assert {"found", "edges", "links", "degree", "known-0"} <= set(tables) and set(tables.values()) == {1}, tables
