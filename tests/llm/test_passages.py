import re

from paneltide.llm import passages

SF = "/root/testdata/sf0.001"


def _units(text):
    """(start, end, words) of every unit with a word, by plain scanning."""
    cuts = [0, *sorted({m.end() for m in re.finditer(r"[.!?](?=\s)|\n", text)}), len(text)]
    found = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        ws = list(re.finditer(r"\w+", text[lo:hi]))
        if ws:
            found.append([lo + ws[0].start(), 0, tuple(w[0].lower() for w in ws)])
    for k, u in enumerate(found):
        u[1] = found[k + 1][0] if k + 1 < len(found) else len(text)
    if found:
        found[0][0] = 0
    return found


def _brute(docs, least=10):
    seen, out = {}, {}
    for i, text in sorted(docs):
        run, spans = [], []
        for start, end, w in [*_units(text), (None, None, None)]:
            if w is not None and w in seen:
                run.append((start, end, len(w), seen[w]))
                continue
            if sum(r[2] for r in run) >= least:
                spans.append((run[0][0], run[-1][1], run[0][3]))
            run = []
            if w is not None:
                seen[w] = i
        kept, at = [], 0
        for s, e, _ in spans:
            kept.append(text[at:s])
            at = e
        out[i] = ("".join([*kept, text[at:]]), spans)
    return out


def _got(df):
    return {r["doc_id"]: (r["text"], [(x["start"], x["end"], x["first_doc"]) for x in r["removed"]]) for r in df.collect()}


def test_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    passage = max((t for _, t in docs if 300 < len(t) < 900), key=lambda t: t.count(". "))
    docs += [(9000 + j, f"Own words of number{j} in front; {passage} and behind{j}.") for j in range(5)]
    got = _got(passages.dedup_passages(spark.createDataFrame(docs, "doc_id long, text string")))
    want = _brute(docs)
    assert got == want
    assert sum(bool(s) for _, s in want.values()) > 20
    assert all(len(got[9000 + j][0]) < 200 for j in range(1, 5))


def test_edge_rows(spark):
    long = "one two three four five six seven eight nine ten."
    rows = [(1, None, "s"), (2, "", "s"), (3, long, "s"), (3, long, "s"), (4, f"Before. ONE two, three four five six seven eight nine ten! After", None),
            (None, long, "s"), (5, "w " * 200_000 + ". " + long, "s"), (6, "  ?! ", "s"), (7, "one two.", "s"), (8, "One two.", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, removed string")
    out = passages.dedup_passages(docs)
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    want = [(i, t) for i, t, _ in rows if i not in (4, 5)] + [(4, "Before. After"), (5, "w " * 200_000 + ". ")]
    assert got == sorted(want, key=str)
    assert out.columns == ["doc_id", "text", "removed"]
    assert passages.dedup_passages(docs.limit(0)).count() == 0
    same = spark.createDataFrame([(1, long + " Alpha"), (1, "Beta. " + long)], "doc_id long, text string")
    assert sorted(r["n"] for r in passages.dedup_passages(same).selectExpr("size(removed) n").collect()) == [0, 1]
