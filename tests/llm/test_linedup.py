import random
import re

import duckdb
import pytest

from paneltide.llm import linedup
from paneltide.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


def _brute(docs, least, words=None):
    """Lines covered by a run of ``least`` lines that occurred before, or of ``words`` words."""
    seen, out = set(), {}
    for i, text in sorted(docs):
        lines = text.split("\n")
        at = [j for j, x in enumerate(lines) if x.strip(" \t\r")]
        gone = set()
        for p in range(len(at) - least + 1):
            run = tuple(lines[j] for j in at[p : p + least])
            if run in seen:
                gone.update(at[p : p + least])
            seen.add(run)
        for j in at:
            if words and len(re.findall(r"[^ \t\r]+", lines[j])) >= words:
                if (lines[j],) in seen:
                    gone.add(j)
                seen.add((lines[j],))
        out[i] = (len(at), len(gone), "\n".join(x for j, x in enumerate(lines) if j not in gone))
    return out


@pytest.mark.parametrize("least", [2, 3, 4, 5])
def test_against_brute_force(spark, least):
    rnd = random.Random(least)
    docs = [(i, "\n".join(rnd.choice(["a", "b", "c", "", " ", "d e"]) for _ in range(rnd.randint(1, 30)))) for i in range(60)]
    docs += [(100 + i, "\n".join(f"x{j}" for j in range(i, 40 + i))) for i in range(0, 12, 3)] + [(200, "a\n" * 70)]
    got = linedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_lines=least).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in got} == _brute(docs, least)


@pytest.mark.parametrize("words", [None, 1, 2, 4])
def test_single_lines_against_brute_force(spark, words):
    rnd = random.Random(words or 9)
    pool = ["a", "b  ", "c\td", "e f g", "h i\r", " j  k l m ", "n\u00a0o p\u3000q", "", " \t"] + [f"{i} x y z" for i in range(30)]
    docs = [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 12)))) for i in range(60)]
    docs += [(100, "only one line here"), (101, "only one line here")]
    got = linedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), min_words=words).collect()
    assert {r["doc_id"]: (r["n_lines"], r["n_removed"], r["text"]) for r in got} == _brute(docs, 2, words)


def test_a_long_line_goes_without_its_neighbours(spark):
    passage = " ".join(f"w{i}" for i in range(51))
    docs = [(1, f"a\n{passage}\nb"), (2, f"c\n{passage}\nd"), (3, passage), (4, f"{passage}\n{passage}\ne"), (5, "short one\nf"), (6, "short one\ng")]
    got = linedup.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"), into=("lines", "copies")).collect()
    want = {1: docs[0][1], 2: "c\nd", 3: "", 4: "e", 5: "short one\nf", 6: "short one\ng"}
    assert {r["doc_id"]: r["text"] for r in got} == want and {r["doc_id"]: r["copies"] for r in got}[4] == 2


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.execute(f"select doc_id, n_lines, n_removed, text from ({ORACLES['op2_line_dedup']}) order by 1").fetchall()
    got = QUERIES["op2_line_dedup"](spark, SF)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert sorted(tuple(r) for r in got.select("doc_id", "n_lines", "n_removed", "text").collect()) == want


def test_edge_rows(spark):
    rows = [(1, None, "s"), (2, "", "s"), (3, "a\nb\nc", "s"), (3, "a\nb\nc", "s"), (4, "x\na\nb\n\ny", None), (None, "a\nb", "s"),
            (5, "a\n\nb", "s"), (6, "\n".join(str(i) for i in range(20_000)), "s"), (7, "\n".join(str(i) for i in range(20_000)), "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_removed string")
    got = sorted(((r["doc_id"], r["n_removed"], r["text"]) for r in linedup.dedup_lines(docs).collect()), key=lambda r: str(r[:2]))
    long = rows[7][1]
    want = [(1, 0, None), (2, 0, ""), (3, 0, "a\nb\nc"), (3, 0, "a\nb\nc"), (4, 2, "x\n\ny"), (5, 2, ""), (6, 0, long), (7, 20_000, ""), (None, 0, "a\nb")]
    assert got == want
    assert linedup.dedup_lines(docs.limit(0)).count() == 0
    same = spark.createDataFrame([(1, "a\nb"), (1, "a\nb\nz")], "doc_id long, text string")
    assert sorted(r["n_removed"] for r in linedup.dedup_lines(same).collect()) == [0, 2]
