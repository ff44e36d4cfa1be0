import re

import pytest
from pyspark.sql import functions as F

from paneltide.llm import urls
from paneltide.llm.queries import QUERIES
from paneltide.llm.shared import Stored

SF = "/root/testdata/sf0.01"
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def _plain(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in RULES if (("." + host).endswith("." + r.split("/", 1)[0]) and path.startswith("/" + r.split("/", 1)[1]))]
    return host, path, max(fits, key=len, default=None)


def test_rules_over_the_whole_table(spark):
    url = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()}
    df = QUERIES["op4_url_filter"](spark, SF)
    plan = df._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    rows = df.collect()
    assert len(rows) == len(url)
    for r in rows:
        host, path, rule = _plain(url[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (RULES[rule] if rule else "block" if r["score"] > 0.5 else "allow")


def test_edge_urls(spark):
    cases = [None, "", "no scheme/x", "http://NET", "http://NET/", "HTTP://A.B.Net/x?y#z", "x://example.net/en/q", "a://b://net/", "http://ÉX.ORG/fr/a",
             "http://example.net/en", "http://notexample.net/en/", "http://net:80/", "http://x.org?/fr/", "http://x.org#/fr/", "http://" + "a" * 50_000 + ".net/" + "b1" * 50_000]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(cases)] + [(0, None, "x"), (None, "http://a.net/", None)], "page_id long, url string, score string")
    rows = urls.filter_urls(df).collect()
    assert len(rows) == len(cases) + 2
    for r in rows:
        if r["page_id"] is not None:
            assert (r["host"], r["path"], r["rule"]) == _plain(cases[r["page_id"]])
            assert r["verdict"] in ("block", "allow")
    assert urls.filter_urls(df.limit(0)).count() == 0
    assert {r["verdict"] for r in urls.filter_urls(df.where("url is null")).collect()} == {"allow"}


def test_held_out_accuracy(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("url")
    rows = pages.withColumns({"host": urls.host(F.col("url")), "path": urls.path(F.col("url"))})
    rule = urls.rule_of(F.col("host"), F.col("path"))
    labelled = rows.withColumn("block", rule.isin("net/", "example.com/de/").cast("int")).where(rule.isNotNull())
    held = F.pmod(F.xxhash64("url"), F.lit(4)) == 0
    model = urls.fit(labelled.where(~held), Stored(spark, "t"))
    right, n = urls.judge(labelled.where(held), model).agg(F.sum(((F.col("score") > 0.5) == (F.col("block") == 1)).cast("int")), F.count("*")).first()
    assert n > 20 and right / n > 0.8


def test_entropy(spark):
    got = spark.createDataFrame([("aabb",), ("",), ("abcd",)], "u string").select(urls._entropy(F.col("u"))).collect()
    assert [r[0] for r in got] == [pytest.approx(x) for x in (1.0, 0.0, 2.0)]
