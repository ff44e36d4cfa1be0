"""URL filter: host and path rules, and gradient-boosted trees for what the rules leave open.

The URLs that a rule decides are the labelled ones.  The trees learn block or allow from
lexical features alone (lengths, depth, digit ratio, entropy, counts of parameters and marks,
and how often each host suffix is blocked among the labelled URLs), and judge the others.
Everything is DataFrame and SQL work.  The trees are fitted on a bounded sample of the labelled
rows; suffix statistics count all of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paneltide.llm.shared import Stored, lower_ascii

#: (rule, verdict); a rule is a host and, from its first slash, the start of a path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

FEATURES = (
    "length", "host_length", "path_length", "depth", "labels", "digit_ratio", "entropy", "parameters",
    "marks", "fragment", "secure", "suffix_rate", "suffix_seen", "top_rate", "top_seen", "section_rate", "section_seen",
    "place_rate", "place_seen",
)


class Model(NamedTuple):
    """``trees`` is None where the labelled URLs have one verdict, or none: ``usual`` holds."""

    suffixes: DataFrame
    trees: GBTClassificationModel | None
    usual: str


def host(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, ``?`` or ``#``, A-Z in lower case; empty for
    a null and for a URL without ``://``."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def rule_of(host_: Column, path_: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits the host or a parent domain and the path's start, or null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):  # the last one to fit wins
        name, slash, start = rule.partition("/")
        fits = ((host_ == name) | host_.endswith("." + name)) & path_.startswith(slash + start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _count(text: Column, marks: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, marks, ""))).cast("double")


def _entropy(text: Column) -> Column:
    """Bits a character."""
    n = F.greatest(F.length(text), F.lit(1)).cast("double")

    def part(c: Column) -> Column:
        p = (n - F.length(F.replace(text, c, F.lit("")))) / n
        return F.when(p > 0, -p * F.log2(p)).otherwise(F.lit(0.0))

    return F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0), lambda acc, c: acc + F.when(c == "", 0.0).otherwise(part(c)))


def _lexical(df: DataFrame, url: str) -> DataFrame:
    u = F.coalesce(F.col(url), F.lit(""))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    n = F.greatest(F.length(u), F.lit(1)).cast("double")
    return df.withColumns(
        {
            "length": F.length(u).cast("double"),
            "host_length": F.length("host").cast("double"),
            "path_length": F.length("path").cast("double"),
            "depth": _count(F.col("path"), "/"),
            "labels": _count(F.col("host"), "."),
            "digit_ratio": _count(u, "0123456789") / n,
            "entropy": _entropy(u),
            "parameters": F.when(query == "", 0.0).otherwise(_count(query, "&;") + 1),
            "marks": _count(u, "-_%@~+="),
            "fragment": F.instr(u, "#").cast("boolean").cast("double"),
            "secure": lower_ascii(u).startswith("https://").cast("double"),
            **_suffixes(),
        }
    )


def _suffixes() -> dict[str, Column]:
    """The parts of a URL whose verdicts are counted: the host's last two labels, its last one,
    the path's first segment, and the last label with that segment."""
    section = F.substring_index(F.col("path"), "/", 2)
    return {
        "suffix": F.substring_index("host", ".", -2),
        "top": F.concat(F.lit("."), F.substring_index("host", ".", -1)),
        "section": F.concat(F.lit("//"), section),
        "place": F.concat(F.substring_index("host", ".", -1), F.lit("//"), section),
    }


def _with_suffixes(df: DataFrame, suffixes: DataFrame, broadcast: bool) -> DataFrame:
    """Smoothed share of blocked URLs, and number seen (log), of the URL's suffixes."""
    for key in _suffixes():
        s = suffixes.select(F.col("name").alias("__name"), F.col("seen").alias("__seen"), F.col("blocked").alias("__blocked"))
        df = df.join(F.broadcast(s) if broadcast else s, F.col(key) == F.col("__name"), "left").withColumns(
            {
                f"{key}_rate": (F.coalesce("__blocked", F.lit(0)) + 1) / (F.coalesce("__seen", F.lit(0)) + 2),
                f"{key}_seen": F.log1p(F.coalesce("__seen", F.lit(0)).cast("double")),
            }
        ).drop("__name", "__seen", "__blocked")
    return df


_BROADCAST_ROWS = 100_000


def _small(suffixes: DataFrame) -> bool:
    return len(suffixes.limit(_BROADCAST_ROWS + 1).select(F.lit(1)).take(_BROADCAST_ROWS + 1)) <= _BROADCAST_ROWS


def fit(labelled: DataFrame, store: Stored, *, sample: int = 20_000, trees: int = 20, depth: int = 4) -> Model:
    """Model from (url, host, path, block): ``block`` is 1 or 0.  About ``sample`` rows, chosen
    by a hash of the URL, train the trees."""
    names = labelled.select(
        F.explode(F.array(*_suffixes().values())).alias("name"), "block"
    )
    suffixes = store.put(names.groupBy("name").agg(F.count("*").alias("seen"), F.sum("block").alias("blocked")), "suffixes")
    n, blocked = labelled.agg(F.count("*"), F.coalesce(F.sum("block"), F.lit(0))).first()
    usual = "block" if 2 * blocked > n else "allow"
    if blocked in (0, n):
        return Model(suffixes, None, usual)
    scale = 1 << 30
    rows = labelled.where(F.pmod(F.xxhash64("url"), F.lit(scale)) < min(scale, scale * sample // n))
    train = store.put(_with_suffixes(_lexical(rows, "url"), suffixes, _small(suffixes)).select("block", *FEATURES).coalesce(8), "train")
    if len(train.select("block").distinct().take(2)) < 2:
        return Model(suffixes, None, usual)
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(train).select("features", F.col("block").cast("double").alias("label"))
    return Model(suffixes, GBTClassifier(maxIter=trees, maxDepth=depth, seed=1).fit(data), usual)


def judge(urls: DataFrame, model: Model) -> DataFrame:
    """Rows (with url, host, path) and ``score``, the trees' probability of block."""
    if model.trees is None:
        return urls.withColumn("score", F.lit(1.0 if model.usual == "block" else 0.0))
    ready = _with_suffixes(_lexical(urls, "url"), model.suffixes, _small(model.suffixes))
    scored = model.trees.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(ready))
    return scored.withColumn("score", vector_to_array("probability")[1]).select(*urls.columns, "score")


def filter_urls(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules: Sequence[tuple[str, str]] = RULES, **options
) -> DataFrame:
    """(id, host, path, rule, verdict, score) of every row: the verdict is its rule's, else block
    where the trees' score is above a half.

    Defined results: a null URL, or one without ``://``, has an empty host and path, fits no
    rule and is judged by the trees; if no URL is labelled, what no rule decides is allowed;
    repeated rows each get their own row; other columns are not read.
    """
    verdicts = F.create_map(*(F.lit(x) for r in rules for x in r))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    labelled = rows.where(F.col("rule").isNotNull()).select(
        "url", "host", "path", (verdicts[F.col("rule")] == "block").cast("int").alias("block")
    )
    model = fit(labelled, Stored(pages.sparkSession, "urls"), **options)
    judged = judge(rows, model)
    learned = F.when(F.col("score") > 0.5, "block").otherwise("allow")
    return judged.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce(verdicts[F.col("rule")], learned).alias("verdict"), "score"
    )
