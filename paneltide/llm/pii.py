"""Personal data: fixed formats, and identifiers found by bootstrapped contextual extraction.

The spans of four fixed formats are the seeds.  The word before a seed, and that
word together with the one after, are lexical patterns, as are those of every other candidate: a
token that holds a digit, or a mark other than an apostrophe or hyphen between two letters, and
a run of two to eight groups of digits of ten digits or more.  Patterns and the values they
surround form a graph.  Each round scores a pattern, for each kind, by the confidence of its
distinct values, and a value by the patterns that are sure enough; values that become sure are
known from the next round on.  When a round finds no more, candidates that stand in a sure
pattern and whose value is known are spans too.

DataFrame and SQL functions only.  All spans of a text come from one regular expression pass for
each kind: matches are set between marks, and the lengths between marks give their places.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.shared import Stored

KINDS = ("email", "ip", "card", "phone")
#: Letters with a mark between them, as in ``name(at)host``.
_JOINED = r"\p{L}[^\s\p{L}'’-]++\p{L}"
#: Groups of digits with blanks between them, as in ``(555) 010 99 99``.
_SPACED = r"(?=\+?(?:[\x20().-]{0,2}[0-9]){10})[+(]?[0-9][0-9().-]*+(?:\x20\(?[0-9][0-9().-]*+){1,7}+(?=[\s,;:!?]|\z)"
#: Fixed formats.  A repetition that cannot give characters back is possessive, and a start
#: inside a run that was tried as a whole is not tried again, so matching stays linear.
FORMATS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "token": rf"(?<!\S)(?:{_SPACED}|(?=[^\s0-9]*+[0-9]|\S*?{_JOINED})\S++)",
}
#: A character that a text must have for a format to occur.
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}
_CANDIDATE = f"[0-9]|{_JOINED}"
_MARK, _OTHER = "", ""
_OCTET = "^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"
_NEAR = 80
#: Code points of text to a file of an intermediate table, and to a partition of the result, at least.
_PER_FILE = 1 << 23


def _valid(kind: Column, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    place = F.sequence(F.lit(1), n)

    def digit(i: Column) -> Column:
        d = digits.substr(i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when((n - i) % 2 == 1, twice).otherwise(d)

    luhn = F.aggregate(place, F.lit(0), lambda acc, i: acc + digit(i)) % 10 == 0
    return (
        F.when(kind == "ip", F.forall(F.split(m, r"\."), lambda x: x.rlike(_OCTET)))
        .when(kind == "card", n.between(14, 19) & F.when(n.between(14, 19), luhn).otherwise(False))
        .when(kind == "phone", n.between(10, 15))
        .otherwise(True)
    )


def _word(piece: Column, last: bool) -> Column:
    """The piece's word next to the match, lower case, without marks at its ends but ``:=#``."""
    found = F.regexp_extract(F.right(piece, F.lit(_NEAR)), r"(\S+)\s*$", 1) if last else F.regexp_extract(F.left(piece, F.lit(_NEAR)), r"^\s*(\S+)", 1)
    return F.regexp_replace(F.lower(found), r"^[^\p{L}\p{N}:=#]+|[^\p{L}\p{N}:=#]+$", "")


def matches(rows: DataFrame) -> DataFrame:
    """(id, t, kind, start, end, value, left, right) of every match in rows (id, t, text)."""
    clean = F.translate("text", _MARK, _OTHER)

    def pieces(kind: str) -> Column:
        may = F.contains("text", F.lit(_NEEDS[kind])) if kind in _NEEDS else F.lit(True)
        if kind != "email":
            may = may & F.col("text").rlike(_CANDIDATE if kind == "token" else "[0-9]")
        return F.when(may, F.split(F.regexp_replace(clean, FORMATS[kind], f"{_MARK}$0{_MARK}"), _MARK))

    some = F.col("text").rlike(f"@|{_CANDIDATE}")
    cut = (
        rows.where(some)
        .select("id", "t", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), pieces(k).alias("pieces")) for k in FORMATS))).alias("x"))
        .where(F.size("x.pieces") > 1)
        .select("id", "t", "x.kind", F.posexplode("x.pieces").alias("i", "piece"))
    )
    odd = F.col("i") % 2 == 1
    small = cut.select(
        "id", "t", "kind", "i", F.length("piece").alias("n"), F.when(odd, F.col("piece")).alias("value"),
        F.when(~odd, _word(F.col("piece"), True)).alias("last"), F.when(~odd, _word(F.col("piece"), False)).alias("first"),
    ).dropDuplicates(["id", "t", "kind", "i"])
    order = Window.partitionBy("id", "t", "kind").orderBy("i")
    return (
        small.withColumns(
            {
                "end": F.sum("n").over(order).cast("int"),
                "left": F.lag("last").over(order),
                "right": F.lead("first").over(order),
            }
        )
        .where(odd)
        .where(_valid(F.col("kind"), F.col("value")))
        .select("id", "t", "kind", (F.col("end") - F.col("n")).cast("int").alias("start"), "end", "value", "left", "right")
    )


def _core(found: DataFrame) -> DataFrame:
    """Tokens without the marks at their ends; other matches as they are."""
    token = F.col("kind") == "token"
    head = F.when(token, F.length(F.regexp_extract("value", r"^[^\p{L}\p{N}+]*", 0))).otherwise(0)
    tail = F.when(token, F.length(F.regexp_extract("value", r"[^\p{L}\p{N}]*$", 0))).otherwise(0)
    return found.withColumns(
        {
            "start": F.col("start") + head,
            "end": F.col("end") - tail,
            "value": F.lower(F.expr("value").substr(head + 1, F.length("value") - head - tail)),
        }
    )


def _open_tokens(found: DataFrame) -> DataFrame:
    """Base matches, and those tokens that overlap none of them."""
    base = F.col("kind") != "token"
    doc = Window.partitionBy("id", "t")
    upto = doc.orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    since = doc.orderBy("start").rangeBetween(0, Window.unboundedFollowing)
    return (
        found.withColumns(
            {"__end": F.max(F.when(base, F.col("end"))).over(upto), "__start": F.min(F.when(base, F.col("start"))).over(since)}
        )
        .where(base | ~F.coalesce((F.col("__end") > F.col("start")) | (F.col("__start") < F.col("end")), F.lit(False)))
        .drop("__end", "__start")
    )


def _learn(found: DataFrame, store: Stored, support: int, sure: float) -> DataFrame:
    """(pattern, value, kind) of the sure patterns and the new values that they bring."""
    seed = F.when(F.col("kind") != "token", F.col("kind"))
    edges = store.put(
        found.select("value", seed.alias("kind"), F.explode(_patterns()).alias("pattern")).where("pattern is not null").distinct(), "edges"
    )
    known = store.put(edges.where("kind is not null").select("value", "kind").distinct().withColumns({"c": F.lit(1.0), "seed": F.lit(True)}), "known-0")
    degree = store.put(edges.groupBy("pattern").agg(F.countDistinct("value").alias("n")), "degree")
    links = store.put(edges.select("pattern", "value").distinct(), "links")
    r = 0
    while True:  # a round adds a value or is the last one
        held = links.join(known, "value").groupBy("pattern", "kind").agg(F.sum("c").alias("s")).where(F.col("s") >= support)
        patterns = store.put(
            held.join(degree, "pattern").withColumn("sure", F.col("s") / F.col("n")).where(F.col("sure") >= sure).select("pattern", "kind", "sure"),
            f"patterns-{r}",
        )
        fresh = (
            links.join(patterns, "pattern")
            .groupBy("value", "kind")
            .agg((1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("sure"), F.lit(1e-12)))))).alias("c"))
            .where(F.col("c") >= sure)
        )
        # a value of two kinds goes to the surer one, then to the one listed first, and stays there
        best = fresh.groupBy("value").agg(F.max(F.struct("c", (-_rank()).alias("o"), "kind")).alias("x")).select("value", "x.kind", "x.c")
        new = store.put(best.join(known.select("value"), "value", "left_anti").withColumn("seed", F.lit(False)), f"new-{r}")
        if new.isEmpty():
            break
        known = store.put(known.unionByName(new), f"known-{r + 1}")
        for name in ("patterns", "new", "known"):
            store.drop(f"{name}-{r}")
        r += 1
    return links.join(patterns.select("pattern", "kind"), "pattern").join(known.where("not seed").select("value", "kind"), ["value", "kind"])


def _patterns() -> Column:
    """The word before, and that word together with the one after; never the latter alone,
    which is too often a common word."""
    near = F.when(F.col("left") != "", F.col("left"))
    return F.array(F.concat(F.lit("after "), near), F.concat(F.lit("between "), near, F.lit(" and "), F.col("right")))


def _rank() -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))


def find(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", support: int = 3, sure: float = 0.8
) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_spans) of every row; the first
    counts and the digest are of the fixed formats, ``spans`` (kind:start:end by start, then
    kind, in code points) and their number have the found ones as well.

    A pattern is sure if its values' confidences sum to ``support`` or more and to a share
    ``sure`` of its distinct values; a value is sure from ``sure`` on.  Defined results: a null
    or empty text has no spans; rows equal in id and text come out alike, and count once in the
    graph; rows with a null id are handled as any other; an empty table gives an empty one.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    files = max(1, math.ceil((docs.agg(F.sum(F.length(text))).first()[0] or 0) / _PER_FILE))
    store = Stored(docs.sparkSession, "pii", files)
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("t"), text.alias("text"))
    found = store.put(_open_tokens(_core(matches(rows))), "found")
    learned = store.put(_learn(found, store, support, sure), "learned")
    tokens = found.where("kind = 'token'").drop("kind")
    added = (
        tokens.withColumn("pattern", F.explode(_patterns())).join(learned, ["pattern", "value"])
        .select("id", "t", "kind", "start", "end", F.lit(False).alias("base")).distinct()
    )
    spans = found.where("kind <> 'token'").select("id", "t", "kind", "start", "end", F.lit(True).alias("base")).unionByName(added)
    each = spans.groupBy(F.col("id").alias("__id"), F.col("t").alias("__t")).agg(
        *(F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in KINDS),
        F.sort_array(F.collect_list(F.struct("start", _rank().alias("o"), "end", "kind", "base"))).alias("x"),
    )
    none = F.array().cast("array<struct<start:int,o:bigint,end:int,kind:string,base:boolean>>")
    x = F.coalesce("x", none)

    def text_of(spans_: Column) -> Column:
        return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return (
        rows.select("id", "t")
        .join(each, F.col("id").eqNullSafe(F.col("__id")) & (F.col("t") == F.col("__t")), "left")
        .select(
            F.col("id").alias(id_col),
            *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
            F.sha2(text_of(F.filter(x, lambda s: s["base"])), 256).alias("base_sha256"),
            text_of(x).alias("spans"),
            F.size(x).cast("long").alias("n_spans"),
        )
        .coalesce(files)
    )
