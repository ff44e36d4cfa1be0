"""Repeated line runs by a suffix array over line ids, built by distributed prefix doubling.

The corpus is one sequence of line ids, cut at document ends.  Round k names every position by
its class of equal runs of 2**k lines; the name is the class's first position (by document id,
then line), so names need no global sort, and the pair of names at a position and 2**k lines on
gives the classes of twice the length.  A position whose class has no second member leaves: its
suffix is told apart.  Sorted by their names of all rounds, positions are in suffix order, and
the classes of a round are the intervals whose longest common prefix is 2**k lines or more.

Every later member of an interval of ``min_lines`` or more is a copy: its lines are deleted.
So is a later copy of one line of ``min_words`` words or more, whatever stands around it; the
classes of the first round hold these.  Adjoining and overlapping copies make up the maximal
repeated runs.  Only DataFrame operations are used, a document's lines are the largest unit that
one task needs together, and classes are counted before rows meet them, so a line that a third of
all documents has is no hot group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.shared import Stored

_NAME = ("d", "t", "p")


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _filled(text: Column) -> Column:
    """(i, line) of the lines that have more than spaces, tabs and carriage returns."""
    numbered = F.transform(_lines(text), lambda line, i: F.struct(i.alias("i"), line.alias("line")))
    return F.filter(numbered, lambda x: F.length(F.translate(x["line"], " \t\r", "")) > 0)


def _long(line: Column, min_words: int | None) -> Column:
    """Has ``min_words`` runs of characters other than spaces, tabs and carriage returns."""
    if min_words is None:
        return F.lit(False)
    # so many words need so many characters; the match ends at the first letter of the last word wanted
    words = rf"^[ \t\r]*+(?:[^ \t\r]++[ \t\r]++){{{min_words - 1}}}+[^ \t\r]"
    return F.when(F.length(line) >= 2 * min_words - 1, line.rlike(words)).otherwise(False)


def _position() -> Column:
    return F.struct(*_NAME)


def _classes(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(_position()).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")


def _named(df: DataFrame, classes: DataFrame, *keys: str, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.join(classes, list(keys)).select(*_NAME, F.col("first").alias("name"), *keep)


def _pairs(state: DataFrame, ahead: int) -> DataFrame:
    """Names here and ``ahead`` lines on, where both are known."""
    on = Window.partitionBy("d", "t").orderBy("p").rangeBetween(ahead, ahead)
    return state.withColumn("next", F.first("name").over(on)).where("next is not null")


def _copies(df: DataFrame, classes: DataFrame, length: int) -> DataFrame:
    """Positions that start a later copy of a run of ``length`` lines."""
    return _named(df, classes, "name", "next").where(F.col("name") != _position()).select(*_NAME, (F.col("p") + length).alias("end"))


def suffix_intervals(
    docs: DataFrame, store: Stored, *, id_col: str, text_col: str, min_lines: int, min_words: int | None
) -> tuple[DataFrame, list[tuple[int, DataFrame, DataFrame]]]:
    """The lines that occur more than once, (d, t, p, name, long), and (length, members, classes)
    of every round from ``min_lines`` on: members (d, t, p, name, next) with the names of their
    two halves, classes (name, next) with the first position."""
    rows = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull())
    filled = rows.select(
        F.col(id_col).cast("long").alias("d"), F.xxhash64(text_col).alias("t"), F.posexplode(_filled(F.col(text_col))).alias("p", "x")
    )
    lines = store.put(
        filled.select("d", "t", "p", F.xxhash64("x.line").alias("a"), F.xxhash64(F.lit(1), "x.line").alias("b"),
                      _long(F.col("x.line"), min_words).alias("long"))
        .dropDuplicates(["d", "t", "p"]),
        "lines",
    )
    classes = store.put(_classes(lines, "a", "b"), "classes-1")
    single = store.put(_named(lines, classes, "a", "b", keep=("long",)), "members-1")
    state = single.drop("long")
    length, found, last = 1, [], None
    while True:
        if length < min_lines < 2 * length:  # two runs of ``length`` lines overlap to min_lines
            members = store.put(_pairs(state, min_lines - length), "members-least")
            classes = store.put(_classes(members, "name", "next"), "classes-least")
            found.append((min_lines, members, classes))
        members = store.put(_pairs(state, length), f"members-{2 * length}")
        classes = store.put(_classes(members, "name", "next"), f"classes-{2 * length}")
        if last and last < min_lines:
            store.drop(f"members-{last}")
        length, last = 2 * length, 2 * length
        if classes.isEmpty():
            return single, found
        if length >= min_lines:
            found.append((length, members, classes))
        state = _named(members, classes, "name", "next")


def dedup_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_lines: int = 2,
    min_words: int | None = 40,
    into: tuple[str, str] = ("n_lines", "n_removed"),
) -> DataFrame:
    """All rows and columns of ``docs`` without the later copies of repeated runs of
    ``min_lines`` (2 or more) lines and of single lines of ``min_words`` words (None: of no
    single line); the columns ``into`` count the text's lines that are not blank, and how many
    of them were copies.

    Words are parted by spaces, tabs and carriage returns.  Blank lines do not count, match or go.  The first occurrence, by id and line, stays, so
    every distinct line does.  Defined results: a null text stays null; a row without an id
    stays as it is; rows that are equal in id and text are one document and come out alike;
    rows that share an id only are ordered by a hash of the text; columns of ``docs`` that
    have the names of ``into`` are replaced; an empty table gives an empty one.
    """
    if min_lines < 2:
        raise ValueError("a run has two lines or more")
    store = Stored(docs.sparkSession, "linedup")
    base = docs.drop(*into)
    single, rounds = suffix_intervals(base, store, id_col=id_col, text_col=text_col, min_lines=min_lines, min_words=min_words)
    d, t = F.col(id_col).cast("long"), F.xxhash64(text_col)
    copies = single.where(F.col("long") & (F.col("name") != _position())).select(*_NAME, (F.col("p") + 1).alias("end"))
    for length, members, classes in rounds:
        copies = copies.unionByName(_copies(members, classes, length))
    before = Window.partitionBy("d", "t").orderBy("p", "end").rowsBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy("d", "t").orderBy("p", "end")
    runs = (
        copies.groupBy(*_NAME).agg(F.max("end").alias("end"))
        .withColumn("opens", (F.col("p") > F.coalesce(F.max("end").over(before), F.lit(-1))).cast("int"))
        .withColumn("run", F.sum("opens").over(so_far))
        .groupBy("d", "t", "run").agg(F.min("p").alias("first"), F.max("end").alias("end"))
    )
    gone = store.put(
        runs.groupBy(F.col("d").alias("__d"), F.col("t").alias("__t")).agg(
            F.flatten(F.collect_list(F.sequence("first", F.col("end") - 1))).alias("__gone")
        ),
        "gone",
    )
    # each of the two arrays is used twice below, so they are computed once for a row
    # a merge join at every size: a broadcast of what is gone would grow with the corpus
    joined = base.join(gone.hint("merge"), (d == F.col("__d")) & (t == F.col("__t")), "left").withColumns(
        {"__lines": _lines(F.col(text_col)), "__filled": F.transform(_filled(F.col(text_col)), lambda x: x["i"])}
    )
    number = F.transform(F.col("__gone"), lambda p: F.element_at(F.col("__filled"), p + 1))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), number)
    cleaned = F.array_join(F.transform(kept, lambda i: F.element_at(F.col("__lines"), i + 1)), "\n")
    return joined.select(
        *(F.when(F.col("__gone").isNull(), F.col(c)).otherwise(cleaned).alias(c) if c == text_col else F.col(c) for c in base.columns),
        F.when(F.col("__filled").isNull(), 0).otherwise(F.size("__filled")).cast("long").alias(into[0]),
        F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("long").alias(into[1]),
    )


#: The same result for ``min_lines`` of 2 and ``min_words`` of 40 over ``documents``.
DEDUP_SQL = """
with cut as (
  select doc_id, generate_subscripts(string_split(text, chr(10)), 1) as i, unnest(string_split(text, chr(10))) as line
  from documents
), filled as (
  select doc_id, i, line, row_number() over (partition by doc_id order by i) as p
  from cut where length(translate(line, ' ' || chr(9) || chr(13), '')) > 0
), runs as (
  select doc_id, p, line, lead(line) over (partition by doc_id order by p) as line2 from filled
), later as (
  select doc_id, p from runs where line2 is not null
  qualify row_number() over (partition by line, line2 order by doc_id, p) > 1
), later_single as (
  select doc_id, p from filled where len(regexp_extract_all(line, '[^ \\t\\r]+')) >= 40
  qualify row_number() over (partition by line order by doc_id, p) > 1
), gone as (
  select doc_id, p from later union select doc_id, p + 1 from later union select doc_id, p from later_single
), marked as (
  select f.doc_id, f.i, g.p is not null as removed from filled f left join gone g on f.doc_id = g.doc_id and f.p = g.p
), counted as (
  select doc_id, count(*) as n_lines, cast(sum(case when removed then 1 else 0 end) as bigint) as n_removed
  from marked group by doc_id
), kept as (
  select c.doc_id, string_agg(c.line, chr(10) order by c.i) as text
  from cut c left join marked m on c.doc_id = m.doc_id and c.i = m.i
  where not coalesce(m.removed, false) group by c.doc_id
)
select d.doc_id, coalesce(n.n_lines, 0) as n_lines, coalesce(n.n_removed, 0) as n_removed,
  case when d.text is not null then coalesce(k.text, '') end as text
from documents d left join counted n on d.doc_id = n.doc_id left join kept k on d.doc_id = k.doc_id
"""
