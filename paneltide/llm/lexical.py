"""Ranked lexical search of items against all documents, by bag deduplication.

A score sees of a document only its counts of the items' terms (its bag) and its length class
``m``.  One pass counts every document's terms and keeps its bag; documents whose bag and m are
equal, found by hash and verified by their whole values, form one class; every class is scored
once; and a class's members, by ascending id, stand for it in the ranking.

An item's ``k`` best documents lie in its k best classes (by score, then smallest member), and
none needs more than the k smallest members of a class, so every step before the last keeps
that many and the result is exact.  A class that holds a third of all documents is cut down to
its k smallest members in every map task, before anything is shuffled.

Items are read in slices whose terms and number are bounded; every slice is one search.  Only a
slice's terms, its counts and N and L reach the driver.

Defined results: a null or empty text, or one without a term, is no document and no item; every
row of either table counts, repeated ones too; documents without an id rank behind others of
their score; items that share an id are ranked each by itself; other columns are not read, so
their names cannot clash; an empty table gives an empty result.  A very long text is read in
pieces that end between terms.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.shared import Stored

#: Bytes of a term stay, A-Z lower-cased; every other byte separates.  Whatever is beyond ASCII
#: belongs to a term, and so do all bytes of its UTF-8 form.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_PIECE = 1 << 20
_CELLS = 1 << 18  # scores held at once
_SLICE_ITEMS, _SLICE_CHARS = 4096, 1 << 24
_EXACT = 2**53


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    folded, lo = text.translate(_FOLD), 0
    while len(folded) - lo > _PIECE:
        cut = folded.find(b" ", lo + _PIECE)
        if cut < 0:
            break
        yield folded[lo:cut].split()
        lo = cut
    yield folded[lo:].split()


def terms_of(text: bytes) -> Counter:
    """Term -> occurrences in a UTF-8 text."""
    found: Counter = Counter()
    for words in _pieces(text):
        found.update(words)
    return found


def _bags(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, bag): all terms' occurrences, and the sorted numbers and counts of known ones."""
    known = docs.sparkSession.sparkContext.broadcast(number)

    def run(batches):
        of = known.value
        for b in batches:
            n, bags = [], []
            for text in b.column(1):
                found = terms_of(text.as_py())
                n.append(found.total())
                pairs = sorted((of[t], found[t]) for t in found.keys() & of.keys())
                bags.append(np.array(pairs, dtype="<i8").astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(bags, pa.binary())], names=["doc_id", "n", "bag"])

    return docs.mapInArrow(run, "doc_id long, n long, bag binary")


def _frequencies(bags: DataFrame, n_terms: int) -> np.ndarray:
    """Documents that hold each known term: one row a task and term meets in the sum."""

    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for b in batches:
            flat = np.frombuffer(b"".join(b.column(0).to_pylist()), "<i4").reshape(-1, 2)
            total += np.bincount(flat[:, 0], minlength=n_terms)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["term", "df"])

    found = bags.select("bag").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()
    out = np.zeros(n_terms, np.int64)
    for r in found:  # at most a slice's terms
        out[r["term"]] = r["df"]
    return out


def _classes(bags: DataFrame, n_docs: int, n_all: int, k: int) -> DataFrame:
    """(m, bag, members): one row for each bag and m, with its k smallest ids."""
    m = F.lit(100 - 25) + F.expr(f"(25L * n * {n_docs}L) div {n_all}L")
    keyed = bags.where(F.length("bag") > 0).select("doc_id", m.alias("m"), "bag").withColumn("h", F.xxhash64("m", "bag"))
    key = ["h", "m", "bag"]
    smallest = keyed.withColumn("at", F.row_number().over(Window.partitionBy(*key).orderBy(F.col("doc_id").asc_nulls_last())))
    members = F.sort_array(F.collect_list(F.struct("at", "doc_id")))  # k of them at most
    return smallest.where(F.col("at") <= k).groupBy(*key).agg(members.alias("x")).select("m", "bag", F.col("x.doc_id").alias("members"))


def _impacts(m: np.ndarray, tf: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What one occurrence of a term in an item adds, in 64-bit integers."""
    return w * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


def _best_classes(classes: DataFrame, weights: np.ndarray, items: list[Counter], k: int) -> DataFrame:
    """(item, score, members) of each task's k best classes for every item."""
    # postings: for every term the items that hold it, and how often
    held = [[] for _ in weights]
    for i, terms in enumerate(items):
        for t, c in terms.items():
            held[t].append((i, c))
    first = np.concatenate(([0], np.cumsum([len(x) for x in held]))).astype(np.int64)
    flat = np.array([y for x in held for y in x], dtype=np.int64).reshape(-1, 2)
    longest = max((sum(t.values()) for t in items), default=1)
    # an impact is at most w * 10**6, and an item adds up at most its own length of them
    exact = int(weights.max(initial=0)) * 1_000_000 * longest < _EXACT
    plan = classes.sparkSession.sparkContext.broadcast((weights, first, flat[:, 0].copy(), flat[:, 1].copy()))
    n_items, rows = len(items), max(k, _CELLS // max(1, len(items)))

    def scores(m: np.ndarray, bags: list[bytes]) -> np.ndarray:
        w, first, item, times = plan.value
        pairs = np.frombuffer(b"".join(bags), "<i4").reshape(-1, 2).astype(np.int64)
        own = np.repeat(np.arange(len(bags)), [len(x) // 8 for x in bags])
        term = pairs[:, 0]
        impact = _impacts(m[own], pairs[:, 1], w[term])
        n = first[term + 1] - first[term]
        at = np.repeat(first[term] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        cell = np.repeat(own, n) * n_items + item[at]
        added = np.repeat(impact, n) * times[at]
        if exact:
            total = np.bincount(cell, weights=added, minlength=len(bags) * n_items).astype(np.int64)
        else:
            total = np.zeros(len(bags) * n_items, np.int64)
            np.add.at(total, cell, added)
        return total.reshape(len(bags), n_items)

    def run(batches):
        last = np.iinfo(np.int64).max
        best = np.zeros((0, n_items), np.int64)  # score, smallest member and place of members
        least, place, kept = best, best, {}
        count = 0
        for b in batches:
            for lo in range(0, b.num_rows, rows):
                part = b.slice(lo, rows)
                members = part.column(2).to_pylist()
                found = scores(part.column(0).to_numpy(), part.column(1).to_pylist())
                smallest = np.array([last if x[0] is None else x[0] for x in members], np.int64)
                numbers = count + np.arange(len(members))
                kept |= dict(zip(numbers.tolist(), members, strict=True))
                count += len(members)
                # the block's own best first: classes by smallest member, then stably by score
                by_member = np.argsort(smallest, kind="stable")
                found, smallest, numbers = found[by_member], smallest[by_member], numbers[by_member]
                top = np.argsort(-found, axis=0, kind="stable")[:k]
                best = np.concatenate((best, np.take_along_axis(found, top, axis=0)))
                least = np.concatenate((least, smallest[top]))
                place = np.concatenate((place, numbers[top]))
                order = np.lexsort((least, -best), axis=0)[:k]
                best, least, place = (np.take_along_axis(x, order, axis=0) for x in (best, least, place))
                used = np.unique(place[best > 0]).tolist()
                kept = {i: kept[i] for i in used}
        row, at = np.nonzero(best > 0)
        for lo in range(0, len(row), 4096):
            r, i = row[lo : lo + 4096], at[lo : lo + 4096]
            lists = pa.array([kept[x] for x in place[r, i].tolist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(best[r, i]), lists], names=["item", "score", "members"])

    return classes.mapInArrow(run, "item int, score long, members array<long>")


def _search(docs: DataFrame, items: list[tuple[int | None, Counter]], k: int, store: Stored, s: int) -> DataFrame | None:
    """The result for a slice of items."""
    spark = docs.sparkSession
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(t for _, t in items))))}
    bags = store.put(_bags(docs, vocabulary), f"bags-{s}")
    n_docs, n_all = bags.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    df = _frequencies(bags, len(vocabulary))
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    numbered = [Counter({vocabulary[t]: c for t, c in terms.items()}) for _, terms in items]
    found = _best_classes(_classes(bags, n_docs, n_all, k), weights, numbered, k)
    # the k best classes of every item, then their members
    w = Window.partitionBy("item")
    classes = found.withColumn("least", F.col("members")[0]).withColumn(
        "at", F.row_number().over(w.orderBy(F.desc("score"), F.col("least").asc_nulls_last()))
    )
    rows = classes.where(F.col("at") <= k).select("item", "score", F.explode("members").alias("doc_id"))
    ranked = rows.withColumn("rank", F.row_number().over(w.orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))).where(F.col("rank") <= k)
    ids = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(items)], "item int, item_id long")
    return store.put(ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"), f"best-{s}")


def rank(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 20,
    doc_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score) of the ``k`` best documents of every item."""
    spark = docs.sparkSession
    store = Stored(spark, "lexical")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(doc_col).cast("long").alias("doc_id"), text.alias("text"))
    wanted = items.select(F.col(item_col).cast("long").alias("item_id"), text.alias("text")).where(F.length("text") > 0)
    n, chars = wanted.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    slices = max(-(-n // _SLICE_ITEMS), -(-chars // _SLICE_CHARS))
    dice = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, slices)))
    done: DataFrame | None = None
    for s in range(slices):
        # a bounded share of the items: their terms are broadcast
        chosen = [(r["item_id"], terms_of(bytes(r["text"]))) for r in wanted.where(dice == s).collect()]
        chosen = [x for x in chosen if x[1]]
        found = _search(rows, chosen, k, store, s) if chosen else None
        if found is not None:
            done = found if done is None else done.unionByName(found)
    if done is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return done


#: The same result over ``documents`` and ``benchmark``.
RANK_SQL = r"""
with doc_terms as (
  select r, doc_id, unnest(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) as raw
  from (select row_number() over () as r, doc_id, text from documents)
), counts as (
  select r, doc_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term, count(*) as tf
  from doc_terms group by all
), docs as (
  select r, doc_id, cast(sum(tf) as bigint) as n from counts group by all
), stats as (
  select count(*) as n_docs, cast(sum(n) as bigint) as n_all from docs
), terms as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w
  from counts, stats group by term, n_docs
), item_terms as (
  select i, item_id, unnest(regexp_extract_all(text, '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) as raw
  from (select row_number() over () as i, item_id, text from benchmark)
), wanted as (
  select i, item_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term, count(*) as c
  from item_terms group by all
), classes as (
  select r, doc_id, 100 - 25 + ((25 * n * n_docs) // n_all) as m from docs, stats
), scored as (
  select q.i, q.item_id, d.r, d.doc_id,
    cast(sum(q.c * t.w * ((1000000000 * c.tf) // (1000 * c.tf + 12 * d.m))) as bigint) as score
  from wanted q join counts c on q.term = c.term join terms t on t.term = q.term join classes d on d.r = c.r
  group by all
)
select item_id, cast(row_number() over (partition by i order by score desc, doc_id nulls last) as integer) as rank, doc_id, score
from scored where score > 0 qualify rank <= 20
"""
