"""Near-duplicate documents by DartMinHash signatures and banding.

Every element owns a region: its weight on one axis, an endless rank on the other.  Seeded
hashes throw Poisson darts into the region's cells, the same ones wherever the element occurs,
and give each dart a rank and one of ``k`` coordinates.  Of the darts that hit a text's regions
the one of least rank stays in each coordinate; two texts agree in a coordinate with the
probability of their weighted Jaccard similarity.  A text throws only as many darts as fill
its coordinates, not ``k`` for each element.

Identical shingle sets are collapsed first.  Texts that share a band are compared, exactly, with
the bucket's smallest text; those that are unlike it meet the bucket's best linked texts.
Members that are still in different components are compared across these, unless their sizes or
their signatures, by five standard deviations, rule the similarity out: by a join in small
buckets, and in large ones a pair of bounded blocks at a time, of which only those links come
back that connect components.  So no bucket is expanded into all pairs of rows, and no link
that banding proposes goes missing between components.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paneltide.llm.components import components
from paneltide.llm.shared import Stored, freeing, text_blocks
from paneltide.llm.words import hash_words, mix, shingles

_BLOCK = 1 << 18
_STEP = np.uint64(0x9E3779B97F4A7C15)
_UNIT = 2.0**-64
#: Best linked texts that those members of a bucket meet which are unlike its smallest text.
_HUBS = 3
#: Members of a bucket that a join compares; those of larger buckets are compared in blocks of at
#: most about so many members and shingles.
_FEW = 32
_MEMBERS, _SHINGLES = 1 << 10, 1 << 21
#: Tables of shingle sets or signatures have at most a file for every so many values of 8 bytes,
#: tables of links and buckets one for every so many documents.
_VALUES_PER_FILE, _DOCS_PER_FILE = 1 << 21, 1 << 17
#: Rank intervals: doubling up to a width of 8, then of that width.
_FIRST = 2.0**-6
_WIDEST = 8.0


@lru_cache(maxsize=None)
def _interval(level: int) -> tuple[float, float, np.ndarray]:
    """(lower edge, width, Poisson distribution function of the darts in it)."""
    doublings = int(math.log2(_WIDEST / _FIRST)) + 1
    if level == 0:
        low, width = 0.0, _FIRST
    elif level <= doublings:
        low = width = _FIRST * 2.0 ** (level - 1)
    else:
        low, width = 2 * _WIDEST + (level - doublings - 1) * _WIDEST, _WIDEST
    j = np.arange(64)
    log = j * math.log(width) - width - np.array([math.lgamma(x + 1) for x in j])
    return low, width, np.cumsum(np.exp(log))


def _hash(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(x + np.uint64(salt & (2**64 - 1)) * _STEP)


def signatures(elements: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, k: int, seed: int = 1) -> np.ndarray:
    """(n, k) dart ids.  ``elements`` are hashes, distinct for each owner; ``weights`` are
    positive; ``owner`` is the text (0 to n - 1).  A text without elements has zeros."""
    out = np.zeros((n, k), np.uint64)
    total = np.bincount(owner, weights=weights, minlength=n)
    todo = np.flatnonzero(total > 0)
    reach = np.zeros(n)
    reach[todo] = k * (math.log(k) + 2) / total[todo]
    cells = np.ceil(weights).astype(np.int64)
    base = np.repeat(np.cumsum(cells) - cells, cells)
    cell = (np.arange(len(base)) - base).astype(np.float64)
    of, mass = np.repeat(owner, cells), np.repeat(weights, cells)
    with np.errstate(over="ignore"):
        region = _hash(np.repeat(elements, cells) + mix(cell.astype(np.uint64)), seed)
    while len(todo):
        slots, ranks, ids = [], [], []
        level, top = 0, reach[todo].max()
        open_ = np.isin(of, todo) if len(todo) < n else np.ones(len(of), bool)
        r, o, c, m = region[open_], of[open_], cell[open_], mass[open_]
        while _interval(level)[0] < top:
            low, width, cdf = _interval(level)
            if low:
                near = reach[o] > low
                r, o, c, m = r[near], o[near], c[near], m[near]
            count = np.searchsorted(cdf, _hash(r, 3 * level + 1) * _UNIT, side="right")
            at = np.flatnonzero(count)
            number = count[at]
            begin = np.repeat(np.cumsum(number) - number, number)
            hit = np.repeat(at, number)
            dart = _hash(r[hit] + (np.arange(len(hit)) - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), 3 * level + 2)
            rank = low + width * (_hash(dart, 11) * _UNIT)
            keep = rank < reach[o[hit]]
            if (m != 1).any():
                keep &= c[hit] + _hash(dart, 12) * _UNIT < m[hit]
            dart, rank = dart[keep], rank[keep]
            slots.append(o[hit][keep].astype(np.int64) * k + (dart % np.uint64(k)).astype(np.int64))
            ranks.append(rank)
            ids.append(dart)
            level += 1
        slot, rank, dart = (np.concatenate(x) for x in (slots, ranks, ids))
        late = np.argsort(-rank, kind="stable")
        flat, filled = out.reshape(-1), np.zeros(n * k, bool)
        flat[slot[late]] = dart[late]  # the last one written to a slot has the least rank
        filled[slot] = True
        todo = todo[~filled.reshape(n, k)[todo].all(axis=1)]
        reach[:] = np.where(np.isin(np.arange(n), todo), 2 * reach, 0)
    return out


def shingle_sets(texts, size: int, weighted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(elements, weights, owner).  A text of fewer than ``size`` words is one shingle; a text
    without words has none.  Weights are 1, or the shingle's count."""
    w = hash_words(texts)
    n = len(texts)
    count = np.diff(w.first)
    if n and count.max(initial=0) >= size:
        grams = shingles(w.hashes, size)
        owner = np.repeat(np.arange(n), count)[: len(grams)]
        inside = np.arange(len(grams)) + size <= w.first[owner + 1]
        grams, owner = grams[inside], owner[inside]
    else:
        grams, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    few = np.flatnonzero((count > 0) & (count < size))
    if len(few):
        own = np.array([shingles(w.hashes[w.first[i] : w.first[i + 1]], int(count[i]))[0] for i in few])
        grams, owner = np.concatenate((grams, own)), np.concatenate((owner, few))
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.concatenate(([True], (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1]))) if len(grams) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    times = np.diff(np.concatenate((start, [len(grams)]))).astype(np.float64)
    return grams[new], times if weighted else np.ones(len(start)), owner[new]


def _sketch(docs: DataFrame, size: int, weighted: bool, bands: int, rows: int, seed: int) -> DataFrame:
    """(id, d1, d2, bands, n, marks) of every document with words; d1 and d2 name the shingle
    set, n is its weight, marks has a byte of each coordinate of its signature."""

    def run(batches):
        # a text throws a few darts for each coordinate, however short it is
        for block, texts in text_blocks(batches, 1, _BLOCK, 4 * bands * rows):
            n = len(texts)
            e, w, o = shingle_sets(texts, size, weighted)
            sig = signatures(e, w, o, n, bands * rows, seed)
            with np.errstate(over="ignore"):
                key = _hash(np.arange(bands, dtype=np.uint64), seed + 5)[None, :].repeat(n, 0)
                for j in range(rows):
                    key = mix(key * _STEP + sig.reshape(n, bands, rows)[:, :, j])
                names = []
                for salt in (21, 22):
                    part = _hash(e + (w * 4096).astype(np.uint64) * _STEP, salt)
                    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part, dtype=np.uint64)))
                    at = np.searchsorted(o, np.arange(n + 1))
                    names.append(mix(sums[at[1:]] - sums[at[:-1]]))
            size_of = np.bincount(o, weights=w, minlength=n)
            has = np.flatnonzero(size_of)
            marks = (mix(sig) & np.uint64(255)).astype(np.uint8).view(np.int8)
            marks_end = pa.array(np.arange(len(has) + 1, dtype=np.int32) * sig.shape[1])
            ends = pa.array(np.arange(len(has) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column(0).take(pa.array(has)),
                    *(pa.array(x[has].view(np.int64)) for x in names),
                    pa.ListArray.from_arrays(ends, pa.array(key[has].reshape(-1).view(np.int64))),
                    pa.array(size_of[has]),
                    pa.ListArray.from_arrays(marks_end, pa.array(marks[has].reshape(-1))),
                ],
                names=["id", "d1", "d2", "bands", "n", "marks"],
            )

    return docs.mapInArrow(freeing(run), "id long, d1 long, d2 long, bands array<long>, n double, marks array<tinyint>")


def _elements(docs: DataFrame, size: int, weighted: bool) -> DataFrame:
    """(node, set): the shingle set as an array; the nth occurrence of a shingle is an element
    of its own where counts are weights."""

    def run(batches):
        for block, texts in text_blocks(batches, 1, _BLOCK):
            e, w, o = shingle_sets(texts, size, weighted)
            times = w.astype(np.int64)
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            with np.errstate(over="ignore"):
                e, o = np.repeat(e, times) + nth.astype(np.uint64) * _STEP, np.repeat(o, times)
            ends = pa.array(np.searchsorted(o, np.arange(len(texts) + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [block.column(0), pa.ListArray.from_arrays(ends, pa.array(e.view(np.int64)))],
                names=["node", "set"],
            )

    return docs.mapInArrow(freeing(run), "node long, set array<long>")


def _link_blocks(side: DataFrame, sizes: DataFrame, similarity: float, least: float) -> DataFrame:
    """(u, v): similar members of a bucket that connect its components.  ``side`` has (band, node,
    c, n, marks, set), ``sizes`` (band, members, shingles).  A bucket is cut into blocks; each
    of them meets itself and every other one in a group of their own."""
    blocks = F.ceil(F.greatest(F.col("members") / _MEMBERS, F.col("shingles") / _SHINGLES)).cast("int")
    cut = side.join(sizes.select("band", blocks.alias("blocks")), "band").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = cut.select("band", "node", "c", "n", "marks", "set", "block", other)
    lo, hi = F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")

    def run(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        node, comp, n, block = (group.column(c).to_numpy() for c in ("node", "c", "n", "block"))
        sets = group.column("set").combine_chunks()
        first = np.concatenate(([0], np.cumsum(sets.value_lengths().to_numpy())))
        names, element = np.unique(sets.flatten().to_numpy(), return_inverse=True)
        marks = group.column("marks").combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        comp, inside, links = np.unique(comp, return_inverse=True)[1], np.zeros(len(names), bool), []
        within = (block == block[0]).all()
        for x in range(len(node) - 1):
            y = np.arange(x + 1, len(node))
            y = y[(comp[y] != comp[x]) & (n[y] >= similarity * n[x]) & (n[x] >= similarity * n[y])]
            if not within:
                y = y[block[y] != block[x]]
            y = y[np.count_nonzero(marks[y] == marks[x], axis=1) >= least]
            mine = element[first[x] : first[x + 1]]
            inside[mine] = True
            for z in y.tolist():
                if comp[z] != comp[x]:
                    both = np.count_nonzero(inside[element[first[z] : first[z + 1]]])
                    if both >= similarity * (len(mine) + first[z + 1] - first[z] - both) - 1e-9:
                        links.append((node[x], node[z]))
                        comp[comp == comp[z]] = comp[x]
            inside[mine] = False
        u, v = zip(*links, strict=True) if links else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return dealt.select("*", lo, hi).groupBy("band", "lo", "hi").applyInArrow(run, "u long, v long")


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    similarity: float = 0.8,
    weighted: bool = False,
    bands: int = 48,
    rows: int = 7,
    seed: int = 1,
) -> DataFrame:
    """(id, class_id) of every row: classes of documents connected by links of ``similarity``
    (Jaccard on shingles of ``size`` words) or more; class_id is the class's smallest id.

    A pair at the threshold shares a band with probability 1 - (1 - similarity**rows)**bands,
    0.99998 as set.  Defined results: a text without words (null, empty) is in a class of its
    own; a row without an id has a null class and takes no part; rows that share an id are one
    document, and fall in one class; other columns are not read.
    """
    store = Stored(docs.sparkSession, "minhash")
    rows_ = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    named = rows_.where(F.col("id").isNotNull())
    sketch = store.put(_sketch(named, size, weighted, bands, rows, seed), "sketch")
    # files by the corpus, not by the tasks: each new one may cost its executor a process
    held = F.greatest("n", F.lit(bands + bands * rows / 8))
    documents, values = sketch.agg(F.count("*"), F.sum(held)).first()
    store.files = max(1, math.ceil((values or 0) / _VALUES_PER_FILE))
    few = max(1, math.ceil(documents / _DOCS_PER_FILE))

    def put_few(df: DataFrame, name: str) -> DataFrame:
        """Dealt anew, since the tasks that make a small table may have much to do."""
        return store.put(df.repartition(few), name)

    sets = store.put(
        sketch.groupBy("d1", "d2").agg(F.min("id").alias("node"), *(F.any_value(c).alias(c) for c in ("bands", "n", "marks"))), "sets"
    )
    member = sketch.select("id", "d1", "d2").join(sets.select("d1", "d2", "node"), ["d1", "d2"]).select("id", "node")

    banded = sets.select("node", F.explode("bands").alias("band"))
    heads = put_few(
        banded.groupBy("band").agg(F.min("node").alias("head"), F.max("node").alias("most")).where("head < most").drop("most"),
        "heads",
    )
    shared = put_few(banded.join(heads, "band"), "shared")  # (band, node, head) of buckets with two texts or more
    pairs = put_few(shared.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct(), "pairs")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    # a merge join at every size: a broadcast of the candidates would grow with the corpus
    texts = named.join(wanted.hint("merge"), F.col("id") == F.col("node"), "left_semi").select("id", "text")
    found = store.put(_elements(texts, size, weighted), "elements")

    def similar(candidates: DataFrame) -> DataFrame:
        """(u, v) of the candidates (a, b) whose sets are similar; b may be in many of them."""
        b = candidates.join(found.select(F.col("node").alias("nb"), F.col("set").alias("sb")), F.col("b") == F.col("nb"))
        ab = b.select("a", "b", "sb").join(found.select(F.col("node").alias("na"), F.col("set").alias("sa")), F.col("a") == F.col("na"))
        both = F.size(F.array_intersect("sa", "sb"))
        return (
            ab.withColumn("both", both)
            .where(F.col("both") >= similarity * (F.size("sa") + F.size("sb") - F.col("both")) - 1e-9)
            .select(F.col("a").alias("u"), F.col("b").alias("v"))
            .distinct()
        )

    # rows that share an id are one document
    copies = member.where("id <> node").select(F.col("id").alias("u"), F.col("node").alias("v"))
    near = put_few(similar(pairs), "near")
    links = near.unionByName(copies)

    # members unlike their bucket's head meet the best linked texts among the head's members
    missed = put_few(pairs.join(near, (F.col("a") == F.col("u")) & (F.col("b") == F.col("v")), "left_anti"), "missed")
    if not missed.isEmpty():
        degree = near.select("u").union(near.select("v")).groupBy(F.col("u").alias("node")).agg(F.count("*").alias("degree"))
        order = Window.partitionBy("head").orderBy(F.desc(F.coalesce("degree", F.lit(0))), F.xxhash64("hub"))
        hubs = (
            pairs.join(missed.select("b").distinct(), "b").select(F.col("a").alias("hub"), F.col("b").alias("head"))
            .join(degree, F.col("hub") == F.col("node"), "left")
            .withColumn("place", F.row_number().over(order)).where(F.col("place") <= _HUBS).select("head", "hub")
        )
        met = missed.join(hubs, F.col("b") == F.col("head")).where("a <> hub").select("a", F.col("hub").alias("b")).distinct()
        links = links.unionByName(put_few(similar(met), "hub-links"))
    parts = components(links, store, "parts", few)

    def part(df: DataFrame, node: str, into: str) -> DataFrame:
        p = parts.select(F.col("node").alias("pn"), F.col("component").alias("pc"))
        return df.join(p, F.col(node) == F.col("pn"), "left").withColumn(into, F.coalesce("pc", node)).drop("pn", "pc")

    # buckets that are still in several components
    unlike = shared.join(missed, (F.col("node") == F.col("a")) & (F.col("head") == F.col("b")), "left_semi").select("band").distinct()
    labelled = part(shared.join(unlike, "band").select("band", "node"), "node", "c")
    several = labelled.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count("*").alias("members")).where("lo < hi")
    left = put_few(labelled.join(several.select("band", "members"), "band"), "left")
    if not left.isEmpty():
        # coordinates agree with the probability of the similarity; five standard deviations
        k = bands * rows
        least = similarity * k - 5 * math.sqrt(k * similarity * (1 - similarity))
        side = left.join(sets.select("node", "n", "marks"), "node")
        x, y = (side.where(F.col("members") <= _FEW).select(*(F.col(c).alias(c + i) for c in ("band", "node", "c", "n", "marks"))) for i in "xy")
        equal = F.zip_with("marksx", "marksy", lambda a, b: (a == b).cast("int"))
        agree = F.aggregate(equal, F.lit(0), lambda total, one: total + one)
        alike = (F.col("nx") >= similarity * F.col("ny")) & (F.col("ny") >= similarity * F.col("nx")) & (agree >= least)
        across = x.join(y, (F.col("bandx") == F.col("bandy")) & (F.col("cx") > F.col("cy")) & alike)
        more = put_few(similar(across.select(F.col("nodex").alias("a"), F.col("nodey").alias("b")).distinct()), "across")
        many = side.where(F.col("members") > _FEW)
        sizes = many.groupBy("band").agg(F.first("members").alias("members"), F.sum("n").alias("shingles"))
        more = more.unionByName(put_few(_link_blocks(many.join(found, "node"), sizes, similarity, least), "blocks"))
        if not more.isEmpty():
            stars = parts.select(F.col("node").alias("u"), F.col("component").alias("v"))
            parts = components(stars.unionByName(more), store, "joined", few)
    of = parts.select(F.col("node").alias("pn"), F.col("component").alias("pc"))
    return (
        rows_.select("id")
        .join(of, F.col("id") == F.col("pn"), "left")
        .select(F.col("id").alias(id_col), F.coalesce("pc", "id").alias("class_id"))
    )
