"""Benchmark decontamination with SimHash windows and multi-index Hamming search.

Every benchmark item has a 128-bit SimHash of its weighted word shingles (weight: the shingle's
count).  A document's windows of an item's size get the same fingerprint.  The fingerprints are
cut into blocks; by the pigeonhole principle two fingerprints within ``RADIUS`` bits agree up to
``RADIUS // BLOCKS`` bits in one block, and the index holds every such block value of every
item, so all fingerprints within the radius are found.  The exact weighted Jaccard similarity of
the shingles decides.

A window that shares no shingle with an item has similarity 0, so windows are laid where a
shared shingle puts them: at the start that lines the shingle up with its place in the item.

The benchmark is cut into slices of bounded size by its item ids; each slice's index is
broadcast and every slice is searched, however many there are.
"""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneltide.llm.shared import freeing, spans_of, text_blocks
from paneltide.llm.words import hash_words, mix, shingles

_BLOCK = 1 << 17
#: Places where shingles meet items that are looked at together.
_PLACES = 1 << 19
BITS = 128
#: Shingle sets of similarity 0.8 differ in 19 of 128 bits on average, standard deviation 4.
RADIUS = 40
BLOCKS = 11
_EDGES = [BITS * j // BLOCKS for j in range(BLOCKS + 1)]
_FILTER_BITS = 22

LEAK = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("similarity", T.DoubleType()),
    ]
)
_LEAK_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("similarity", pa.float64())]))


class Index(NamedTuple):
    """Items of one slice.  ``place`` gives, for each known shingle of ``known`` (sorted), its
    first row in ``item`` and ``offset``; ``blocks`` the sorted block values and their items."""

    ids: np.ndarray
    n_words: np.ndarray
    sizes: list[int]
    gram_size: np.ndarray
    known: np.ndarray
    place: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    prints: np.ndarray
    blocks: list[tuple[np.ndarray, np.ndarray]]
    bags: list[tuple[np.ndarray, np.ndarray]]
    filter: np.ndarray


def _bits(grams: np.ndarray) -> np.ndarray:
    """(n, 128) of 0 and 1."""
    two = np.stack((grams, mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5))), axis=1)
    return np.unpackbits(np.ascontiguousarray(two).view(np.uint8).reshape(len(grams), 16), axis=1)


def _block_values(prints: np.ndarray) -> list[np.ndarray]:
    out = []
    for lo, hi in zip(_EDGES, _EDGES[1:], strict=False):
        weights = 1 << np.arange(hi - lo)
        out.append(prints[:, lo:hi].astype(np.int64) @ weights)
    return out


def _near_values(width: int, radius: int) -> np.ndarray:
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)])


def _slot(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def build(ids: list[int], texts: list[str], size: int) -> Index:
    w = hash_words(texts)
    n_words = np.diff(w.first)
    gram_size = np.minimum(size, n_words)
    grams = [shingles(w.hashes[w.first[i] : w.first[i + 1]], int(g)) if g else np.zeros(0, np.uint64) for i, g in enumerate(gram_size)]
    flat = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(ids)), [len(g) for g in grams])
    offset = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
    order = np.argsort(flat, kind="stable")
    known, first = np.unique(flat[order], return_index=True)
    prints = np.stack([2 * _bits(g).sum(axis=0) > len(g) for g in grams]) if grams else np.zeros((0, BITS), bool)
    blocks = []
    for j, value in enumerate(_block_values(prints)):
        near = _near_values(_EDGES[j + 1] - _EDGES[j], RADIUS // BLOCKS)
        values = (value[:, None] ^ near[None, :]).reshape(-1)
        owner = np.repeat(np.arange(len(ids), dtype=np.int32), len(near))
        by = np.argsort(values, kind="stable")
        blocks.append((values[by].astype(np.int32), owner[by]))
    member = np.zeros(1 << _FILTER_BITS, bool)
    member[_slot(known)] = True
    return Index(
        np.array(ids, np.int64), n_words, sorted({int(g) for g in gram_size if g}), gram_size, known,
        np.concatenate((first, [len(flat)])), item[order], offset[order], prints, blocks,
        [np.unique(g, return_counts=True) for g in grams], member,
    )


def within_radius(prints: np.ndarray, index: Index) -> list[np.ndarray]:
    """For each fingerprint the items whose fingerprint differs in at most RADIUS bits."""
    values = _block_values(prints)
    out = []
    for i in range(len(prints)):
        found = []
        for (known, owner), v in zip(index.blocks, values, strict=True):
            lo, hi = np.searchsorted(known, [v[i], v[i] + 1])
            found.append(owner[lo:hi])
        items = np.unique(np.concatenate(found))
        out.append(items[(index.prints[items] != prints[i]).sum(axis=1) <= RADIUS])
    return out


def similarity(bag: tuple[np.ndarray, np.ndarray], grams: np.ndarray) -> float:
    """Weighted Jaccard similarity of an item's shingle counts and a window's shingles."""
    known, times = bag
    own, n = np.unique(grams, return_counts=True)
    _, x, y = np.intersect1d(known, own, assume_unique=True, return_indices=True)
    both = np.minimum(times[x], n[y]).sum()
    return float(both / (times.sum() + n.sum() - both))


def _windows(index: Index, size: int, first: np.ndarray, hit: np.ndarray, at: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The distinct (text, begin, end) that line the shingles at ``hit``, the known ones ``at``,
    up with their places in the items.  A frequent shingle has many, so they are laid in parts."""
    parts = [np.zeros((3, 0), np.int64)]
    times = index.place[at + 1] - index.place[at]
    for lo, hi in spans_of(times.tolist(), _PLACES):
        many = times[lo:hi]
        row = np.repeat(index.place[at[lo:hi]], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        fits = index.gram_size[index.item[row]] == size
        row, place, of = row[fits], np.repeat(hit[lo:hi], many)[fits], np.repeat(text[lo:hi], many)[fits]
        begin = np.maximum(place - index.offset[row], first[of])
        end = np.minimum(place - index.offset[row] + index.n_words[index.item[row]], first[of + 1])
        parts.append(np.unique(np.stack((of, begin, end)), axis=1))
    return np.unique(np.concatenate(parts, axis=1), axis=1).T


def leaks_of(texts, index: Index, least: float) -> list[list[dict]]:
    """For each text its leaks: of every item the most similar window (the first, in a tie)."""
    w = hash_words(texts)
    best: list[dict[int, tuple]] = [{} for _ in texts]
    for size in index.sizes:
        grams = shingles(w.hashes, size)
        hit = np.flatnonzero(index.filter[_slot(grams)])
        at = np.searchsorted(index.known, grams[hit])
        at[at == len(index.known)] = 0
        true = index.known[at] == grams[hit]
        hit, at = hit[true], at[true]
        text = np.searchsorted(w.first, hit, side="right") - 1
        inside = hit + size <= w.first[text + 1]
        hit, at, text = hit[inside], at[inside], text[inside]
        windows = _windows(index, size, w.first, hit, at, text)
        if not len(windows):
            continue
        prints = np.stack([2 * _bits(grams[b : e - size + 1]).sum(axis=0) > e - size + 1 - b for _, b, e in windows])
        for (i, b, e), items in zip(windows.tolist(), within_radius(prints, index), strict=True):
            for item in items.tolist():
                if index.gram_size[item] != size:
                    continue
                s = similarity(index.bags[item], grams[b : e - size + 1])
                if s >= least and (item not in best[i] or s > best[i][item][0]):
                    best[i][item] = (s, int(w.start[b]), int(w.end[e - 1]))
    return [
        [{"item_id": int(index.ids[k]), "start": b, "end": e, "similarity": s} for k, (s, b, e) in sorted(x.items())] for x in best
    ]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    keep: list[str] | None = None,
    into: str = "leaks",
    size: int = 5,
    least: float = 0.8,
    items_per_slice: int = 4096,
    chars_per_slice: int = 1 << 24,
) -> DataFrame:
    """All rows of ``docs`` with its columns (or those in ``keep``) and the array ``into`` of
    the benchmark items that occur in the text: item_id, code-point offsets start and end, and
    similarity (``least`` or more).

    Defined results: a null or empty text leaks nothing; an item without words or without an id
    matches nothing; an item of fewer than ``size`` words is one shingle; items with equal texts
    are each found; items that share an id are items of their own; repeated rows each get their
    own row; a column named ``into`` is replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id_col).cast("long").alias("id"), F.col(item_text_col).alias("text")).where(
        "id is not null and text is not null"
    )
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    slices = max(1, -(-n // (items_per_slice // 2)), -(-chars // (chars_per_slice // 2)))
    names = [c for c in (docs.columns if keep is None else keep) if c != into]
    # a text that is kept goes to the workers once
    base = docs.select(*names) if text_col in names else docs.select(*names, F.col(text_col).alias("__searched"))
    at = names.index(text_col) if text_col in names else len(names)
    fields = base.schema.fields
    out = base.withColumn(into, F.array().cast(T.ArrayType(LEAK)))
    for s in range(slices):
        # hashed to slices of half the bound on average
        own = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(slices)) == s).orderBy("id", "text").collect()
        index = spark.sparkContext.broadcast(build([r["id"] for r in own], [r["text"] for r in own], size))

        def run(batches, index=index):
            for part, texts in text_blocks(batches, at, _BLOCK):
                found = leaks_of(texts, index.value, least)
                if slices > 1:
                    found = [x + y for x, y in zip(part.columns[-1].to_pylist(), found, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, _LEAK_ARROW)], names=part.schema.names)

        out = out.mapInArrow(freeing(run), T.StructType([*fields, T.StructField(into, T.ArrayType(LEAK))]))
    return out if text_col in names else out.drop("__searched")
