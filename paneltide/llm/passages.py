"""Repeated passages by hashing normalised units.

A unit is a sentence within a line: a line is cut behind ``.``, ``!`` or ``?`` before white
space, so a paragraph that repeats as a whole and a passage that stands inside another line are
both found.  A unit is named by a 128-bit digest of its lower-cased words.  Digests are grouped
over the whole corpus; the earliest occurrence, by document id and then place, stays and the
others are copies.  Adjoining copies make up a passage; passages of ``min_words`` or more are
removed, with their offsets in the original text retained.

Counting comes first, on the digest's first half alone, with map-side combining, and its result
is written; the joins that meet it stand between two plain exchanges, so a unit that very many
documents share is split between tasks.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneltide.llm.shared import Stored, spans_of
from paneltide.llm.words import code_points, hash_words, mix

_BLOCK = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ENDS = np.array([ord(c) for c in ".!?"], np.uint32)
_SPACE = np.zeros(sys.maxunicode + 1, bool)
_SPACE[[c for c in range(0x3001) if chr(c).isspace()]] = True

SPAN = T.StructType(
    [
        T.StructField("start", T.IntegerType()),
        T.StructField("end", T.IntegerType()),
        T.StructField("n_words", T.IntegerType()),
        T.StructField("first_doc", T.LongType()),
    ]
)


def units(texts) -> tuple[np.ndarray, ...]:
    """(owner, ordinal within the text, start, end, n_words, digest a, digest b) of every unit
    with a word.  Offsets run from its first word to the next unit's, or to the text's end, so
    adjoining units touch; the first unit starts at 0."""
    w = hash_words(texts)
    flat, begins = code_points(texts)
    n = len(texts)
    cut = flat == 10
    cut[1:] |= _SPACE[flat[1:]] & np.isin(flat[:-1], _ENDS)
    owner = np.repeat(np.arange(n), np.diff(w.first))
    at = w.start + begins[owner]
    number = np.cumsum(cut)[at] if len(at) else np.zeros(0, np.int64)
    new = np.concatenate(([True], (number[1:] != number[:-1]) | (owner[1:] != owner[:-1]))) if len(at) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    if not len(first):
        return tuple(np.zeros(0, np.int64) for _ in range(5)) + tuple(np.zeros(0, np.uint64) for _ in range(2))
    last = np.concatenate((first[1:], [len(at)])) - 1
    place = (np.arange(len(at)) - np.repeat(first, last - first + 1)).astype(np.uint64)
    digests = []
    with np.errstate(over="ignore"):
        for salt in (np.uint64(31), np.uint64(32)):
            each = mix(w.hashes + mix(place * _STEP + salt))
            digests.append(mix(np.add.reduceat(each, first)))
    of = owner[first]
    opens = np.concatenate(([True], of[1:] != of[:-1]))
    ordinal = np.arange(len(first)) - np.repeat(np.flatnonzero(opens), np.diff(np.concatenate((np.flatnonzero(opens), [len(first)]))))
    start = np.where(opens, 0, w.start[first])
    closes = np.concatenate((opens[1:], [True]))
    end = np.where(closes, (begins[1:] - begins[:-1] - 1)[of], np.concatenate((start[1:], [0])))
    return of, ordinal, start, end, last - first + 1, digests[0], digests[1]


def _unit_rows(docs: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            ids, versions = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            texts = b.column(2).to_pylist()
            for lo, hi in spans_of([len(t or "") for t in texts], _BLOCK):
                of, ordinal, *_, a, d = units(texts[lo:hi])
                columns = (ids[lo:hi][of], versions[lo:hi][of] + ordinal, a.view(np.int64), d.view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["id", "place", "a", "b"])

    return docs.mapInArrow(run, "id long, place long, a long, b long")


def _cut(text: str, of: list[tuple[int, int]], spans: list[tuple], least: int) -> tuple[str, list[dict]]:
    """The text without its passages, and these; ``of`` has (ordinal, first_doc) of its copies."""
    copies, removed, kept, done = dict(of), [], [], 0
    run: list[tuple] = []

    def close() -> None:
        nonlocal done
        if run and sum(s[2] for _, s in run) >= least:
            start, end = run[0][1][0], run[-1][1][1]
            removed.append({"start": start, "end": end, "n_words": sum(s[2] for _, s in run), "first_doc": copies[run[0][0]]})
            kept.append(text[done:start])
            done = end
        run.clear()

    for k, s in enumerate(spans):
        if k in copies:
            run.append((k, s))
        else:
            close()
    close()
    return "".join([*kept, text[done:]]), removed


def dedup_passages(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10, keep: list[str] | None = None
) -> DataFrame:
    """All rows of ``docs`` with its columns (or those in ``keep``), the text without its later
    copies in ``text_col``, and ``removed``: an array of start, end (code points of the original
    text), n_words and first_doc, the document with the first unit's earliest occurrence.

    Defined results: a null text stays null; a row without an id stays as it is; rows that share
    an id are ordered by a hash of their texts, and rows that are equal in both come out alike; a unit repeated in its own document is a copy too; columns named
    ``removed`` are replaced.
    """
    store = Stored(docs.sparkSession, "passages")
    names = [c for c in (docs.columns if keep is None else keep) if c not in ("removed", text_col)]
    # a place orders the units of an id: by the text's hash (23 bits), then within the text
    version = F.shiftleft(F.xxhash64(text_col).bitwiseAND(F.lit((1 << 23) - 1)), 40)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), version.alias("version"), F.col(text_col).alias("text")).where(
        "id is not null and text is not null"
    )
    found = _unit_rows(rows)
    again = store.put(found.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a"), "again")
    repeated = store.put(found.join(again, "a"), "repeated")
    firsts = store.put(repeated.groupBy("a", "b").agg(F.min(F.struct("id", "place")).alias("first")), "firsts")
    copies = store.put(
        repeated.join(firsts, ["a", "b"])
        .where(F.col("first") != F.struct("id", "place"))
        .groupBy(F.col("id").alias("__id"), F.shiftright("place", 40).alias("__v"))
        .agg(F.collect_set(F.struct((F.col("place") % (1 << 40)).cast("int").alias("ordinal"), F.col("first.id").alias("first_doc"))).alias("__copies")),
        "copies",
    )
    base = docs.select(
        *names, F.col(id_col).cast("long").alias("__key"), F.shiftright(version, 40).alias("__version"), F.col(text_col).alias("__text")
    )
    # a merge join at every size: a broadcast of the copies would grow with the corpus
    joined = base.join(copies.hint("merge"), (F.col("__key") == F.col("__id")) & (F.col("__version") == F.col("__v")), "left").select(
        *names, "__text", "__copies"
    )
    schema = T.StructType(
        [*docs.select(*names).schema.fields, T.StructField(text_col, T.StringType()), T.StructField("removed", T.ArrayType(SPAN))]
    )
    arrow_spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("n_words", pa.int32()), ("first_doc", pa.int64())]))

    def run(batches):
        for b in batches:
            texts, copied = b.column(len(names)).to_pylist(), b.column(len(names) + 1).to_pylist()
            for lo, hi in spans_of([len(t or "") for t in texts], _BLOCK):
                out = [(t, []) for t in texts[lo:hi]]
                some = [i for i in range(lo, hi) if copied[i] and texts[i]]
                of, _, start, end, n, *_ = units([texts[i] for i in some])
                at = np.searchsorted(of, np.arange(len(some) + 1))
                for j, i in enumerate(some):
                    s = slice(at[j], at[j + 1])
                    spans = list(zip(start[s].tolist(), end[s].tolist(), n[s].tolist(), strict=True))
                    out[i - lo] = _cut(texts[i], [(c["ordinal"], c["first_doc"]) for c in copied[i]], spans, min_words)
                part = b.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(names)], pa.array([t for t, _ in out], pa.string()), pa.array([r for _, r in out], arrow_spans)],
                    names=[*names, text_col, "removed"],
                )

    return joined.mapInArrow(run, schema)
