"""Language identification with language-bitmask n-gram filters.

Every cell of one table holds a bit per language: bit l of cell p is bit p of the Bloom filter
of language l (a bit-sliced layout).  AND-ing the cells of an n-gram's probes returns all
languages whose filter has it at once.  A text's per-language popcounts over all its n-grams,
corrected for each filter's false-positive rate, decide.

An n-gram is in a language's filter if its rate there is at least ``share`` of its highest rate
in any language.  The filters are fitted on a bounded sample of labelled rows (``per_language``
documents of each language, chosen by a hash of the id); every row is judged over its whole text.

Defined results: a null text or one without a letter is ``und`` with score 0; so is every row if
nothing was learned.  A text whose n-grams are in no filter gets the language with most training
documents and score 0.  Ties go to the language that sorts first.  Repeated rows each get their
own row; other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneltide.llm import words
from paneltide.llm.shared import freeing, text_blocks

UNKNOWN = "und"
ORDERS = (3, 4)
_BLOCK = 1 << 16
_SPACE = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Filters(NamedTuple):
    """``cells[w, p]`` has the bits of languages 64 w to 64 w + 63; ``false_rate`` is by language."""

    languages: list[str]
    cells: np.ndarray
    probes: int
    false_rate: np.ndarray
    usual: int


def ngrams(texts, orders=ORDERS) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram hashes, index of their text): lower-cased letters; any run of other characters,
    and either end of the text, is one space."""
    flat, begins = words.code_points([" " + (t or "") for t in texts])
    folded = words.letter_table()[flat]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(begins))
    blank = folded == _SPACE
    keep = np.concatenate(([True], ~(blank[1:] & blank[:-1] & (owner[1:] == owner[:-1]))))
    c, owner = folded[keep].astype(np.uint64), owner[keep]
    hashes, owners = [], []
    with np.errstate(over="ignore"):
        for n in orders:
            m = len(c) - n + 1
            if m <= 0:
                continue
            inside = owner[:m] == owner[n - 1 :]
            h = np.full(m, n, np.uint64)
            for j in range(n):
                h = h * _STEP + c[j : j + m]
            hashes.append(words.mix(h[inside]))
            owners.append(owner[:m][inside])
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    return np.concatenate(hashes), np.concatenate(owners)


def _cells(hashes: np.ndarray, probe: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((hashes + np.uint64(probe) * _STEP) * np.uint64(0xD6E8FEB86659FD93 + 2 * probe)) >> np.uint64(64 - bits)


def fit(
    labelled: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_language: int = 2000,
    grams_per_language: int = 1 << 16,
    share: float = 0.5,
    least: int = 3,
    cell_bits: int = 20,
    probes: int = 3,
) -> Filters:
    """Filters from the labelled rows (null languages are left out).

    The sample holds about ``per_language`` documents of each language, whatever the input's
    size; each filter holds the language's ``grams_per_language`` most frequent n-grams."""
    rows = labelled.select(
        F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Filters([], np.zeros((1, 1 << cell_bits), np.uint64), probes, np.zeros(0), 0)
    scale = 1 << 30
    taken = F.create_map(*(x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(scale, scale * per_language // n)))))
    sample = rows.where(F.pmod("h", F.lit(scale)) < taken[F.col("lang")]).select("lang", "text")

    def count(batches):
        for part, texts in text_blocks(batches, 1, 4 * _BLOCK):
            langs = np.array([languages.index(x) for x in part.column(0).to_pylist()], np.int32)
            hashes, owner = ngrams(texts)
            of = langs[owner]
            for lang in np.unique(of):
                gram, n = np.unique(hashes[of == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(gram), lang, np.int32)), pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"],
                )

    from pyspark.sql import Window

    counts = sample.mapInArrow(freeing(count), "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    totals = {r["lang"]: float(r["n"]) for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return Filters([], np.zeros((1, 1 << cell_bits), np.uint64), probes, np.zeros(0), 0)
    total = F.create_map(*(F.lit(x) for pair in totals.items() for x in pair))
    best = (
        counts.withColumn("rate", F.col("n") / total[F.col("lang")])
        .withColumn("top", F.max("rate").over(Window.partitionBy("gram")))  # a row per language
        .where((F.col("rate") >= share * F.col("top")) & (F.col("n") >= least))
        .withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram")))
        .where(F.col("place") <= grams_per_language)
        .select("lang", "gram")
        .toArrow()  # at most grams_per_language rows of each language
    )
    lang, gram = best.column(0).to_numpy(), best.column(1).to_numpy().view(np.uint64)
    cells = np.zeros((-(-len(languages) // 64), 1 << cell_bits), np.uint64)
    for i in range(len(languages)):
        own = gram[lang == i]
        for p in range(probes):
            cells[i // 64, _cells(own, p, cell_bits)] |= np.uint64(1 << (i % 64))
    filled = np.array([np.mean(cells[i // 64] >> np.uint64(i % 64) & np.uint64(1)) for i in range(len(languages))])
    return Filters(languages, cells, probes, filled**probes, languages.index(max(languages, key=lambda x: (sizes[x], x))))


def judge(texts, filters: Filters) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """(language, score, coverage, margin) of every text.  The score is the best language's part
    of all languages' hits; coverage is the share of the text's n-grams that the best language's
    filter holds, corrected, and margin is by how much it passes the second language's."""
    n, n_lang = len(texts), len(filters.languages)
    hashes, owner = ngrams(texts)
    size = np.bincount(owner, minlength=n).astype(float)
    if not n_lang or not len(hashes):
        return [UNKNOWN] * n, np.zeros(n), np.zeros(n), np.zeros(n)
    bits = int(filters.cells.shape[1]).bit_length() - 1
    place = [_cells(hashes, p, bits) for p in range(filters.probes)]
    found = [np.bitwise_and.reduce([w[at] for at in place]) for w in filters.cells]
    hits = np.stack(
        [
            np.bincount(owner, weights=(found[i // 64] >> np.uint64(i % 64) & np.uint64(1)), minlength=n)
            for i in range(n_lang)
        ],
        axis=1,
    )
    rate = hits / np.maximum(size, 1)[:, None]
    true = np.clip((rate - filters.false_rate) / np.maximum(1 - filters.false_rate, 1e-9), 0, 1)
    total, best = true.sum(axis=1), true.argmax(axis=1)
    score = np.where(total > 0, true[np.arange(n), best] / np.maximum(total, 1e-300), 0.0)
    best = np.where(total > 0, best, filters.usual)
    ranked = np.sort(np.column_stack((np.zeros(n), true)), axis=1)
    # without a letter a text is one space, too short for any n-gram
    languages = [filters.languages[b] if s else UNKNOWN for b, s in zip(best, size, strict=True)]
    return languages, np.where(size > 0, score, 0.0), ranked[:, -1], ranked[:, -1] - ranked[:, -2]


def identify(
    docs: DataFrame,
    filters: Filters,
    *,
    text_col: str = "text",
    keep: list[str] | None = None,
    into: tuple[str, ...] = ("lang_pred", "score"),
) -> DataFrame:
    """All rows of ``docs`` with its columns (or those in ``keep``) and the columns ``into``,
    which replace columns of that name: as many as are named of language, score, coverage and
    margin (see ``judge``)."""
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(filters)  # 8 MB for each 64 languages
    names = [c for c in (docs.columns if keep is None else keep) if c not in into]
    # a text that is kept goes to the workers once
    base = docs.select(*names) if text_col in names else docs.select(*names, F.col(text_col).alias("__judged"))
    kinds = (T.StringType(), T.DoubleType(), T.DoubleType(), T.DoubleType())
    schema = T.StructType([*base.schema.fields[: len(names)], *map(T.StructField, into, kinds)])
    at = names.index(text_col) if text_col in names else len(names)

    def run(batches):
        for part, texts in text_blocks(batches, at, _BLOCK):
            judged = judge(texts, model.value)[: len(into)]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[: len(names)], *map(pa.array, judged)], names=[*names, *into]
            )

    return base.mapInArrow(freeing(run), schema)
