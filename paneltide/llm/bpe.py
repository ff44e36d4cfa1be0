"""Byte-level BPE encoding and decoding by overlapping chunks.

A text longer than ``chunk`` code points is cut into chunks that overlap their successor by
``overlap``.  Every chunk is pre-tokenised on its own, in parallel.  Pre-token matching has no
memory but its position, so two neighbouring chunks that once share a pre-token start agree
from there on: the first shared start inside the overlap is where they are stitched.  The
pieces between stitches are encoded in parallel and their ids are put in order again.  A text
with a seam that finds no shared start (a run longer than the overlap) is encoded whole.

Defined results: a null text counts as empty and has no ids; repeated rows each get their own
row; other columns are not read, so their names cannot clash; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paneltide.llm.shared import freeing, spans_of, text_blocks

VOCABULARY = "byte_bpe_50k.tiktoken"
_LONG_SPACE = 50_000
#: No pre-token that ends this close to the end of a cut text is relied on: a contraction has
#: three characters, and white space looks one character ahead.
_LOOKAHEAD = 4
_BLOCK = 1 << 19


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str) -> tuple[tiktoken.Encoding, regex.Pattern]:
    table = {base64.b64decode(t): int(n) for t, n in (x.split() for x in ranks.splitlines() if x)}
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return own, regex.compile(pattern)


def encode_text(text: str, ranks: bytes, pattern: str) -> np.ndarray:
    """Ids of one text.  The library's matcher overflows its stack on very long white space;
    such a text is matched here and its pre-tokens are encoded one by one."""
    own, rx = _encoding(ranks, pattern)
    if len(text) >= _LONG_SPACE and re.search(r"\s{%d}" % _LONG_SPACE, text):
        ids = [i for m in rx.finditer(text) for i in own._encode_single_piece(m[0])]
        return np.array(ids, dtype=np.int32)
    return own.encode_to_numpy(text, disallowed_special=()).astype(np.int32)


def _id_lists(ids: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, type=pa.int32()))


def _with_ids(df: DataFrame, text: str, ranks, pattern: str) -> DataFrame:
    """Replace column ``text`` (last) by ``ids``."""
    schema = T.StructType([*df.schema.fields[:-1], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    last = len(df.columns) - 1

    def run(batches):
        for part, texts in text_blocks(batches, last, _BLOCK):
            ids = _id_lists([encode_text(t, ranks.value, pattern) for t in texts])
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids], names=[*part.schema.names[:-1], "ids"])

    assert df.columns[-1] == text
    return df.mapInArrow(freeing(run), schema)


def _with_starts(chunks: DataFrame, chunk: int, overlap: int, ranks, pattern: str) -> DataFrame:
    """Add ``head`` and ``tail``: the pre-token starts (offsets in the whole text) in the
    overlap with the chunk before and in that with the chunk after."""
    schema = T.StructType(
        [*chunks.schema.fields, *(T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("head", "tail"))]
    )

    def starts(text: str, k: int, last: bool) -> tuple[list[int], list[int]]:
        trusted = len(text) - (0 if last else _LOOKAHEAD)
        found = [m.start() for m in _encoding(ranks.value, pattern)[1].finditer(text)]
        near = [s for s in found if s <= trusted]
        base = k * chunk
        return [base + s for s in near if s < overlap], [base + s for s in near if s >= chunk]

    def run(batches):
        for b in batches:
            cols = [b.column(b.schema.get_field_index(c)).to_pylist() for c in ("piece", "k", "n_chunks")]
            pairs = [starts(t, k, k == n - 1) for t, k, n in zip(*cols, strict=True)]
            lists = [pa.array([p[i] for p in pairs], type=pa.list_(pa.int32())) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*b.columns, *lists], names=[*b.schema.names, "head", "tail"])

    return chunks.mapInArrow(freeing(run), schema)


def encode(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    chunk: int = 1 << 15,
    overlap: int = 1 << 10,
) -> DataFrame:
    """(id, ids) of every row: the ids that encoding the whole text at once would give.

    ``vocabulary`` is the path of a rank file (token in base64, rank); ``overlap`` must be
    larger than a few characters and smaller than ``chunk``.
    """
    if not 2 * _LOOKAHEAD < overlap < chunk:
        raise ValueError("overlap must lie between 8 and chunk")
    spark = docs.sparkSession
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    ranks = spark.sparkContext.broadcast(read_ranks(path))  # one vocabulary: about 1 MB
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    short = _with_ids(rows.where(F.length("text") <= chunk), "text", ranks, pattern)

    long = (
        rows.where(F.length("text") > chunk)
        .groupBy("id", "text")
        .agg(F.count("*").alias("copies"))
        .withColumns({"key": F.xxhash64("text"), "n": F.length("text")})
        .withColumn("n_chunks", F.ceil((F.col("n") - overlap) / chunk).cast("int"))
        .withColumn("n_chunks", F.greatest("n_chunks", F.lit(1)))
    )
    chunks = long.select(
        "id", "key", "copies", "n", "n_chunks", "text",
        F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)).alias("k"),
    ).select(
        "id", "key", "copies", "n", "n_chunks", "k",
        F.when(F.col("k") == F.col("n_chunks") - 1, F.col("text").substr(F.col("k") * chunk + 1, F.col("n")))
        .otherwise(F.col("text").substr(F.col("k") * chunk + 1, F.lit(chunk + overlap)))
        .alias("piece"),
    ).repartition("id", "key", "k")
    doc = Window.partitionBy("id", "key").orderBy("k")
    seams = (
        _with_starts(chunks, chunk, overlap, ranks, pattern)
        .withColumn("cut", F.array_min(F.array_intersect("tail", F.lead("head").over(doc))))
        .withColumn("begin", F.coalesce(F.lag("cut").over(doc), F.lit(0)))
        .withColumn("finish", F.when(F.col("k") == F.col("n_chunks") - 1, F.col("n")).otherwise(F.col("cut")))
        .withColumn(
            "seamless",
            F.min(F.col("finish").isNotNull()).over(Window.partitionBy("id", "key")),
        )
    )
    stitched = seams.where("seamless").select(
        "id", "key", "copies", "k",
        F.expr(f"substr(piece, begin - k * {chunk} + 1, finish - begin)").alias("piece"),
    )
    joined = (
        _with_ids(stitched, "piece", ranks, pattern)
        .groupBy("id", "key")
        .agg(
            F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"),
            F.first("copies").alias("copies"),
        )
    )
    torn = seams.where(~F.col("seamless") & (F.col("k") == 0)).select("id", "key")
    whole = _with_ids(
        long.join(torn.select(F.col("id").alias("tid"), F.col("key").alias("tkey")),
                  F.col("id").eqNullSafe(F.col("tid")) & (F.col("key") == F.col("tkey")), "left_semi")
        .select("id", "copies", "text"), "text", ranks, pattern,
    )
    each = joined.select("id", "copies", "ids").unionByName(whole)
    return short.unionByName(
        each.select("id", "ids", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("id", "ids")
    ).withColumnRenamed("id", id_col)


def decode(
    encoded: DataFrame, *, vocabulary: str | None = None, pattern: str = public_tokenizers.PATTERN
) -> DataFrame:
    """Replace column ``ids`` by ``decoded``, the concatenated bytes of its tokens.  Null ids
    give no bytes; an id outside the vocabulary is an error."""
    spark = encoded.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(vocabulary or public_tokenizers.path(VOCABULARY)))
    keep = [c for c in encoded.columns if c != "ids"]
    schema = T.StructType([*encoded.select(*keep).schema.fields, T.StructField("decoded", T.BinaryType())])

    def run(batches):
        own, _ = _encoding(ranks.value, pattern)
        for b in batches:
            ids = b.column(b.schema.get_field_index("ids"))
            ends = ids.offsets.to_numpy()
            flat = ids.values.to_numpy(zero_copy_only=False)
            rest = b.select(keep)
            for lo, hi in spans_of(np.diff(ends).tolist(), _BLOCK):
                # one text's ids are Python objects at a time
                out = [own.decode_bytes(flat[ends[i] : ends[i + 1]].tolist()) for i in range(lo, hi)]
                yield pa.RecordBatch.from_arrays(
                    [*rest.slice(lo, hi - lo).columns, pa.array(out, pa.binary())], names=[*keep, "decoded"]
                )

    return encoded.mapInArrow(freeing(run), schema)


def digests(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: encodes, then decodes the ids."""
    encoded = encode(docs, id_col=id_col, **options).select(
        F.col(id_col),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        "ids",
    )
    return decode(encoded).select(
        id_col, "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256")
    )
