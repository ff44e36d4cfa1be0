"""The training-data pipeline: documents through the stages of ``STAGES``, in order.

A stage is ``(name, function)``; the function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next stage's ``docs``.  All but
the last return the columns of ``docs``.  Null texts and ids, repeated rows and empty tables
have the results that the operators define; a row with a null id is never a copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.llm import bpe, decontaminate, langid, linedup, minhash
from paneltide.llm.shared import Stored, table

#: A document goes if its best language's filter holds a smaller share of its n-grams, or passes
#: the second language's by less: gibberish and untaught languages, and texts between languages.
LEAST_LANGUAGE_COVERAGE = 0.35
LEAST_LANGUAGE_MARGIN = 0.05


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach: those without a letter, those of
    which too little is known in any language, and those whose best language is unsure, go."""
    model = langid.fit(docs)
    judged = langid.identify(docs, model, into=("__lang", "__score", "__coverage", "__margin"))
    sure = (F.col("__coverage") >= LEAST_LANGUAGE_COVERAGE) & (F.col("__margin") >= LEAST_LANGUAGE_MARGIN)
    return judged.where(sure).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later copies of line runs and long lines; a document that was all copies
    goes.  ``n_chars``, where there is one, follows a text that was cut."""
    cleaned = linedup.dedup_lines(docs, into=("__lines_seen", "__lines_cut")).where("__lines_cut = 0 or __lines_cut < __lines_seen")
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("__lines_cut") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        cleaned = cleaned.withColumn("n_chars", n_chars)
    return cleaned.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class."""
    classes = minhash.near_duplicates(docs)
    copies = classes.where("doc_id <> class_id").select(F.col("doc_id").alias("__copy")).distinct()
    return docs.join(copies.hint("merge"), docs["doc_id"] == F.col("__copy"), "left_anti").select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), into="__leaks")
    return found.where(F.size("__leaks") == 0).select(*docs.columns)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE encoding and decoding of every document that is left."""
    return bpe.digests(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", drop_repeated_lines),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("byte_bpe", encode_bytes),
]

#: SQL cannot express the learned and hashed stages; a test compares with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    store, docs = Stored(spark, "pipeline"), table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store.put(docs, name)
            if i:
                store.drop(STAGES[i - 1][0])
    return docs
