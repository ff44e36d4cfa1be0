"""Registered queries of the package: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paneltide.llm import bpe, ctw, decontaminate, kmeans, langid, lexical, linedup, minhash, passages, pii, records, topk, urls
from paneltide.llm.shared import crc_bucket, table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = decontaminate.find_leaks(docs, items, keep=["doc_id"])
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_passage_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = passages.dedup_passages(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return cleaned.select(
        "doc_id",
        F.size("removed").cast("long").alias("n_removed"),
        F.col("removed.start").alias("starts"),
        F.col("removed.end").alias("ends"),
        F.col("removed.first_doc").alias("first_docs"),
        "text",
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


def op5_ctw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_bucket(docs["doc_id"], 4) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op8_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_record_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.digests(records.write_records(table(spark, sf_dir, "documents")))


def op13_bisector_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans.cluster(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_line_dedup": op2_line_dedup,
    "op3_passage_dedup": op3_passage_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_ctw_scores": op5_ctw_scores,
    "op6_language_id": op6_language_id,
    "op7_personal_data": op7_personal_data,
    "op8_dart_minhash": op8_dart_minhash,
    "op9_top_k": op9_top_k,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_lexical_search": op11_lexical_search,
    "op12_record_files": op12_record_files,
    "op13_bisector_clusters": op13_bisector_clusters,
}

ORACLES: dict[str, str] = {
    "op2_line_dedup": linedup.DEDUP_SQL,
    "op9_top_k": topk.TOP_K_SQL,
    "op11_lexical_search": lexical.RANK_SQL,
    "op13_bisector_clusters": kmeans.CLUSTER_SQL,
}
