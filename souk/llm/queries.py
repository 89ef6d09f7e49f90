"""One registered query per operator: its whole table, production parameters, full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from souk.llm import (
    decontaminate,
    exact_dedup,
    fingerprints,
    language_id,
    license_scan,
    line_dedup,
    merkle,
    near_dedup,
    packing,
    quality,
    url_filter,
    vector_codes,
    warc_zip,
)
from souk.llm.common import read_table
from souk.llm.sql import ORACLE_SQL

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs)


def op2_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return warc_zip.round_trip(pages).select(*names)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    items = read_table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.find_contamination(docs, items))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_dedup(docs, hash_all=True)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return license_scan.scan_licenses(docs).drop("places")


def op6_best_fit_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op8_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_classes(docs)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = language_id.fold(F.col("doc_id"))
    model = language_id.fit(docs.where(fold != 1))
    named = language_id.identify(docs.select("doc_id", "text"), model)
    held_out = F.coalesce(fold == 1, F.lit(False)).alias("held_out")
    return named.select("doc_id", held_out, "lang_pred", "score", F.size("spans").alias("n_spans"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    result = quality.scored(docs, quality.fit(docs)).select("doc_id", "score")
    return result.withColumn("kept", F.col("score") >= quality.MIN_SCORE)


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return fingerprints.compare_edited(docs)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("doc_id", "source", "lang", "n_chars", "text")
    docs = read_table(spark, sf_dir, "documents").select(*names)
    fields = [F.col(c) for c in names]
    without_breaks = merkle.leaf_hash(*fields[:-1], F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.manifest(docs, merkle.leaf_hash(*fields), F.when(even, without_breaks))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_warc_zip,
        op3_decontaminate,
        op4_exact_dedup,
        op5_license_scan,
        op6_best_fit_pack,
        op7_url_filter,
        op8_dart_minhash,
        op9_language_id,
        op10_quality,
        op11_fingerprints,
        op12_merkle,
        op13_vector_codes,
    )
}

__all__ = ["ORACLE_SQL", "QUERIES"]
