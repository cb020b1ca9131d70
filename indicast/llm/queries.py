"""The registered queries: each applies one operator, with production
parameters, to its whole table and derives the digest columns of its contract."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicast.llm import (
    bpe, decontaminate, html_text, language_id, line_dedup, pii, quality, runs, search, simhash, substring_dedup,
    token_files, warc,
)
from indicast.llm.common import table

QUERIES = {}
ORACLES: dict[str, str] = {
    "op1_line_dedup": line_dedup.ORACLE, "op12_warc": warc.ORACLE, "op13_search": search.ORACLE}
TOKENIZER = "word_bpe_49k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def sha256(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return out.select("doc_id", "n_tokens", sha256("ids").alias("ids_sha256"), sha256("decoded").alias("decoded_sha256"))


@query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", sha256("kept_text").alias("kept_sha256"))


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = language_id.predict(docs, language_id.fit(docs))
    return out.select("doc_id", F.coalesce(language_id.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score",
                      "coverage")


@query
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest, folder = token_files.write_tokens(docs, public_tokenizers.path(TOKENIZER))
    return token_files.crc_of_ids(token_files.read_tokens(spark, manifest, folder))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


@query
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html_text.extract(table(spark, sf_dir, "pages"))
    return out.withColumn("n_chars", F.char_length("text").cast("long"))


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


@query
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.with_echoes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return runs.digest(runs.find_runs(docs))


@query
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, folder = warc.write_archives(table(spark, sf_dir, "pages"))
    out = warc.read_archives(spark, manifest, folder)
    return out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(search.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))
