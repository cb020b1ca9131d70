"""The corpus pipeline: five of the operators in a row over ``documents``.

Each stage takes ``(spark, docs, sf_dir)``, works on all that the stage before
kept, and returns the columns of ``documents``; the last returns the token ids
of what is left. Between stages the rows are written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicast.llm import bpe, decontaminate, language_id, line_dedup, simhash
from indicast.llm.common import Shelf, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    return language_id.accepted(docs, language_id.fit(docs))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others repeat."""
    return line_dedup.line_dedup(docs).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of what is left."""
    out = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return out.select("doc_id", "n_tokens", digest("ids").alias("ids_sha256"), digest("decoded").alias("decoded_sha256"))


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("benchmark_decontamination", benchmark_stage),
    ("bpe", token_stage),
]

#: The language model, the hash tables and the alignments have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    shelf = Shelf(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shelf.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
