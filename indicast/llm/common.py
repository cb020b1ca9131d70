"""Helpers shared by the operators: tables, row keys, shared storage, Arrow batches."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicast.session import shared_folder

#: Texts are handed to numpy in chunks of about this many bytes (its temporary
#: arrays take up to a hundred times that).
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """128-bit identity ``k1, k2`` of a row by id and text; never null.

    Rows that repeat both get the same key, which is harmless: they get the
    same result. Two texts under one id stay apart."""
    parts = [F.col(doc_id), F.col(doc_id).isNull(), F.col(text), F.col(text).isNull()]
    return [F.xxhash64(*parts).alias("k1"), F.xxhash64(F.lit(1), *parts).alias("k2")]


class Shelf:
    """Stage tables of one run, written to the folder all executors share, so
    that a lost executor costs a task and not a stage."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{shared_folder(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex[:12]}"

    def keep(self, df: DataFrame, name: str, **options) -> DataFrame:
        df.write.options(**options).parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def drop(self, name: str) -> None:
        """Remove a table that no later step reads."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def chunks(batches: Iterable[pa.RecordBatch], size_by: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose column ``size_by`` holds about ``limit``
    bytes; a longer text forms a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(size_by)), 0).to_pylist()
        at = used = 0
        for i, n in enumerate(lengths):
            if i > at and used + n > limit:
                yield batch.slice(at, i - at)
                at, used = i, 0
            used += n
        yield batch.slice(at)


def blobs(column: pa.Array) -> list[bytes]:
    """A binary column as bytes, null as empty."""
    return [x or b"" for x in column.to_pylist()]


def worker_cache(name: str, make):
    """An object that lives as long as the Python worker process, across tasks."""
    home = sys.modules.setdefault("_indicast_llm_worker", types.ModuleType("_indicast_llm_worker"))
    if not hasattr(home, name):
        setattr(home, name, make())
    return getattr(home, name)
