"""Tables laid out for pruning (K1, K6; serves P9-P11 and A8).

A table is split into one folder per value of the partition columns, and within
a partition sorted by the cluster columns into files that hold a range of them
each. A filter on a partition column then leaves out folders when the query is
planned, and one on a cluster column leaves out files' row groups by their
smallest and largest values.

Rows are dealt by range over partition and cluster columns, not by a hash of the
partition columns: a partition that holds a third of all rows is written by a
third of the tasks, and small partitions share one. ``replace_partitions`` overwrites the
partitions that the given rows belong to and no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



def _dealt(df: DataFrame, by: list[str], cluster: list[str], tasks: int | None) -> DataFrame:
    n = tasks or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(f"`{c}`") for c in [*by, *cluster]]
    # Rows with equal keys are parted by their content, so that a hot key does not fill one task.
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.repartitionByRange(n, *order, spread).sortWithinPartitions(*order)


def write_partitioned(df: DataFrame, path: str, by: list[str], cluster: list[str] = (), fmt: str = "parquet",
                      tasks: int | None = None) -> str:
    """Write a table in folders by ``by``, each sorted by ``cluster``."""
    _dealt(df, list(by), list(cluster), tasks).write.mode("overwrite").format(fmt).partitionBy(*by).save(path)
    return path


def replace_partitions(df: DataFrame, path: str, by: list[str], cluster: list[str] = (), fmt: str = "parquet",
                       tasks: int | None = None) -> str:
    """Overwrite the partitions that ``df`` has rows of; all others stay as they are."""
    (_dealt(df, list(by), list(cluster), tasks).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .format(fmt).partitionBy(*by).save(path))
    return path


def read_partitioned(spark: SparkSession, path: str, like: DataFrame, fmt: str = "parquet") -> DataFrame:
    """The table under ``path`` with the columns and types of ``like``: filters on
    its partition columns reach the listing, others the files' statistics."""
    return spark.read.schema(like.schema).format(fmt).load(path).select(*[F.col(f"`{c}`") for c in like.columns])


__all__ = ["write_partitioned", "replace_partitions", "read_partitioned"]
