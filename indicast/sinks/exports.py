"""Stage writes and exports (K1-K8).

Stage tables are Parquet; CSV and JSON exist only at the export edge. All
writes go through the DataFrame writer, so every task writes its own part
file and nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicast.schema import EXPORT_DATASET_NAME, INDICATORS


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> str:
    """K1/K2: write a stage table (an empty table is written too, schema intact)."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def export_csv(df: DataFrame, path: str, order_by: list[str] | None = None,
               partitions: int | None = None) -> str:
    """K3/K7: header CSV; with ``order_by`` the parts are range-partitioned and
    sorted so that reading the parts in name order gives the sorted table."""
    if order_by:
        n = partitions or df.sparkSession.sparkContext.defaultParallelism
        df = df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def manifest(df: DataFrame, dataset: str = EXPORT_DATASET_NAME) -> DataFrame:
    """K4: one row with dataset, generated, n_records and the indicator labels."""
    kv = []
    for k, v in INDICATORS:
        kv += [F.lit(k), F.lit(v)]
    return df.agg(F.count(F.lit(1)).alias("n_records")).select(
        F.lit(dataset).alias("dataset"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generated"),
        "n_records", F.create_map(*kv).alias("indicators"))


def export_json(df: DataFrame, path: str, dataset: str = EXPORT_DATASET_NAME) -> str:
    """K4: records as JSON Lines (NULL cells kept) plus the one-row
    :func:`manifest` in ``<path>/_manifest``."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/records")
    manifest(df, dataset).coalesce(1).write.mode("overwrite").json(f"{path}/_manifest")
    return path


def write_bundle(tables: dict[str, DataFrame], base: str, fmt: str = "parquet") -> dict[str, str]:
    """K5: one folder per named table; empty tables are skipped."""
    out = {}
    for name, df in tables.items():
        if df is None or df.isEmpty():
            continue
        out[name] = write_stage(df, f"{base}/{name}", fmt)
    return out


def export_all(df: DataFrame, base: str, formats: tuple[str, ...] = ("csv", "json", "parquet"),
               order_by: list[str] | None = ("ISO3", "YEAR")) -> dict[str, str]:
    """K6: export ``df`` in every configured format; returns format -> path."""
    out = {}
    for fmt in formats:
        path = f"{base}/{fmt}"
        if fmt == "csv":
            out[fmt] = export_csv(df, path, list(order_by) if order_by else None)
        elif fmt == "json":
            out[fmt] = export_json(df, path)
        else:
            out[fmt] = write_stage(df, path, fmt)
    return out


def write_registry(registry_df: DataFrame, path: str) -> str:
    """K8: the nested registry row as one JSON document."""
    registry_df.coalesce(1).write.mode("overwrite").json(path)
    return path
