"""Pipeline stages over the driver tables: raw -> long -> harmonised -> wide.

Each function returns a lazy DataFrame; callers that reuse a stage many
times should materialise it with ``materialize`` (a reliable checkpoint in
the shared checkpoint folder, so a lost executor does not lose the stage).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicast.operators.harmonize import (
    attach_country_meta, dedup_by_priority, enforce_schema, filter_year_range, harmonize,
)
from indicast.operators.reshape import pivot_wide
from indicast.schema import HARMONIZED_COLS, SOURCE_API, SOURCE_SDMX
from indicast.session import materialize
from indicast.sources.testdata import TIE_BREAK, raw_observations


def raw_long(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    """Raw observations in the long schema (+ tie-break columns)."""
    return enforce_schema(raw_observations(spark, sf_dir, dirty=dirty), extra_cols=TIE_BREAK)


def feed_frames(spark: SparkSession, sf_dir: str, dirty: bool = False) -> list[DataFrame]:
    """The raw observations as the two feeds they come from, each its own frame."""
    raw = raw_observations(spark, sf_dir, dirty=dirty)
    return [enforce_schema(raw.where(F.col("SOURCE") == s), source_name=s, extra_cols=TIE_BREAK).drop("INDICATOR_LABEL")
            for s in (SOURCE_API, SOURCE_SDMX)]


def harmonized(spark: SparkSession, sf_dir: str, materialized: bool = False, dirty: bool = False) -> DataFrame:
    """Entry 1: de-duplicated, filtered, country-enriched long table.

    The table is keyed by (indicator, country, year) with country and year
    restricted to the dimension (30 x 31 country-years), so it grows with the
    number of indicator ids, not with the raw volume. It is lazy by default, so
    that a consumer's predicates reach the scans; ``materialized`` writes it
    once (reliable checkpoint in the shared folder) for plans with several
    consumers, which then do not re-run the scan, joins and de-dup.
    """
    h = harmonize(raw_long(spark, sf_dir, dirty).drop("INDICATOR_LABEL"), tie_break=TIE_BREAK)
    return materialize(h) if materialized else h


def wide(spark: SparkSession, sf_dir: str, materialized: bool = False, dirty: bool = False) -> DataFrame:
    """Country-year wide table, bounded by countries x years (930 rows);
    materialised for imputation, which reads it several times (receivers,
    donors, column means)."""
    w = pivot_wide(harmonized(spark, sf_dir, dirty=dirty))
    return materialize(w) if materialized else w


def supplier_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale variant of the harmonised table whose rows grow with the data: the
    entity is the supplier (``ISO3`` holds the supplier id) instead of the
    country, with the supplier's country attributes."""
    raw = enforce_schema(raw_observations(spark, sf_dir, with_entity=True),
                         extra_cols=[*TIE_BREAK, "ENTITY"])
    keyed = raw.withColumnsRenamed({"ISO3": "COUNTRY", "ENTITY": "ISO3"})
    deduped = filter_year_range(dedup_by_priority(keyed, ["SOURCE", *TIE_BREAK]))
    long = attach_country_meta(deduped.withColumnRenamed("ISO3", "ENTITY")
                               .withColumnRenamed("COUNTRY", "ISO3")).drop("ISO3")
    return long.withColumnRenamed("ENTITY", "ISO3").select(*HARMONIZED_COLS)


def supplier_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide table of :func:`supplier_long`, materialised for its several readers."""
    return materialize(pivot_wide(supplier_long(spark, sf_dir)))


__all__ = ["raw_long", "feed_frames", "harmonized", "wide", "supplier_long", "supplier_wide", "materialize"]
