"""Reshaping: per-indicator coverage (A1) and the long -> wide pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicast.functions.scalars import pct
from indicast.operators.ordinals import with_ordinals
from indicast.schema import INDICATOR_IDS, META_COLS, catalogue_df


def distinct_with_null(c: str) -> Column:
    """Number of distinct values counting NULL as one value (pandas ``unique``)."""
    return F.count_distinct(c) + F.max(F.col(c).isNull().cast("int"))


def grid_size(long: DataFrame, count_null_iso3: bool = True) -> Column:
    """Scalar sub-query: #distinct ISO3 x #distinct YEAR over the whole table.

    Evaluated once by Spark and inlined as a literal into the consuming
    plan, so no cross join and no driver round-trip is needed.
    """
    n_iso = distinct_with_null("ISO3") if count_null_iso3 else F.count_distinct("ISO3")
    return long.select(F.coalesce(n_iso * F.count_distinct("YEAR"), F.lit(0))).scalar()


def per_indicator(long: DataFrame, *aggs: Column) -> DataFrame:
    """Catalogue-driven aggregate (J3): every catalogue id gets one row, ids
    outside the catalogue none. The aggregate is pruned to catalogue ids
    before the shuffle, so it has at most one row per catalogue id (11): a
    proven bound, so it is broadcast into the join with the catalogue."""
    agg = (long.where(F.col("INDICATOR_ID").isin(*INDICATOR_IDS))
           .groupBy("INDICATOR_ID").agg(*aggs))
    cat = catalogue_df(long.sparkSession).select("CAT_POS", "INDICATOR_ID", "INDICATOR_LABEL")
    return cat.join(F.broadcast(agg), "INDICATOR_ID", "left")


def coverage(long: DataFrame) -> DataFrame:
    """A1: N_COUNTRIES, N_YEARS, N_OBSERVATIONS, N_MISSING (floored at 0),
    COVERAGE_PCT (round 2, 0 when the grid is empty), YEAR_MIN, YEAR_MAX."""
    grid = grid_size(long)
    j = per_indicator(
        long,
        F.count_distinct("ISO3").alias("N_COUNTRIES"),
        F.count_distinct("YEAR").alias("N_YEARS"),
        F.count("VALUE").alias("N_OBSERVATIONS"),
        F.min("YEAR").alias("YEAR_MIN"),
        F.max("YEAR").alias("YEAR_MAX"),
    )
    n_obs = F.coalesce(F.col("N_OBSERVATIONS"), F.lit(0))
    return j.select(
        "INDICATOR_ID", "INDICATOR_LABEL",
        F.coalesce("N_COUNTRIES", F.lit(0)).cast("bigint").alias("N_COUNTRIES"),
        F.coalesce("N_YEARS", F.lit(0)).cast("bigint").alias("N_YEARS"),
        n_obs.cast("bigint").alias("N_OBSERVATIONS"),
        F.greatest(grid - n_obs, F.lit(0)).cast("bigint").alias("N_MISSING"),
        pct(n_obs, grid).alias("COVERAGE_PCT"),
        "YEAR_MIN", "YEAR_MAX",
    )


def pivot_wide(long: DataFrame) -> DataFrame:
    """One row per (ISO3, YEAR, REGION, INCOME_GROUP), one double column per
    catalogue indicator (largest VALUE per key), absent indicators NULL.

    Rows without a non-null VALUE or with a NULL key/attribute are dropped
    before grouping; a key whose values are all outside the catalogue stays as
    an all-NULL row. The value list is explicit, so the schema is static and
    Spark runs no extra job to discover pivot values.
    """
    base = long.where(F.col("VALUE").isNotNull() & F.col("ISO3").isNotNull()
                      & F.col("YEAR").isNotNull() & F.col("REGION").isNotNull()
                      & F.col("INCOME_GROUP").isNotNull())
    return (base.groupBy(*META_COLS)
            .pivot("INDICATOR_ID", INDICATOR_IDS)
            .agg(F.max("VALUE")))


def wide_order(wide: DataFrame, index: str | None = None) -> DataFrame:
    """O2: order of the wide table (apply only at export); ``index`` names a
    column for each row's place, counted from 0."""
    return with_ordinals(wide, ["ISO3", "YEAR"], index) if index else wide.orderBy("ISO3", "YEAR")
