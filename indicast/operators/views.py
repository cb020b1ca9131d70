"""Read-side views a dashboard needs.

Every view is one lazy Spark plan over the wide / long / report tables;
parameters become predicates or group keys, never driver-side loops.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicast.functions.scalars import qcol, status_class
from indicast.schema import DASHBOARD_LABELS, INDICATOR_IDS, TREND_DEFAULT_COUNTRIES

GPI_VIEW_COL = "GPIA.CR.1"


def _mean(c: str) -> Column:
    return F.avg(qcol(c))


def trend_extract(wide: DataFrame, indicator: str = INDICATOR_IDS[0],
                  countries: list[str] | tuple = tuple(TREND_DEFAULT_COUNTRIES)) -> DataFrame:
    """Selected countries, four columns, rows with the indicator present."""
    return (wide.where(F.col("ISO3").isin(*countries))
            .select("ISO3", "YEAR", "REGION", qcol(indicator).alias(indicator))
            .where(qcol(indicator).isNotNull()))


def regional_mean_by_year(wide: DataFrame, indicator: str = INDICATOR_IDS[0]) -> DataFrame:
    """Mean of one indicator per (REGION, YEAR); NULL regions are dropped,
    a group with only NULL values keeps a NULL mean."""
    return (wide.where(F.col("REGION").isNotNull())
            .groupBy("REGION", "YEAR").agg(_mean(indicator).alias(indicator)))


def latest_year(wide: DataFrame) -> Column:
    """Scalar sub-query: the most recent year of the wide table."""
    return wide.select(F.max("YEAR")).scalar()


def equity_extract(wide: DataFrame, year: int | Column | None = None) -> DataFrame:
    """P10 + O4: one year's parity indices, rows with GPIA.CR.1 present,
    ascending by GPIA.CR.1 (latest year by default)."""
    y = latest_year(wide) if year is None else (year if isinstance(year, Column) else F.lit(year))
    return (wide.where(F.col("YEAR") == y)
            .select("ISO3", "REGION", "INCOME_GROUP", qcol("GPIA.CR.1").alias("GPIA.CR.1"),
                    qcol("GPIA.CR.2").alias("GPIA.CR.2"))
            .where(qcol(GPI_VIEW_COL).isNotNull())
            .orderBy(qcol(GPI_VIEW_COL), "ISO3"))


def regional_gpi(wide: DataFrame, year: int | Column | None = None) -> DataFrame:
    """A9 + O4: mean GPIA.CR.1 per region for one year, ascending."""
    e = equity_extract(wide, year)
    return (e.where(F.col("REGION").isNotNull()).groupBy("REGION")
            .agg(_mean(GPI_VIEW_COL).alias(GPI_VIEW_COL))
            .orderBy(qcol(GPI_VIEW_COL), "REGION"))


def overview_kpis(wide: DataFrame, long: DataFrame) -> DataFrame:
    """A10: distinct countries, catalogue size, year range, non-null observations."""
    n_obs = long.select(F.count("VALUE")).scalar()
    return wide.agg(
        F.count_distinct("ISO3").alias("N_COUNTRIES"),
        F.lit(len(INDICATOR_IDS)).cast("bigint").alias("N_INDICATORS"),
        F.min("YEAR").alias("YEAR_MIN"),
        F.max("YEAR").alias("YEAR_MAX"),
    ).withColumn("N_OBSERVATIONS", n_obs)


def countries_per_region(wide: DataFrame) -> DataFrame:
    """Distinct countries per region, descending count (REGION depends on ISO3)."""
    return (wide.select("ISO3", "REGION").distinct()
            .where(F.col("REGION").isNotNull())
            .groupBy("REGION").agg(F.count(F.lit(1)).alias("N_COUNTRIES"))
            .orderBy(F.desc("N_COUNTRIES"), "REGION"))


def availability_matrix(wide: DataFrame) -> DataFrame:
    """1/0 per (row, indicator) for present/absent values."""
    return wide.select("ISO3", "YEAR", *[qcol(i).isNotNull().cast("int").alias(i)
                                         for i in INDICATOR_IDS])


def years_heatmap(wide: DataFrame) -> DataFrame:
    """Number of years with data per country and indicator."""
    return wide.groupBy("ISO3").agg(*[F.count(qcol(i)).alias(i) for i in INDICATOR_IDS])


def pick_lists(wide: DataFrame, anomalies: DataFrame | None = None) -> DataFrame:
    """Sorted distinct non-null values for the selectors, as (LIST_ID, ITEM)."""
    parts = [wide.select(F.lit(c).alias("LIST_ID"), F.col(c).alias("ITEM"))
             for c in ("ISO3", "REGION", "INCOME_GROUP")]
    if anomalies is not None:
        parts.append(anomalies.select(F.lit("INDICATOR_ID").alias("LIST_ID"),
                                      F.col("INDICATOR_ID").alias("ITEM")))
    u = reduce(DataFrame.unionByName, parts)
    return u.where(F.col("ITEM").isNotNull()).distinct().orderBy("LIST_ID", "ITEM")


def filter_table(wide: DataFrame, region: str | None = None, income_group: str | None = None,
                 years: tuple[int, int] | None = None) -> DataFrame:
    """Optional conjunctive predicates; None (the "All" choice) adds none."""
    conds = []
    if region is not None:
        conds.append(F.col("REGION") == region)
    if income_group is not None:
        conds.append(F.col("INCOME_GROUP") == income_group)
    if years is not None:
        conds.append(F.col("YEAR").between(years[0], years[1]))
    return wide.where(reduce(lambda a, b: a & b, conds)) if conds else wide


def row_counts(**frames: DataFrame) -> DataFrame:
    """Row count of each named frame, one row per name."""
    parts = [df.agg(F.count(F.lit(1)).alias("N_ROWS")).select(F.lit(name).alias("TABLE_NAME"), "N_ROWS")
             for name, df in frames.items()]
    return reduce(DataFrame.unionByName, parts)


def coverage_summary(coverage: DataFrame) -> DataFrame:
    """The coverage columns the dashboard shows."""
    return coverage.select("INDICATOR_ID", "INDICATOR_LABEL", "N_OBSERVATIONS",
                           "COVERAGE_PCT", "YEAR_MIN", "YEAR_MAX")


def qa_status_classes(summary: DataFrame) -> DataFrame:
    """QA status -> severity class (ok / warn / fail)."""
    return summary.withColumn("STATUS_CLASS", status_class("QA_STATUS"))


def anomalies_for(anomalies: DataFrame, indicator: str | None = None) -> DataFrame:
    """Anomaly rows, optionally for one indicator (None = all)."""
    a = anomalies.where(F.col("IS_ANOMALY")) if "IS_ANOMALY" in anomalies.columns else anomalies
    return a if indicator is None else a.where(F.col("INDICATOR_ID") == indicator)


def with_dashboard_labels(long: DataFrame) -> DataFrame:
    """Replace INDICATOR_LABEL by the dashboard's label (unknown id -> NULL)."""
    kv = []
    for k, v in DASHBOARD_LABELS:
        kv += [F.lit(k), F.lit(v)]
    return long.withColumn("INDICATOR_LABEL", F.element_at(F.create_map(*kv), F.col("INDICATOR_ID")))


def sample_head(df: DataFrame, order: list[str], n: int = 4) -> DataFrame:
    """First ``n`` rows in a total order (a top-n, so the limit is the feature)."""
    return df.orderBy(*order).limit(n)
