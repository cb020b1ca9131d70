"""Table schemas, fixed reference values and rule thresholds."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    ArrayType, DoubleType, IntegerType, LongType, StringType,
    StructField, StructType,
)

# ---------------------------------------------------------------------------
# Fixed values. These must equal the values the original pipeline uses, so
# they are written out plainly, in their natural order.
# ---------------------------------------------------------------------------

# Indicator catalogue: id -> label (11 indicators, catalogue order).
INDICATORS = [
    ("CR.1", "Completion rate — primary education"),
    ("CR.2", "Completion rate — lower secondary education"),
    ("CR.3", "Completion rate — upper secondary education"),
    ("ROFST.1", "Out-of-school rate — primary"),
    ("ROFST.2", "Out-of-school rate — lower secondary"),
    ("ROFST.3", "Out-of-school rate — upper secondary"),
    ("PPPRT.1", "Pre-primary participation rate (gross)"),
    ("GPIA.CR.1", "GPI — completion rate, primary"),
    ("GPIA.CR.2", "GPI — completion rate, lower secondary"),
    ("TRTP.1", "Proportion of trained teachers — primary"),
    ("TRTP.2", "Proportion of trained teachers — lower secondary"),
]

# Second label set used by the dashboard views (same ids, shorter labels).
DASHBOARD_LABELS = [
    ("CR.1", "Completion rate — primary"),
    ("CR.2", "Completion rate — lower secondary"),
    ("CR.3", "Completion rate — upper secondary"),
    ("ROFST.1", "Out-of-school rate — primary"),
    ("ROFST.2", "Out-of-school rate — lower secondary"),
    ("ROFST.3", "Out-of-school rate — upper secondary"),
    ("PPPRT.1", "Pre-primary participation rate"),
    ("GPIA.CR.1", "GPI — completion rate, primary"),
    ("GPIA.CR.2", "GPI — completion rate, lower secondary"),
    ("TRTP.1", "Trained teachers — primary (%)"),
    ("TRTP.2", "Trained teachers — lower secondary (%)"),
]

# Default country selection of the trend view.
TREND_DEFAULT_COUNTRIES = ["MDG", "GHA", "IND", "BRA", "FRA"]

# Country dimension: ISO3 -> (region, income group), 30 countries.
COUNTRIES = [
    ("MDG", "Sub-Saharan Africa", "Low income"),
    ("GHA", "Sub-Saharan Africa", "Lower middle income"),
    ("KEN", "Sub-Saharan Africa", "Lower middle income"),
    ("ETH", "Sub-Saharan Africa", "Low income"),
    ("NGA", "Sub-Saharan Africa", "Lower middle income"),
    ("ZAF", "Sub-Saharan Africa", "Upper middle income"),
    ("MAR", "Middle East & North Africa", "Lower middle income"),
    ("EGY", "Middle East & North Africa", "Lower middle income"),
    ("BRA", "Latin America & Caribbean", "Upper middle income"),
    ("MEX", "Latin America & Caribbean", "Upper middle income"),
    ("COL", "Latin America & Caribbean", "Upper middle income"),
    ("ARG", "Latin America & Caribbean", "Upper middle income"),
    ("IND", "South Asia", "Lower middle income"),
    ("BGD", "South Asia", "Lower middle income"),
    ("PAK", "South Asia", "Lower middle income"),
    ("NPL", "South Asia", "Low income"),
    ("FRA", "Europe & Central Asia", "High income"),
    ("DEU", "Europe & Central Asia", "High income"),
    ("GBR", "Europe & Central Asia", "High income"),
    ("ITA", "Europe & Central Asia", "High income"),
    ("ESP", "Europe & Central Asia", "High income"),
    ("USA", "North America", "High income"),
    ("CAN", "North America", "High income"),
    ("AUS", "East Asia & Pacific", "High income"),
    ("CHN", "East Asia & Pacific", "Upper middle income"),
    ("JPN", "East Asia & Pacific", "High income"),
    ("KOR", "East Asia & Pacific", "High income"),
    ("IDN", "East Asia & Pacific", "Lower middle income"),
    ("VNM", "East Asia & Pacific", "Lower middle income"),
    ("THA", "East Asia & Pacific", "Upper middle income"),
]

# Source names, in priority order (ascending name = higher priority).
SOURCE_API = "UIS_API"
SOURCE_SDMX = "UIS_SDMX"

# Dataset title written into the JSON export manifest.
EXPORT_DATASET_NAME = "UIS SDG 4 Education Indicators"


@dataclass(frozen=True)
class QAConfig:
    """Quality-rule thresholds (fixed values)."""
    max_missing_pct: float = 30.0
    rate_min: float = 0.0
    rate_max: float = 100.0
    gpi_min: float = 0.0
    gpi_max: float = 2.5
    year_min: int = 2000
    year_max: int = 2030


@dataclass(frozen=True)
class ImputeConfig:
    """Imputation settings (fixed values)."""
    method: str = "knn"
    knn_neighbors: int = 5
    max_iter: int = 10
    tol: float = 1e-3
    random_state: int = 42


@dataclass(frozen=True)
class AnomalyConfig:
    """Isolation-forest settings (fixed values)."""
    n_trees: int = 100
    max_samples: int = 256
    min_samples: int = 20
    seed: int = 42
    contamination: float = 0.05


QA = QAConfig()
IMPUTE = ImputeConfig()
ANOMALY = AnomalyConfig()

# Marker text that identifies a parity-index indicator (range 0..2.5).
GPI_MARKER = "GPIA"

# ---------------------------------------------------------------------------
# Derived lists
# ---------------------------------------------------------------------------

INDICATOR_IDS = [i for i, _ in INDICATORS]
INDICATOR_LABELS = dict(INDICATORS)
GPI_IDS = [i for i in INDICATOR_IDS if GPI_MARKER in i]
COUNTRY_ISO3 = [c for c, _, _ in COUNTRIES]
META_COLS = ["ISO3", "YEAR", "REGION", "INCOME_GROUP"]

# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

LONG_SCHEMA = StructType([
    StructField("INDICATOR_ID", StringType()),
    StructField("INDICATOR_LABEL", StringType()),
    StructField("ISO3", StringType()),
    StructField("YEAR", IntegerType()),
    StructField("VALUE", DoubleType()),
    StructField("SOURCE", StringType()),
])
LONG_COLS = [f.name for f in LONG_SCHEMA.fields]

HARMONIZED_SCHEMA = StructType(LONG_SCHEMA.fields + [
    StructField("REGION", StringType()),
    StructField("INCOME_GROUP", StringType()),
])
HARMONIZED_COLS = [f.name for f in HARMONIZED_SCHEMA.fields]

FEED_A_SCHEMA = StructType([
    StructField("INDICATOR_ID", StringType()),
    StructField("ISO3", StringType()),
    StructField("YEAR", IntegerType()),
    StructField("VALUE", DoubleType()),
    StructField("MAGNITUDE", StringType()),
    StructField("QUALIFIER", StringType()),
    StructField("INDICATOR_LABEL", StringType()),
])

FEED_B_SCHEMA = StructType([
    StructField("INDICATOR_ID", StringType()),
    StructField("ISO3", StringType()),
    StructField("YEAR", IntegerType()),
    StructField("VALUE", DoubleType()),
    StructField("OBS_STATUS", StringType()),
    StructField("INDICATOR_LABEL", StringType()),
])

COVERAGE_SCHEMA = StructType([
    StructField("INDICATOR_ID", StringType()),
    StructField("INDICATOR_LABEL", StringType()),
    StructField("N_COUNTRIES", LongType()),
    StructField("N_YEARS", LongType()),
    StructField("N_OBSERVATIONS", LongType()),
    StructField("N_MISSING", LongType()),
    StructField("COVERAGE_PCT", DoubleType()),
    StructField("YEAR_MIN", IntegerType()),
    StructField("YEAR_MAX", IntegerType()),
])

IMPUTATION_REPORT_SCHEMA = StructType([
    StructField("INDICATOR_ID", StringType()),
    StructField("INDICATOR_LABEL", StringType()),
    StructField("N_TOTAL", LongType()),
    StructField("N_MISSING_BEFORE", LongType()),
    StructField("PCT_MISSING_BEFORE", DoubleType()),
    StructField("N_MISSING_AFTER", LongType()),
    StructField("PCT_MISSING_AFTER", DoubleType()),
    StructField("N_IMPUTED", LongType()),
    StructField("METHOD", StringType()),
])

CONCEPT_SCHEMA = StructType([
    StructField("INDICATOR_ID", StringType()),
    StructField("LABEL", StringType()),
    StructField("SDG_TARGET", StringType()),
    StructField("UNIT", StringType()),
    StructField("MEASUREMENT", StringType()),
    StructField("DISAGGREGATIONS", ArrayType(StringType())),
    StructField("SOURCE_ORGANISATION", StringType()),
    StructField("NOTE", StringType()),
])


# ---------------------------------------------------------------------------
# Dimension tables (fixed, tiny: safe to broadcast)
# ---------------------------------------------------------------------------

def catalogue_df(spark: SparkSession) -> DataFrame:
    """Indicator catalogue with its position, measure kind and valid range."""
    rows = []
    for pos, (ind, label) in enumerate(INDICATORS):
        gpi = GPI_MARKER in ind
        rows.append((pos, ind, label, "index" if gpi else "rate",
                     QA.gpi_min if gpi else QA.rate_min,
                     QA.gpi_max if gpi else QA.rate_max))
    schema = StructType([
        StructField("CAT_POS", IntegerType(), False),
        StructField("INDICATOR_ID", StringType(), False),
        StructField("INDICATOR_LABEL", StringType(), False),
        StructField("KIND", StringType(), False),
        StructField("LO", DoubleType(), False),
        StructField("HI", DoubleType(), False),
    ])
    return spark.createDataFrame(rows, schema)


def country_df(spark: SparkSession) -> DataFrame:
    """Country dimension: ISO3, REGION, INCOME_GROUP."""
    schema = StructType([
        StructField("ISO3", StringType(), False),
        StructField("REGION", StringType(), False),
        StructField("INCOME_GROUP", StringType(), False),
    ])
    return spark.createDataFrame(COUNTRIES, schema)
