"""Indicator metadata as tables (M1-M8): concepts, code lists, structure,
lineage, the nested registry and the flattened concept sheet.

The registry is small, fixed reference data; it is kept as flat dimension
tables (joinable with the observation tables) and only nested into one
registry row (structs / maps / arrays) for export.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, IntegerType, StringType, StructField, StructType,
)

from indicast.schema import CONCEPT_SCHEMA, INDICATORS

# ---------------------------------------------------------------------------
# Fixed values (must equal the original registry).
# ---------------------------------------------------------------------------

DEFAULT_UNIT = "Percentage"
DEFAULT_SOURCE_ORG = "UNESCO UIS"
GPI_NOTE = "GPI > 1 favours females; GPI < 1 favours males"

# id, SDG target, unit, measurement, disaggregations, source organisation, note
CONCEPT_DETAILS = [
    ("CR.1", "4.1", "Percentage", "Proportion of children who complete primary education",
     ["sex", "location", "wealth_quintile"], "UNESCO UIS", None),
    ("CR.2", "4.1", "Percentage", "Proportion of youth who complete lower secondary education",
     ["sex", "location", "wealth_quintile"], "UNESCO UIS", None),
    ("CR.3", "4.1", "Percentage", "Proportion of youth who complete upper secondary education",
     ["sex", "location", "wealth_quintile"], "UNESCO UIS", None),
    ("ROFST.1", "4.1", "Percentage", "Proportion of primary-school-age children out of school",
     ["sex", "location"], "UNESCO UIS", None),
    ("ROFST.2", "4.1", "Percentage", "Proportion of lower-secondary-age youth out of school",
     ["sex", "location"], "UNESCO UIS", None),
    ("ROFST.3", "4.1", "Percentage", "Proportion of upper-secondary-age youth out of school",
     ["sex", "location"], "UNESCO UIS", None),
    ("PPPRT.1", "4.2", "Percentage", "Gross enrolment ratio in pre-primary education",
     ["sex"], "UNESCO UIS", None),
    ("GPIA.CR.1", "4.5", "Index (0–2.5)", "Gender Parity Index for primary completion rate",
     [], "UNESCO UIS", GPI_NOTE),
    ("GPIA.CR.2", "4.5", "Index (0–2.5)", "Gender Parity Index for lower secondary completion rate",
     [], "UNESCO UIS", GPI_NOTE),
    ("TRTP.1", "4.c", "Percentage", "Proportion of primary teachers who are trained",
     ["sex"], "UNESCO UIS", None),
    ("TRTP.2", "4.c", "Percentage", "Proportion of lower secondary teachers who are trained",
     ["sex"], "UNESCO UIS", None),
]

CONCEPT_SCHEME = {
    "id": "UIS_SDG4_CONCEPTS",
    "name": "UNESCO UIS SDG 4 Indicator Concept Scheme",
    "version": "1.0",
    "agency": "UNESCO UIS",
    "valid_from": "2010-01-01",
}

# list id, list name, description, [(code, label), ...]
CODE_LISTS = [
    ("CL_AREA", "Reference Area (ISO 3166-1 alpha-3)", "Country codes used as the geographic dimension.", [
        ("MDG", "Madagascar"), ("GHA", "Ghana"), ("KEN", "Kenya"), ("ETH", "Ethiopia"),
        ("NGA", "Nigeria"), ("ZAF", "South Africa"), ("MAR", "Morocco"), ("EGY", "Egypt"),
        ("BRA", "Brazil"), ("MEX", "Mexico"), ("COL", "Colombia"), ("IND", "India"),
        ("BGD", "Bangladesh"), ("PAK", "Pakistan"), ("NPL", "Nepal"), ("FRA", "France"),
        ("DEU", "Germany"), ("GBR", "United Kingdom"), ("USA", "United States"), ("CAN", "Canada"),
        ("CHN", "China"), ("JPN", "Japan"), ("IDN", "Indonesia"), ("VNM", "Viet Nam"),
    ]),
    ("CL_OBS_STATUS", "Observation Status", None, [
        ("", "Actual observation"), ("E", "Estimated"), ("P", "Provisional"), ("M", "Missing"),
        ("I", "Imputed (pipeline)"),
    ]),
    ("CL_FREQ", "Frequency", None, [("A", "Annual")]),
]

# role, id, concept, code list, type
STRUCTURE = [
    ("dimension", "INDICATOR_ID", "Indicator", "UIS_SDG4_CONCEPTS", None),
    ("dimension", "REF_AREA", "Reference Area", "CL_AREA", None),
    ("dimension", "TIME_PERIOD", "Time Period", None, "integer"),
    ("attribute", "OBS_STATUS", "Observation Status", "CL_OBS_STATUS", None),
    ("attribute", "UNIT_MEASURE", "Unit of Measure", None, None),
    ("attribute", "SOURCE", "Data Source", None, None),
    ("primary_measure", "OBS_VALUE", "Observation Value", None, "float"),
]
STRUCTURE_ID = "DSD_UIS_SDG4"
STRUCTURE_NAME = "Data Structure Definition — UIS SDG 4"

REGISTRY_ID = "UIS_SDG4_METADATA"
REGISTRY_DESCRIPTION = "Concepts, code lists, data structure and processing steps behind the published indicator tables."

# What the stages of this engine do (step, name, module, description).
LINEAGE_STEPS = [
    (1, "JSON feed", "indicast.sources.feeds", "Payload files landed from the API feed; one row per observation."),
    (2, "SDMX feed", "indicast.sources.feeds", "Series of landed SDMX 2.1 files; one row per Obs element."),
    (3, "Harmonise", "indicast.operators.harmonize",
     "One row per indicator, country and year, by source order; unknown countries and years out of range removed; "
     "country attributes added."),
    (4, "Reshape", "indicast.operators.reshape", "One row per country and year, catalogue indicators as columns."),
    (5, "Check", "indicast.operators.quality", "One row per rule violation found in the harmonised table."),
    (6, "Score outliers", "indicast.operators.anomaly",
     "Harmonised rows with isolation-forest score and flag; rows that cannot be scored stay without."),
    (7, "Impute", "indicast.operators.impute", "Wide table with gaps filled by the chosen method, clipped and rounded."),
]

# ---------------------------------------------------------------------------

CODE_SCHEMA = StructType([
    StructField("LIST_ID", StringType(), False), StructField("LIST_NAME", StringType()),
    StructField("DESCRIPTION", StringType()), StructField("CODE", StringType(), False),
    StructField("LABEL", StringType()),
])
STRUCTURE_SCHEMA = StructType([
    StructField("ROLE", StringType(), False), StructField("ID", StringType(), False),
    StructField("CONCEPT", StringType()), StructField("CODELIST", StringType()),
    StructField("TYPE", StringType()),
])
LINEAGE_SCHEMA = StructType([
    StructField("STEP", IntegerType(), False), StructField("NAME", StringType()),
    StructField("MODULE", StringType()), StructField("DESCRIPTION", StringType()),
])
_DETAIL_SCHEMA = StructType([
    StructField("INDICATOR_ID", StringType()), StructField("SDG_TARGET", StringType()),
    StructField("UNIT", StringType()), StructField("MEASUREMENT", StringType()),
    StructField("DISAGGREGATIONS", ArrayType(StringType())),
    StructField("SOURCE_ORGANISATION", StringType()), StructField("NOTE", StringType()),
])


def concept_table(spark: SparkSession) -> DataFrame:
    """M1: catalogue LEFT JOIN details with the registry defaults for absent fields."""
    cat = spark.createDataFrame(INDICATORS, "INDICATOR_ID string, LABEL string")
    det = F.broadcast(spark.createDataFrame(CONCEPT_DETAILS, _DETAIL_SCHEMA))
    return cat.join(det, "INDICATOR_ID", "left").select(
        "INDICATOR_ID", "LABEL",
        F.coalesce("SDG_TARGET", F.lit("")).alias("SDG_TARGET"),
        F.coalesce("UNIT", F.lit(DEFAULT_UNIT)).alias("UNIT"),
        F.coalesce("MEASUREMENT", F.lit("")).alias("MEASUREMENT"),
        F.coalesce("DISAGGREGATIONS", F.array().cast("array<string>")).alias("DISAGGREGATIONS"),
        F.coalesce("SOURCE_ORGANISATION", F.lit(DEFAULT_SOURCE_ORG)).alias("SOURCE_ORGANISATION"),
        F.coalesce("NOTE", F.lit("")).alias("NOTE"),
    ).select(*[f.name for f in CONCEPT_SCHEMA.fields])


def code_lists(spark: SparkSession) -> DataFrame:
    """M2: code lists as one long table (LIST_ID, LIST_NAME, DESCRIPTION, CODE, LABEL)."""
    rows = [(lid, name, desc, code, label) for lid, name, desc, codes in CODE_LISTS
            for code, label in codes]
    return spark.createDataFrame(rows, CODE_SCHEMA)


def data_structure(spark: SparkSession) -> DataFrame:
    """M3: dimensions, attributes and the primary measure."""
    return spark.createDataFrame(STRUCTURE, STRUCTURE_SCHEMA)


def lineage(spark: SparkSession, counts: DataFrame | None = None) -> DataFrame:
    """M4: processing steps with a UTC timestamp; ``counts`` (STEP, N_ROWS)
    attaches the real output size of each executed stage."""
    steps = spark.createDataFrame(LINEAGE_STEPS, LINEAGE_SCHEMA).withColumn(
        "TIMESTAMP", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    if counts is not None:
        steps = steps.join(counts, "STEP", "left")
    return steps


def step_counts(stages: dict[int, DataFrame]) -> DataFrame:
    """STEP, N_ROWS: the size of each executed stage's output."""
    parts = [df.agg(F.count(F.lit(1)).alias("N_ROWS")).select(F.lit(step).alias("STEP"), "N_ROWS")
             for step, df in stages.items()]
    return reduce(DataFrame.unionByName, parts)


def process_history(lineage_df: DataFrame) -> DataFrame:
    """M7: lineage in step order."""
    return lineage_df.orderBy("STEP")


def indicator_meta(concepts: DataFrame, indicator_id: str) -> DataFrame:
    """M6: one indicator's concept row (unknown id -> empty)."""
    return concepts.where(F.col("INDICATOR_ID") == indicator_id)


def concept_sheet(concepts: DataFrame) -> DataFrame:
    """M8: flat concept sheet, disaggregations joined with ', '."""
    return concepts.withColumn("DISAGGREGATIONS", F.array_join("DISAGGREGATIONS", ", "))


def registry(spark: SparkSession, lineage_df: DataFrame | None = None) -> DataFrame:
    """M5: the nested registry as one row (concept map, code-list map,
    structure struct, lineage array); ``to_json`` it for export."""
    concepts = concept_table(spark)
    cmap = concepts.agg(F.map_from_entries(F.collect_list(F.struct(
        "INDICATOR_ID", F.struct(*[F.col(c).alias(c.lower()) for c in concepts.columns])))).alias("concepts"))
    codes = code_lists(spark).groupBy("LIST_ID", "LIST_NAME", "DESCRIPTION").agg(
        F.map_from_entries(F.collect_list(F.struct("CODE", "LABEL"))).alias("codes"))
    lists = codes.agg(F.map_from_entries(F.collect_list(F.struct(
        "LIST_ID", F.struct(F.col("LIST_ID").alias("id"), F.col("LIST_NAME").alias("name"),
                            F.col("DESCRIPTION").alias("description"), "codes")))).alias("codelists"))
    st = data_structure(spark).agg(F.collect_list(F.struct(
        F.col("ROLE").alias("role"), F.col("ID").alias("id"), F.col("CONCEPT").alias("concept"),
        F.col("CODELIST").alias("codelist"), F.col("TYPE").alias("type"))).alias("components"))
    lin = (lineage_df if lineage_df is not None else lineage(spark)).agg(
        F.sort_array(F.collect_list(F.struct(*[F.col(c).alias(c.lower()) for c in
                                               ["STEP", "NAME", "MODULE", "DESCRIPTION", "TIMESTAMP"]])))
        .alias("process_history"))
    # Each part is a one-row global aggregate: attach them as scalar subqueries.
    one = cmap.select("concepts", lists.select("codelists").scalar().alias("codelists"),
                      st.select("components").scalar().alias("components"),
                      lin.select("process_history").scalar().alias("process_history"))
    return one.select(
        F.lit(REGISTRY_ID).alias("registry_id"), F.lit("1.0").alias("version"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created"),
        F.lit(REGISTRY_DESCRIPTION).alias("description"),
        F.struct(*[F.lit(v).alias(k) for k, v in CONCEPT_SCHEME.items()], F.col("concepts")).alias("concept_scheme"),
        F.col("codelists"),
        F.struct(F.lit(STRUCTURE_ID).alias("id"), F.lit(STRUCTURE_NAME).alias("name"),
                 F.col("components")).alias("data_structure"),
        F.col("process_history"),
    )
