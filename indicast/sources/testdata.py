"""Deterministic view that turns the driver's TPC-H-like tables into raw
indicator observations (the mapping documented in FIXTURES.md §3).

It yields out-of-range values, NULLs, duplicate keys within and across the
two sources, implausible years, one unknown country and unknown indicators,
so every rule of the pipeline has something to find.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicast.schema import INDICATOR_IDS, SOURCE_API, SOURCE_SDMX

# Fixed values of the mapping: p_partkey % 13 -> indicator id (11 and 12 are
# an unknown id), s_nationkey -> country code (24 and up are unknown).
MAPPING_UNKNOWN_INDICATOR = "XX.9"
MAPPING_COUNTRIES = [
    "MDG", "GHA", "KEN", "ETH", "NGA", "ZAF", "MAR", "EGY", "BRA", "MEX", "COL",
    "IND", "BGD", "PAK", "NPL", "FRA", "DEU", "GBR", "USA", "CAN", "CHN", "JPN",
    "IDN", "VNM",
]
MAPPING_UNKNOWN_COUNTRY = "ZZZ"
PARITY_BUCKETS = (7, 8)

# Tie-break columns that make the source-priority de-dup deterministic.
TIE_BREAK = ["ORD_A", "ORD_B"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _lookup(values: list[str], key, default: str):
    kv = []
    for i, v in enumerate(values):
        kv += [F.lit(i), F.lit(v)]
    return F.coalesce(F.element_at(F.create_map(*kv), key.cast("int")), F.lit(default))


# The dirty variant of the mapping. Two ids are sparse (kept for half of the
# countries and years only), and text cells come in these forms, by row:
SPARSE_IDS = ["CR.3", "GPIA.CR.2"]
#   VALUE by l_orderkey % 11: padded; 1e2; not a number; NaN; else plain
#   YEAR  by l_linenumber % 7 (order keys divisible by 3): 2010.0, 2010.5, text, padded; else plain
#   ISO3  by (l_orderkey + l_linenumber) % 9: padded lower case, blank, null; else plain


def _dirty(observed: DataFrame) -> DataFrame:
    """The same observations as untyped text with dirty cells."""
    order, line = F.col("ORD_A"), F.col("ORD_B")
    value, year = F.col("VALUE").cast("string"), F.col("YEAR").cast("string")
    v, y, c = order % 11, F.when(order % 3 == 0, line % 7).otherwise(0), (order + line) % 9
    sparse = F.col("INDICATOR_ID").isin(*SPARSE_IDS)
    place = F.col("_nation") * 2 + F.col("YEAR")
    return observed.where(~sparse | ((F.col("_nation") % 2 == 0) & (place % 4 == 0))).withColumns({
        "VALUE": F.when(v == 0, F.concat(F.lit("  "), value, F.lit("\t"))).when((v == 1) & value.isNotNull(), F.lit("1e2"))
                 .when(v == 2, F.lit("x")).when(v == 3, F.lit("nan")).otherwise(value),
        "YEAR": F.when(y == 1, F.concat(year, F.lit(".0"))).when(y == 2, F.concat(year, F.lit(".5")))
                .when(y == 3, F.lit("n/a")).when(y == 4, F.concat(F.lit(" "), year, F.lit(" "))).otherwise(year),
        "ISO3": F.when(c == 0, F.concat(F.lit(" "), F.lower("ISO3"), F.lit("\n"))).when(c == 1, F.lit("   "))
                .when(c == 2, F.lit(None)).otherwise(F.col("ISO3"))})


def raw_observations(spark: SparkSession, sf_dir: str, with_entity: bool = False, dirty: bool = False) -> DataFrame:
    """Raw long observations: INDICATOR_ID, ISO3, YEAR, VALUE, SOURCE, ORD_A, ORD_B.

    Column pruning keeps the scans to the six lineitem columns, one part column
    and two supplier columns; join strategy is left to Catalyst/AQE, which
    broadcasts a side only when its measured size is under the threshold.
    ``dirty`` gives ISO3, YEAR and VALUE as text with cells in need of parsing.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey")
    supp = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")

    bucket = F.col("p_partkey") % 13
    value = (
        F.when(F.col("l_orderkey") % 7 == 0, F.lit(None).cast("double"))
        .when(bucket.isin(*PARITY_BUCKETS), F.round(F.lit(0.7) + F.col("l_discount") * 6, 4))
        .otherwise(F.round(F.col("l_quantity") * 2.02, 2))
    )
    observed = (
        li.join(part, F.col("p_partkey") == F.col("l_partkey"))
        .join(supp, F.col("s_suppkey") == F.col("l_suppkey"))
        .select(
            _lookup(INDICATOR_IDS, bucket, MAPPING_UNKNOWN_INDICATOR).alias("INDICATOR_ID"),
            _lookup(MAPPING_COUNTRIES, F.col("s_nationkey"), MAPPING_UNKNOWN_COUNTRY).alias("ISO3"),
            (F.year("l_shipdate") + 4).cast("int").alias("YEAR"),
            value.alias("VALUE"),
            F.when(F.col("l_orderkey") % 2 == 0, F.lit(SOURCE_API))
            .otherwise(F.lit(SOURCE_SDMX)).alias("SOURCE"),
            F.col("l_orderkey").alias("ORD_A"),
            F.col("l_linenumber").alias("ORD_B"),
            *([F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("ENTITY")]
              if with_entity else []),
            *([F.col("s_nationkey").alias("_nation")] if dirty else []),
        )
    )
    return _dirty(observed).drop("_nation") if dirty else observed


# The same mapping as DuckDB SQL, used by the oracles.
RAW_SQL = """
SELECT
  CASE p_partkey % 13 WHEN 0 THEN 'CR.1' WHEN 1 THEN 'CR.2' WHEN 2 THEN 'CR.3' WHEN 3 THEN 'ROFST.1'
    WHEN 4 THEN 'ROFST.2' WHEN 5 THEN 'ROFST.3' WHEN 6 THEN 'PPPRT.1' WHEN 7 THEN 'GPIA.CR.1'
    WHEN 8 THEN 'GPIA.CR.2' WHEN 9 THEN 'TRTP.1' WHEN 10 THEN 'TRTP.2' ELSE 'XX.9' END AS INDICATOR_ID,
  CASE s_nationkey WHEN 0 THEN 'MDG' WHEN 1 THEN 'GHA' WHEN 2 THEN 'KEN' WHEN 3 THEN 'ETH' WHEN 4 THEN 'NGA'
    WHEN 5 THEN 'ZAF' WHEN 6 THEN 'MAR' WHEN 7 THEN 'EGY' WHEN 8 THEN 'BRA' WHEN 9 THEN 'MEX' WHEN 10 THEN 'COL'
    WHEN 11 THEN 'IND' WHEN 12 THEN 'BGD' WHEN 13 THEN 'PAK' WHEN 14 THEN 'NPL' WHEN 15 THEN 'FRA' WHEN 16 THEN 'DEU'
    WHEN 17 THEN 'GBR' WHEN 18 THEN 'USA' WHEN 19 THEN 'CAN' WHEN 20 THEN 'CHN' WHEN 21 THEN 'JPN' WHEN 22 THEN 'IDN'
    WHEN 23 THEN 'VNM' ELSE 'ZZZ' END AS ISO3,
  CAST(year(l_shipdate) + 4 AS INT) AS YEAR,
  CASE WHEN l_orderkey % 7 = 0 THEN NULL
       WHEN p_partkey % 13 IN (7, 8) THEN round(0.7 + l_discount * 6, 4)
       ELSE round(l_quantity * 2.02, 2) END AS VALUE,
  CASE WHEN l_orderkey % 2 = 0 THEN 'UIS_API' ELSE 'UIS_SDMX' END AS SOURCE,
  l_orderkey AS ORD_A, l_linenumber AS ORD_B
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey
"""

# The dirty variant, stated as what each form of cell must be read as.
DIRTY_SQL = f"""
SELECT INDICATOR_ID,
  CASE (ORD_A + ORD_B) % 9 WHEN 1 THEN '' WHEN 2 THEN NULL ELSE ISO3 END AS ISO3,
  CASE WHEN ORD_A % 3 = 0 AND ORD_B % 7 IN (2, 3) THEN NULL ELSE YEAR END AS YEAR,
  CASE WHEN ORD_A % 11 IN (2, 3) THEN NULL WHEN ORD_A % 11 = 1 AND VALUE IS NOT NULL THEN 100.0 ELSE VALUE END AS VALUE,
  SOURCE, ORD_A, ORD_B
FROM ({RAW_SQL.replace("l_linenumber AS ORD_B", "l_linenumber AS ORD_B, s_nationkey AS nation")})
WHERE INDICATOR_ID NOT IN ('CR.3', 'GPIA.CR.2') OR (nation % 2 = 0 AND (nation * 2 + YEAR) % 4 = 0)
"""
