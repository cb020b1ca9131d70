"""Coverage from mergeable bitmaps, kept per feed file (A1, A2, A10).

Country and year are dimensions of fixed size, so a set of country-years is a
bitmap of at most 30 x 31 bits. For every feed file and indicator the state holds four
bitmaps: countries, years, the country-years with a record (``SEEN``) and those whose
first record of the file has a value (``VALUED``). They follow from the file alone. A new file adds its
rows to the state, a file that is read again replaces its own, and coverage of everything so far follows
from the state without another look at the files.

Distinct counts are bits of the bitmaps' union. Observations need care: of the files that have a
country-year the first one in order of source and file decides whether it has a value. File by file, a
file adds the country-years that are valued in it and not seen before, which is
``|VALUED or SEEN before| - |SEEN before|``: unions and counts only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indicast.functions.scalars import pct
from indicast.operators.harmonize import dedup_by_priority, filter_known_countries, filter_year_range
from indicast.schema import COUNTRY_ISO3, QA, catalogue_df

YEARS = QA.year_max - QA.year_min + 1
#: Bits of one bitmap (a fixed value of Spark's bitmap functions); all positions lie in its first bucket.
BITMAP_BITS = 32_768
STATE = ["FILE_ID", "SOURCE", "INDICATOR_ID", "COUNTRIES", "YEARS", "SEEN", "VALUED", "YEAR_MIN", "YEAR_MAX"]


def _bits(position: Column) -> Column:
    """Bitmap of 0-based positions; NULL positions set no bit."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(position.cast("bigint") + 1))


def file_state(feed: DataFrame, tie_break: list[str] | tuple = (), file_col: str = "FILE_ID") -> DataFrame:
    """The state of the files whose rows ``feed`` holds (long schema, with the file's
    name in ``file_col``). A file is of one source; ``tie_break`` orders its records."""
    if len(COUNTRY_ISO3) * YEARS > BITMAP_BITS:
        raise ValueError("the country-year grid is larger than a bitmap")
    known = filter_year_range(filter_known_countries(feed))
    first = dedup_by_priority(known, ["SOURCE", *tie_break], keys=[file_col, "INDICATOR_ID", "ISO3", "YEAR"])
    country = F.array_position(F.array(*[F.lit(c) for c in sorted(COUNTRY_ISO3)]), F.col("ISO3")) - 1
    year = F.col("YEAR") - QA.year_min
    cell = country * YEARS + year
    return first.groupBy(F.col(file_col).alias("FILE_ID"), "INDICATOR_ID").agg(
        F.min("SOURCE").alias("SOURCE"), _bits(country).alias("COUNTRIES"), _bits(year).alias("YEARS"),
        _bits(cell).alias("SEEN"), _bits(F.when(F.col("VALUE").isNotNull(), cell)).alias("VALUED"),
        F.min("YEAR").alias("YEAR_MIN"), F.max("YEAR").alias("YEAR_MAX")).select(*STATE)


def coverage_from_state(state: DataFrame) -> DataFrame:
    """A1 of all files in the state: the columns of :func:`indicast.operators.reshape.coverage`."""
    everywhere = state.agg(F.bitmap_or_agg("COUNTRIES").alias("c"), F.bitmap_or_agg("YEARS").alias("y"))
    grid = everywhere.select(F.coalesce(F.bitmap_count("c") * F.bitmap_count("y"), F.lit(0))).scalar()
    # As many rows an indicator as files.
    earlier = W.partitionBy("INDICATOR_ID").orderBy("SOURCE", "FILE_ID").rowsBetween(W.unboundedPreceding, -1)
    before = state.withColumn("_before", F.bitmap_or_agg("SEEN").over(earlier))
    # The union of the two bitmaps of a row: an aggregate over a pair of rows.
    pairs = before.withColumn("_bits", F.explode(F.array("VALUED", "_before")))
    per_file = pairs.groupBy("FILE_ID", "INDICATOR_ID").agg(
        (F.bitmap_count(F.bitmap_or_agg("_bits")) - F.bitmap_count(F.first("_before"))).alias("N_ADDED"),
        *[F.first(c).alias(c) for c in ("COUNTRIES", "YEARS", "YEAR_MIN", "YEAR_MAX")])
    found = per_file.groupBy("INDICATOR_ID").agg(
        F.bitmap_count(F.bitmap_or_agg("COUNTRIES")).alias("N_COUNTRIES"), F.bitmap_count(F.bitmap_or_agg("YEARS")).alias("N_YEARS"),
        F.sum("N_ADDED").alias("N_OBSERVATIONS"), F.min("YEAR_MIN").alias("YEAR_MIN"), F.max("YEAR_MAX").alias("YEAR_MAX"))
    cat = catalogue_df(state.sparkSession).select("INDICATOR_ID", "INDICATOR_LABEL")
    n_obs = F.coalesce("N_OBSERVATIONS", F.lit(0)).cast("bigint")
    return cat.join(found, "INDICATOR_ID", "left").select(
        "INDICATOR_ID", "INDICATOR_LABEL",
        F.coalesce("N_COUNTRIES", F.lit(0)).cast("bigint").alias("N_COUNTRIES"),
        F.coalesce("N_YEARS", F.lit(0)).cast("bigint").alias("N_YEARS"),
        n_obs.alias("N_OBSERVATIONS"), F.greatest(grid - n_obs, F.lit(0)).cast("bigint").alias("N_MISSING"),
        pct(n_obs, grid).alias("COVERAGE_PCT"), "YEAR_MIN", "YEAR_MAX")


__all__ = ["STATE", "file_state", "coverage_from_state"]
