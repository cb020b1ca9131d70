"""Counters that come with the write of a stage.

An ``Observation`` gathers its metrics in the tasks that write the stage, so no
second pass counts what was written. Metrics of a task that runs again count
once only in the job's last stage: the tasks of a shuffle's map side are run
again when their output is lost, and would count twice. So the number of raw
rows is carried through the de-dup as a count per key, and everything is observed
behind the last shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from indicast.functions.scalars import label_of
from indicast.operators.harmonize import attach_country_meta, dedup_by_priority, filter_known_countries, filter_year_range, union_feeds
from indicast.schema import COUNTRY_ISO3, HARMONIZED_COLS, QA
from indicast.sinks.exports import write_stage

COUNTERS = ["N_RAW", "DROPPED_DUPLICATES", "DROPPED_ISO3", "DROPPED_YEAR", "N_HARMONIZED"]


def write_observed(df: DataFrame, path: str, *metrics: Column, fmt: str = "parquet") -> dict:
    """Write a stage table and return what its metrics gathered (by default the number
    of rows, ``N_ROWS``). An empty table's counts are 0, its other metrics None."""
    metrics = metrics or (F.count(F.lit(1)).alias("N_ROWS"),)
    seen = Observation()
    write_stage(df.observe(seen, *metrics), path, fmt)
    return dict(seen.get)


def harmonize_observed(path: str, *feeds: DataFrame, tie_break: list[str] | tuple = (), prefer_non_null: bool = False,
                       extra_cols: list[str] | tuple = ()) -> dict[str, int]:
    """Entry 1 written to ``path``, and P6's counters from the same pass: rows that
    came in, rows that the de-dup, the country filter and the year filter dropped, rows written."""
    combined = union_feeds(*feeds)
    counted = dedup_by_priority(combined, ["SOURCE", *tie_break], prefer_non_null, count_as="_rows")
    known, in_range = F.col("ISO3").isin(*COUNTRY_ISO3), F.col("YEAR").between(QA.year_min, QA.year_max)
    seen = Observation()
    keys = counted.observe(
        seen, F.sum("_rows").alias("N_RAW"), F.count(F.lit(1)).alias("N_KEYS"), F.count(F.when(known, 1)).alias("N_KNOWN"),
        F.count(F.when(known & in_range, 1)).alias("N_HARMONIZED"))
    kept = filter_year_range(filter_known_countries(keys.drop("_rows")))
    if "INDICATOR_LABEL" not in combined.columns:
        kept = kept.withColumn("INDICATOR_LABEL", label_of(F.col("INDICATOR_ID")))
    write_stage(attach_country_meta(kept).select(*HARMONIZED_COLS, *extra_cols), path)
    n = {k: v or 0 for k, v in dict(seen.get).items()}
    raw, keys_, known_, last = (n.get(k, 0) for k in ("N_RAW", "N_KEYS", "N_KNOWN", "N_HARMONIZED"))
    return dict(zip(COUNTERS, (raw, raw - keys_, keys_ - known_, known_ - last, last)))


__all__ = ["COUNTERS", "write_observed", "harmonize_observed"]
