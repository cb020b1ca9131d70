"""Harmonisation: schema enforcement, source-priority de-dup, country and
year filters, country attributes.

Plan shape for ``harmonize``: scan -> project (P1-P3) -> filter (P4, P5;
Catalyst pushes both below the de-dup because they only touch key columns)
-> partial aggregate per key (W1, one row per key and map task) -> shuffle
-> final aggregate -> broadcast join to the 30-row country dimension (J1).
The only shuffle carries at most (#map tasks x #distinct keys) rows, so a hot
key holding a third of all input costs nothing extra.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicast.functions.scalars import (
    label_of, lenient_double, lenient_int, strip_upper, strip_ws,
)
from indicast.operators.ordinals import with_ordinals
from indicast.schema import COUNTRY_ISO3, HARMONIZED_COLS, LONG_COLS, QA, country_df

KEY = ["INDICATOR_ID", "ISO3", "YEAR"]


def enforce_schema(df: DataFrame, source_name: str | None = None,
                   extra_cols: list[str] | tuple = ()) -> DataFrame:
    """Align any raw frame to the long schema.

    Absent columns become typed NULLs, text is stripped (ISO3 also upper-cased),
    YEAR/VALUE are parsed leniently (bad text, NaN and fractional years become
    NULL). ``source_name`` stamps SOURCE; without it an existing SOURCE column
    is kept. ``extra_cols`` (e.g. OBS_STATUS, tie-break columns) are carried.
    """
    types = dict(df.dtypes)
    fields = {f.name: f.dataType for f in df.schema.fields}

    def get(c: str) -> Column:
        return F.col(c) if c in types else F.lit(None).cast("string")

    label = (strip_ws(get("INDICATOR_LABEL")) if "INDICATOR_LABEL" in types
             else label_of(strip_ws(get("INDICATOR_ID"))))
    source = F.lit(source_name) if source_name is not None else get("SOURCE")
    cols = [
        strip_ws(get("INDICATOR_ID")).alias("INDICATOR_ID"),
        label.alias("INDICATOR_LABEL"),
        strip_upper(get("ISO3")).alias("ISO3"),
        lenient_int(get("YEAR"), fields.get("YEAR")).alias("YEAR"),
        lenient_double(get("VALUE"), fields.get("VALUE")).alias("VALUE"),
        source.cast("string").alias("SOURCE"),
    ]
    cols += [F.col(c) if c in types else F.lit(None).cast("string").alias(c)
             for c in extra_cols]
    if "string" in (types.get("YEAR"), types.get("VALUE")):
        # Text is parsed once, where the row is made: a filter on the result would parse it again for every test.
        return df.select(F.inline(F.array(F.struct(*cols))))
    return df.select(*cols)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    """Union-all of normalised feeds by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def dedup_by_priority(df: DataFrame, order: list[str] | tuple = ("SOURCE",), prefer_non_null: bool = False,
                      keys: list[str] = KEY, count_as: str | None = None) -> DataFrame:
    """Keep the first row per key by ``order`` (ascending, NULLs last).

    Readers supply (FILE, POS) so that the first record within a source wins.
    Where ``order`` leaves a tie, a value wins over NULL, then the smaller
    value, so a value is never lost to a NULL by accident. ``prefer_non_null``
    puts that rule right after the first order column (the source). ``count_as``
    names a further column with the number of rows a key had.

    Implemented as ``min(struct(order..., payload...))`` per key: an aggregate
    with a map-side partial step instead of a window, so skewed keys are
    pre-reduced before the shuffle.
    """
    order = list(order)
    payload = [c for c in df.columns if c not in keys]
    sort_fields = []
    for i, c in enumerate(order):
        sort_fields += [F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_o{i}")]
    if "VALUE" in df.columns:
        no_value = F.col("VALUE").isNull()
        if prefer_non_null:
            sort_fields.insert(2 if order else 0, no_value.alias("_pn"))
        sort_fields += [no_value.alias("_vn"), F.col("VALUE").alias("_vv")]
    best = F.min(F.struct(*sort_fields, *[F.col(c).alias(f"_p_{c}") for c in payload]))
    counts = [F.count(F.lit(1)).alias(count_as)] if count_as else []
    return (df.groupBy(*keys).agg(best.alias("_best"), *counts)
            .select(*keys, *[F.col(f"_best._p_{c}").alias(c) for c in payload], *([count_as] if count_as else []))
            .select(*df.columns, *([count_as] if count_as else [])))


def filter_known_countries(df: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Keep rows whose ISO3 is in the country dimension (NULL dropped)."""
    if countries is None:
        return df.where(F.col("ISO3").isin(*COUNTRY_ISO3))
    return df.join(countries.select("ISO3"), "ISO3", "left_semi")


def filter_year_range(df: DataFrame, lo: int = QA.year_min, hi: int = QA.year_max) -> DataFrame:
    """P5: inclusive year range; NULL years are dropped."""
    return df.where(F.col("YEAR").between(lo, hi))


def attach_country_meta(df: DataFrame, countries: DataFrame | None = None) -> DataFrame:
    """Left join REGION / INCOME_GROUP on ISO3.

    The built-in dimension has 30 rows, so it is broadcast; a caller-supplied
    dimension is left to AQE, which broadcasts it only if it is measured small.
    """
    if countries is None:
        dim = F.broadcast(country_df(df.sparkSession))
    else:
        dim = countries.select("ISO3", "REGION", "INCOME_GROUP")
    return df.join(dim, "ISO3", "left")


def harmonize(*feeds: DataFrame, tie_break: list[str] | tuple = (), prefer_non_null: bool = False,
              countries: DataFrame | None = None, extra_cols: list[str] | tuple = ()) -> DataFrame:
    """Entry 1: feeds (already through ``enforce_schema``) -> harmonised long table.

    ``extra_cols`` are carried behind the standard columns. Labels are a
    function of the id: they are left out of the de-dup's rows and attached after it."""
    combined = union_feeds(*feeds)
    own_labels = "INDICATOR_LABEL" in combined.columns
    deduped = dedup_by_priority(combined, ["SOURCE", *tie_break], prefer_non_null)
    kept = filter_year_range(filter_known_countries(deduped, countries))
    if not own_labels:
        kept = kept.withColumn("INDICATOR_LABEL", label_of(F.col("INDICATOR_ID")))
    out = attach_country_meta(kept, countries)
    return out.select(*HARMONIZED_COLS, *extra_cols)


def drop_counters(combined: DataFrame) -> DataFrame:
    """Rows dropped by de-dup, the country filter and the year filter.

    One pass over the input: a per-key count (partial aggregate, one row per
    key and map task), then a global aggregate over the keys; the raw count is
    the sum of the per-key counts.
    """
    keys = combined.groupBy(*KEY).agg(F.count(F.lit(1)).alias("_n"))
    iso_ok = F.col("ISO3").isin(*COUNTRY_ISO3)
    yr_ok = F.col("YEAR").between(QA.year_min, QA.year_max)
    return keys.agg(
        F.sum("_n").alias("N_RAW"),
        F.count(F.lit(1)).alias("N_AFTER_DEDUP"),
        F.count(F.when(iso_ok, 1)).alias("N_AFTER_ISO3"),
        F.count(F.when(iso_ok & yr_ok, 1)).alias("N_HARMONIZED"),
    ).select(
        F.col("N_RAW").cast("bigint").alias("N_RAW"),
        (F.col("N_RAW") - F.col("N_AFTER_DEDUP")).cast("bigint").alias("DROPPED_DUPLICATES"),
        (F.col("N_AFTER_DEDUP") - F.col("N_AFTER_ISO3")).alias("DROPPED_ISO3"),
        (F.col("N_AFTER_ISO3") - F.col("N_HARMONIZED")).alias("DROPPED_YEAR"),
        "N_HARMONIZED",
    )


def long_order(df: DataFrame, index: str | None = None) -> DataFrame:
    """O1: final order of the long table (apply only at export); ``index`` names
    a column for each row's place, counted from 0."""
    return with_ordinals(df, KEY, index) if index else df.orderBy(*KEY)


__all__ = [
    "KEY", "enforce_schema", "union_feeds", "dedup_by_priority",
    "filter_known_countries", "filter_year_range", "attach_country_meta",
    "harmonize", "drop_counters", "long_order", "LONG_COLS",
]
