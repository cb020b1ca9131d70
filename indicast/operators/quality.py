"""Rule-based quality checks (C1-C6) and the per-indicator QA summary (A2-A4).

Row-level rules (range, duplicate key, year, ISO3) are evaluated in one pass:
each row gets an array of flag structs and ``explode`` emits one row per
flag, so a row hit by two rules is counted twice, as in the original. The
duplicate rule needs key multiplicities; they come from a partial/final
aggregate on the key (map-side combine; a hot key costs one row per map
task) joined back null-safely, instead of a window that would pull a hot
key's rows into one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indicast.functions.scalars import is_gpi, pct, range_hi, range_lo, strip_ws
from indicast.schema import INDICATOR_IDS, QA, catalogue_df

KEY = ["INDICATOR_ID", "ISO3", "YEAR"]

FLAG_RANGE = "OUT_OF_RANGE"
FLAG_MISSING = "HIGH_MISSING_RATE"
FLAG_DUP = "DUPLICATE_KEY"
FLAG_YEAR = "IMPLAUSIBLE_YEAR"
FLAG_ISO3 = "MISSING_ISO3"

DETAIL_DUP = "Duplicate (INDICATOR_ID, ISO3, YEAR) triplet"
DETAIL_YEAR = f"YEAR outside [{QA.year_min}, {QA.year_max}]"
DETAIL_ISO3 = "ISO3 is null or empty"


def range_violation() -> Column:
    """C1 predicate: bounds inclusive, NULL value or NULL id never flagged;
    ids outside the parity set (including unknown ids) are rates."""
    v, ind = F.col("VALUE"), F.col("INDICATOR_ID")
    return ind.isNotNull() & v.isNotNull() & ((v < range_lo(ind)) | (v > range_hi(ind)))


def range_detail() -> Column:
    bounds = (F.when(is_gpi("INDICATOR_ID"), F.lit(f"{QA.gpi_min}, {QA.gpi_max}"))
              .otherwise(F.lit(f"{QA.rate_min}, {QA.rate_max}")))
    return F.concat(F.lit("VALUE outside ["), bounds, F.lit("] for "), F.col("INDICATOR_ID"))


def year_violation() -> Column:
    y = F.col("YEAR")
    return y.isNotNull() & ~y.between(QA.year_min, QA.year_max)


def iso3_violation() -> Column:
    return F.col("ISO3").isNull() | (strip_ws("ISO3") == "")


def _with_flag(df: DataFrame, cond: Column, flag: str, detail: Column | str) -> DataFrame:
    d = detail if isinstance(detail, Column) else F.lit(detail)
    return df.where(cond).withColumns({"QA_FLAG": F.lit(flag), "QA_DETAIL": d})


def check_value_range(df: DataFrame) -> DataFrame:
    """OUT_OF_RANGE rows."""
    return _with_flag(df, range_violation(), FLAG_RANGE, range_detail())


def check_year_range(df: DataFrame) -> DataFrame:
    """C4: IMPLAUSIBLE_YEAR rows (NULL year is not flagged)."""
    return _with_flag(df, year_violation(), FLAG_YEAR, DETAIL_YEAR)


def check_missing_iso3(df: DataFrame) -> DataFrame:
    """MISSING_ISO3 rows (NULL or blank)."""
    return _with_flag(df, iso3_violation(), FLAG_ISO3, DETAIL_ISO3)


def key_stats(df: DataFrame, flags: bool = False) -> DataFrame:
    """Rows and non-null values per (INDICATOR_ID, ISO3, YEAR): one partial/final
    aggregate whose size is the number of distinct keys, not the input size.
    With ``flags`` also the number of row flags of the key's rows (``_nf``): the
    rules other than the duplicate rule are counted where the rows are, that
    one follows from the key's row count."""
    aggs = [F.count(F.lit(1)).alias("_n"), F.count("VALUE").alias("_nv")]
    if flags:
        rules = [range_violation(), year_violation(), iso3_violation()]
        aggs.append(sum((F.count_if(r) for r in rules[1:]), F.count_if(rules[0])).alias("_nr"))
    out = df.groupBy(*KEY).agg(*aggs)
    if not flags:
        return out
    return out.withColumn("_nf", F.col("_nr") + F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).drop("_nr")


def _mark_duplicates(df: DataFrame) -> DataFrame:
    """Add ``_DUP`` = key occurs more than once (NULL keys equal each other)."""
    dup = (key_stats(df)
           .where(F.col("_n") > 1)
           .select(*[F.col(k).alias(f"_k_{k}") for k in KEY], F.lit(True).alias("_DUP")))
    cond = reduce(lambda a, b: a & b, [df[k].eqNullSafe(dup[f"_k_{k}"]) for k in KEY])
    return (df.join(dup, cond, "left")
            .drop(*[f"_k_{k}" for k in KEY])
            .withColumn("_DUP", F.coalesce(F.col("_DUP"), F.lit(False))))


def check_duplicates(df: DataFrame) -> DataFrame:
    """Every member of a duplicated key."""
    return _with_flag(_mark_duplicates(df), F.col("_DUP"), FLAG_DUP, DETAIL_DUP).drop("_DUP")


def missing_rate(df: DataFrame, flags: bool = False) -> DataFrame:
    """Per catalogue indicator: N_VALID, expected grid (#distinct ISO3 x
    #distinct YEAR over the whole table, NULLs not counted), unrounded missing %;
    with ``flags`` also the number of its row flags (ROW_FLAGS).

    Computed from ``key_stats`` with one ``rollup``: the per-indicator rows
    give N_VALID, the grand-total row gives the grid. Every catalogue id is
    seeded with a zero row (NULL ISO3/YEAR, ignored by the distinct counts) so
    it gets a row even without data. The grid is spread with a window over at
    most 12 rows (catalogue ids + total)."""
    spark = df.sparkSession
    cat = catalogue_df(spark)
    zero = lambda name: F.lit(0).cast("bigint").alias(name)
    extra = ["_nf"] if flags else []
    seed = cat.select("INDICATOR_ID", F.lit(None).cast("string").alias("ISO3"),
                      F.lit(None).cast("int").alias("YEAR"), *[zero(n) for n in ["_n", "_nv", *extra]])
    ks = key_stats(df, flags).unionByName(seed)
    r = (ks.rollup("INDICATOR_ID")
         .agg(F.sum("_nv").alias("N_VALID"), F.count_distinct("ISO3").alias("_ni"),
              F.count_distinct("YEAR").alias("_ny"), F.grouping_id().alias("_g"),
              *[F.sum(n).alias("ROW_FLAGS") for n in extra])
         .where((F.col("_g") == 1) | F.col("INDICATOR_ID").isin(*INDICATOR_IDS)))
    r = r.withColumn("N_EXPECTED", F.max(F.when(F.col("_g") == 1, F.col("_ni") * F.col("_ny")))
                     .over(Window.partitionBy())).where(F.col("_g") == 0)
    expected = F.col("N_EXPECTED")
    return F.broadcast(cat.select("CAT_POS", "INDICATOR_ID", "INDICATOR_LABEL")).join(
        r, "INDICATOR_ID").select(
        "CAT_POS", "INDICATOR_ID", "INDICATOR_LABEL",
        expected.cast("bigint").alias("N_EXPECTED"), F.col("N_VALID").cast("bigint").alias("N_VALID"),
        F.when(expected > 0, (F.lit(1.0) - F.col("N_VALID") / expected) * 100.0)
        .otherwise(F.lit(0.0)).alias("MISS_PCT_RAW"),
        *(["ROW_FLAGS"] if flags else []),
    )


def check_missing_rate(df: DataFrame) -> DataFrame:
    """One HIGH_MISSING_RATE row per catalogue indicator above threshold."""
    m = missing_rate(df).where(F.col("MISS_PCT_RAW") > QA.max_missing_pct)
    return m.select(
        "INDICATOR_ID",
        F.lit(FLAG_MISSING).alias("QA_FLAG"),
        # Halves go to the even digit, as in Python's formatting.
        F.format_string(f"%.1f%% missing (threshold {QA.max_missing_pct}%%)",
                        F.bround("MISS_PCT_RAW", 1)).alias("QA_DETAIL"),
        F.lit("ALL").alias("ISO3"),
        F.lit(None).cast("int").alias("YEAR"),
        F.lit(None).cast("double").alias("VALUE"),
    )


def row_flags(df: DataFrame) -> DataFrame:
    """C1, C3, C4, C5 in a single pass over ``df``."""
    marked = _mark_duplicates(df)
    flag = lambda cond, name, detail: F.when(
        cond, F.struct(F.lit(name).alias("f"),
                       (detail if isinstance(detail, Column) else F.lit(detail)).alias("d")))
    flags = F.array(
        flag(range_violation(), FLAG_RANGE, range_detail()),
        flag(F.col("_DUP"), FLAG_DUP, DETAIL_DUP),
        flag(year_violation(), FLAG_YEAR, DETAIL_YEAR),
        flag(iso3_violation(), FLAG_ISO3, DETAIL_ISO3),
    )
    out = (marked.select(*df.columns, F.explode(F.filter(flags, lambda x: x.isNotNull())).alias("_f"))
           .select(*df.columns, F.col("_f.f").alias("QA_FLAG"), F.col("_f.d").alias("QA_DETAIL")))
    return out


def run_checks(df: DataFrame) -> DataFrame:
    """All flag rows (row rules + missing-rate rows), union by name."""
    return row_flags(df).unionByName(check_missing_rate(df), allowMissingColumns=True)


def qa_summary(df: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """A3: N_EXPECTED, N_VALID, N_MISSING (floored), MISSING_PCT (round 2),
    N_FLAGGED, QA_STATUS (PASS / WARN_MISSING / FAIL / WARN_MISSING|FAIL)."""
    if flagged is None:
        # Counting needs no flag rows: one scan, one key aggregate, no join back.
        high = (F.col("MISS_PCT_RAW") > QA.max_missing_pct).cast("bigint")
        j = missing_rate(df, flags=True).withColumn("N_FLAGGED", F.col("ROW_FLAGS") + high)
    else:
        n_flag = (flagged.where(F.col("INDICATOR_ID").isNotNull())
                  .groupBy("INDICATOR_ID").agg(F.count(F.lit(1)).alias("N_FLAGGED")))
        j = missing_rate(df).join(n_flag, "INDICATOR_ID", "left")
    n_miss = F.col("N_EXPECTED") - F.col("N_VALID")
    miss_pct = pct(n_miss, F.col("N_EXPECTED"))
    n_flagged = F.coalesce(F.col("N_FLAGGED"), F.lit(0)).cast("bigint")
    warn = miss_pct > QA.max_missing_pct
    status = (F.when(warn & (n_flagged > 0), F.lit("WARN_MISSING|FAIL"))
              .when(warn, F.lit("WARN_MISSING"))
              .when(n_flagged > 0, F.lit("FAIL"))
              .otherwise(F.lit("PASS")))
    return j.select(
        "INDICATOR_ID", "INDICATOR_LABEL", "N_EXPECTED", "N_VALID",
        F.greatest(n_miss, F.lit(0)).cast("bigint").alias("N_MISSING"),
        miss_pct.alias("MISSING_PCT"), n_flagged.alias("N_FLAGGED"), status.alias("QA_STATUS"),
    )


def pass_tally(summary: DataFrame, flagged: DataFrame) -> DataFrame:
    """A4: indicators passing, indicators total, flagged rows total."""
    n_flagged_rows = flagged.select(F.count(F.lit(1))).scalar()
    return summary.agg(
        F.count(F.when(F.col("QA_STATUS") == "PASS", 1)).alias("N_PASS"),
        F.count(F.lit(1)).alias("N_INDICATORS"),
    ).withColumn("N_FLAGGED_ROWS", n_flagged_rows)
