"""Exact quantiles per group from mergeable sketches.

1. A KLL sketch per group and map task, merged behind a shuffle of a few
   kilobytes a group, gives two values between which the order statistics lie
   (the sketch's rank error on either side).
2. One pass counts the values below the bracket and keeps the distinct values
   within it, with their counts: about ``2 * ERROR`` of the rows, reduced in each task.
3. A running count over the bracket's values gives the order statistics exactly.
   Groups whose bracket does not hold them (a sketch may be off by more, with small probability) go through
   step 2 again with a wider one, and in the end with all their values; nothing is lost to the sketch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from indicast.session import materialize

#: Size of a sketch and the rank error assumed of it (its 99 % bound is below half of that).
SKETCH_K, ERROR = 2048, 0.004


def _refined(rows: DataFrame, brackets: DataFrame, group: str, q: float) -> DataFrame:
    """``group, _n, _t, _whole``: the quantile of each bracketed group, and whether the bracket held it."""
    within = rows.join(brackets, group)  # one row a group on this side
    low, high, v = F.col("_low"), F.col("_high"), F.col("_v")
    kept = F.when(v.between(low, high), v)
    # Values below the bracket count under NULL, those above are not counted.
    counted = within.where(v <= high).groupBy(group, "_n", kept.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy(group).orderBy(F.col("_v").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.withColumn("_hi", F.sum("_c").over(upto)).where(F.col("_v").isNotNull())
    pos = F.lit(q) * (F.col("_n") - 1)
    k0 = F.floor(pos)
    k1 = F.least(k0 + 1, F.col("_n") - 1)
    holds = lambda k: (F.col("_hi") - F.col("_c") <= k) & (k < F.col("_hi"))
    found = placed.groupBy(group, "_n").agg(F.max(F.when(holds(k0), F.col("_v"))).alias("_v0"),
                                            F.max(F.when(holds(k1), F.col("_v"))).alias("_v1"))
    value = F.col("_v0") + (pos - k0) * (F.col("_v1") - F.col("_v0"))
    return brackets.select(group, "_n").join(found.select(group, value.alias("_t")), group, "left").withColumn(
        "_whole", F.col("_t").isNotNull())


def grouped_quantile(rows: DataFrame, q: float, col: str, group: str = "INDICATOR_ID", name: str = "THRESHOLD",
                     k: int = SKETCH_K, error: float = ERROR) -> DataFrame:
    """``group, name``: the quantile ``q`` of ``col`` in each group, interpolated between
    order statistics; NULLs do not count, a group without values has no row."""
    values = rows.where(F.col(col).isNotNull()).select(group, F.col(col).cast("double").alias("_v"))
    sketches = materialize(values.groupBy(group).agg(
        F.kll_sketch_agg_double("_v", F.lit(k)).alias("_s"), F.count("*").alias("_n"), F.min("_v").alias("_min"),
        F.max("_v").alias("_max")))

    def brackets(width: float) -> DataFrame:
        at = lambda rank: F.kll_sketch_get_quantile_double("_s", F.lit(rank))
        few = F.col("_n") * width < 4  # the order statistics lie further apart than the bracket is wide
        low = F.when(few, F.col("_min")).otherwise(at(q - width)) if q > width else F.col("_min")
        high = F.when(few, F.col("_max")).otherwise(at(q + width)) if q + width < 1 else F.col("_max")
        return sketches.select(group, "_n", low.alias("_low"), high.alias("_high"))

    width = error
    found = materialize(_refined(values, brackets(width), group, q))
    while found.where(~F.col("_whole")).head(1):
        width *= 8
        again = brackets(width).join(found.where(~F.col("_whole")).select(group), group, "left_semi")
        found = materialize(found.where("_whole").unionByName(_refined(values, again, group, q)))
    return found.select(group, F.col("_t").alias(name))


__all__ = ["grouped_quantile"]
