"""Order with index reset (O1, O2): the place of every row in the whole table's
order, without a task that sees all rows.

Rows are range-partitioned by the order columns and sorted within partitions.
Each row's partition and its number there are written with it (so that nothing
after depends on ranges being drawn twice the same), one count per partition gives the
rows before it, and these offsets, one row per partition, are broadcast. Rows with equal order
columns are spread over partitions by a hash of the whole row and, if they are
equal, by where they were read, so that a hot key does not fill one partition.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicast.session import materialize

#: ``monotonically_increasing_id`` holds the partition above this bit, the row's number below.
_ROW_BITS = 33


def with_ordinals(df: DataFrame, order: list[str], name: str = "PLACE", start: int = 0) -> DataFrame:
    """``df`` in the order of ``order`` (ascending, NULLs last), with each row's
    place, counted from ``start``, in column ``name``. Rows whose order columns
    are equal get places next to each other, in no particular order."""
    spark = df.sparkSession
    keys = [F.col(f"`{c}`").asc_nulls_last() for c in order]
    spread = df.withColumns({"_h": F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), "_at": F.monotonically_increasing_id()})
    by = [*keys, F.col("_h"), F.col("_at")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = spread.repartitionByRange(parts, *by).sortWithinPartitions(*by).drop("_h", "_at")
    numbered = materialize(ranged.withColumn("_id", F.monotonically_increasing_id())
                           .withColumns({"_part": F.shiftright("_id", _ROW_BITS).cast("int"),
                                         "_row": F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1)}).drop("_id"))
    # One row per partition.
    counts = sorted((r["_part"], r["n"]) for r in numbered.groupBy("_part").agg(F.count("*").alias("n")).collect())
    before = list(accumulate((n for _, n in counts), initial=start))
    offsets = spark.createDataFrame([(p, b) for (p, _), b in zip(counts, before)], "_part int, _before bigint")
    placed = numbered.join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_row"))
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], name)


__all__ = ["with_ordinals"]
