"""Imputation of the wide table: missing audit (A5), k-NN (I1/I1b),
chained equations (I2), dispatch + clip/round (I3/I4) and the report (A6).

k-NN layout (exact). Distances follow the NaN-aware Euclidean rule:
d(r, s) = sqrt(p / n_common * sum over commonly present features (r - s)^2);
pairs without a common feature have no distance. For every missing cell of a
receiver the donors are the rows where that feature is present; the cell gets
the mean of the k nearest donors (ties broken by distance rounded to 1e-9,
then donor ISO3, YEAR) or, when no donor has a distance, the column mean.

The exact form streams donors past slices of receivers (``neighbors.nearest_streamed``).
The blocked form has one path at every size: receivers (rows with a NULL) are hashed into
slices of about ``RECEIVERS_PER_TASK`` rows and donors (rows with a value) into
chunks of about ``DONORS_PER_TASK``, both sized from a count per block;
``cogroup`` on (block, slice, chunk) hands each task one slice and one chunk, so
its memory does not depend on the size of the table or of a block. numpy
computes the distances and the task emits the top k of its chunk for each
missing cell, never the pairs; a window merges the chunks' lists. Exact k-NN
compares every receiver with every donor; ``knn_impute_blocked`` restricts
donors to the receiver's block, which makes the work linear in the number of
blocks, and a block that is too large for a task is cut like the whole table.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, StringType, StructField, StructType,
)
from pyspark.sql.window import Window

from indicast.functions.scalars import clip, pct, qcol
from indicast.schema import (
    GPI_IDS, IMPUTE, INDICATOR_IDS, QA, catalogue_df,
)

KEYS = ["ISO3", "YEAR"]
RECEIVERS_PER_TASK = 1_000
DONORS_PER_TASK = 50_000
DIST_DIGITS = 9
_BLOCK = 256  # receivers per numpy block, at most
_PAIRS = 1 << 20  # pairs in memory at a time


# ---------------------------------------------------------------- audit (A5)

def audit_missing(wide: DataFrame, label: str = "before",
                  cols: list[str] | None = None) -> DataFrame:
    """A5: per indicator column: N_TOTAL, N_MISSING, PCT_MISSING (round 2).

    One aggregate over the table (count(*) and count(col) per column), then
    unpivoted to one row per column.
    """
    cols = [c for c in (cols or INDICATOR_IDS) if c in wide.columns]
    agg = wide.agg(F.count(F.lit(1)).alias("_n"),
                   *[F.count(qcol(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    stacked = F.explode(F.array(*[
        F.struct(F.lit(c).alias("INDICATOR_ID"), F.lit(i).alias("POS"),
                 (F.col("_n") - F.col(f"_c{i}")).alias("N_MISSING"))
        for i, c in enumerate(cols)]))
    out = agg.select(F.col("_n").alias("N_TOTAL"), stacked.alias("s"))
    return out.select(
        F.col("s.INDICATOR_ID").alias("INDICATOR_ID"), F.col("s.POS").alias("POS"),
        F.lit(label).alias("LABEL"), F.col("N_TOTAL").cast("bigint").alias("N_TOTAL"),
        F.col("s.N_MISSING").cast("bigint").alias("N_MISSING"),
        pct(F.col("s.N_MISSING"), F.col("N_TOTAL")).alias("PCT_MISSING"),
    )


# ---------------------------------------------------------------- k-NN

def _any(cols: list[str], pred) -> Column:
    return reduce(lambda a, b: a | b, [pred(qcol(c)) for c in cols])


def _column_means(wide: DataFrame, cols: list[str]) -> list[Column]:
    """Global mean of every column: one scalar sub-query returning a struct."""
    means = wide.select(F.struct(*[F.avg(qcol(c)).alias(f"m{i}") for i, c in enumerate(cols)])).scalar()
    return [means.getField(f"m{i}") for i in range(len(cols))]


def _safe_names(wide: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """Rename indicator columns to dot-free names for the Python step
    (grouped-map functions resolve input columns by plain name)."""
    safe = [f"_x{i}" for i in range(len(cols))]
    mapping = dict(zip(cols, safe))
    out = wide.select(*[qcol(c).alias(mapping.get(c, c)) for c in wide.columns])
    return out, safe


def _restore(df: DataFrame, orig: DataFrame, cols: list[str]) -> DataFrame:
    """Undo ``_safe_names`` and restore the original column order."""
    mapping = {c: f"_x{i}" for i, c in enumerate(cols)}
    return df.select(*[qcol(mapping.get(c, c)).alias(c) for c in orig.columns])


def _order_donors(d: pd.DataFrame) -> pd.DataFrame:
    return d.sort_values(["ISO3", "YEAR"], kind="mergesort").reset_index(drop=True)


def _sq_dist(R: np.ndarray, D: np.ndarray) -> np.ndarray:
    """Mean squared difference over common features; NaN when none in common.

    Computed with three matrix products (the NaN-aware expansion
    sum m_r m_d (r - d)^2 = (m_r r^2) m_d^T - 2 (m_r r)(m_d d)^T + m_r (m_d d^2)^T),
    so a block needs O(rows x donors) memory, not O(rows x donors x features).
    Ordering by this value equals ordering by the NaN-aware Euclidean distance
    (the constant p and the square root are monotone)."""
    rm, dm = (~np.isnan(R)).astype(float), (~np.isnan(D)).astype(float)
    Rz, Dz = np.where(rm > 0, R, 0.0), np.where(dm > 0, D, 0.0)
    ss = (Rz * Rz) @ dm.T - 2.0 * (Rz @ Dz.T) + rm @ (Dz * Dz).T
    nc = rm @ dm.T
    with np.errstate(invalid="ignore", divide="ignore"):
        dd = np.where(nc > 0, np.maximum(ss, 0.0) / np.maximum(nc, 1.0), np.nan)
    return np.round(dd, DIST_DIGITS)


def _nearest(dist: np.ndarray, k: int) -> np.ndarray:
    """Mask of the k smallest finite entries of each row, the leftmost of ties:
    a partition finds the k-th value, only entries equal to it need an order."""
    if dist.shape[1] > k:
        kth = np.partition(dist, k - 1, axis=1)[:, k - 1:k]
        below, tied = dist < kth, dist == kth
        need = k - below.sum(axis=1, keepdims=True)
        return (below | (tied & (np.cumsum(tied, axis=1) <= need))) & np.isfinite(dist)
    return np.isfinite(dist)


def _knn_partial(cols: list[str], k: int):
    """cogroup function: the k nearest donors of one chunk for each missing cell
    of one slice. Donors are sorted by (ISO3, YEAR), so ties resolve by donor key."""
    def fn(key, recv, donors):
        parts = []
        if not recv.empty and not donors.empty:
            donors = _order_donors(donors)
            D = donors[cols].to_numpy(dtype=float)
            R = recv[cols].to_numpy(dtype=float)
            present = ~np.isnan(D)
            d_iso, d_year = donors["ISO3"].to_numpy(), donors["YEAR"].to_numpy().astype("int32")
            r_iso, r_year = recv["ISO3"].to_numpy(), recv["YEAR"].to_numpy().astype("int32")
            size = max(1, min(_BLOCK, _PAIRS // len(D)))
            for start in range(0, len(R), size):
                block = R[start:start + size]
                dist = _sq_dist(block, D)
                dist[np.isnan(dist)] = np.inf
                for j in range(R.shape[1]):
                    rows, cand = np.flatnonzero(np.isnan(block[:, j])), np.flatnonzero(present[:, j])
                    if not rows.size or not cand.size:
                        continue
                    sub = dist[np.ix_(rows, cand)]
                    r, c = np.nonzero(_nearest(sub, k))
                    at, d = start + rows[r], cand[c]
                    parts.append(pd.DataFrame({
                        "ISO3": r_iso[at], "YEAR": r_year[at], "J": np.full(len(r), j, dtype="int32"), "DD": sub[r, c],
                        "D_ISO3": d_iso[d], "D_YEAR": d_year[d], "V": D[d, j]}))
        if parts:
            return pd.concat(parts, ignore_index=True)
        return pd.DataFrame({c: pd.Series(dtype=t) for c, t in [
            ("ISO3", "object"), ("YEAR", "int32"), ("J", "int32"), ("DD", "float64"),
            ("D_ISO3", "object"), ("D_YEAR", "int32"), ("V", "float64")]})
    return fn


_PARTIAL_SCHEMA = StructType([
    StructField("ISO3", StringType()), StructField("YEAR", IntegerType()),
    StructField("J", IntegerType()), StructField("DD", DoubleType()),
    StructField("D_ISO3", StringType()), StructField("D_YEAR", IntegerType()),
    StructField("V", DoubleType()),
])


def _top_k(part: DataFrame, k: int) -> DataFrame:
    """The k nearest donors of every missing cell. A group limit keeps k rows
    a cell of every map task before the shuffle."""
    w = Window.partitionBy("ISO3", "YEAR", "J").orderBy("DD", "D_ISO3", "D_YEAR")
    return part.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k)


def _filled(orig: DataFrame, wide: DataFrame, cols0: list[str], top: DataFrame, means: list[Column]) -> DataFrame:
    """``orig`` with missing cells filled by the mean of their neighbours in
    ``top``, or the column's mean; ``wide`` and the cells' numbers are those of ``_safe_names``."""
    cols = [f"_x{i}" for i in range(len(cols0))]
    keep = [c for c in wide.columns if c not in cols]
    any_null = _any(cols, lambda c: c.isNull())
    found = top.groupBy("ISO3", "YEAR").pivot("J", list(range(len(cols)))).agg(F.avg("V"))
    filled = wide.where(any_null).join(found, KEYS, "left").select(
        *keep, *[F.coalesce(qcol(c), F.col(f"`{i}`"), means[i]).alias(c) for i, c in enumerate(cols)])
    return _restore(wide.where(~any_null).unionByName(filled), orig, cols0)


def nearest_donors(wide: DataFrame, k: int, cols0: list[str], block: list[str] = (),
                   receivers_per_task: int = RECEIVERS_PER_TASK, donors_per_task: int = DONORS_PER_TASK) -> DataFrame:
    """``ISO3, YEAR, J, DD, D_ISO3, D_YEAR, V``: for every missing cell (J is the
    column's place in ``cols0``) its k nearest donors, their distances and values."""
    wide, cols = _safe_names(wide, cols0)
    any_null = _any(cols, lambda c: c.isNull())
    any_val = _any(cols, lambda c: c.isNotNull())
    blocks = [f"_b{i}" for i in range(len(block))]
    base = wide.select("*", *[F.col(c).alias(b) for b, c in zip(blocks, block)])
    # Slices and chunks of a block from its counts: one row per block, joined by key.
    pieces = lambda n, size: F.greatest(F.lit(1), F.ceil(n / size)).cast("bigint")
    sizes = base.groupBy(*blocks).agg(
        pieces(F.count_if(any_null), receivers_per_task).alias("_slices"),
        pieces(F.count_if(any_val), donors_per_task).alias("_chunks"))
    if not blocks:
        n = sizes.first()
        sized = base.withColumns({"_slices": F.lit(n["_slices"]), "_chunks": F.lit(n["_chunks"])})
    else:
        sized = base.join(sizes, blocks)  # a null block has no donors and falls back to the means
    every = lambda c: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(c) - 1))
    recv = (sized.where(any_null).withColumn("_slice", F.pmod(F.xxhash64("ISO3", "YEAR"), F.col("_slices")))
            .withColumn("_chunk", every("_chunks")).select(*blocks, "_slice", "_chunk", *KEYS, *cols))
    # Fresh aliases: both cogroup sides derive from one plan and must not share attributes.
    dons = (sized.where(any_val).select(*[F.col(c).alias(c) for c in [*blocks, "_slices", "_chunks", *KEYS, *cols]])
            .withColumn("_chunk", F.pmod(F.xxhash64("ISO3", "YEAR", F.lit(7)), F.col("_chunks")))
            .withColumn("_slice", every("_slices")))
    return _top_k(_compared(recv, dons, [*blocks, "_slice", "_chunk"], cols, k), k)


def _compared(recv: DataFrame, dons: DataFrame, group: list[str], cols: list[str], k: int) -> DataFrame:
    """The k nearest donors of each group's donors for every missing cell of the group's receivers."""
    return recv.groupBy(*group).cogroup(dons.groupBy(*group)).applyInPandas(_knn_partial(cols, k), _PARTIAL_SCHEMA)


def _fill(wide: DataFrame, k: int, cols: list[str] | None, block: list[str],
          receivers_per_task: int, donors_per_task: int) -> DataFrame:
    cols0 = [c for c in (cols or INDICATOR_IDS) if c in wide.columns]
    top = nearest_donors(wide, k, cols0, block, receivers_per_task, donors_per_task)
    safe, names = _safe_names(wide, cols0)
    return _filled(wide, safe, cols0, top, _column_means(safe, names))


def knn_impute(wide: DataFrame, k: int = IMPUTE.knn_neighbors, cols: list[str] | None = None,
               receivers_per_task: int | None = None, donors_per_task: int | None = None) -> DataFrame:
    """Exact k-NN imputation of the indicator columns; keys and other
    columns pass through. Complete rows never enter the Python side.

    Donors stream past slices of receivers, and no candidates are shuffled (see
    ``indicast.operators.neighbors``). With a size given, slices and chunks of
    that size meet in pairs instead, as in the blocked form."""
    if receivers_per_task is None and donors_per_task is None:
        from indicast.operators.neighbors import knn_impute_streamed
        return knn_impute_streamed(wide, k, cols)
    return _fill(wide, k, cols, [], receivers_per_task or RECEIVERS_PER_TASK, donors_per_task or DONORS_PER_TASK)


def knn_impute_blocked(wide: DataFrame, block: str | list[str] = "REGION", k: int = IMPUTE.knn_neighbors,
                       cols: list[str] | None = None, receivers_per_task: int = RECEIVERS_PER_TASK,
                       donors_per_task: int = DONORS_PER_TASK) -> DataFrame:
    """I1b (approximate): donors are restricted to rows that share the ``block``
    columns (one or several, e.g. region and year), so the work grows with the
    sum of the squared block sizes. The column-mean fallback stays global."""
    blocks = [block] if isinstance(block, str) else list(block)
    return _fill(wide, k, cols, blocks, receivers_per_task, donors_per_task)


# ---------------------------------------------------------------- I3 / I4

def clip_round(wide: DataFrame, cols: list[str] | None = None, digits: int = 4) -> DataFrame:
    """I4: clip every indicator cell to its valid range and round (all cells,
    observed ones included); NULL stays NULL."""
    cols = [c for c in (cols or INDICATOR_IDS) if c in wide.columns]
    exprs = {}
    for c in cols:
        lo, hi = (QA.gpi_min, QA.gpi_max) if c in GPI_IDS else (QA.rate_min, QA.rate_max)
        exprs[c] = F.round(clip(qcol(c), lo, hi), digits)
    return wide.withColumns(exprs)


def impute_wide(wide: DataFrame, method: str = IMPUTE.method, **kw) -> DataFrame:
    """I3 + I4: dispatch on ``method`` (unknown -> k-NN), then clip and round."""
    if method == "iterative":
        from indicast.operators.iterative import iterative_impute
        filled = iterative_impute(wide, **kw)
    else:
        filled = knn_impute(wide, **kw)
    return clip_round(filled)


# ---------------------------------------------------------------- report

def imputation_report(before: DataFrame, after: DataFrame, method: str = IMPUTE.method) -> DataFrame:
    """Missing cells before and after, by indicator; N_IMPUTED floored at 0.

    One aggregate over the null marks of both tables, for the indicators both have."""
    cols = [c for c in INDICATOR_IDS if c in before.columns and c in after.columns]

    def marks(wide: DataFrame, side: int) -> DataFrame:
        return wide.select(F.lit(side).alias("_side"), *[qcol(c).isNull().alias(f"_m{i}") for i, c in enumerate(cols)])

    def total(side: int, mark: Column = F.lit(True)) -> Column:
        return F.count_if((F.col("_side") == side) & mark)

    agg = marks(before, 0).unionAll(marks(after, 1)).agg(
        total(0).alias("_n0"), total(1).alias("_n1"),
        *[total(side, F.col(f"_m{i}")).alias(f"_c{i}_{side}") for i in range(len(cols)) for side in (0, 1)])
    rows = agg.select("_n0", "_n1", F.inline(F.array(*[
        F.struct(F.lit(c).alias("INDICATOR_ID"), F.col(f"_c{i}_0").alias("_b"), F.col(f"_c{i}_1").alias("_a"))
        for i, c in enumerate(cols)])))
    cat = catalogue_df(before.sparkSession).select("INDICATOR_ID", "INDICATOR_LABEL")
    return (rows.join(cat, "INDICATOR_ID", "left")
            .select(
                "INDICATOR_ID",
                F.coalesce("INDICATOR_LABEL", F.lit("")).alias("INDICATOR_LABEL"),
                F.col("_n0").alias("N_TOTAL"),
                F.col("_b").alias("N_MISSING_BEFORE"),
                pct(F.col("_b"), F.col("_n0")).alias("PCT_MISSING_BEFORE"),
                F.col("_a").alias("N_MISSING_AFTER"),
                pct(F.col("_a"), F.col("_n1")).alias("PCT_MISSING_AFTER"),
                F.greatest(F.col("_b") - F.col("_a"), F.lit(0)).cast("bigint").alias("N_IMPUTED"),
                F.lit(method.upper()).alias("METHOD")))


def total_imputed(report: DataFrame) -> DataFrame:
    """Grand total of imputed cells."""
    return report.agg(F.coalesce(F.sum("N_IMPUTED"), F.lit(0)).cast("bigint").alias("TOTAL_IMPUTED"))


__all__ = ["audit_missing", "nearest_donors", "knn_impute", "knn_impute_blocked", "clip_round",
           "impute_wide", "imputation_report", "total_imputed"]
