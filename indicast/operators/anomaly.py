"""Per-indicator outlier scoring with an isolation forest.

Plan:
1. N1/N2/W4: per-indicator min/max and row counts come from one aggregate
   (at most one row per catalogue indicator, so it is broadcast back); the
   feature vector is [VALUE_NORM, YEAR_NORM, one-hot REGION].
2. N3: every (indicator, tree) draws up to ``max_samples`` rows without
   replacement: the rows with the smallest seeded hash. A row is paired with a
   tree only if its hash lies below a bound that lets ``SAMPLE_MARGIN`` times the
   sample through on average, so a row meets few trees however large the table;
   ``row_number <= 256`` then takes the sample (with a partial group limit before
   the shuffle). Sample sizes are checked and drawn without the bound if one
   falls short. Each tree is grown in ``applyInPandas`` on its <= 256 rows.
3. The forest (<= indicators x trees x (2 * 256 - 1) nodes, independent of
   data size) is collected once and broadcast as a model.
4. N4: ``mapInPandas`` scores every eligible row against all trees.
5. N5: the contamination cut-off is the exact linear-interpolated quantile of
   the unrounded scores. A histogram of 6-decimal scores (<= 10^6 values per
   indicator) finds the one or two bins that hold the order statistics; only
   their scores are then ordered exactly. Rows scoring strictly below the
   cut-off are anomalies; the stored score is rounded to 6 decimals.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType, IntegerType, StringType, StructField, StructType,
)
from pyspark.sql.window import Window

from indicast.schema import ANOMALY, COUNTRIES, INDICATOR_IDS, catalogue_df
from indicast.session import materialize

REGIONS = sorted({r for _, r, _ in COUNTRIES})
SCORE_DIGITS = 6
SAMPLE_MARGIN = 3.0
_EULER = 0.5772156649015329


# ---------------------------------------------------------------- N1 / N2

def feature_stats(long: DataFrame, min_samples: int = ANOMALY.min_samples) -> DataFrame:
    """Per catalogue indicator: N, VALUE and YEAR ranges over rows with both
    present; only indicators with at least ``min_samples`` rows."""
    valid = long.where(F.col("VALUE").isNotNull() & F.col("YEAR").isNotNull()
                       & F.col("INDICATOR_ID").isin(*INDICATOR_IDS))
    return (valid.groupBy("INDICATOR_ID").agg(
        F.count(F.lit(1)).alias("N"),
        F.min("VALUE").alias("V_MIN"), F.max("VALUE").alias("V_MAX"),
        F.min("YEAR").alias("Y_MIN"), F.max("YEAR").alias("Y_MAX"))
        .where(F.col("N") >= min_samples))


def _norm(c: str, lo: str, hi: str):
    rng = F.col(hi) - F.col(lo)
    return F.when(rng > 0, (F.col(c) - F.col(lo)) / rng).otherwise(F.lit(0.0))


def build_features(long: DataFrame, min_samples: int = ANOMALY.min_samples) -> DataFrame:
    """Eligible rows with VALUE_NORM, YEAR_NORM, one-hot REGION (see
    :func:`feature_columns`) and N_ROWS, the indicator's number of eligible rows.
    Regions use the dimension's sorted region list (a region absent from an
    indicator is a constant zero column, which the tree builder never splits on)."""
    stats = F.broadcast(feature_stats(long, min_samples))  # <= 11 rows
    valid = long.where(F.col("VALUE").isNotNull() & F.col("YEAR").isNotNull())
    j = valid.join(stats, "INDICATOR_ID", "inner")
    numeric = [_norm("VALUE", "V_MIN", "V_MAX").alias("VALUE_NORM"),
               _norm("YEAR", "Y_MIN", "Y_MAX").alias("YEAR_NORM")]
    has_region = "REGION" in long.columns
    onehot = ([(F.col("REGION") == r).cast("double").alias(f"REGION_{i}") for i, r in enumerate(REGIONS)]
              if has_region else [])
    return j.select(*long.columns, *numeric, *onehot, F.col("N").alias("N_ROWS"))


def feature_columns(features: DataFrame) -> list[str]:
    return ["VALUE_NORM", "YEAR_NORM"] + [c for c in (f"REGION_{i}" for i in range(len(REGIONS))) if c in features.columns]


def _matrix(pdf: pd.DataFrame, names: list[str]) -> np.ndarray:
    return np.nan_to_num(pdf[names].to_numpy(dtype=float))  # an unknown region is in no one-hot column


# ---------------------------------------------------------------- N3

def _c(n: float) -> float:
    """Average path length of an unsuccessful search in a binary tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + _EULER) - 2.0 * (n - 1.0) / n


_TREE_SCHEMA = StructType([
    StructField("INDICATOR_ID", StringType()), StructField("TREE", IntegerType()),
    StructField("NODE", IntegerType()), StructField("FEAT", IntegerType()),
    StructField("THRESH", DoubleType()), StructField("LEFT", IntegerType()),
    StructField("RIGHT", IntegerType()), StructField("SIZE", IntegerType()),
    StructField("DEPTH", IntegerType()), StructField("PSI", IntegerType()),
])


TREES_PER_TASK = 10


def _grow_trees(seed: int, names: list[str]):
    """Grow every tree of one (indicator, tree block) group; each tree's rows
    are its own <= max_samples sample, so a group holds at most
    TREES_PER_TASK x max_samples rows."""
    one = _grow_tree(seed, names)

    def fn(key, pdf):
        parts = [one((key[0], t), g) for t, g in pdf.groupby("TREE", sort=True)]
        return pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(
            columns=[f.name for f in _TREE_SCHEMA.fields])
    return fn


def _grow_tree(seed: int, names: list[str]):
    def fn(key, pdf):
        ind, tree = key[0], int(key[1])
        pdf = pdf.sort_values(["_h", "_row"], kind="mergesort")
        X = _matrix(pdf, names)
        psi = len(pdf)  # min(n, max_samples): the sample is the whole group
        max_depth = int(math.ceil(math.log2(max(psi, 2))))
        rng = np.random.default_rng([seed, zlib.crc32(ind.encode()), tree])
        nodes = []  # (feat, thresh, left, right, size, depth)

        def grow(rows: np.ndarray, depth: int) -> int:
            nid = len(nodes)
            nodes.append(None)
            sub = X[rows]
            if depth >= max_depth or len(rows) <= 1:
                nodes[nid] = (-1, 0.0, -1, -1, len(rows), depth)
                return nid
            lo, hi = sub.min(axis=0), sub.max(axis=0)
            cand = np.flatnonzero(hi > lo)
            if cand.size == 0:
                nodes[nid] = (-1, 0.0, -1, -1, len(rows), depth)
                return nid
            f = int(cand[rng.integers(cand.size)])
            t = float(rng.uniform(lo[f], hi[f]))
            go_left = sub[:, f] < t
            left = grow(rows[go_left], depth + 1)
            right = grow(rows[~go_left], depth + 1)
            nodes[nid] = (f, t, left, right, len(rows), depth)
            return nid

        grow(np.arange(len(X)), 0)
        return pd.DataFrame([(ind, tree, i, *n, psi) for i, n in enumerate(nodes)],
                            columns=[f.name for f in _TREE_SCHEMA.fields])
    return fn


def fit_forest(features: DataFrame, n_trees: int = ANOMALY.n_trees,
               max_samples: int = ANOMALY.max_samples, seed: int = ANOMALY.seed,
               margin: float | None = SAMPLE_MARGIN) -> DataFrame:
    """Grow ``n_trees`` isolation trees per indicator; returns node rows.
    ``margin=None`` draws the samples without the bound on the hash."""
    names = feature_columns(features)
    row = F.xxhash64(F.lit(seed), "INDICATOR_ID", "ISO3", "YEAR", "VALUE")
    # Share of the rows that may meet a tree, as a bound on a 40-bit hash.
    share = F.least(F.lit(1.0), F.lit((margin or 0.0) * max_samples) / F.col("N_ROWS")) if margin else F.lit(1.0)
    trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    near = F.filter(trees, lambda t: F.xxhash64("_row", t).bitwiseAND(F.lit((1 << 40) - 1)) < F.col("_bound"))
    w = Window.partitionBy("INDICATOR_ID", "TREE").orderBy("_h", "_row")
    sample = (features.withColumns({"_row": row, "_bound": (share * float(1 << 40)).cast("bigint")})
              .select("INDICATOR_ID", "_row", *names, F.explode(near).alias("TREE"))
              .withColumn("_h", F.xxhash64("_row", "TREE").bitwiseAND(F.lit((1 << 40) - 1)))
              .withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") <= max_samples)
              .select("INDICATOR_ID", "TREE", (F.col("TREE") / TREES_PER_TASK).cast("int").alias("_blk"), "_h", "_row", *names))
    return sample.groupBy("INDICATOR_ID", "_blk").applyInPandas(_grow_trees(seed, names), _TREE_SCHEMA)


def fit_model(features: DataFrame, n_trees: int = ANOMALY.n_trees, max_samples: int = ANOMALY.max_samples,
              seed: int = ANOMALY.seed) -> dict:
    """The collected forest. If some tree is missing or its sample fell short of
    min(rows, ``max_samples``), all samples are drawn again without the bound."""
    needed = {r["INDICATOR_ID"]: min(r["N_ROWS"], max_samples)
              for r in features.select("INDICATOR_ID", "N_ROWS").distinct().collect()}  # <= 11 rows
    model = collect_model(fit_forest(features, n_trees, max_samples, seed))
    short = [i for i, n in needed.items() if i not in model or len(model[i][0]) < n_trees or min(model[i][1]) < n]
    if short:
        model = collect_model(fit_forest(features, n_trees, max_samples, seed, margin=None))
    return model


def collect_model(trees: DataFrame) -> dict:
    """Bounded model (<= indicators x trees x 511 nodes) as numpy arrays."""
    pdf = trees.toPandas()
    model = {}
    for ind, g in pdf.groupby("INDICATOR_ID"):
        per_tree = []
        for _, t in g.sort_values(["TREE", "NODE"]).groupby("TREE"):
            leaf_len = t["DEPTH"].to_numpy(float) + np.array([_c(s) for s in t["SIZE"]])
            per_tree.append((t["FEAT"].to_numpy(), t["THRESH"].to_numpy(),
                             t["LEFT"].to_numpy(), t["RIGHT"].to_numpy(), leaf_len))
        model[ind] = (per_tree, g[g["NODE"] == 0].sort_values("TREE")["PSI"].astype(int).tolist())
    return model


# ---------------------------------------------------------------- N4

def _path_lengths(X: np.ndarray, tree) -> np.ndarray:
    feat, thr, left, right, leaf_len = tree
    node = np.zeros(len(X), dtype=int)
    while True:
        f = feat[node]
        inner = f >= 0
        if not inner.any():
            return leaf_len[node]
        idx = np.flatnonzero(inner)
        go_left = X[idx, f[idx]] < thr[node[idx]]
        node[idx] = np.where(go_left, left[node[idx]], right[node[idx]])


RAW_SCORE = "_RAW_SCORE"


def score_rows(features: DataFrame, model) -> DataFrame:
    """The score -2^(-E[h(x)] / c(psi)), unrounded in ``_RAW_SCORE`` and
    rounded to 6 decimals in ANOMALY_SCORE.

    ``model`` is the forest dict or a broadcast of it (the caller then owns
    the broadcast and may release it once the scores are materialised)."""
    spark = features.sparkSession
    bmodel = model if hasattr(model, "value") else spark.sparkContext.broadcast(model)
    names = feature_columns(features)
    cols = [c for c in features.columns if c not in (*names, "N_ROWS")]
    out_schema = StructType([features.schema[c] for c in cols] + [StructField(RAW_SCORE, DoubleType())])

    def fn(batches):
        m = bmodel.value
        for pdf in batches:
            if pdf.empty:
                continue
            scores = np.full(len(pdf), np.nan)
            X = _matrix(pdf, names)
            for ind, idx in pdf.groupby("INDICATOR_ID").indices.items():
                trees, psi = m[ind]
                depth = np.zeros(len(idx))
                for tree in trees:
                    depth += _path_lengths(X[idx], tree)
                denom = sum(map(_c, psi))
                e = depth / denom if denom else np.ones_like(depth)
                scores[idx] = -(2.0 ** (-e))
            out = pdf[cols].copy()
            out[RAW_SCORE] = scores
            yield out

    scored = features.select(*cols, *names).mapInPandas(fn, out_schema)
    return scored.withColumn("ANOMALY_SCORE", F.round(RAW_SCORE, SCORE_DIGITS))


# ---------------------------------------------------------------- N5

def quantile_thresholds(scored: DataFrame, q: float = ANOMALY.contamination, col: str = "ANOMALY_SCORE") -> DataFrame:
    """Exact quantile (linear interpolation) of ``col`` per indicator.

    A histogram of ``col`` to 6 decimals gives running counts per indicator
    (bounded by the number of bins) and the bins of the two order statistics
    around position q * (n - 1); the distinct values of those bins are then
    counted and ordered exactly. No group collects its rows."""
    binned = scored.select("INDICATOR_ID", F.col(col).alias("_v"), F.round(col, SCORE_DIGITS).alias("_bin"))
    hist = binned.groupBy("INDICATOR_ID", "_bin").agg(F.count(F.lit(1)).alias("_c"))
    n = hist.groupBy("INDICATOR_ID").agg(F.sum("_c").alias("_n"))
    pos = F.lit(q) * (F.col("_n") - 1)
    k0 = F.floor(pos)
    k1 = F.least(k0 + 1, F.col("_n") - 1)
    within = lambda k: (F.col("_hi") - F.col("_c") <= k) & (k < F.col("_hi"))
    upto = lambda *by: Window.partitionBy("INDICATOR_ID").orderBy(*by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    bins = (hist.withColumn("_hi", F.sum("_c").over(upto("_bin"))).join(F.broadcast(n), "INDICATOR_ID")
            .where(within(k0) | within(k1))
            .select("INDICATOR_ID", "_bin", "_n", (F.col("_hi") - F.col("_c")).alias("_before")))
    exact = (binned.join(F.broadcast(bins), ["INDICATOR_ID", "_bin"])  # at most two bins an indicator
             .groupBy("INDICATOR_ID", "_bin", "_n", "_before", "_v").agg(F.count(F.lit(1)).alias("_c"))
             .withColumn("_hi", F.col("_before") + F.sum("_c").over(
                 Window.partitionBy("INDICATOR_ID", "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))))
    t = exact.groupBy("INDICATOR_ID", "_n").agg(
        F.max(F.when(within(k0), F.col("_v"))).alias("_v0"),
        F.max(F.when(within(k1), F.col("_v"))).alias("_v1"),
        F.first(pos - k0).alias("_frac"))
    return t.select("INDICATOR_ID",
                    (F.col("_v0") + F.col("_frac") * (F.col("_v1") - F.col("_v0"))).alias("THRESHOLD"))


# ---------------------------------------------------------------- N6 / A7

def detect_anomalies(long: DataFrame, n_trees: int = ANOMALY.n_trees,
                     max_samples: int = ANOMALY.max_samples, seed: int = ANOMALY.seed,
                     contamination: float = ANOMALY.contamination,
                     min_samples: int = ANOMALY.min_samples) -> DataFrame:
    """The input rows plus ANOMALY_SCORE (NULL when not scored) and
    IS_ANOMALY (false when not scored)."""
    feats = build_features(long, min_samples)
    bmodel = long.sparkSession.sparkContext.broadcast(fit_model(feats, n_trees, max_samples, seed))
    # Scores feed both the cut-off and the row flags: compute them once; the
    # materialised scores no longer need the model, so its broadcast is freed.
    scored = materialize(score_rows(feats, bmodel).select(*long.columns, RAW_SCORE, "ANOMALY_SCORE"))
    bmodel.unpersist()
    thr = F.broadcast(quantile_thresholds(scored, contamination, RAW_SCORE))  # <= 11 rows
    flagged = (scored.join(thr, "INDICATOR_ID", "left")
               .withColumn("IS_ANOMALY", F.coalesce(F.col(RAW_SCORE) < F.col("THRESHOLD"), F.lit(False)))
               .select(*long.columns, "ANOMALY_SCORE", "IS_ANOMALY"))
    eligible = F.broadcast(feature_stats(long, min_samples).select("INDICATOR_ID", F.lit(True).alias("_ok")))
    rest = (long.join(eligible, "INDICATOR_ID", "left")
            .where(F.col("_ok").isNull() | F.col("VALUE").isNull() | F.col("YEAR").isNull())
            .select(*long.columns, F.lit(None).cast("double").alias("ANOMALY_SCORE"),
                    F.lit(False).alias("IS_ANOMALY")))
    return flagged.unionByName(rest)


def anomaly_summary(scored: DataFrame) -> DataFrame:
    """Scored indicators only: N_OBSERVATIONS, N_ANOMALIES, ANOMALY_RATE_PCT."""
    cat = F.broadcast(catalogue_df(scored.sparkSession).select("CAT_POS", "INDICATOR_ID", "INDICATOR_LABEL"))
    agg = (scored.where(F.col("ANOMALY_SCORE").isNotNull()).groupBy("INDICATOR_ID")
           .agg(F.count(F.lit(1)).alias("N_OBSERVATIONS"),
                F.count(F.when(F.col("IS_ANOMALY"), 1)).alias("N_ANOMALIES")))
    return (agg.join(cat, "INDICATOR_ID").select(
        "INDICATOR_ID", "INDICATOR_LABEL",
        F.col("N_OBSERVATIONS").cast("bigint").alias("N_OBSERVATIONS"),
        F.col("N_ANOMALIES").cast("bigint").alias("N_ANOMALIES"),
        F.round(F.col("N_ANOMALIES") / F.col("N_OBSERVATIONS") * 100.0, 2).alias("ANOMALY_RATE_PCT")))


REPORT_COLS = ["INDICATOR_ID", "INDICATOR_LABEL", "ISO3", "YEAR", "VALUE", "ANOMALY_SCORE",
               "REGION", "INCOME_GROUP"]


def anomaly_report(scored: DataFrame) -> DataFrame:
    """P12 + O3 + P13: anomalies only, most anomalous first, report columns that exist."""
    cols = [c for c in REPORT_COLS if c in scored.columns]
    return (scored.where(F.col("IS_ANOMALY")).select(*cols)
            .orderBy("ANOMALY_SCORE", "INDICATOR_ID", "ISO3", "YEAR"))


__all__ = ["build_features", "feature_columns", "fit_forest", "fit_model", "collect_model", "score_rows", "quantile_thresholds",
           "detect_anomalies", "anomaly_summary", "anomaly_report", "REGIONS"]
