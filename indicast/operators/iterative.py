"""Chained-equations imputation (I2) with a Bayesian ridge per feature.

Semantics: columns that are entirely missing are left NULL; the start value of
every missing cell is its column mean; features are visited in ascending
order of missing count (stable); each visit fits a Bayesian ridge (evidence
maximisation for the noise and weight precisions, intercept by centring) of
the feature on all other current columns over the rows where the feature is
observed, and replaces its missing cells with the predictions. Rounds stop
after ``max_iter`` or when the largest row-wise absolute change falls below
``tol * max|observed value|``.

Distribution: a fit needs only the sufficient statistics n, sum(x) and
sum(x x^T) over the observed rows. Within a round every value is an affine
function of the round-start values whose coefficients depend only on the
row's missing pattern, so one Spark aggregate of per-pattern moments per
round lets the driver replay all visits exactly ((p x p) eigen-solves; the
model is bounded by the number of features and patterns, not by the data).
One update then applies each pattern's affine map (broadcast join of the
<= 2^p-row map table); each round is checkpointed into the shared folder so
lineage stays short and a lost executor only recomputes the current round.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicast.functions.scalars import qcol
from indicast.schema import IMPUTE, INDICATOR_IDS
from indicast.session import checkpoint_dir

_EPS = np.finfo(np.float64).eps
#: Bounds the patterns collected and broadcast (at most 2^features, 4,096).
MAX_FEATURES = 12


def bayesian_ridge_from_stats(n: float, sx: np.ndarray, sy: float, sxx: np.ndarray,
                              sxy: np.ndarray, syy: float, max_iter: int = 300,
                              tol: float = 1e-3, a1: float = 1e-6, a2: float = 1e-6,
                              l1: float = 1e-6, l2: float = 1e-6) -> tuple[np.ndarray, float]:
    """Fit a Bayesian ridge with intercept from raw sums; returns (coef, intercept)."""
    mx, my = sx / n, sy / n
    G = sxx - n * np.outer(mx, mx)             # centred X'X
    b = sxy - n * mx * my                      # centred X'y
    yy = syy - n * my * my                     # centred y'y
    ev, V = np.linalg.eigh(G)
    ev = np.clip(ev, 0.0, None)
    Vb = V.T @ b
    alpha = 1.0 / (yy / n + _EPS)
    lam = 1.0

    def coef_for(alpha, lam):
        coef = V @ (Vb / (ev + lam / alpha))
        rmse = max(yy - 2.0 * coef @ b + coef @ G @ coef, 0.0)
        return coef, rmse

    coef_old = None
    for it in range(max_iter):
        coef, rmse = coef_for(alpha, lam)
        gamma = float(np.sum(alpha * ev / (lam + alpha * ev)))
        lam = (gamma + 2 * l1) / (float(np.sum(coef ** 2)) + 2 * l2)
        alpha = (n - gamma + 2 * a1) / (rmse + 2 * a2)
        if it != 0 and np.sum(np.abs(coef_old - coef)) < tol:
            break
        coef_old = coef.copy()
    coef, _ = coef_for(alpha, lam)
    return coef, float(my - mx @ coef)


def _pattern_moments(df: DataFrame, xs: list[str]) -> tuple[dict[int, tuple], float | None]:
    """One aggregate per round: n, sum(x) and sum(x x^T) of the current values
    per missing pattern (<= 2^p rows, and never more than the table), plus the
    previous round's largest row change when ``_delta`` is present."""
    p = len(xs)
    pairs = [(i, j) for i in range(p) for j in range(i, p)]
    exprs = (["count(1)"] + [f"sum(`{x}`)" for x in xs]
             + [f"sum(`{xs[i]}` * `{xs[j]}`)" for i, j in pairs])
    has_delta = "_delta" in df.columns
    exprs.append("max(_delta)" if has_delta else "CAST(NULL AS DOUBLE)")
    rows = df.groupBy("_pat").agg(*[F.expr(e) for e in exprs]).collect()
    out = {}
    deltas = [r[-1] for r in rows if r[-1] is not None]
    for r in rows:
        n = float(r[1])
        sx = np.array([float(r[2 + i] or 0.0) for i in range(p)])
        m = np.zeros((p, p))
        for k, (i, j) in enumerate(pairs):
            m[i, j] = m[j, i] = float(r[2 + p + k] or 0.0)
        out[int(r[0])] = (n, sx, m)
    return out, (max(deltas) if has_delta and deltas else None)


def _round_maps(moments: dict[int, tuple], p: int, order: list[int]) -> dict[int, tuple]:
    """Replay one round of visits on the driver.

    Inside a round every value is an affine map y = A_P x + b_P of the
    round-start values x, and the map depends only on the row's missing
    pattern P. The moments of y follow from those of x (n, A s + n b,
    A M A^T + A s b^T + b s^T A^T + n b b^T), so each visit's Bayesian-ridge
    fit is exact without touching the data again; the visit then rewrites row
    c of A_P and b_P for every pattern where c is missing."""
    maps = {pat: (np.eye(p), np.zeros(p)) for pat in moments}
    for c in order:
        others = [o for o in range(p) if o != c]
        n_tot, sy, syy = 0.0, np.zeros(p), np.zeros((p, p))
        for pat, (n, sx, m) in moments.items():
            if not (pat >> c) & 1:
                continue
            A, b = maps[pat]
            As = A @ sx
            n_tot += n
            sy += As + n * b
            syy += A @ m @ A.T + np.outer(As, b) + np.outer(b, As) + n * np.outer(b, b)
        ix = np.array(others)
        coef, icpt = bayesian_ridge_from_stats(n_tot, sy[ix], sy[c], syy[np.ix_(ix, ix)],
                                               syy[ix, c], syy[c, c])
        for pat in moments:
            if (pat >> c) & 1:
                continue
            A, b = maps[pat]
            A[c, :] = coef @ A[ix, :]
            b[c] = icpt + coef @ b[ix]
    return maps


def iterative_impute(wide: DataFrame, max_iter: int = IMPUTE.max_iter, tol: float = IMPUTE.tol,
                     cols: list[str] | None = None) -> DataFrame:
    """Chained-equations imputation of the indicator columns.

    Per round: one aggregate of per-pattern moments (which also carries the
    previous round's convergence measure), the visits replayed on the driver
    (``_round_maps``), and one update applying each pattern's affine map (a
    broadcast join of the <= 2^p-row map table), checkpointed in the shared
    folder."""
    spark = wide.sparkSession
    checkpoint_dir(spark)
    cols = [c for c in (cols or INDICATOR_IDS) if c in wide.columns]
    safe = {c: f"_x{i}" for i, c in enumerate(cols)}

    # One pass: counts, means and the largest absolute observed value.
    stats = wide.agg(F.count(F.lit(1)).alias("n"),
                     *[F.count(qcol(c)).alias(f"c{i}") for i, c in enumerate(cols)],
                     *[F.avg(qcol(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                     F.greatest(*[F.max(F.abs(qcol(c))) for c in cols]).alias("amax")).first()
    n_rows = stats["n"]
    counts = {c: stats[f"c{i}"] for i, c in enumerate(cols)}
    means = {c: stats[f"m{i}"] for i, c in enumerate(cols)}
    valid = [c for c in cols if counts[c] > 0]
    missing = {c: n_rows - counts[c] for c in valid}

    keep = [c for c in wide.columns if c not in cols]
    pattern = sum(((qcol(c).isNotNull().cast("int")) * (1 << i) for i, c in enumerate(valid)), F.lit(0))
    cur = wide.select(
        *[qcol(c) for c in keep],
        pattern.alias("_pat"),
        *[(F.coalesce(qcol(c), F.lit(means[c])) if c in valid else qcol(c)).alias(safe[c]) for c in cols])
    if not valid or all(m == 0 for m in missing.values()) or max_iter == 0:
        return _finish(cur, wide, cols, safe)

    p = len(valid)
    if p > MAX_FEATURES:
        raise ValueError(f"at most {MAX_FEATURES} features: moments and maps are kept per missing pattern (2^features)")
    xs = [safe[c] for c in valid]
    # Visit order: ascending missing count (stable); complete features need no visit.
    order = [valid.index(c) for c in sorted(valid, key=lambda c: missing[c]) if missing[c] > 0]
    norm_tol = tol * float(stats["amax"] or 0.0)
    cur = cur.checkpoint(eager=True)
    for it in range(max_iter):
        # The moments job also reports the previous round's largest row change.
        moments, delta = _pattern_moments(cur, xs)
        if it > 0 and delta is not None and delta < norm_tol:
            break
        maps = _round_maps(moments, p, order)
        table = spark.createDataFrame(
            [(pat, [float(v) for v in A.ravel()], [float(v) for v in b]) for pat, (A, b) in maps.items()],
            "_pat int, _A array<double>, _b array<double>")
        other = [c for c in cur.columns if c not in xs and c != "_delta"]
        upd = []
        for j, x in enumerate(xs):
            if missing[valid[j]] == 0:
                upd.append(f"`{x}` AS `_n{j}`")
                continue
            lin = " + ".join([f"_b[{j}]"] + [f"_A[{j * p + k}] * `{xk}`" for k, xk in enumerate(xs)])
            upd.append(f"CASE WHEN ((_pat >> {j}) & 1) = 1 THEN `{x}` ELSE {lin} END AS `_n{j}`")
        diff = " + ".join(f"abs(`_n{j}` - `{x}`)" for j, x in enumerate(xs))
        step = (cur.join(F.broadcast(table), "_pat")   # <= 2^p map rows: bounded
                .selectExpr(*[f"`{c}`" for c in other], *[f"`{x}`" for x in xs], *upd)
                .selectExpr(*[f"`{c}`" for c in other],
                            *[f"`_n{j}` AS `{x}`" for j, x in enumerate(xs)], f"{diff} AS _delta")
                .checkpoint(eager=True))
        cur = step
    return _finish(cur, wide, cols, safe)


def _finish(cur: DataFrame, wide: DataFrame, cols: list[str], safe: dict) -> DataFrame:
    return cur.select(*[(F.col(safe[c]) if c in safe else qcol(c)).alias(c) for c in wide.columns])
