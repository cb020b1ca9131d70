"""k-NN and chained-equations imputation against brute-force references."""

import math

import numpy as np
import pytest
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

from indicast.operators import impute as I
from indicast.operators.iterative import bayesian_ridge_from_stats, iterative_impute

COLS = ["A.1", "B.2", "C", "D"]


def fixture(spark, n=40, seed=3, miss=0.3):
    rng = np.random.default_rng(seed)
    X = rng.integers(0, 15, size=(n, len(COLS))).astype(float)
    X[rng.random(X.shape) < miss] = np.nan
    X[0, :] = np.nan                        # all-missing row -> column means
    X[1, :] = [np.nan, np.nan, np.nan, 3.0]  # single feature
    rows = [(f"C{i % 7}", 2000 + i // 7, f"R{i % 3}", "G", *[None if np.isnan(v) else float(v) for v in X[i]])
            for i in range(n)]
    schema = StructType([StructField("ISO3", StringType()), StructField("YEAR", IntegerType()),
                         StructField("REGION", StringType()), StructField("INCOME_GROUP", StringType())]
                        + [StructField(c, DoubleType()) for c in COLS])
    return spark.createDataFrame(rows, schema), rows


def brute_knn(rows, k=5, block=None):
    keys = [(r[0], r[1]) for r in rows]
    X = np.array([[np.nan if v is None else v for v in r[4:]] for r in rows])
    means = np.nanmean(X, axis=0)
    out = X.copy()
    for i in range(len(X)):
        for j in np.flatnonzero(np.isnan(X[i])):
            cand = []
            for d in range(len(X)):
                if d == i or np.isnan(X[d, j]):
                    continue
                if block is not None and rows[d][block] != rows[i][block]:
                    continue
                common = ~np.isnan(X[i]) & ~np.isnan(X[d])
                if not common.any():
                    continue
                dd = round(float(np.sum((X[i, common] - X[d, common]) ** 2)) / common.sum(), 9)
                cand.append((dd, keys[d][0], keys[d][1], X[d, j]))
            cand.sort()
            out[i, j] = np.mean([c[3] for c in cand[:k]]) if cand else means[j]
    return {keys[i]: out[i] for i in range(len(X))}


def as_map(df):
    return {(r["ISO3"], r["YEAR"]): np.array([r[c] for c in COLS], dtype=float) for r in df.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        np.testing.assert_allclose(a[k], b[k], rtol=0, atol=1e-9, equal_nan=True)


def test_knn_matches_brute_force(spark):
    df, rows = fixture(spark)
    close(as_map(I.knn_impute(df, cols=COLS)), brute_knn(rows))


def test_knn_chunked_equals_single(spark):
    df, rows = fixture(spark, n=60, seed=5)
    a = as_map(I.knn_impute(df, cols=COLS))
    b = as_map(I.knn_impute(df, cols=COLS, receivers_per_task=20, donors_per_task=15))
    close(a, b)
    close(a, brute_knn(rows))


def test_knn_blocked_matches_brute_force(spark):
    df, rows = fixture(spark, seed=7)
    close(as_map(I.knn_impute_blocked(df, block="REGION", cols=COLS)), brute_knn(rows, block=2))
    small = I.knn_impute_blocked(df, block=["REGION"], cols=COLS, receivers_per_task=3, donors_per_task=4)
    close(as_map(small), brute_knn(rows, block=2))


def test_nearest_breaks_ties_by_position():
    rng = np.random.default_rng(4)
    d = rng.integers(0, 4, (50, 30)).astype(float)
    d[rng.random(d.shape) < 0.3] = np.inf
    d[0] = np.inf
    for k in (1, 5, 30, 40):
        got = I._nearest(d, k)
        for row, mask in zip(d, got):
            want = [i for i in np.argsort(row, kind="stable")[:k] if np.isfinite(row[i])]
            assert sorted(want) == np.flatnonzero(mask).tolist()


def test_knn_keeps_passthrough_columns(spark):
    df, _ = fixture(spark)
    out = I.knn_impute(df, cols=COLS)
    assert out.columns == df.columns and out.count() == df.count()
    assert {r["REGION"] for r in out.collect()} == {"R0", "R1", "R2"}


def test_clip_round_and_report(spark):
    schema = "ISO3 string, YEAR int, REGION string, INCOME_GROUP string, `CR.1` double, `GPIA.CR.1` double"
    df = spark.createDataFrame([("A", 2000, "r", "g", 101.23456, 3.0), ("B", 2000, "r", "g", None, -1.0),
                                ("C", 2000, "r", "g", 12.345678, None)], schema)
    out = {r["ISO3"]: r for r in I.clip_round(df, cols=["CR.1", "GPIA.CR.1"]).collect()}
    assert out["A"]["CR.1"] == 100.0 and out["A"]["GPIA.CR.1"] == 2.5
    assert out["B"]["CR.1"] is None and out["B"]["GPIA.CR.1"] == 0.0
    assert out["C"]["CR.1"] == 12.3457
    filled = df.fillna(1.0)
    rep = {r["INDICATOR_ID"]: r for r in I.imputation_report(df, filled).collect()}
    assert rep["CR.1"]["N_MISSING_BEFORE"] == 1 and rep["CR.1"]["N_IMPUTED"] == 1
    assert rep["CR.1"]["PCT_MISSING_BEFORE"] == 33.33 and rep["CR.1"]["METHOD"] == "KNN"
    assert rep["GPIA.CR.1"]["N_MISSING_AFTER"] == 0 and rep["CR.1"]["PCT_MISSING_AFTER"] == 0.0


def test_report_of_two_tables_that_differ(spark):
    """Indicators of one table only are left out; more gaps than before count as none imputed."""
    schema = "ISO3 string, YEAR int, `CR.1` double, `CR.2` double"
    before = spark.createDataFrame([("A", 2000, 1.0, None), ("B", 2000, 2.0, 3.0)], schema)
    after = spark.createDataFrame([("A", 2000, None), ("B", 2000, None), ("C", 2000, 5.0)],
                                  "ISO3 string, YEAR int, `CR.1` double")
    row, = I.imputation_report(before, after, "iterative").collect()
    assert (row.INDICATOR_ID, row.N_TOTAL, row.N_MISSING_BEFORE, row.N_MISSING_AFTER) == ("CR.1", 2, 0, 2)
    assert (row.PCT_MISSING_BEFORE, row.PCT_MISSING_AFTER, row.N_IMPUTED, row.METHOD) == (0.0, 66.67, 0, "ITERATIVE")
    empty = I.imputation_report(before.limit(0), after.limit(0)).collect()
    assert [(r.N_TOTAL, r.N_MISSING_BEFORE, r.PCT_MISSING_AFTER) for r in empty] == [
        (r.N_TOTAL, r.N_MISSING, r.PCT_MISSING) for r in I.audit_missing(before.limit(0), cols=["CR.1"]).collect()]


def test_audit_missing(spark):
    df, rows = fixture(spark)
    a = {r["INDICATOR_ID"]: r for r in I.audit_missing(df, cols=COLS).collect()}
    for j, c in enumerate(COLS):
        n_miss = sum(1 for r in rows if r[4 + j] is None)
        assert a[c]["N_MISSING"] == n_miss and a[c]["N_TOTAL"] == len(rows)
        assert a[c]["PCT_MISSING"] == round(n_miss / len(rows) * 100, 2)


# ---- chained equations

def br_svd(X, y, max_iter=300, tol=1e-3):
    xo, yo = X.mean(0), y.mean()
    Xc, yc = X - xo, y - yo
    n = len(X)
    alpha, lam = 1.0 / (np.var(yc) + np.finfo(float).eps), 1.0
    XTy = Xc.T @ yc
    _, S, Vh = np.linalg.svd(Xc, full_matrices=False)
    ev = S ** 2

    def upd(a, l):
        c = Vh.T @ (Vh / (ev + l / a)[:, None]) @ XTy
        return c, np.sum((yc - Xc @ c) ** 2)
    old = None
    for it in range(max_iter):
        c, rmse = upd(alpha, lam)
        g = np.sum(alpha * ev / (lam + alpha * ev))
        lam = (g + 2e-6) / (np.sum(c ** 2) + 2e-6)
        alpha = (n - g + 2e-6) / (rmse + 2e-6)
        if it and np.sum(np.abs(old - c)) < tol:
            break
        old = c.copy()
    c, _ = upd(alpha, lam)
    return c, yo - xo @ c


def brute_iterative(X, max_iter=10, tol=1e-3):
    mask = np.isnan(X)
    Xt = np.where(mask, np.nanmean(X, axis=0), X)
    order = np.argsort(mask.sum(0), kind="mergesort")
    ntol = tol * np.max(np.abs(X[~mask]))
    for _ in range(max_iter):
        prev = Xt.copy()
        for j in order:
            if not mask[:, j].any():
                continue
            o = [c for c in range(X.shape[1]) if c != j]
            obs = ~mask[:, j]
            c, b = br_svd(Xt[obs][:, o], Xt[obs, j])
            Xt[mask[:, j], j] = Xt[mask[:, j]][:, o] @ c + b
        if np.max(np.abs(Xt - prev).sum(axis=1)) < ntol:
            break
    return Xt


def test_bayesian_ridge_from_stats():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(80, 5)) * 10 + 3
    y = X @ rng.normal(size=5) + rng.normal(size=80) + 1
    c1, b1 = br_svd(X, y)
    c2, b2 = bayesian_ridge_from_stats(len(X), X.sum(0), y.sum(), X.T @ X, X.T @ y, y @ y)
    np.testing.assert_allclose(c1, c2, atol=1e-9)
    assert math.isclose(b1, b2, abs_tol=1e-8)


def test_iterative_matches_reference_loop(spark):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(50, 1))
    X = np.hstack([base * s + rng.normal(size=(50, 1)) * 0.3 + 10 for s in (1, 2, -1, 0.5)])
    X[rng.random(X.shape) < 0.2] = np.nan
    X[X[:, 0] != X[:, 0], 1] = 5.0  # keep every row partly observed
    rows = [(f"C{i}", 2000, "r", "g", *[None if np.isnan(v) else float(v) for v in X[i]]) for i in range(50)]
    schema = ("ISO3 string, YEAR int, REGION string, INCOME_GROUP string, "
              + ", ".join(f"`{c}` double" for c in COLS))
    df = spark.createDataFrame(rows, schema)
    got = as_map(iterative_impute(df, cols=COLS))
    ref = brute_iterative(X)
    for i in range(50):
        np.testing.assert_allclose(got[(f"C{i}", 2000)], ref[i], atol=1e-6)
    # observed cells are untouched
    for i in range(50):
        obs = ~np.isnan(X[i])
        np.testing.assert_array_equal(got[(f"C{i}", 2000)][obs], X[i][obs])


@pytest.mark.parametrize("method", ["knn", "bogus"])
def test_dispatch_unknown_method_is_knn(spark, method):
    df, _ = fixture(spark)
    out = I.impute_wide(df, method=method, cols=COLS) if method == "knn" else I.impute_wide(df, method=method, cols=COLS)
    assert out.where(" OR ".join(f"`{c}` IS NULL" for c in COLS)).count() == 0


def test_knn_supplier_entities_brute_force(spark):
    from indicast.plans import stages as S
    from support import SF_SMALL
    w = S.supplier_wide(spark, SF_SMALL)
    cols = w.columns[4:]
    rows = [tuple(r) for r in w.collect()]
    ref = brute_knn(rows)
    got = {(r["ISO3"], r["YEAR"]): np.array([r[c] for c in cols], dtype=float)
           for r in I.knn_impute(w, receivers_per_task=20, donors_per_task=20).collect()}
    assert len(rows) > 20
    close(got, ref)
