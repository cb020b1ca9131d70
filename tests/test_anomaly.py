"""Isolation-forest invariants (bit-equality with any library is a non-goal)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from indicast.operators import anomaly as A
from indicast.plans import stages as S

from support import SF_SMALL


@pytest.fixture(scope="module")
def harmonized(spark):
    return S.materialize(S.harmonized(spark, SF_SMALL))


@pytest.fixture(scope="module")
def scored(harmonized):
    return A.detect_anomalies(harmonized, n_trees=30).cache()


def test_average_path_length():
    assert A._c(1) == 0.0 and A._c(2) == 1.0
    assert math.isclose(A._c(256), 2 * (math.log(255) + 0.5772156649015329) - 2 * 255 / 256)


def test_scores_in_range_and_unscored_rows(scored, harmonized):
    assert scored.count() == harmonized.count()
    s = scored.where(F.col("ANOMALY_SCORE").isNotNull()).select("ANOMALY_SCORE").toPandas()["ANOMALY_SCORE"]
    assert len(s) > 0 and (s >= -1).all() and (s < 0).all()
    nulls = scored.where(F.col("VALUE").isNull())
    assert nulls.where(F.col("ANOMALY_SCORE").isNotNull() | F.col("IS_ANOMALY")).count() == 0


def test_flag_share_and_threshold(harmonized, scored):
    feats = A.build_features(harmonized)
    raw = A.score_rows(feats, A.fit_model(feats, n_trees=30)).toPandas()
    flags = scored.where(F.col("IS_ANOMALY")).groupBy("INDICATOR_ID").count().toPandas().set_index("INDICATOR_ID")["count"]
    for ind, g in raw.groupby("INDICATOR_ID"):
        v = g[A.RAW_SCORE].to_numpy()
        assert flags.get(ind, 0) == (v < np.percentile(v, 5)).sum() <= 0.05 * len(v) + 1
        assert (np.round(v, 6) == g["ANOMALY_SCORE"]).all()


def test_short_samples_are_drawn_again(harmonized, monkeypatch):
    feats = A.build_features(harmonized)
    whole = A.collect_model(A.fit_forest(feats, n_trees=4, margin=None))
    monkeypatch.setattr(A.fit_forest, "__defaults__", (*A.fit_forest.__defaults__[:-1], 0.02))
    model = A.fit_model(feats, n_trees=4)
    assert {i: psi for i, (_, psi) in model.items()} == {i: psi for i, (_, psi) in whole.items()}


def test_threshold_matches_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.round(-rng.uniform(0.3, 0.7, size=333), 6)
    df = spark.createDataFrame([("X", float(v)) for v in vals], "INDICATOR_ID string, ANOMALY_SCORE double")
    thr = A.quantile_thresholds(df).first()["THRESHOLD"]
    assert math.isclose(thr, np.percentile(vals, 5), abs_tol=1e-12)
    close = np.concatenate([vals, vals[:60] + 1e-8, vals[:20]])  # several values in one bin, and ties
    df = spark.createDataFrame([("X", float(v)) for v in close], "INDICATOR_ID string, S double")
    thr = A.quantile_thresholds(df, 0.31, "S").first()["THRESHOLD"]
    assert math.isclose(thr, np.percentile(close, 31), abs_tol=1e-13)


def test_deterministic_across_partitionings(harmonized):
    a = A.detect_anomalies(harmonized.repartition(1), n_trees=20)
    b = A.detect_anomalies(harmonized.repartition(7), n_trees=20)
    key = ["INDICATOR_ID", "ISO3", "YEAR"]
    pa = a.select(*key, "ANOMALY_SCORE", "IS_ANOMALY").toPandas().sort_values(key).reset_index(drop=True)
    pb = b.select(*key, "ANOMALY_SCORE", "IS_ANOMALY").toPandas().sort_values(key).reset_index(drop=True)
    assert pa.equals(pb)


def test_trees_partition_their_sample(harmonized):
    trees = A.fit_forest(A.build_features(harmonized), n_trees=5).toPandas()
    for _, t in trees.groupby(["INDICATOR_ID", "TREE"]):
        leaves = t[t["FEAT"] < 0]
        assert leaves["SIZE"].sum() == t["PSI"].iat[0] == t[t["NODE"] == 0]["SIZE"].iat[0]
        assert t["DEPTH"].max() <= math.ceil(math.log2(t["PSI"].iat[0]))


def test_summary_and_report(scored):
    summ = A.anomaly_summary(scored).collect()
    assert summ and all(r["N_ANOMALIES"] <= r["N_OBSERVATIONS"] for r in summ)
    rep = A.anomaly_report(scored)
    assert rep.columns == A.REPORT_COLS
    scores = [r["ANOMALY_SCORE"] for r in rep.collect()]
    assert scores == sorted(scores)
    assert len(scores) == sum(r["N_ANOMALIES"] for r in summ)
