"""Streamed, pruned and bucketed k-NN against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_impute import COLS, as_map, brute_knn, close, fixture

from indicast.operators import impute as I
from indicast.operators import neighbors as N


@pytest.mark.parametrize("slice_rows, slab", [(20_000, 256), (7, 3), (1, 1)])
def test_streamed_equals_brute_force(spark, monkeypatch, slice_rows, slab):
    df, rows = fixture(spark, n=60, seed=5)
    monkeypatch.setattr(N, "_SLAB", slab)
    close(as_map(N.knn_impute_streamed(df, cols=COLS, slice_rows=slice_rows)), brute_knn(rows))


def test_streamed_lists_are_the_paired_ones(spark):
    df, _ = fixture(spark, n=80, seed=6)
    keys = ["ISO3", "YEAR", "J", "DD", "D_ISO3", "D_YEAR", "V"]
    lists = [sorted(map(tuple, d.select(*keys).collect())) for d in (
        N.nearest_streamed(df, 3, COLS, slice_rows=11), I.nearest_donors(df, 3, COLS, (), 9, 13))]
    assert lists[0] == lists[1]


def test_running_best_over_batches_keeps_the_smallest_keys(spark):
    import pandas as pd
    recv = pd.DataFrame({"ISO3": ["R"], "YEAR": [1], "a": [np.nan], "b": [0.0]})
    donors = pd.DataFrame({"ISO3": [f"D{i:02d}" for i in range(30)], "YEAR": 1, "a": np.arange(30.0), "b": [float(i % 3) for i in range(30)]})
    for step in (1, 4, 30):
        run = N._Running(recv, ["a", "b"], 5)
        for at in range(0, 30, step):
            run.add(donors.iloc[at:at + step], ["a", "b"])
        assert run.result()["D_ISO3"].tolist() == ["D00", "D03", "D06", "D09", "D12"]


def test_nothing_is_shuffled_behind_the_comparison(spark):
    df, _ = fixture(spark)
    plan = N.nearest_streamed(df, 5, COLS)._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("MapInPandas")]
    assert "Exchange" not in above and "Window" not in above


@pytest.mark.parametrize("miss", [0.1, 0.3, 0.7])
@pytest.mark.parametrize("leaf_rows, sample, tasks", [(4, 1000, 1000), (10, 25, 3)])
def test_pruned_equals_brute_force(spark, miss, leaf_rows, sample, tasks):
    df, rows = fixture(spark, n=70, seed=int(miss * 10), miss=miss)
    got = N.knn_impute_pruned(df, cols=COLS, leaf_rows=leaf_rows, sample_rows=sample, receivers_per_task=tasks, donors_per_task=tasks)
    close(as_map(got), brute_knn(rows))


def grouped(spark, n=1500, groups=15, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.random((groups, 4))[rng.integers(0, groups, n)] * 100 + rng.normal(size=(n, 4))
    x = x.round(1)
    x[rng.random(x.shape) < 0.15] = np.nan
    rows = [(f"C{i:05d}", 2000, "R", "G", *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, fixture(spark, n=3)[0].schema)


def test_pruned_compares_a_part_of_the_pairs(spark):
    df = grouped(spark)
    out = N.knn_impute_pruned(df, cols=COLS, leaf_rows=20, count_pairs="N_PAIRS")
    missing = I._any(COLS, lambda c: c.isNull())
    pairs, receivers = out.agg({"N_PAIRS": "sum"}).first()[0], df.where(missing).count()
    assert 0 < pairs < 0.4 * receivers * df.count()
    close(as_map(out), as_map(I.knn_impute(df, cols=COLS)))
    assert out.where("N_PAIRS = 0").count() == df.where(~missing).count()


def test_bounds_never_exceed_a_distance():
    rng = np.random.default_rng(3)
    for trial in range(30):
        rows = rng.normal(size=(120, 5)).round(1)
        rows[rng.random(rows.shape) < rng.choice([0.1, 0.4, 0.8])] = np.nan
        rows = rows[~np.isnan(rows).all(axis=1)]
        leaf = rng.integers(0, 9, len(rows))
        ids = np.unique(leaf)
        parts = [rows[leaf == i] for i in ids]
        with np.errstate(all="ignore"):
            low, high = (np.array([[f(c[~np.isnan(c)]) if (~np.isnan(c)).any() else np.nan for c in p.T] for p in parts]) for f in (np.min, np.max))
        index = N.Leaves(ids, np.array([len(p) for p in parts]), np.array([(~np.isnan(p)).sum(axis=1).min() for p in parts]),
                         np.array([(~np.isnan(p)).sum(axis=0) for p in parts]), low, high)
        recv = rng.normal(size=(20, 5)) * 3
        recv[rng.random(recv.shape) < 0.4] = np.nan
        bound, dist = index.bounds(recv), I._sq_dist(recv, rows)
        for c, i in enumerate(ids):
            d = dist[:, leaf == i]
            assert not (np.where(np.isnan(d), np.inf, d) < bound[:, c][:, None] * (1 - 1e-9) - 2e-9).any()


def test_identical_rows_and_hardly_any_data(spark):
    schema = fixture(spark, n=3)[0].schema
    same = spark.createDataFrame([(f"C{i}", 1, "R", "G", 1.0, 2.0, None if i % 4 == 0 else float(i), None) for i in range(30)], schema)
    want = as_map(I.knn_impute(same, cols=COLS))
    for f in (N.knn_impute_pruned, N.knn_impute_lsh):
        close(as_map(f(same, cols=COLS, receivers_per_task=2, donors_per_task=4)), want)
        close(as_map(f(same.limit(1), cols=COLS)), as_map(I.knn_impute(same.limit(1), cols=COLS)))
        empty = spark.createDataFrame([("C", 1, "R", "G", None, None, None, None)], schema)
        assert np.isnan(as_map(f(empty, cols=COLS))[("C", 1)]).all()


def test_buckets_find_the_neighbours_of_grouped_rows(spark):
    df = grouped(spark)
    exact, found = N.nearest_streamed(df, 5, COLS), N.nearest_by_buckets(df, 5, COLS, bucket_rows=60)
    told = N.recall(exact, found).collect()
    assert {r.J for r in told} == {0, 1, 2, 3} and all(r.RECALL >= 0.9 for r in told)
    assert sum(r.N_CELLS for r in told) == sum(df.where(f"`{c}` IS NULL").count() for c in COLS)
    assert [round(r.RECALL, 6) for r in N.recall(exact, exact).collect()] == [1.0] * 4


def test_buckets_look_at_a_part_of_the_donors(spark):
    rng = np.random.default_rng(0)
    sample = rng.random((5000, 6)) * 100
    sample[rng.random(sample.shape) < 0.3] = np.nan
    tables = N.fit_tables(sample, 2_000_000, 500)
    assert {len(t.features) for t in tables} == {1, 2, 3}
    for t in tables:
        has = ~np.isnan(sample[:, t.features]).any(axis=1) & ((~np.isnan(sample)).sum(axis=1) <= t.most)
        _, n = np.unique(t.cells(sample[has]), axis=0, return_counts=True)
        assert t.most == len(t.features) or (n * n).sum() / n.sum() * 400 <= 2 * 500 * 1.5


def test_streamed_prunes_and_gives_the_same_lists(spark):
    df = grouped(spark)
    keys = ["ISO3", "YEAR", "J", "DD", "D_ISO3", "D_YEAR", "V"]
    found = N.nearest_streamed(df, 3, COLS, slice_rows=200, leaf_rows=20, piece_rows=7, pairs=True).cache()
    lists = [sorted(map(tuple, d.select(*keys).collect())) for d in (found.where("J >= 0"), I.nearest_donors(df, 3, COLS, (), 400, 500))]
    assert lists[0] == lists[1]
    pairs = found.where("J = -1")
    receivers = df.where(I._any(COLS, lambda c: c.isNull())).count()
    assert pairs.count() == receivers and 0 < pairs.agg({"DD": "sum"}).first()[0] < 0.4 * receivers * df.count()


def test_tree_puts_every_row_in_a_leaf():
    rng = np.random.default_rng(4)
    rows = rng.random((400, 3)).round(1)
    rows[rng.random(rows.shape) < 0.3] = np.nan
    rows[:, 2] = 1.0
    tree = N.fit_tree(rows[:100], 40)
    leaf = N.leaf_of(tree, rows)
    assert 20 < len(np.unique(leaf)) <= 42 and set(leaf) <= set(tree["leaf"][tree["feature"] < 0])
    assert len(np.unique(N.leaf_of(N.fit_tree(rows[:0], 40), rows))) == 1


def test_pairs_in_memory_do_not_grow_with_the_chunk(monkeypatch):
    import pandas as pd
    rng = np.random.default_rng(2)
    frame = lambda n: pd.DataFrame({"ISO3": [f"C{i:04d}" for i in range(n)], "YEAR": 1, "a": rng.random(n).round(2), "b": rng.random(n)})
    recv, donors = frame(60).assign(a=np.nan), frame(500)
    want = I._knn_partial(["a", "b"], 5)((0,), recv, donors)
    sizes, plain = [], I._sq_dist
    monkeypatch.setattr(I, "_PAIRS", 2000, raising=False)
    monkeypatch.setattr(I, "_sq_dist", lambda r, d: sizes.append(len(r) * len(d)) or plain(r, d))
    pd.testing.assert_frame_equal(I._knn_partial(["a", "b"], 5)((0,), recv, donors), want)
    assert max(sizes) <= 2000


def test_rows_that_ask_are_searched_against_all(spark):
    df, _ = fixture(spark, n=80, seed=6)
    keys = ["ISO3", "YEAR", "J", "DD", "D_ISO3", "D_YEAR", "V"]
    asking = df["YEAR"] % 2 == 0
    odd = df.where(asking & I._any(COLS, lambda c: c.isNull())).count()
    assert 0 < odd < df.where(I._any(COLS, lambda c: c.isNull())).count()
    for near in (N.nearest_streamed, N.nearest_by_buckets):
        some, every = (sorted(map(tuple, d.select(*keys).collect())) for d in (
            near(df, 3, COLS, asking=F.expr("YEAR % 2 = 0")), near(df, 3, COLS).where("YEAR % 2 = 0")))
        assert some == every and some


def test_lists_leave_a_slice_in_small_parts(monkeypatch):
    import pandas as pd
    monkeypatch.setattr(N, "RESULT_CELLS", 7, raising=False)
    rng = np.random.default_rng(2)
    frame = lambda n, a: pd.DataFrame({"ISO3": [f"C{i:04d}" for i in range(n)], "YEAR": 1, "a": a, "b": rng.random(n)})
    recv, donors = frame(60, np.nan).assign(_slice=0, _side=0), frame(90, rng.random(90)).assign(_slice=0, _side=1)
    parts = list(N._stream(["a", "b"], 3, 50, True)([recv, donors]))
    assert len(parts) > 9 and max(map(len, parts)) <= 7 * 3
    out = pd.concat(parts)
    assert (out["J"] >= 0).sum() == 60 * 3 and (out["J"] == -1).sum() == 60 and (out.loc[out["J"] == -1, "DD"] == 90).all()


def test_buckets_hold_many_copies_and_sparse_rows(spark):
    rng = np.random.default_rng(8)
    x = (rng.random((600, 8)) * 100).round(1)
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:6, 1:] = np.nan
    cols = [f"f{i}" for i in range(8)]
    rows = [(f"C{i % 600:03d}", i // 600, *[None if np.isnan(v) else float(v) for v in x[i % 600]]) for i in range(600 * 20)]
    df = spark.createDataFrame(rows, "ISO3 string, YEAR int, " + ", ".join(f"{c} double" for c in cols)).repartition(8).cache()
    asking = F.col("YEAR") == 3
    exact, found = (near(df, 5, cols, asking=asking, **kw).cache() for near, kw in (
        (N.nearest_streamed, {}), (N.nearest_by_buckets, {"bucket_rows": 100})))
    told = N.recall(exact, found).collect()
    assert {r.J for r in told} == set(range(8)) and all(r.RECALL >= 0.9 for r in told)
    # No more than k different donors a cell, those of the smallest keys among copies.
    cells = found.groupBy("ISO3", "YEAR", "J").agg(F.count("*").alias("n"), F.countDistinct("D_ISO3", "D_YEAR").alias("d"))
    assert cells.where("n <> d OR n > 5").count() == 0
    assert found.groupBy("ISO3", "J", "D_ISO3").agg(F.count("*").alias("n"), F.max("D_YEAR").alias("y")).where("y <> n - 1").count() == 0


def test_receivers_are_compared_with_the_leaves_they_ask(spark):
    import pandas as pd
    rng = np.random.default_rng(9)
    rows = rng.random((2000, 6)) * 100
    rows[rng.random(rows.shape) < 0.2] = np.nan
    leaf = N.leaf_of(N.fit_tree(rows, 40), rows)
    ids = np.unique(leaf)
    parts = [N._ranges(rows[leaf == i]) for i in ids]
    known = N.Leaves(ids, *[np.concatenate([getattr(p, n) for p in parts]) for n in ("rows", "fewest", "has", "low", "high")])
    recv = rows[np.isnan(rows).any(axis=1)][:150]
    asked = known.nearest(recv, 5)
    assert asked.shape == (150, 5) and all(len(set(a)) == 5 for a in asked)
    cols = list("abcdef")
    frame = lambda x, key: pd.DataFrame(x, columns=cols).assign(ISO3=[f"{key}{i:04d}" for i in range(len(x))], YEAR=1)
    order = np.argsort(leaf, kind="stable")
    run = N._Running(frame(recv, "R").assign(_probes=list(ids[asked].astype("int32"))), cols, 3)
    run.add(frame(rows[order], "D").assign(_leaf=leaf[order]), cols)
    most = np.array([known.rows[a].sum() for a in asked])
    assert (run.pairs <= most).all() and run.pairs.max() > 0
    whole = N._Running(frame(recv, "R"), cols, 3)
    whole.add(frame(rows[order], "D"), cols)
    keys = ["ISO3", "J", "D_ISO3"]
    every, some = (set(map(tuple, r.result()[keys].to_numpy())) for r in (whole, run))
    assert len(every & some) > 0.3 * len(every)  # five of some forty leaves
