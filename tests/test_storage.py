"""Payloads larger than a task, publication of versions, layout, coverage state, sketched quantiles."""

import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from indicast.operators import coverage_state as CS
from indicast.operators import quantiles as QT
from indicast.operators import reshape as R
from indicast.plans import stages as S
from indicast.sinks import layout as L
from indicast.sinks.versions import Publication
from indicast.sources import feeds, large_json as J
from indicast.sources.testdata import TIE_BREAK
from support import SF_SMALL

# ---------------------------------------------------------------- large JSON

NASTY = ['}, {"', '\\"', '\\\\', '],"data":[{', "ünï {[", '"data": [', "", "\n\t", "\\u0041", "]}"]


def payload(rng, n, extra=True):
    rows = [{"countryId": rng.choice(["KEN", "BRA"]), "year": str(2000 + i % 9), "value": rng.choice([None, "1.5", "x"]),
             "qualifier": rng.choice(NASTY), "more": {"deep": [1, {"data": [rng.choice(NASTY)]}]}} for i in range(n)]
    body = {"data": rows}
    if extra:
        body = {"meta": {"data": [{"countryId": "no"}], rng.choice(NASTY): [[], {}]}, "list": [{"countryId": "no"}], **body, "end": NASTY}
    return json.dumps(body, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))


@pytest.mark.parametrize("size", [64, 1000, 1 << 20])
def test_ranges_give_what_the_whole_text_gives(spark, tmp_path, size):
    rng = random.Random(size)
    for i, n in enumerate([0, 1, 12]):
        (tmp_path / f"IND.{i}.json").write_text(payload(rng, n), encoding="utf-8")
    got, broken = J.read_large_json(spark, f"{tmp_path}/*.json", range_bytes=size)
    want, _ = feeds.read_json_documents(spark, f"{tmp_path}/*.json")
    key = ["INDICATOR_ID", "ISO3", "YEAR", "VALUE", "MAGNITUDE", "QUALIFIER", "INDICATOR_LABEL"]
    in_order = lambda df: [tuple(r[c] for c in key) for r in sorted(df.collect(), key=lambda r: (r.FILE, r.POS))]
    assert in_order(got) == in_order(want) and broken.collect() == []
    assert set(got.columns) == set(want.columns)


def test_files_that_are_no_payload_are_reported(spark, tmp_path):
    bad = {"cut": '{"data":[{"countryId":"KEN"},{"country', "open": '{"data":[{"countryId":"KEN"}', "none": '{"other":[]}',
           "text": "hello", "list": "[]"}
    for name, text in {**bad, "good": '{"data":[{"countryId":"KEN"}]}'}.items():
        (tmp_path / f"{name}.json").write_text(text)
    got, broken = J.read_large_json(spark, f"{tmp_path}/*.json", range_bytes=10)
    assert [r.INDICATOR_ID for r in got.collect()] == ["good"]
    assert sorted(r.FILE.split("/")[-1].split(".")[0] for r in broken.collect()) == sorted(bad)


def test_every_cut_through_a_file(spark, tmp_path):
    text = '{"a\\\\":"\\"]}","data" : [{"countryId":"K\\\\\\"{"},{"countryId":"B","qualifier":"}]"} ] ,"z":[{}]}'
    (tmp_path / "x.json").write_text(text)
    want = [e["countryId"] for e in json.loads(text)["data"]]
    for size in (1, 4, 23, len(text)):
        got, _ = J.read_large_json(spark, f"{tmp_path}/x.json", range_bytes=size)
        assert [r.ISO3 for r in sorted(got.collect(), key=lambda r: r.POS)] == want, size


# ---------------------------------------------------------------- publication

def rows(df):
    return sorted(r[0] for r in df.collect())


def test_versions_failures_and_pinned_readers(spark, tmp_path):
    store = Publication(spark, f"{tmp_path}/p")
    assert store.snapshot() == 0
    with pytest.raises(FileNotFoundError):
        store.read("a")
    one = store.publish({"a": spark.range(3), "b": spark.range(5), "none": spark.range(0)})
    pinned = store.read("a", one)
    bad = spark.range(4).select(F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        store.publish({"b": spark.range(1), "a": bad})
    assert store.versions() == [1] and rows(store.read("b")) == list(range(5))
    two = store.publish({"a": spark.range(10, 12)})
    assert two == 2 and rows(store.read("a")) == [10, 11] and rows(pinned) == [0, 1, 2]
    assert rows(store.read("b")) == list(range(5)) and store.read("none").dtypes == spark.range(0).dtypes
    assert {n: t["rows"] for n, t in store.manifest()["tables"].items()} == {"a": 2, "b": 5, "none": 0}
    store.publish({"c": spark.range(1)}, keep_others=False)
    with pytest.raises(FileNotFoundError):
        store.read("a")


def test_two_writers_get_a_version_each(spark, tmp_path):
    store = Publication(spark, f"{tmp_path}/p")
    ready = threading.Barrier(4)
    numbers = []

    def write(i):
        ready.wait()
        numbers.append(store.publish({f"t{i}": spark.range(i + 1)}))
    threads = [threading.Thread(target=write, args=(i,)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(numbers) == [1, 2, 3, 4] == store.versions()
    assert [rows(store.read(f"t{i}")) for i in range(4)] == [list(range(i + 1)) for i in range(4)]
    assert not store._commit(2, {}) and store.versions() == [1, 2, 3, 4]


def test_vacuum_keeps_what_is_named(spark, tmp_path):
    store = Publication(spark, f"{tmp_path}/p")
    store.publish({"a": spark.range(1), "b": spark.range(2)})
    store.publish({"a": spark.range(3)})
    spark.range(1).write.parquet(f"{tmp_path}/p/a/left-behind")
    assert store.vacuum(keep=1, older_than_s=3600) == []  # too young
    assert len(store.vacuum(keep=1, older_than_s=0)) == 2
    assert store.versions() == [2] and rows(store.read("a")) == [0, 1, 2] and rows(store.read("b")) == [0, 1]


# ---------------------------------------------------------------- layout

def test_filters_prune_folders_and_reach_the_files(spark, tmp_path):
    df = spark.range(2000).select((F.col("id") % 5).cast("int").alias("y"), (F.col("id") % 40).alias("k"), "id")
    path = L.write_partitioned(df, f"{tmp_path}/t", ["y"], ["k"])
    read = L.read_partitioned(spark, path, df)
    assert read.columns == df.columns and read.exceptAll(df).count() == 0 and read.count() == 2000
    part = read.where("y = 3 AND k > 35")
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(y" in plan and "PushedFilters: [IsNotNull(k), GreaterThan(k,35)]" in plan
    assert part.count() == df.where("y = 3 AND k > 35").count()
    assert {r[0].split("/y=")[1][0] for r in part.select("_metadata.file_path").collect()} == {"3"}


def test_replacing_partitions_leaves_the_others(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 4).cast("int").alias("y"), "id")
    path = L.write_partitioned(df, f"{tmp_path}/t", ["y"])
    new = spark.createDataFrame([(2, 1000), (7, 1001)], "y int, id long")
    L.replace_partitions(new, path, ["y"])
    got = L.read_partitioned(spark, path, df)
    assert sorted(map(tuple, got.collect())) == sorted([*map(tuple, df.where("y <> 2").collect()), (2, 1000), (7, 1001)])
    L.replace_partitions(new.limit(0), path, ["y"])
    assert got.count() == 77


def test_a_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    df = spark.range(4000).select(F.lit(1).alias("y"), (F.col("id") % 7).alias("k"), "id")
    L.write_partitioned(df, f"{tmp_path}/t", ["y"], ["k"])
    assert len(spark.read.parquet(f"{tmp_path}/t").inputFiles()) > 1


# ---------------------------------------------------------------- coverage state

def test_coverage_after_every_file_equals_a_full_run(spark):
    raw = S.raw_long(spark, SF_SMALL).withColumn("FILE_ID", F.concat_ws("-", "SOURCE", (F.col("ORD_A") / 500).cast("int")))
    names = sorted(r[0] for r in raw.select("FILE_ID").distinct().collect())
    assert len(names) >= 6
    random.Random(3).shuffle(names)
    state = None
    for i, name in enumerate(names):
        more = S.materialize(CS.file_state(raw.where(F.col("FILE_ID") == name), TIE_BREAK))
        state = more if state is None else state.unionByName(more)
        if i in (0, 2, len(names) - 1):
            from indicast.operators.harmonize import harmonize
            seen = raw.where(F.col("FILE_ID").isin(*names[:i + 1]))
            # Files come in order of their names within a source.
            full = harmonize(seen.drop("INDICATOR_LABEL"), tie_break=["FILE_ID", *TIE_BREAK])
            assert sorted(map(tuple, CS.coverage_from_state(state).collect())) == sorted(map(tuple, R.coverage(full).collect()))


def test_coverage_of_no_files(spark):
    state = CS.file_state(S.raw_long(spark, SF_SMALL).withColumn("FILE_ID", F.lit("f")).limit(0), TIE_BREAK)
    assert {(r.N_COUNTRIES, r.N_OBSERVATIONS, r.COVERAGE_PCT) for r in CS.coverage_from_state(state).collect()} == {(0, 0, 0.0)}


# ---------------------------------------------------------------- quantiles

@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 1.0])
def test_sketched_quantile_is_exact(spark, q):
    import numpy as np
    rng = np.random.default_rng(1)
    groups = {"one": [3.0], "two": [1.0, 2.0], "ties": [5.0] * 4000 + [1.0] * 100, "many": rng.normal(size=9000).tolist(),
              "twenty": rng.random(20).tolist()}
    data = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("one", None), ("null", None)]
    df = spark.createDataFrame(data, "INDICATOR_ID string, v double").repartition(5)
    got = {r[0]: r[1] for r in QT.grouped_quantile(df, q, "v").collect()}
    assert got.keys() == groups.keys()
    for g, vs in groups.items():
        assert got[g] == pytest.approx(np.quantile(vs, q), rel=1e-12, abs=1e-12), g


def test_a_bracket_that_misses_is_widened(spark):
    import numpy as np
    values = np.random.default_rng(2).normal(size=5000)
    df = spark.createDataFrame([("g", float(v)) for v in values], "INDICATOR_ID string, v double")
    got = QT.grouped_quantile(df, 0.3, "v", k=8, error=1e-3).first()  # a sketch far worse than assumed
    assert got[1] == pytest.approx(np.quantile(values, 0.3), rel=1e-12)
