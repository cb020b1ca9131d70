"""Places in an order, and counters gathered by the writing job."""

import os
import random
import subprocess
import sys

from pyspark.sql import functions as F

from indicast.operators import harmonize as H
from indicast.operators import observed as OB
from indicast.operators import reshape as R
from indicast.operators.ordinals import with_ordinals
from indicast.plans import stages as S
from support import SF_SMALL
from indicast.sources.testdata import TIE_BREAK


def test_places_follow_the_order_over_many_partitions(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *"abc"]), rng.choice([None, 1, 2, 3]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, `y.z` int, i int").repartition(7)
    got = with_ordinals(df, ["k", "y.z", "i"], start=1).collect()
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", r[1] is None, r[1] or 0, r[2]))
    assert [tuple(r)[:3] for r in sorted(got, key=lambda r: r.PLACE)] == want
    assert sorted(r.PLACE for r in got) == list(range(1, 501))


def test_a_hot_key_is_spread_and_repeated_rows_get_a_place_each(spark):
    df = spark.createDataFrame([("hot", 1)] * 900 + [(f"k{i}", i) for i in range(100)], "k string, v int").repartition(8)
    placed = with_ordinals(df, ["k"])
    assert sorted(r.PLACE for r in placed.select("PLACE").collect()) == list(range(1000))
    hot = [r.PLACE for r in placed.where("k = 'hot'").collect()]
    assert sorted(hot) == list(range(900))
    assert placed.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_empty_table_and_no_one_task_window(spark):
    df = spark.createDataFrame([], "a int")
    assert with_ordinals(df, ["a"]).collect() == []
    placed = with_ordinals(spark.range(100).withColumnRenamed("id", "a"), ["a"])
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_long_and_wide_order(spark):
    h = S.harmonized(spark, SF_SMALL, materialized=True)
    got = H.long_order(h, index="i").orderBy("i").select(*H.KEY).collect()
    assert [tuple(r) for r in got] == sorted(tuple(r) for r in h.select(*H.KEY).collect())
    w = R.pivot_wide(h)
    got = R.wide_order(w, index="i").orderBy("i").select("ISO3", "YEAR").collect()
    assert [tuple(r) for r in got] == sorted(tuple(r) for r in w.select("ISO3", "YEAR").collect())


def test_counters_of_the_write_equal_a_second_pass(spark, tmp_path):
    for dirty in (False, True):
        feeds = S.feed_frames(spark, SF_SMALL, dirty=dirty)
        n = OB.harmonize_observed(f"{tmp_path}/h{dirty}", *feeds, tie_break=TIE_BREAK)
        want = H.drop_counters(H.union_feeds(*feeds)).first().asDict()
        assert n == want
        table = spark.read.parquet(f"{tmp_path}/h{dirty}")
        assert table.count() == n["N_HARMONIZED"]
        assert table.exceptAll(H.harmonize(*feeds, tie_break=TIE_BREAK)).count() == 0


def test_counters_of_empty_feeds(spark, tmp_path):
    empty = S.feed_frames(spark, SF_SMALL)[0].limit(0)
    assert set(OB.harmonize_observed(f"{tmp_path}/h", empty, tie_break=TIE_BREAK).values()) == {0}
    assert OB.write_observed(empty, f"{tmp_path}/e").get("N_ROWS", 0) == 0


RERUN = """
import os, sys
sys.path.insert(0, {root!r})
from pyspark import TaskContext
from indicast.operators import harmonize as H, observed as OB
from indicast.plans import stages as S
from indicast.session import build_session
from indicast.sources.testdata import TIE_BREAK

spark = build_session("local[2,4]", 2, {{"spark.checkpoint.dir": {home!r}}})  # a task may fail three times

def fail_at_first(parts):
    yield from parts  # the rows are counted before the task is lost
    mark = {home!r} + f"/lost-{{TaskContext.get().partitionId()}}"
    if not os.path.exists(mark):
        open(mark, "w").close()
        raise RuntimeError("lost")

feeds = [f.repartition(3) for f in S.feed_frames(spark, {sf!r})]
shaky = [f.mapInPandas(fail_at_first, f.schema) for f in feeds]
got = OB.harmonize_observed({home!r} + "/h", *shaky, tie_break=TIE_BREAK)
want = H.drop_counters(H.union_feeds(*feeds)).first().asDict()
assert any(n.startswith("lost-") for n in os.listdir({home!r})) and got == want, (got, want)
print("counted once")
"""


def test_tasks_that_run_again_count_once(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = RERUN.format(root=root, home=str(tmp_path), sf=SF_SMALL)
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=240)
    assert "counted once" in out.stdout, out.stderr[-3000:]


def test_nothing_is_observed_below_the_exchange(spark):
    feeds = S.feed_frames(spark, SF_SMALL)
    plan = H.dedup_by_priority(H.union_feeds(*feeds), ["SOURCE", *TIE_BREAK], count_as="n").observe(
        "x", F.sum("n").alias("raw"))._jdf.queryExecution().executedPlan().toString()
    assert plan.index("CollectMetrics") < plan.index("Exchange")
