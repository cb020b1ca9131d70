import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from indicast.llm import common, decontaminate, queries, simhash

HOME = "/root/testdata/sf0.01"
REPO = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage but the last."""
    docs, out = common.table(spark, HOME, "documents"), []
    shelf = common.Shelf(spark, "test")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = shelf.keep(stage(spark, docs, HOME), name)
        out.append(docs)
    return out


def test_stages_keep_the_columns_of_documents(spark, stages):
    columns = common.table(spark, HOME, "documents").columns
    assert [s.columns for s in stages] == [columns] * 4
    counts = [s.count() for s in stages]
    assert counts[0] == counts[1] > counts[2] > counts[3] > 400


def test_decisions_take_effect(spark, stages):
    dropped = queries.op1_line_dedup(spark, HOME).filter("n_dropped > 0").count()
    before = {r.doc_id: r.text for r in stages[0].collect()}
    changed = [r for r in stages[1].collect() if r.text != before[r.doc_id]]
    assert abs(len(changed) - dropped) <= 5 and all(r.n_chars == len(r.text) for r in changed)
    groups = simhash.near_duplicates(stages[1])
    assert stages[2].count() == groups.select("root").distinct().count()
    assert {r.doc_id for r in stages[2].collect()} == {r.component_id for r in groups.collect()}
    bench = common.table(spark, HOME, "benchmark")
    assert decontaminate.contamination(stages[3], bench).count() == 0
    lost = stages[2].join(stages[3], "doc_id", "left_anti").count()
    assert lost == decontaminate.contamination(stages[2], bench).select("doc_id").distinct().count()


def test_run_gives_the_tokens_of_what_is_left(spark, stages):
    out = corpus_pipeline.run(spark, HOME)
    assert out.count() == stages[3].count()
    whole = queries.op2_bpe(spark, HOME)
    same = stages[3].join(common.table(spark, HOME, "documents").select("doc_id", F.col("text").alias("whole")), "doc_id")
    same = same.filter(F.col("text") == F.col("whole")).select("doc_id")
    left = sorted(map(tuple, out.join(same, "doc_id").collect()))
    assert left and left == sorted(map(tuple, whole.join(same, "doc_id").collect()))


def test_the_rest_imports_without_these_parts(tmp_path):
    for name in ("indicast", "__spark_entry__.py", "corpus_pipeline.py"):
        copy = shutil.copytree if (REPO / name).is_dir() else shutil.copy
        copy(REPO / name, tmp_path / name)
    code = "import __spark_entry__ as e; print(len([q for q in e.queries() if q.startswith('op') or q == 'pipeline']), len(e.oracle_sql()))"

    def seen():
        said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True,
                              env=os.environ | {"PYTHONPATH": str(tmp_path)})
        assert said.returncode == 0, said.stderr
        return int(said.stdout.split()[0])
    assert seen() == 14
    shutil.rmtree(tmp_path / "indicast" / "llm")
    (tmp_path / "corpus_pipeline.py").unlink()
    assert seen() == 0
