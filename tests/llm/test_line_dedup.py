import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from indicast.llm import line_dedup as L

COLUMNS = ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
LOWER = str.maketrans(L.UPPER, L.LOWER)


def brute(rows, least=20, docs=3):
    number = lambda d: -(1 << 63) if d is None else d
    key = lambda x: x.strip(L.SPACES).translate(LOWER)
    held = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            held[key(x)].add(number(d))
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= least and len(held[key(x)]) >= docs
                                         and max(held[key(x)]) != number(d))]
        out.append((d, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def corpus(n=120):
    rnd = random.Random(4)
    pool = [f"{c} a line that several documents hold {i}" for i, c in enumerate("ÉÄñAbZ" * 8)]
    rows = [(i, "\n".join(rnd.choice(["", " \t"]) + rnd.choice([str.upper, str, str])(rnd.choice(pool))
                          if rnd.random() < .4 else f"own {i} {rnd.random()}" for _ in range(rnd.randrange(12))))
            for i in range(n)]
    return rows + [(None, pool[0]), (None, pool[0] + "\n" + pool[0]), (500, None), (501, ""), (502, "\n\n"),
                   (503, "short\nshort"), (504, "short"), (505, "short"), (7, pool[1]), (7, pool[1]), (8, pool[2]),
                   (506, "x" * 19), (507, "x" * 19), (508, "x" * 19), (509, "x" * 20), (510, "x" * 20), (511, "X" * 20),
                   (512, "ü" * 20), (513, "ü" * 20), (514, "ü" * 20), (515, "Ü" * 20), (516, "\n".join(pool * 400))]


def test_query_against_brute_force(run):
    rows = corpus()
    assert run("op1_line_dedup", rows, COLUMNS) == brute(rows)


@pytest.mark.parametrize("batches,docs_needed", [(1, 2), (7, 4)])
def test_batches_and_levels_do_not_change_the_result(docs, batches, docs_needed):
    rows = corpus(40)
    out = L.line_dedup(docs(rows), min_docs=docs_needed, batches=batches).collect()
    got = sorted(((r.doc_id, r["__n_lines"], r["__n_dropped"], hashlib.sha256((r.text or "").encode()).hexdigest())
                  for r in out), key=lambda r: tuple((x is not None, x) for x in r))
    assert got == brute(rows, docs=docs_needed)


def test_runs_are_compacted_and_saturated_keys_not_stored_again(spark):
    index = L.LineIndex(L.Shelf(spark, "test"), min_docs=2)
    for base in (30, 20, 10):
        index.add(spark.createDataFrame([(1, 1, base), (1, 1, base + 1), (base, 2, base)], "h1 long, h2 long, id long"))
    assert [len(level) for level in index.levels] == [1, 1]
    assert index.levels[0][0][1].count() == 1  # the saturated key is not in the newest run
    assert [tuple(r) for r in index.repeated().collect()] == [(1, 1, 31)]


def test_plan_has_no_python(docs):
    plan = L.line_dedup(docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_empty_table_and_extra_columns(docs):
    assert L.line_dedup(docs([])).count() == 0
    df = docs([(1, "a\nb")]).withColumns({"line": F.lit(1), "gone": F.lit("g"), "h1": F.lit(2)})
    out = L.line_dedup(df).collect()[0]
    assert (out.text, out.line, out.gone, out.h1, out.n_chars) == ("a\nb", 1, "g", 2, 3)
