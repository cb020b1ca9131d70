import random
import re
from collections import Counter

import numpy as np
import pytest

from indicast.llm import gbt, quality as Q
from indicast.llm.common import table

COUNTS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def brute(doc, text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i, w in enumerate(zip(words, words[1:], words[2:])) if seen[w] > 1 for j in range(i, i + 3)}
    lines, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in lines
            lines.add(line)
    n = len(words)
    return (doc, n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(repeated),
            n < 50 or 100 * len(repeated) > 50 * n)


def corpus():
    rnd = random.Random(6)
    rows = [(i, rnd.choice([" ", "\n"]).join(rnd.choice(["a", "Öl", "b|", "c#$", "日本", "x&y", "\x1c", "\x85\xa0"]) * rnd.randrange(1, 3)
                                            for _ in range(rnd.randrange(120)))) for i in range(80)]
    return rows + [(None, "a b c a b c"), (100, None), (101, ""), (102, " \n \n"), (103, "one two\none two\n\none two "),
                   (104, "x"), (104, "x"), (105, "a " * 30000)]


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_counts_against_brute_force(run, spark):
    rows = corpus()
    got = run("op7_quality_rules", rows, COUNTS, labels=labels(spark, [(None, 1, 0), (100, None, 0), (5555, 1, 1)]))
    assert got == sorted((brute(*r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def test_nothing_to_learn_leaves_the_base_rules(run, spark):
    rows = corpus()
    got = run("op7_quality_rules", rows, ["kept", "base_failed"], labels=labels(spark, []))
    assert all(kept is not failed for kept, failed in got)


def test_held_out_accuracy(spark):
    home = "/root/testdata/sf0.1"
    docs, known = table(spark, home, "documents"), table(spark, home, "labels")
    trees = Q.fit(docs, known.filter("doc_id % 2 = 0"))
    held = Q.judge(docs, trees).join(known.filter("doc_id % 2 = 1"), "doc_id").toPandas()
    right = (held["quality_score"] >= 0.5) == (held["quality"] == 1)
    assert len(held) > 1000 and right.mean() >= 0.98
    assert held.loc[(held["quality"] == 1) & ~held["base_failed"], "kept"].mean() >= 0.98


@pytest.mark.parametrize("sign", [1, -1])
def test_constraints_hold_for_any_labels(sign):
    rnd = np.random.default_rng(2)
    x = rnd.random((400, 3))
    y = (rnd.random(400) < 0.5 - 0.4 * sign * (x[:, 0] - 0.5)).astype(float)  # labels that go against the constraint
    trees = gbt.fit(x, y, [sign, 0, 0])
    grid = np.repeat(x[:50], 40, axis=0)
    grid[:, 0] = np.tile(np.linspace(-1, 2, 40), 50)
    steps = np.diff(trees.margin(grid).reshape(50, 40), axis=1)
    assert (sign * steps >= -1e-9).all()


def test_trees_fit_an_interaction_and_constants():
    rnd = np.random.default_rng(3)
    x = rnd.random((800, 2))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.5)).astype(float)
    assert ((gbt.fit(x, y, [0, 0]).probability(x) > 0.5) == (y > 0)).mean() > 0.97
    assert gbt.fit(np.empty((0, 2)), np.empty(0), [0, 0]).probability(x).std() == 0
    assert gbt.fit(x, np.ones(800), [0, 0]).probability(x).min() > 0.99


def test_sample_is_bounded_under_repeated_ids_and_texts(spark, docs, monkeypatch):
    text = " ".join(f"word{i}" for i in range(60))
    rows = docs([(i, f"{text} {i}") for i in range(1000)] + [(0, f"{text} other {i}") for i in range(500)])
    known = labels(spark, [(0, 1, 0)] * 3000 + [(0, 0, 0)] * 50 + [(i, i % 2, 0) for i in range(1, 1000)])
    seen = []
    monkeypatch.setattr(Q.gbt, "fit", lambda x, y, *a: seen.append(len(y)) or gbt.Trees(
        *(np.empty(0) for _ in range(5)), np.empty(0, int), 1, 0.0))
    Q.fit(rows, known, sample_rows=50)
    assert 15 <= seen[0] <= 100
    Q.fit(rows, known, sample_rows=100_000)
    assert seen[1] == 1001  # every distinct label, the repeated id's two among them


def test_clashing_columns_empty_tables_and_long_texts(spark, docs):
    text = " ".join(f"w{i}" for i in range(400_000))  # past a chunk
    rows = docs([(1, text), (2, "a b")]).selectExpr("*", "1 AS n_words", "'x' AS kept", "2 AS label")
    known = labels(spark, [(1, 1, 0), (2, 0, 0)]).selectExpr("*", "'t' AS text")
    out = {r.doc_id: (r.n_words, r.base_failed) for r in Q.judge(rows, Q.fit(rows, known)).collect()}
    assert out == {1: (400_000, False), 2: (2, True)}
    assert Q.judge(rows.limit(0), Q.fit(rows.limit(0), known.limit(0))).collect() == []
