import random
import re
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from indicast.llm import simhash as S
from indicast.llm.common import Shelf
from indicast.llm.components import connected_components

COLUMNS = ["doc_id", "fingerprint", "component_id"]


def brute_mark(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(nodes, near):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in combinations(nodes, 2):
        if near(a, b):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {x: find(x) for x in nodes}


def corpus():
    rnd = random.Random(5)
    rows, base = [], [" ".join(rnd.choice("the of Ünd Et".split()) + str(rnd.randrange(900)) for _ in range(200))
                      for _ in range(4)]
    for i in range(90):
        w = base[i % 4].split()
        for _ in range(rnd.randrange(4)):
            w[rnd.randrange(len(w))] = "edit" + str(rnd.randrange(5))
        rows.append((1000 - i, " ".join(w)))
    rows += [(i, " ".join(str(rnd.random()) for _ in range(20))) for i in range(2000, 2030)]
    return rows + [(3000, None), (3001, ""), (2999, " \n"), (3002, "one"), (3003, "ONE"), (3004, "one two"),
                   (3005, "a b c"), (3005, "a b c"), (3006, "É"), (3007, "é"), (3008, "x " * 50000)]


def test_query_against_brute_force(run):
    rows = corpus()
    marks = {r: brute_mark(r[1]) for r in rows}
    roots = brute_roots(sorted(set(marks.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for r in rows:
        k = roots[marks[r]]
        least[k] = min(least.get(k, r[0]), r[0])
    assert run("op8_simhash_near_dedup", rows, COLUMNS) == sorted(
        (r[0], f"{marks[r]:016x}", least[roots[marks[r]]]) for r in rows)


def test_covering_drops_every_triple():
    masks = S.covering_masks(list(range(24)), 3)
    assert len(masks) == 15
    for triple in combinations(range(24), 3):
        assert any(not any(m >> p & 1 for p in triple) for m in masks)


@pytest.mark.parametrize("bucket", [2, 30, 1024])
def test_refined_buckets_lose_no_link(spark, bucket):
    rnd = random.Random(7)
    centre, values = rnd.getrandbits(64), set()
    while len(values) < 250:
        x = centre
        for _ in range(rnd.randrange(5)):
            x ^= 1 << rnd.randrange(64)
        values.add(x)
    values |= {rnd.getrandbits(64) for _ in range(50)}
    nodes = spark.createDataFrame([(S._signed(x),) for x in values], "fp long")
    shelf = Shelf(spark, "test")
    got = {r.node: r.root for r in connected_components(S.links(nodes, shelf, 3, bucket), shelf).collect()}
    want = brute_roots(sorted(map(S._signed, values)), lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    assert {x: got.get(x, x) for x in want} == want


def test_components_of_a_long_chain(spark):
    order = list(range(200))
    random.Random(3).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "u long, v long")
    got = connected_components(edges, Shelf(spark, "test")).collect()
    assert len(got) == 200 and {r.root for r in got} == {0}


def test_one_of_each_keeps_all_columns_and_one_row(docs):
    df = docs([(5, "a b c d"), (4, "a b c d"), (4, "a b c d"), (None, "q r s t"), (None, "q r s t"), (9, None), (8, "")])
    df = df.withColumns({"fp": F.lit("x"), "root": F.lit(1)})
    out = S.one_of_each(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == [(0, "q r s t"), (4, "a b c d"), (8, "")]
    assert S.one_of_each(docs([])).count() == 0 and S.near_duplicates(docs([])).count() == 0
