"""Ranked search against a plain scan of all documents, and the DuckDB oracle."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from indicast.llm import queries, search as S
from indicast.llm.common import chunks

ITEMS = "item_id long, text string"
COLUMNS = ["item_id", "rank", "doc_id", "score"]


def terms(text):
    found = re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in found]


def scan(docs, items, k=10):
    """Scores of all documents by the formula."""
    docs = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in docs]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item_id, text in items:
        found = []
        for (doc_id, tf), n in zip(docs, sizes):
            score = 0
            for t in terms(text):
                if tf[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += w * (10**9 * tf[t] // (1000 * tf[t] + 8 * (25 + 75 * n * n_docs // n_terms)))
            if score > 0:
                found.append((-score, doc_id))
        out += [(item_id, r + 1, d, -s) for r, (s, d) in enumerate(sorted(found)[:k])]
    return sorted(out)


def corpus(rng, n, words=400):
    """Documents over a vocabulary with a few very frequent words, some documents twice."""
    rows = []
    for i in range(n):
        size = rng.choice([0, 1, 5, 40, 200])
        rows.append((i, " ".join(f"w{int(words * rng.random() ** 4)}" for _ in range(size))))
    return rows + [(n + j, rows[j][1]) for j in range(0, n, 9)]


def items_of(rng, n, words=400):
    return [(i, " ".join(f"w{int(words * rng.random() ** 2)}" for _ in range(rng.choice([1, 3, 20])))) for i in range(n)]


def test_query_equals_a_scan_and_its_oracle(spark, run, tmp_path):
    rng = random.Random(2)
    docs = corpus(rng, 250) + [(9001, None), (9002, ""), (9003, "?!"), (9004, "W1 w1-W2_w3\x80É"), (9005, "É é x")]
    items = items_of(rng, 25) + [(100, None), (101, ""), (102, "nowhere"), (103, "w1 w1 w1"), (104, "É W1\x80")]
    bench = spark.createDataFrame(items, ITEMS)
    got = run("op13_search", docs, COLUMNS, benchmark=bench)
    assert got == scan(docs, items)
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/in0/{name}.parquet/*.parquet'")
    assert sorted(con.execute(S.ORACLE).fetchall()) == got


def ranked(texts, items, k, segment_docs):
    """The segments' part of the work, without Spark."""
    block = S.Block.of([i for i, _ in items], [t.encode() for _, t in items])
    rows = []
    for at in range(0, len(texts), segment_docs):
        part = texts[at:at + segment_docs]
        words = S.terms_of([t.encode() for _, t in part])
        rows.append(S._segment([S.postings(words)], [i for i, _ in part], [np.diff(words.first)]).to_pylist()[0])
    counts = Counter(t for _, text in texts for t in set(terms(text)))
    by_hash = {S.terms_of([t.encode()]).hashes()[0]: n for t, n in counts.items()}
    block.weigh(np.array([by_hash.get(h, 0) for h in block.vocabulary]), sum(r["n_docs"] for r in rows),
                sum(r["n_terms"] for r in rows))
    best = [S.Best(k) for _ in items]
    for row in rows:
        segment = S.Segment(row, block)
        for b, t, n in zip(best, block.terms, block.times):
            segment.rank(t, n, b)
    return sorted((item_id, r + 1, d, s) for (item_id, _), b in zip(items, best)
                  for r, (d, s) in enumerate(zip(b.ids.tolist(), b.scores.tolist())))


@pytest.mark.parametrize("accumulate, step, segment", [(1, 7, 64), (50, 16, 1000), (200, 1, 90), (1 << 20, 4096, 64), (0, 4096, 33)])
def test_any_split_between_accumulators_and_walked_lists(accumulate, step, segment, monkeypatch):
    monkeypatch.setattr(S, "STEP", step)
    rank = S.Segment.rank

    def limited(self, *args):
        self.most = accumulate
        rank(self, *args)
    monkeypatch.setattr(S.Segment, "rank", limited)
    rng = random.Random(accumulate + step)
    for k in (1, 3, 10):
        docs, items = corpus(rng, 150, 60), items_of(rng, 12, 60)
        assert ranked(docs, items, k, segment) == scan(docs, items, k)


def test_documents_are_skipped():
    # One word of the item is in every document, the other in twenty: the frequent list is not walked.
    texts = [(i, "common filler" + (" rare" if i % 500 == 0 else "")) for i in range(10_000)]
    block = S.Block.of([0], [b"common rare"])
    words = S.terms_of([t.encode() for _, t in texts])
    row = S._segment([S.postings(words)], [i for i, _ in texts], [np.diff(words.first)]).to_pylist()[0]
    frequencies = {S.terms_of([t]).hashes()[0]: n for t, n in ((b"common", 10_000), (b"rare", 20))}
    block.weigh(np.array([frequencies[h] for h in block.vocabulary]), row["n_docs"], row["n_terms"])
    segment, best, seen = S.Segment(row, block), S.Best(10), []
    add = best.add
    best.add = lambda scores, ids: (seen.extend(ids.tolist()), add(scores, ids))
    segment.rank(block.terms[0], block.times[0], best)
    assert best.ids.tolist() == list(range(0, 5000, 500)) and len(seen) < 5000


def test_ties_repeated_rows_null_ids_and_clashing_columns(spark, docs):
    rows = docs([(3, "x"), (1, "x"), (1, "x"), (None, "x"), (2, "x y")])
    clash = rows.withColumns({"id": F.lit(1), "n_docs": F.lit("a"), "score": F.lit(0), "item": F.lit(None)})
    items = spark.createDataFrame([(7, "x"), (7, "x"), (None, "X")], ITEMS).withColumn("rank", F.lit(0))
    found = sorted((str(r.item_id), r["rank"], str(r.doc_id)) for r in S.search(S.build(clash), items).collect())
    one = [(1, "1"), (2, "1"), (3, "3"), (4, "None"), (5, "2")]
    assert found == sorted((i, r, d) for i in ("7", "7", "None") for r, d in one)


def test_blocks_of_items_give_the_same(spark, docs, monkeypatch):
    rng = random.Random(4)
    rows, items = corpus(rng, 80, 50), items_of(rng, 30, 50)
    bench = spark.createDataFrame(items, ITEMS)
    monkeypatch.setattr(S, "chunks", lambda batches, size_by: chunks(batches, size_by, 1000))
    index = S.build(docs(rows).repartition(3), segment_bytes=2000)
    assert index.count() > 3
    got = sorted(tuple(r) for r in S.search(index, bench, k=4, block_words=20).collect())
    assert got == scan(rows, items, 4)


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([(1, "x")], ITEMS)
    assert S.search(S.build(docs([])), bench).collect() == []
    assert S.search(S.build(docs([(1, None)])), bench).collect() == []
    assert S.search(S.build(docs([(1, "x")])), bench.limit(0)).collect() == []


def test_a_text_past_a_segment(docs, spark):
    long = "alpha beta " * 300_000
    index = S.build(docs([(1, long), (2, "alpha")]).coalesce(1), segment_bytes=1 << 20)
    assert index.count() == 2
    bench = spark.createDataFrame([(1, "beta"), (2, "alpha")], ITEMS)
    found = sorted(tuple(r) for r in S.search(index, bench).collect())
    assert found == scan([(1, long), (2, "alpha")], [(1, "beta"), (2, "alpha")])
