import random

import numpy as np
import pytest

from indicast.llm import decontaminate as D

rnd = random.Random(9)
VOCABULARY = [f"w{i}ord" for i in range(3000)]
COMMON = "the of and to in a is".split()
word = lambda: rnd.choice(COMMON) if rnd.random() < .4 else rnd.choice(VOCABULARY)
ITEMS = [(i, " ".join(word() for _ in range(rnd.randrange(20, 60)))) for i in range(30)]


def edited(text, share):
    return " ".join(word() if rnd.random() < share else w for w in text.split())


def filler(n):
    return " ".join(word() for _ in range(n))


ROWS = [(i, filler(rnd.randrange(10, 300))) for i in range(200)]
PLANTED = {1000 + i: i % 30 for i in range(90)}
ROWS += [(d, filler(80) + " " + (ITEMS[i][1] if d < 1030 else ITEMS[i][1].upper().replace(" ", ", ") if d < 1060
                                 else edited(ITEMS[i][1], .15)) + ".\n" + filler(60)) for d, i in PLANTED.items()]


def test_planted_copies_and_edits_are_found_and_nothing_else(run, spark):
    bench = spark.createDataFrame([*ITEMS, (500, None), (501, ""), (502, "the of"), (None, ITEMS[0][1])], "item_id long, text string")
    extra = [(None, ITEMS[3][1]), (2000, None), (2001, ""), (2002, ITEMS[4][1]), (2002, ITEMS[4][1]), (2003, ("x " * 9000) + ITEMS[5][1])]
    got = run("op6_decontamination", ROWS + extra, ["doc_id", "item_id", "score"], benchmark=bench)
    pairs = [(d, i) for d, i, _ in got if i is not None]
    assert set(pairs) == set(PLANTED.items()) | {(None, 3), (2002, 4), (2003, 5)}
    assert pairs.count((2002, 4)) == 2
    assert {d for d, i, _ in got if i is None} == {d for d, i in PLANTED.items() if i == 0}
    assert all(s == 1 for d, i, s in got if d is not None and 1000 <= d < 1060)


def test_blocks_do_not_change_the_matches(spark, docs):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    whole = D.contamination(docs(ROWS), bench).collect()
    parts = D.contamination(docs(ROWS), bench, block_words=200).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, parts)) and len(whole) == 90


def test_clean_keeps_every_other_row_and_column(spark, docs):
    from pyspark.sql import functions as F
    df = docs([*ROWS, (None, None), (3000, "")]).withColumn("item_id", F.lit("x"))
    out = D.clean(df, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert out.columns == df.columns
    assert {r.doc_id for r in out.collect()} == {d for d, _ in ROWS if d not in PLANTED} | {None, 3000}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert D.clean(df, empty).count() == df.count()
    assert D.contamination(df, empty).count() == 0 and D.contamination(docs([]), empty).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_alignment_against_a_plain_table(seed):
    r = np.random.default_rng(seed)
    a, b = r.integers(0, 6, 25), r.integers(0, 6, 60)
    best = 0
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(len(a)):
        for j in range(len(b)):
            h[i + 1, j + 1] = max(0, h[i, j] + (D.MATCH if a[i] == b[j] else D.MISS), h[i, j + 1] + D.GAP, h[i + 1, j] + D.GAP)
            best = max(best, h[i + 1, j + 1])
    assert D.align(a, b)[0] == best


def test_edited_copies_of_short_items_are_found(run, spark):
    r = random.Random(4)
    new = lambda: r.choice(VOCABULARY)
    short, rows = [], list(ROWS[:200])
    for n in range(6, 15):
        for edits in (0, 1, 2):
            words = [r.choice(COMMON) if k % 3 == 1 else new() for k in range(n)]
            item = 100 * n + edits
            short.append((item, " ".join(words)))
            for k in r.sample(range(1, n - 1), edits):
                words[k] = f"other{k}"
            rows.append((10000 + item, f"{filler(70)} {' '.join(words)}. {filler(50)}"))
    # Six words that are everywhere: a copy is found, four of them in a row are not a copy.
    short.append((1, "the of and to in a"))
    rows += [(5000 + i, filler(20) + " the of and to w1ord w2ord " + filler(20)) for i in range(300)] + [(10001, "x the of and to in a x")]
    bench = spark.createDataFrame(short, "item_id long, text string")
    got = run("op6_decontamination", rows, ["doc_id", "item_id"], benchmark=bench)
    assert got == sorted((10000 + i, i) for i, _ in short)


@pytest.mark.parametrize("times", [1, 300, 100_000])
def test_every_item_has_seeds_whatever_the_size_of_the_corpus(times):
    r = random.Random(6)
    items = [[r.choice(COMMON) for _ in range(n)] for n in [3, 4, 5, 6, 7, 8, 12, 14, 15, 20, 40, 59]]
    texts = [" ".join(w).encode() for w in items]
    block = D.Block.of(list(range(len(items))), texts)
    # Every word makes up 5 % of the corpus.
    block.choose(np.full(len(block.vocabulary), 2000. * times), 40_000 * times)
    docs = [f"{' '.join(f'a{k}' for k in range(60))} {t.decode()}! {' '.join(f'b{k}' for k in range(60))}".encode() for t in texts]
    pairs = {(d, f[0]) for d, found in D.find(block, docs) for f in found}
    assert {(i, i) for i in range(len(items))} <= pairs
    for i, words in enumerate(items):
        at = np.unique(block.seed_at[block.seed_item == i])
        assert np.diff(np.concatenate(([-1], at, [len(words) - 2]))).max() < 2 * D.STRETCH


def every_third_replaced(words, new):
    return [next(new) if i % 3 == 2 else w for i, w in enumerate(words)]


def one_inserted_after_every_second(words, new):
    return [x for i, w in enumerate(words) for x in ([w, next(new)] if i % 2 else [w])]


def random_edits(words, new):
    return [next(new) if rnd.random() < .3 else w for w in words]


def given(spark):
    from indicast.llm.common import table
    home = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, home, "documents").collect()]
    return docs, [(r.item_id, r.text) for r in table(spark, home, "benchmark").collect()]


def test_recall_against_aligning_every_item_with_every_document(spark):
    """Evenly edited copies of the given items, planted in the given documents' words."""
    docs, items = given(spark)
    pool = [w for _, t in docs for w in (t or "").split()]
    new = iter(lambda: rnd.choice(pool), None)
    planted = {}
    for k, edit in enumerate((every_third_replaced, one_inserted_after_every_second, random_edits)):
        for i, text in items:
            d = 10_000 + 1000 * k + i
            planted[d] = " ".join([*(next(new) for _ in range(60)), *edit(text.split(), new), *(next(new) for _ in range(40))])
    rows = docs + list(planted.items())
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {(r.doc_id, r.item_id) for r in D.contamination(frame, bench).collect()}
    block = D.Block(**next(D.blocks(frame, bench)).value)
    texts = [(d, D.Words([D.normal((t or "").encode())]).hashes()) for d, t in rows]
    cells = [(block.item_ids[i], block.words[a:b], block.bits[a:b]) for i, (a, b) in enumerate(zip(block.first[:-1], block.first[1:]))]
    true = {(d, i) for d, words in texts if len(words) for i, own, bits in cells if D.found_in(own, words, bits)}
    assert found <= true and len(true) > 2 * len(items)
    for k in range(3):
        mine = {p for p in true if 10_000 + 1000 * k <= p[0] < 11_000 + 1000 * k}
        assert len(mine) >= 0.5 * len(items) and len(mine & found) >= 0.9 * len(mine), (k, len(mine), len(mine & found))
    assert len(true & found) >= 0.95 * len(true)


def test_repeated_items_long_texts_and_clashing_columns(spark, docs):
    long = filler(200_000) + " " + ITEMS[7][1]  # past a chunk
    rows = docs([(1, long), (2, ITEMS[8][1])]).selectExpr("*", "0.5 AS score", "'x' AS item_id", "1 AS copies")
    bench = spark.createDataFrame([ITEMS[7]] * 300 + [ITEMS[8]], "item_id long, text string").selectExpr("*", "'x' AS copies", "1 AS doc_id")
    got = [(r.doc_id, r.item_id) for r in D.contamination(rows, bench).collect()]
    assert sorted(got) == [(1, 7)] * 300 + [(2, 8)]
    assert next(D.blocks(rows, bench)).value["item_ids"] == [7, 8]
