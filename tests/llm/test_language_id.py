import zlib

import numpy as np
from pyspark.sql import functions as F

from indicast.llm import language_id as L
from indicast.llm.common import table

COLUMNS = ["doc_id", "held_out", "lang_pred", "score"]
EN = "the weather was good and they went out to the river with the other people of the town "
DE = "das wetter war schön und sie gingen mit den anderen leuten aus der stadt zum fluss "
TEXTS = [(i, (EN if i % 2 else DE) * (1 + i % 3), "en" if i % 2 else "de") for i in range(60)]


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = L.predict(docs, L.fit(docs)).join(docs.select("doc_id", "lang"), "doc_id").filter(L.held_out())
    right = out.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")), F.count("*")).first()
    assert right[1] > 150 and right[0] >= 0.99
    kept = L.accepted(docs, L.fit(docs))
    assert kept.schema == docs.schema and kept.count() >= 0.99 * docs.count()


def test_edge_cases(run):
    rows = [*TEXTS, (1000, None, "en"), (1001, "", "en"), (1002, "12 +-", None), (None, EN, "xx"), (1003, "a", None),
            (1004, EN.upper(), None), (1005, DE + "\n" + DE, None), (1005, DE + "\n" + DE, None), (1006, "日本語 テキスト", None)]
    got = {}
    for r in run("op4_language_id", rows, COLUMNS):
        got.setdefault(r[0], []).append(r[1:])
    assert [got[k][0][1] for k in (1000, 1001, 1002)] == ["und"] * 3 and got[1000][0][2] == 0
    assert got[1004][0][1] == "en" and [x[1] for x in got[1005]] == ["de", "de"]
    assert got[None][0][0] is False and got[None][0][1] == "en"
    assert got[1006][0][1] in ("en", "de") and got[1006][0][2] == 0
    assert all(0 <= x[2] <= 1 for v in got.values() for x in v)
    assert all(v[0][0] == (zlib.crc32(str(k).encode()) % 4 == 2) for k, v in got.items() if k is not None)


def test_held_out_labels_are_not_learned(docs):
    rows = [(i, EN, "held" if zlib.crc32(str(i).encode()) % 4 == 2 else "en") for i in range(40)]
    assert L.fit(docs(rows)).langs == ["en"]
    assert L.fit(docs([(1, EN, None), (None, EN, "en")])).langs == []
    nothing = L.predict(docs(rows[:2]), L.fit(docs([])))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


def test_filters_return_all_languages_and_correct_false_positives():
    rnd = np.random.default_rng(1)
    members = [rnd.integers(0, 1 << 62, 400).astype(np.uint64) for _ in range(70)]
    members[65] = np.concatenate([members[65], members[3]])
    filters = L.Filters.build([f"l{i}" for i in range(70)], members, 12)
    found = filters.lookup(members[3])
    assert ((found[:, 0] >> np.uint64(3)) & np.uint64(1)).all() and ((found[:, 1] >> np.uint64(1)) & np.uint64(1)).all()
    other = rnd.integers(0, 1 << 62, 20000).astype(np.uint64)
    seen = (filters.lookup(other)[:, 0] & np.uint64(1)).mean()
    assert abs(seen - filters.false_rate[0]) < 0.01


def test_grams_do_not_cross_texts():
    hashes, text = L.grams([b"ab", b"", b"12", b"cd e", "É".encode()])
    assert [int((text == i).sum()) for i in range(5)] == [2, 0, 0, 4, 1]
    single = [L.grams([t])[0].tolist() for t in (b"ab", b"cd e", "é".encode())]
    assert hashes[text == 0].tolist() == single[0] and hashes[text == 3].tolist() == single[1]
    assert hashes[text == 4].tolist() == single[2]


def test_long_texts_give_the_same_grams_in_blocks():
    text = ("Über  den 1,2 Fluß; " * 50 + "日本語" + "x" * 40 + " -- ").encode()
    want = L.grams([text])[0].tolist()
    for block in (1, 2, 7, 100, 10000):
        assert [int(h) for part in L.long_grams(text, block=block) for h in part] == want
    filters = L.Filters.build(["a"], [L.grams([text])[0]])
    old, L.LONG = L.LONG, 64
    try:
        hits, total = filters.corrected([b"zz", text, b"", text])
    finally:
        L.LONG = old
    assert total.tolist() == [2, len(want), 0, len(want)] and hits[1, 0] == hits[3, 0] > 0.99 * len(want)


def test_a_language_with_flat_frequencies_is_not_rejected(docs):
    r = np.random.default_rng(3)
    signs = lambda n: "".join(map(chr, r.integers(0x4E00, 0x9F00, n)))
    pool = [signs(6) for _ in range(100)]
    flat = lambda: "".join(pool[r.integers(100)] if r.random() < .25 else signs(6) for _ in range(100))
    rows = [*TEXTS, *[(100 + i, flat(), "zz") for i in range(60)]]
    strange = [(500, "".join(map(chr, r.integers(0xAC00, 0xD700, 600))), None), (501, "qzx vkj wqx zvq kxj " * 20, None)]
    kept = L.accepted(docs(rows + strange), L.fit(docs(rows)))
    assert {x.doc_id for x in kept.collect()} == {d for d, _, _ in rows}
