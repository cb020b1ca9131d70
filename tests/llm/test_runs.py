"""Periodic runs against brute force over all periods and places."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from indicast.llm import runs as R


def slow_runs(words):
    """Every run by the definition, with no use of blocks or hashes."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            low, high, i = i, j + q, j + 1
            smaller = any(all(words[x] == words[x + p] for x in range(low, high - p)) for p in range(1, q))
            if high - low >= max(6, 4 * q) and not smaller:
                out.append((low, high - low, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_row(doc_id, text):
    """The contract's row, step by step."""
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", text or "") if w]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = slow_runs(words)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    milli = 1000 * best[1] // best[2] if found else None
    return (doc_id, len(found), *best, milli, sha("".join(f"{s},{size},{q}\n" for s, size, q in found)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def patterned(rng, n):
    words = []
    while len(words) < n:
        unit = [str(rng.randrange(rng.choice([1, 2, 3, 60]))) for _ in range(rng.randint(1, 12))]
        words += [unit[i % len(unit)] for i in range(rng.randint(0, 6 * len(unit)))]
        words += [str(rng.randrange(3)) for _ in range(rng.randint(0, 4))]
    return words


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_brute_force(run):
    rng = random.Random(5)
    joins = [" ", "\n", " \t ", "\r\n"]
    rows = [(i, rng.choice(joins).join(patterned(rng, rng.randint(0, 70)))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, " \n"), (403, "x " * 6), (404, "x " * 5), (405, "Ünï cödé " * 9), (406, "one")]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 10
    got = run("op11_runs", rows, COLUMNS)
    assert got == sorted(slow_row(*r) for r in rows)
    assert sum(r[1] > 0 for r in got) > 100


@pytest.mark.parametrize("piece", [1, 3, 7, 64, R.PIECE])
def test_appending_in_pieces_gives_the_same_runs(piece, monkeypatch):
    monkeypatch.setattr(R, "PIECE", piece)
    rng = random.Random(piece)
    for _ in range(60):
        texts = [patterned(rng, rng.randint(0, 90)) for _ in range(rng.randint(1, 4))]
        got = [list(zip(*found[1:])) for found in R.runs_of([" ".join(t).encode() for t in texts])]
        assert got == [slow_runs(t) for t in texts]


def test_runs_of_every_length_and_period():
    for q in [1, 2, 3, 4, 5, 6, 7, 8, 13, 14, 15, 16, 17, 30, 31, 33]:
        unit = [f"u{i}" for i in range(q)]
        for size in range(max(6, 4 * q) - 1, 4 * q + 3 * q // 2):
            words = ["a", "b", *[unit[i % q] for i in range(size)], "c"]
            found = list(zip(*next(R.runs_of([" ".join(words).encode()]))[1:]))
            assert found == ([(2, size, q)] if size >= max(6, 4 * q) else []), (q, size)


def test_long_periodic_text_has_one_run():
    # A text past one piece, whose every period's multiples repeat too.
    (n, start, length, period), = R.runs_of([b"a b a " * 100_000])
    assert (n, start, length, period) == (300_000, [0], [300_000], [3])
    thue_morse = " ".join("ab"[bin(i).count("1") % 2] for i in range(1 << 15))
    assert next(R.runs_of([thue_morse.encode()]))[1] == []  # no cube, though linear hashes would collide


def test_runs_do_not_reach_across_texts(docs):
    rows = docs([(1, "x x x"), (2, "x x x"), (3, "x x x x x x")]).coalesce(1)
    found = {r.doc_id: [tuple(x) for x in r.runs] for r in R.find_runs(rows).collect()}
    assert found == {1: [], 2: [], 3: [(0, 6, 1)]}


def test_repeated_rows_null_ids_extra_columns_and_empty_tables(docs):
    base = docs([(1, "y " * 8), (1, "y " * 8), (None, "z " * 7)])
    clash = base.withColumns({"runs": F.lit(1), "n_words": F.lit("x"), "collapsed": F.lit(None), "__a": F.lit(2)})
    found = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in R.find_runs(clash).collect()]
    assert sorted(found, key=str) == [(1, 8, [(0, 8, 1)], "y"), (1, 8, [(0, 8, 1)], "y"), (None, 7, [(0, 7, 1)], "z")]
    assert R.with_echoes(clash).columns == ["doc_id", "text"]
    assert R.digest(R.find_runs(R.with_echoes(docs([])))).collect() == []
