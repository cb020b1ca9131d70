import hashlib
import random
import re
from collections import Counter

import pytest

from indicast.llm import substring_dedup as S

COLUMNS = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def brute(rows, width=35):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - width + 1) if seen[tuple(w[i:i + width])] > 1 for j in range(i, i + width)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


def corpus(seed=1, n=60):
    rnd = random.Random(seed)
    text = lambda k: [rnd.choice(["über", "a", "b", "the"]) + str(rnd.randrange(400)) for _ in range(k)]
    shared = [text(rnd.randrange(30, 120)) for _ in range(6)]
    rows = []
    for i in range(n):
        w = text(rnd.randrange(0, 150))
        for _ in range(rnd.randrange(3)):
            s, at = rnd.choice(shared), rnd.randrange(len(w) + 1)
            cut = rnd.randrange(len(s))
            w[at:at] = s[:cut] if rnd.random() < .5 else s[cut:]
        rows.append((i, rnd.choice([" ", "\n", " \t"]).join(w)))
    return rows


EDGES = [(None, "x " * 40), (None, None), (900, None), (901, ""), (902, " \n\t "), (903, "same " * 36),
         (904, " ".join(f"q{i}" for i in range(35))), (904, " ".join(f"q{i}" for i in range(35))),
         (905, " ".join(f"q{i}" for i in range(34))), (906, " ".join(f"q{i}" for i in range(40))),
         (907, " ".join(f"r{i % 50}" for i in range(9000)))]


def test_query_against_brute_force(run):
    rows = corpus() + EDGES
    assert run("op3_substring_dedup", rows, COLUMNS) == brute(rows)


@pytest.mark.parametrize("width,log2", [(35, 4), (3, 26), (9, 8)])
def test_widths_and_overloaded_sketch(docs, width, log2):
    rows = corpus(2, 30)
    out = S.substring_dedup(docs(rows), width, log2).collect()
    got = sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in out)
    assert got == brute(rows, width)


def test_copies_fall_whole_and_empty_table(docs, run):
    text = " ".join(f"w{i}" for i in range(300))
    near = text.replace("w150 ", "edited ")
    rows = [(i, text) for i in range(50)] + [(i, near) for i in range(50, 52)] + [(99, text.replace("w9 ", "other "))]
    assert run("op3_substring_dedup", rows, COLUMNS) == brute(rows)
    assert S.substring_dedup(docs([])).count() == 0


def test_clashing_extra_columns(docs):
    from pyspark.sql import functions as F
    df = docs([(1, "a b")]).withColumns({"k1": F.lit("x"), "anchor": F.lit(1), "n_words": F.lit(5)})
    assert S.substring_dedup(df).collect()[0].asDict() == {"doc_id": 1, "kept_text": "a b", "n_words": 2, "n_removed": 0}


def test_sketch_grows_with_the_text_and_stays_selective(docs):
    import numpy as np

    from indicast.llm.wordhash import Words
    sizes = [S.sketch_width(docs([(i, "a b\tc\n " * n) for i in range(20)])) for n in (1, 10_000, 40_000)]
    assert sizes[0] == S.MIN_WIDTH_LOG2 and sizes[2] == sizes[1] + 2
    assert S.sketch_width(docs([])) == S.MIN_WIDTH_LOG2 == S.sketch_width(docs([(1, None)]))
    text = " ".join(f"u{i}" for i in range(400_000))
    log2 = S.sketch_width(docs([(1, text)]))
    bits = S.repeated_cells(docs([(1, text)]), S.WIDTH, log2)
    anchors = np.unique(S.Segments(Words([text.encode()])).anchor)
    hit = np.ones(len(anchors), bool)
    for cell in S.cells(anchors, log2):
        hit &= (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
    assert hit.mean() < .2


def test_phrase_that_anchors_very_many_segments(docs, run):
    """Segments with one anchor: most single, some with windows in common."""
    from indicast.llm.wordhash import Words, windows
    words = [f"p{i}" for i in range(50_000)]
    at = int(windows(Words([" ".join(words).encode()]).hashes(), S.GRAM, 1).argmin())
    phrase, rows = words[at:at + S.GRAM], []
    for i in range(400):
        left, right = [f"l{i}x{j}" for j in range(40)], [f"r{i}x{j}" for j in range(40)]
        if i % 40 == 0:
            right[:30] = [f"shared{j}" for j in range(30)]
        rows.append((i, " ".join(left + phrase + right)))
    segments = S.Segments(Words([t.encode() for _, t in rows]))
    assert max(Counter(segments.anchor.tolist()).values()) >= 390
    got = run("op3_substring_dedup", rows, COLUMNS)
    assert got == brute(rows) and sum(r[2] > 0 for r in got) == 10
