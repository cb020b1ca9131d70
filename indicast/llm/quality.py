"""Quality rules: fixed base rules, and gradient-boosted trees over document statistics.

The statistics of a text are counted in numpy for many texts at once. The trees
are fitted to at most (an expected) ``SAMPLE_ROWS`` distinct rows of the quality labels, and
the flat node arrays are broadcast to score all documents. Rates of symbols,
repetition, repeated lines, bars, exclamation marks and capitals can only lower
the verdict, distinct words can only raise it, whatever the labels say.

A document is kept if the base rules do not fail it and the trees give it a
probability of good quality of at least ``THRESHOLD``.

Edge cases: a null or empty text has no words and fails the base rules; labels
that are null or whose document is missing are not learned from; a label counts once
however often it is repeated, an id with both labels counts for both, and of several texts
under one id one is learned from; a score of exactly ``THRESHOLD`` is kept; with nothing to learn
from, only the base rules decide; repeated rows repeat; other columns are ignored, whatever their
names; an empty table gives an empty result. A text is handed to numpy whole: it takes some 24 times its bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicast.llm import gbt
from indicast.llm.common import blobs, chunks
from indicast.llm.wordhash import U64, Words, mix, windows

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SAMPLE_ROWS = 20_000
THRESHOLD = 0.5
REPEAT_WIDTH = 3
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics the trees see, with their monotonic constraint on good quality.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_rate": -1, "bar_rate": -1, "mark_rate": -1, "capital_rate": -1,
    "digit_rate": 0, "stop_rate": 0, "line_words": 0, "dup_line_rate": -1, "repeat_rate": -1, "distinct_rate": 1,
}


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_CLASSES = {
    "symbols": _class(SYMBOLS), "bars": _class(b"|"), "marks": _class(b"!"), "digits": _class(b"0123456789"),
    "capitals": _class(bytes(range(65, 91))), "small": _class(bytes(range(97, 123))), "stops": _class(b".,;:?"),
    # First bytes of UTF-8 characters that are not white space.
    "chars": ~_class(bytes(range(0x80, 0xC0)) + b" \t\n\x0b\x0c\r"),
}


def statistics(texts: list[bytes]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of each text by name, and the features as columns of a matrix."""
    words, n = Words(texts), len(texts)
    length = np.fromiter(map(len, texts), np.int64, n)
    count: dict[str, np.ndarray] = {}
    for name, table in _CLASSES.items():
        at = np.flatnonzero(table[words.buf])
        count[name] = np.searchsorted(at, words.offset + length) - np.searchsorted(at, words.offset)
    n_words = np.diff(words.first)
    hashes = words.hashes()
    doc = np.repeat(np.arange(n), n_words)
    own = mix(hashes + doc.astype(U64) * U64(0xC2B2AE3D27D4EB4F), 31)
    distinct = np.bincount(doc[np.unique(own, return_index=True)[1]], minlength=n) if len(own) else np.zeros(n, int)
    covered = np.zeros(len(hashes) + 1, np.int64)
    if len(hashes) >= REPEAT_WIDTH:
        runs = windows(hashes, REPEAT_WIDTH, 4)
        inside = np.flatnonzero(doc[:len(runs)] == doc[REPEAT_WIDTH - 1:])
        key = mix(runs[inside] + doc[inside].astype(U64) * U64(0xC2B2AE3D27D4EB4F), 32)
        _, back, seen = np.unique(key, return_inverse=True, return_counts=True)
        twice = inside[seen[back] > 1]
        np.add.at(covered, twice, 1)
        np.add.at(covered, twice + REPEAT_WIDTH, -1)
    repeated = np.bincount(doc, weights=np.cumsum(covered)[:-1] > 0, minlength=n).astype(np.int64)
    lines = [[x for x in t.split(b"\n") if x and not x.isspace()] for t in texts]
    n_lines = np.fromiter(map(len, lines), np.int64, n)
    dups = n_lines - np.fromiter((len(set(x)) for x in lines), np.int64, n)
    counts = dict(zip(COUNTS, (n_words, count["chars"], count["symbols"], dups, repeated)))
    w, c, k = np.maximum(n_words, 1), np.maximum(count["chars"], 1), np.maximum(n_lines, 1)
    features = np.column_stack([
        np.log1p(n_words), count["chars"] / w, count["symbols"] / w, count["bars"] / w, count["marks"] / w,
        count["capitals"] / np.maximum(count["capitals"] + count["small"], 1), count["digits"] / c, count["stops"] / w,
        n_words / k, dups / k, repeated / w, distinct / w])
    return counts, features


def _statistics(batches):
    for part in chunks(batches, "text"):
        _, features = statistics(blobs(part.column("text")))
        yield pa.RecordBatch.from_arrays(
            [part.column("label")] + [pa.array(features[:, j]) for j in range(len(FEATURES))], ["label", *FEATURES])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> gbt.Trees:
    """Fit the trees to ``labels(doc_id, quality)`` over ``docs(doc_id, text)``."""
    # A label counts once however often it is repeated, and an id stands for one text.
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).select("doc_id", "quality").distinct()
    total = known.count()
    share = F.xxhash64("doc_id", "quality").bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    # sample_rows distinct rows on average; few enough to broadcast.
    sample = known.filter(share * total < sample_rows).select("doc_id", F.col("quality").cast("double").alias("label"))
    schema = "label double, " + ", ".join(f"{name} double" for name in FEATURES)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = (docs.select("doc_id", text.alias("text")).join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
            .select("label", "text").mapInArrow(_statistics, schema).toPandas())
    rows = rows.sort_values(list(rows.columns))  # the fit does not depend on the order of partitions
    return gbt.fit(rows[list(FEATURES)].to_numpy(), rows["label"].to_numpy(), list(FEATURES.values()))


def _score(model):
    def run(batches):
        trees = gbt.Trees(**model.value)
        for part in chunks(batches, "text"):
            counts, features = statistics(blobs(part.column("text")))
            rest = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in rest] + [pa.array(counts[c], pa.int64()) for c in COUNTS]
                + [pa.array(trees.probability(features) if len(trees.roots) else np.ones(len(features)))],
                [*rest, *COUNTS, "quality_score"])
    return run


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, trees: gbt.Trees, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, the counts, ``quality_score``, ``base_failed`` and ``kept`` of every row."""
    model = docs.sparkSession.sparkContext.broadcast(vars(trees))  # a few hundred nodes
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", quality_score double"
    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return (own.mapInArrow(_score(model), schema).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality_score") >= threshold)))
