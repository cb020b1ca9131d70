"""Substring dedup: remove every word covered by a window of ``width``
consecutive words whose word sequence also starts anywhere else.

1. Each window has an anchor: the leftmost of its ``GRAM``-word grams with the
   smallest hash. Equal windows have equal anchors, so the number of
   occurrences of an anchor bounds a window's count from above. Every partition
   builds a count-min sketch of its anchors (the cells that are set, with their
   counts); the sketches are merged by summing cells.
2. The cells with a count of two or more are broadcast as bit sets of
   ``DEPTH * 2**width_log2 / 8`` bytes. The width follows from the input's
   bytes (two to four cells an anchor, if words take four bytes with the space
   behind) up to ``MAX_WIDTH_LOG2``, that is 256 MB, enough for some 30 GB of
   text. An overloaded sketch lets more windows through and loses none.
3. The second pass takes the windows estimated repeated. Consecutive windows
   with one anchor travel as one segment. Segments are grouped exactly; a
   segment that occurs twice has only repeated windows. Where an anchor also
   has segments that occur once, the distinct segments of that anchor are
   unfolded into windows and those are grouped exactly. The join that finds
   them deals an anchor's segments to ``SALTS`` places, since a common phrase
   may anchor very many different segments.
4. The covered positions go back to the documents by row key.

A window is compared by 128 bits (its anchor's hash and its own). No group is
collected: all grouping is by partial aggregates, and what is listed per
document or segment is bounded by that document's length or by ``width``.

Edge cases: a null or empty text, or one of fewer than ``width`` words, has no
window and keeps all its words; repeated rows are repeats of one another;
a null id is a document like any other; an empty table gives an empty result.
A very long text is held whole by its task (some 20 times its bytes). Columns
other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicast.llm.common import Shelf, blobs, chunks, row_key
from indicast.llm.wordhash import Tables, U64, Words, mix, range_sums, windows

WIDTH = 35
GRAM = 8
DEPTH = 2
MIN_WIDTH_LOG2, MAX_WIDTH_LOG2 = 16, 30
SALTS = 16


def sketch_width(docs: DataFrame, width: int = WIDTH) -> int:
    """``width_log2`` of a sketch with two to four cells for each anchor that
    ``docs`` can be expected to have, within the bounds above.

    Four bytes are taken for a word and its space; shorter words only load the
    sketch more. Of all windows, two in ``width - gram + 2`` begin a new anchor."""
    words = (docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0) / 4
    anchors = 2 * words / (width - min(GRAM, width) + 2)
    return min(max(math.ceil(math.log2(2 * anchors + 1)), MIN_WIDTH_LOG2), MAX_WIDTH_LOG2)


def cells(anchors: np.ndarray, width_log2: int) -> list[np.ndarray]:
    """The sketch cell of each anchor in each row of the sketch."""
    width = 1 << width_log2
    return [(mix(anchors, 11 + r) & U64(width - 1)).astype(np.int64) + r * width for r in range(DEPTH)]


class Segments:
    """Runs of consecutive windows with one anchor, over the words of many texts."""

    def __init__(self, words: Words, width: int = WIDTH):
        hashes = words.hashes()
        gram = min(GRAM, width)
        doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
        self.hashes = hashes
        n = len(hashes) - width + 1
        if n <= 0:
            self.start = self.size = self.doc = np.empty(0, np.int64)
            self.anchor = np.empty(0, U64)
            return
        grams = windows(hashes, gram, 1)
        best = smallest(grams, width - gram + 1)
        inside = np.flatnonzero(doc[:n] == doc[width - 1:])
        place = best[inside]
        new = np.ones(len(inside), bool)
        new[1:] = (place[1:] != place[:-1]) | (np.diff(inside) != 1)
        at = np.flatnonzero(new)
        self.start = inside[at]
        self.size = np.diff(np.append(at, len(inside)))
        self.anchor = grams[place[at]]
        self.doc = doc[self.start]
        self.width = width


def smallest(values: np.ndarray, span: int) -> np.ndarray:
    """Index of the leftmost smallest of every ``span`` consecutive values."""
    n = len(values) - span + 1
    best, size = np.arange(len(values)), 1
    while size * 2 <= span:
        left, right = best[:-size], best[size:]
        best = np.where(values[right] < values[left], right, left)
        size *= 2
    left, right = best[:n], best[span - size:span - size + n]
    return np.where(values[right] < values[left], right, left)


def _sketch(width: int, width_log2: int):
    def run(batches):
        for part in chunks(batches, "text"):
            seg = Segments(Words(blobs(part.column("text"))), width)
            found, counts = np.unique(np.concatenate(cells(seg.anchor, width_log2)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(counts, pa.int64())], ["cell", "n"])
    return run


def repeated_cells(docs: DataFrame, width: int, width_log2: int) -> np.ndarray:
    """Bit set over all sketch cells: those whose merged count is at least two."""
    merged = (docs.select(F.col("text").cast("binary").alias("text"))
              .mapInArrow(_sketch(width, width_log2), "cell long, n long")
              .groupBy("cell").agg(F.sum("n").alias("n")).filter("n > 1").select((F.col("cell") + 1).alias("cell")))
    maps = (merged.groupBy(F.bitmap_bucket_number("cell").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("cell")).alias("bits")).collect())
    out = np.zeros((DEPTH << width_log2) // 8 + 4096, np.uint8)
    for bucket, bits in maps:
        out[(bucket - 1) * 4096:bucket * 4096] = np.frombuffer(bits, np.uint8)
    return out


SEGMENT = "k1 long, k2 long, start int, size int, anchor long, seg long, wins binary"


def _candidates(width: int, width_log2: int, repeated):
    def run(batches):
        bits = repeated.value
        tables = Tables()
        for part in chunks(batches, "text"):
            words = Words(blobs(part.column("text")))
            seg = Segments(words, width)
            keep = np.ones(len(seg.start), bool)
            for cell in cells(seg.anchor, width_log2):
                keep &= (bits[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1 == 1
            start, size, doc = seg.start[keep], seg.size[keep], seg.doc[keep]
            if not len(start):
                continue
            own = windows(seg.hashes, width, 2)
            stop = start + size
            whole = mix(range_sums(mix(seg.hashes, 5), start, stop + width - 1, tables) ^ size.astype(U64), 3)
            flat = np.repeat(start - np.concatenate(([0], np.cumsum(size)))[:-1], size) + np.arange(size.sum())
            offsets = np.concatenate(([0], np.cumsum(size * 8))).astype(np.int32)
            wins = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(own[flat])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.asarray(part.column("k1"))[doc]), pa.array(np.asarray(part.column("k2"))[doc]),
                 pa.array((start - words.first[doc]).astype(np.int32)), pa.array(size.astype(np.int32)),
                 pa.array(seg.anchor[keep].view(np.int64)), pa.array(whole.view(np.int64)), wins],
                ["k1", "k2", "start", "size", "anchor", "seg", "wins"])
    return run


def _unfold(batches):
    """One row per window of each segment."""
    for b in batches:
        sizes = np.asarray(b.column("size")).astype(np.int64)
        wins = np.frombuffer(b"".join(b.column("wins").to_pylist()), np.int64)
        row = np.repeat(np.arange(b.num_rows), sizes)
        nth = np.arange(len(row)) - np.repeat(np.concatenate(([0], np.cumsum(sizes)))[:-1], sizes)
        take = lambda name: b.column(name).take(pa.array(row))
        yield pa.RecordBatch.from_arrays(
            [take("anchor"), take("seg"), pa.array(nth.astype(np.int32)), pa.array(wins), take("copies")],
            ["anchor", "seg", "nth", "win", "copies"])


def _salted_semi(left: DataFrame, right: DataFrame, keys: list[str], salt: Column) -> DataFrame:
    """Rows of ``left`` with a partner in ``right``; rows of one key are dealt
    to ``SALTS`` places by ``salt``, a copy of the partner to each."""
    places = F.explode(F.array(*[F.lit(i) for i in range(SALTS)]))
    dealt = left.withColumn("salt", F.pmod(salt, F.lit(SALTS)).cast("int"))
    return dealt.join(right.select(*keys, places.alias("salt")), [*keys, "salt"], "left_semi").drop("salt")


def covered(docs: DataFrame, shelf: Shelf, width: int = WIDTH, width_log2: int | None = None) -> DataFrame:
    """Per row key: the starts of its repeated windows, as ``spots`` of a
    first position and a bit for each of up to ``width`` positions from it."""
    spark = docs.sparkSession
    if width_log2 is None:
        width_log2 = sketch_width(docs, width)
    keyed = docs.select(*row_key(), F.col("text").cast("binary").alias("text"))
    bits = spark.sparkContext.broadcast(repeated_cells(docs, width, width_log2))
    found = shelf.keep(keyed.mapInArrow(_candidates(width, width_log2, bits), SEGMENT), "segments")
    distinct = shelf.keep(found.groupBy("anchor", "seg").agg(
        F.count("*").alias("copies"), F.first("size").alias("size"), F.first("wins").alias("wins")), "distinct")
    mixed = (distinct.groupBy("anchor").agg(F.count("*").alias("n"), F.min("copies").alias("least"))
             .filter("n > 1 and least = 1").select("anchor"))
    single = _salted_semi(distinct, mixed, ["anchor"], F.col("seg")).mapInArrow(
        _unfold, "anchor long, seg long, nth int, win long, copies long")
    single = shelf.keep(single, "windows")
    twice = single.groupBy("anchor", "win").agg(F.sum("copies").alias("n")).filter("n > 1").select("anchor", "win")
    partly = (single.filter("copies = 1").join(twice, ["anchor", "win"], "left_semi")
              .groupBy("anchor", "seg").agg(F.bit_or(F.expr("shiftleft(1L, nth)")).alias("mask")))
    whole = distinct.filter("copies > 1").select("anchor", "seg", F.expr("shiftleft(1L, size) - 1").alias("mask"))
    spots = (found.select("k1", "k2", "start", "anchor", "seg").join(whole.unionByName(partly), ["anchor", "seg"])
             .groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "mask")).alias("spots")))
    spots = shelf.keep(spots, "spots")
    for name in ("segments", "distinct", "windows"):  # no later step reads them
        shelf.drop(name)
    return spots


def _strip(width: int):
    def run(batches):
        for part in chunks(batches, "text"):
            texts = blobs(part.column("text"))
            words = Words(texts)
            spots, kept, total, removed = part.column("spots").to_pylist(), [], [], []
            for i in range(len(texts)):
                low, high = words.first[i], words.first[i + 1]
                gone = np.zeros(high - low + 1, np.int64)
                if spots[i]:
                    start = np.array([s["start"] for s in spots[i]])
                    mask = np.array([s["mask"] for s in spots[i]])
                    for bit in range(width):
                        at = start[(mask >> bit) & 1 == 1] + bit
                        np.add.at(gone, at, 1)
                        np.add.at(gone, at + width, -1)
                stay = np.cumsum(gone)[:-1] == 0
                a, b = words.start[low:high][stay].tolist(), words.end[low:high][stay].tolist()
                kept.append(b" ".join([words.raw[s:e] for s, e in zip(a, b)]))
                total.append(high - low)
                removed.append(high - low - len(a))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array(total, pa.int64()), pa.array(removed, pa.int64())],
                ["doc_id", "kept_text", "n_words", "n_removed"])
    return run


def substring_dedup(docs: DataFrame, width: int = WIDTH, width_log2: int | None = None) -> DataFrame:
    """``doc_id, kept_text, n_words, n_removed`` for every row of ``docs(doc_id, text)``."""
    if not 1 < width < 64:
        raise ValueError("width must lie between 2 and 63")
    docs = docs.select("doc_id", "text")
    spots = covered(docs, Shelf(docs.sparkSession, "substring"), width, width_log2)
    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"), *row_key())
    # Long documents need no cap: a row's list is bounded by its own length.
    joined = own.join(spots, ["k1", "k2"], "left").select("doc_id", "text", "spots")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(_strip(width), f"doc_id {kind}, kept_text string, n_words long, n_removed long")
