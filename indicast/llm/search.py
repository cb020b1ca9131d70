"""Ranked lexical search: hybrid term-at-a-time and document-at-a-time.

Terms are maximal stretches of digits, letters and non-ASCII characters, A-Z
lower-cased. The score is BM25 with k1 = 1.2 and b = 0.75 in whole numbers: with
N documents that hold a term, L terms in them, n terms in one document, df
documents with a term and tf occurrences of it in the document, a term's weight
is ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and it adds
``w * ((10**9 * tf) div (1000 * tf + 8 * m))``, ``m = 25 + (75 * n * N) div L``,
for every time the item has it.

1. ``build``: each task turns its documents into segments of about
   ``SEGMENT_BYTES`` of text, each an inverted index of its own: terms in order of
   their hashes, and for each term the documents' places and frequencies. The
   index is a Parquet table; nothing is shuffled.
2. ``search``: items come in blocks of about ``BLOCK_WORDS`` words, which are
   broadcast. One pass over the terms of the segments sums the block's document
   frequencies, one pass ranks. A task holds one segment at a time, and for
   each item the best ``k`` documents so far, whose last score is the bar.
3. An item on a segment (:class:`Segment`): its posting lists go from short to
   long. Short lists, up to ``ACCUMULATE`` postings together (more where there are few documents), are taken
   term at a time: their scores are summed in accumulators, which become one list
   in document order, bounded by the largest sum. This list and the long lists,
   each bounded by its largest score, are then taken document at a time, ``STEP``
   documents a step: the lists whose bounds together stay under the bar cannot
   bring in a document, so only the others are walked; documents under the bar
   with all that may be added are dropped, and the lists that were not walked are
   searched for the rest only, the highest bound first. After every step the bar rises.
   A step in which the walked lists end is the last.

No document that could be among the first ``k`` is ever dropped: bounds are
compared strictly, so equal scores are settled by the order of ids.

Memory: a segment and an item's accumulators (8 bytes a document of the segment).
A text past ``SEGMENT_BYTES`` is a segment of its own and takes about 25 times its bytes.

Edge cases: null and empty texts hold no term and are not counted; items without
a term the documents have give no rows; repeated rows are documents of their own and
repeated items are ranked each; documents of equal score are ranked by id, null
last; other columns are ignored; empty tables give an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from indicast.llm.common import Shelf, blobs, chunks
from indicast.llm.wordhash import Words

SEGMENT_BYTES = 16 << 20
BLOCK_WORDS = 200_000
ACCUMULATE = 4096
STEP = 4096
TOP = 10
NO_ID = (1 << 63) - 1  # after all others
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_INDEX = ("n_docs long, n_terms long, doc_ids binary, sizes binary, terms binary, first binary, "
          "docs binary, counts binary")


def terms_of(texts: list[bytes]) -> Words:
    return Words([t.translate(_TABLE) for t in texts])


def postings(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``term, doc, count`` of the texts, by term and then text."""
    hashes = words.hashes()
    doc = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    order = np.argsort(hashes, kind="stable")
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return hashes[at], doc[at], np.diff(np.append(at, len(hashes)))


def _segment(parts: list, ids: list, sizes: list) -> pa.RecordBatch:
    term, doc, count = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(term, kind="stable")  # the parts follow each other in document order
    term, doc, count = term[order], doc[order], count[order]
    new = np.ones(len(term), bool)
    new[1:] = term[1:] != term[:-1]
    at = np.flatnonzero(new)
    columns = [term[at], np.append(at, len(term)).astype("<u4"), doc.astype("<u4"), count.astype("<u4")]
    sizes = np.concatenate(sizes)
    return pa.RecordBatch.from_arrays(
        [pa.array([np.count_nonzero(sizes)], pa.int64()), pa.array([sizes.sum()], pa.int64()),
         *(pa.array([c.tobytes()], pa.binary()) for c in (np.array(ids, "<i8"), sizes.astype("<u4"), *columns))],
        [f.split()[0] for f in _INDEX.split(", ")])


def _index(segment_bytes: int):
    def run(batches):
        parts, ids, sizes, held = [], [], [], 0
        for part in chunks(batches, "text"):
            texts = blobs(part.column("text"))
            words = terms_of(texts)
            term, doc, count = postings(words)
            parts.append((term, doc + len(ids), count))
            sizes.append(np.diff(words.first))
            ids += part.column("id").to_pylist()
            held += sum(map(len, texts))
            if held >= segment_bytes:
                yield _segment(parts, ids, sizes)
                parts, ids, sizes, held = [], [], [], 0
        if ids:
            yield _segment(parts, ids, sizes)
    return run


def build(docs: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """The index of ``docs(doc_id, text)``: one row per segment, written to the shared folder."""
    own = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("id"),
                      F.col("text").cast("binary").alias("text"))
    return Shelf(docs.sparkSession, "search").keep(own.mapInArrow(_index(segment_bytes), _INDEX), "index")


@dataclass
class Block:
    """A block of items: each item's terms (places in the vocabulary) and how often it has them."""

    item_ids: list
    vocabulary: np.ndarray
    terms: list[np.ndarray]
    times: list[np.ndarray]
    weights: np.ndarray | None = None
    n_docs: int = 0
    n_terms: int = 0

    @classmethod
    def of(cls, item_ids: list, texts: list[bytes]) -> Block:
        words = terms_of(texts)
        vocabulary, place = np.unique(words.hashes(), return_inverse=True)
        found = [np.unique(place[a:b], return_counts=True) for a, b in zip(words.first[:-1], words.first[1:])]
        return cls(item_ids, vocabulary, [t for t, _ in found], [n for _, n in found])

    def weigh(self, found_in: np.ndarray, n_docs: int, n_terms: int) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in found_in],
                                np.int64)


class Best:
    """The best ``k`` documents of an item so far, and the score that a further one has to reach."""

    def __init__(self, k: int):
        self.k, self.bar = k, 1
        self.scores = self.ids = np.empty(0, np.int64)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.bar = int(self.scores[-1])


class Segment:
    """One segment as far as a block's vocabulary goes: for each of its terms the
    documents that hold it, in order, and what one occurrence in an item adds."""

    def __init__(self, row: dict, block: Block):
        self.ids = np.frombuffer(row["doc_ids"], "<i8")
        sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
        terms, first = np.frombuffer(row["terms"], "<u8"), np.frombuffer(row["first"], "<u4")
        docs, counts = np.frombuffer(row["docs"], "<u4"), np.frombuffer(row["counts"], "<u4")
        at = np.minimum(np.searchsorted(terms, block.vocabulary), max(len(terms) - 1, 0))
        there = terms[at] == block.vocabulary if len(terms) else np.zeros(len(at), bool)
        m = 25 + (75 * sizes * block.n_docs) // max(block.n_terms, 1)
        self.most = max(ACCUMULATE, len(self.ids) // 4)  # postings that are summed term at a time
        self.lists: list = [None] * len(at)
        for term in np.flatnonzero(there).tolist():
            low, high = first[at[term]], first[at[term] + 1]
            where, tf = docs[low:high].astype(np.int64), counts[low:high].astype(np.int64)
            gain = block.weights[term] * (10**9 * tf // (1000 * tf + 8 * m[where]))
            self.lists[term] = where, gain, int(gain.max())

    def rank(self, terms: np.ndarray, times: np.ndarray, best: Best) -> None:
        """Enter the segment's documents into ``best`` for one item."""
        lists = sorted(((*self.lists[t], n) for t, n in zip(terms.tolist(), times.tolist()) if self.lists[t]),
                       key=lambda x: len(x[0]))
        if sum(top * n for _, _, top, n in lists) < best.bar:
            return
        # Term at a time: the short lists become one.
        held = short = 0
        while short < len(lists) and held + len(lists[short][0]) <= self.most:
            held += len(lists[short][0])
            short += 1
        walks = [(where, gain * n, top * n) for where, gain, top, n in lists[short:]]
        if short:
            where, place = np.unique(np.concatenate([x[0] for x in lists[:short]]), return_inverse=True)
            sums = np.zeros(len(where), np.int64)
            np.add.at(sums, place, np.concatenate([gain * n for _, gain, _, n in lists[:short]]))
            walks.append((where, sums, int(sums.max())))
        self._walk(sorted(walks, key=lambda x: -x[2]), best)

    def _walk(self, lists: list, best: Best) -> None:
        """Document at a time over lists in descending order of their bounds."""
        bounds = [top for _, _, top in lists]
        # What the lists from the i-th on can add together.
        left = np.append(np.cumsum(bounds[::-1])[::-1], 0).tolist()
        at = [0] * len(lists)
        begin = 0
        while begin < len(self.ids) and left[0] >= best.bar:
            walked = next(i for i in range(len(lists) + 1) if left[i] < best.bar)
            # Skip to the first document that one of the walked lists has.
            heads = [int(lists[i][0][at[i]]) for i in range(walked) if at[i] < len(lists[i][0])]
            if not heads:
                return
            begin = max(begin, min(heads))
            sums = np.zeros(min(STEP, len(self.ids) - begin), np.int64)
            for i in range(walked):
                where, gain, _ = lists[i]
                low = at[i] + int(np.searchsorted(where[at[i]:], begin))
                at[i] = low + int(np.searchsorted(where[low:], begin + len(sums)))
                sums[where[low:at[i]] - begin] += gain[low:at[i]]
            found = np.flatnonzero(sums)
            for i in range(walked, len(lists)):
                found = found[sums[found] + left[i] >= best.bar]
                if not len(found):
                    break
                where, gain, _ = lists[i]
                place = np.minimum(np.searchsorted(where, found + begin), len(where) - 1)
                sums[found] += np.where(where[place] == found + begin, gain[place], 0)
            found = found[sums[found] >= best.bar]
            if len(found):
                best.add(sums[found], self.ids[found + begin])
            begin += len(sums)


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The items in blocks of about ``block_words`` words, whatever their number."""
    items = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // (4 * block_words)))
    for i in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else items
        rows = sorted(own.collect(), key=lambda r: (r["item_id"] is not None, r["item_id"], r["text"]))
        block = Block.of([r["item_id"] for r in rows], [r["text"].encode() for r in rows])
        if len(block.vocabulary):
            yield block


def _frequencies(vocabulary):
    def run(batches):
        known, sums = vocabulary.value, np.zeros(len(vocabulary.value), np.int64)
        for batch in batches:
            for terms, first in zip(blobs(batch.column(0)), blobs(batch.column(1))):
                terms, n = np.frombuffer(terms, "<u8"), np.diff(np.frombuffer(first, "<u4").astype(np.int64))
                if len(terms):
                    at = np.minimum(np.searchsorted(terms, known), len(terms) - 1)
                    sums += np.where(terms[at] == known, n[at], 0)
        found = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums[found])], ["place", "n"])
    return run


def _rank(block, k: int):
    def run(batches):
        own = Block(**block.value)
        best = [Best(k) for _ in own.item_ids]
        for batch in batches:
            for row in batch.to_pylist():
                segment = Segment(row, own)
                for item, (terms, times) in enumerate(zip(own.terms, own.times)):
                    segment.rank(terms, times, best[item])
        sizes = [len(b.ids) for b in best]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(best)), sizes)),
                 pa.array(np.concatenate([b.ids for b in best])), pa.array(np.concatenate([b.scores for b in best]))],
                ["item", "doc_id", "score"])
    return run


def search(index: DataFrame, benchmark: DataFrame, k: int = TOP, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``item_id, rank, doc_id, score`` of each item's ``k`` best documents with a score above 0."""
    spark = index.sparkSession
    kind = benchmark.schema["item_id"].dataType.simpleString()
    out = spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    n_docs, n_terms, segments = index.agg(F.sum("n_docs"), F.sum("n_terms"), F.count("*")).first()
    if not n_terms:
        return out
    # Few segments a task: their rows are large, and a task returns k documents an item whatever it reads.
    tasks = max(1, -(-segments // max(1, (64 << 20) // SEGMENT_BYTES)), min(segments, spark.sparkContext.defaultParallelism))
    for block in blocks(benchmark, block_words):
        vocabulary = spark.sparkContext.broadcast(block.vocabulary)
        counted = index.select("terms", "first").mapInArrow(_frequencies(vocabulary), "place long, n long")
        found_in = np.zeros(len(block.vocabulary), np.int64)
        for place, n in counted.groupBy("place").agg(F.sum("n")).collect():  # bounded by the block's words
            found_in[place] = n
        block.weigh(found_in, n_docs, n_terms)
        shared = spark.sparkContext.broadcast(vars(block))
        names = spark.createDataFrame(list(enumerate(block.item_ids)), f"item long, item_id {kind}")
        ranked = index.drop("n_docs", "n_terms").coalesce(tasks).mapInArrow(
            _rank(shared, k), "item long, doc_id long, score long")
        order = W.partitionBy("item").orderBy(F.desc("score"), "doc_id")
        top = ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        out = out.union(top.join(F.broadcast(names), "item").select(
            "item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score"))
    return out


ORACLE = f"""
WITH words AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
size AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM size),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
           FROM tf, total GROUP BY term),
query AS (SELECT item_id, term, count(*) AS times FROM (
  SELECT item_id, translate(unnest(regexp_extract_all(text, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id,
    CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM query JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (doc_id), total
  GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0)
WHERE rank <= {TOP}
"""
