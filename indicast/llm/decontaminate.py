"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased and parted at everything but letters, digits and other
non-ASCII characters, so case and punctuation do not matter.

1. The benchmark is taken in blocks of about ``BLOCK_WORDS`` words, chosen by a
   hash of the item; a block is small enough to broadcast, and each block meets
   all documents. All documents' words are counted, as far as the block has them.
2. Seeds are the block's ``GRAM``-word grams that are rare: by their words'
   frequencies one expects fewer than one in the whole corpus by chance. (That
   rests on single words, so a passage copied a million times keeps its seeds.)
   Whatever the size of the corpus, the most telling gram of every ``STRETCH``
   grams is one too, and an item has ``LEAST_SEEDS`` at least. Of an item of three
   to ``SHORT`` words every gram is a seed, and from ``LEAST_SHORT`` to under
   ``PAIRS`` words every pair of words, so that a copy with ``EDITS`` words
   replaced always has one.
3. Where a document has a seed, the stretch around it that the item could cover
   is aligned with the item, word by word: ``MATCH`` for equal words, ``MISS``
   and ``GAP`` otherwise. A document is contaminated by an item if the best
   local alignment reaches ``SHARE`` of the item's full score, or the score of
   ``LONG_RUN`` equal words. Against chance, a score below that of ``SHORT_RUN``
   equal words and of ``NEARLY_ALL`` of the item counts only if no more than
   ``EDITS`` words' worth of it is missing (and at least ``HALF`` is there) and the
   equal words carry ``TELLING`` bits of information, less ``EDIT_BITS`` for every
   edit. A word's bits come from its share of the corpus' words, ``UNREAD`` further
   words assumed, so the bar does not rise with the size of the input.

Documents are scanned where they lie; nothing is shuffled but word counts.

Edge cases: null or empty texts and items match nothing; items of fewer than
``LEAST_SHORT`` words count only as a whole, those of one or two words only if they
are rarer than once in the corpus or carry ``TELLING`` bits; repeated rows and items each
give their own rows; a null id is returned as null; of alignments with equal scores the first one's
place is returned, and a score equal to the least that counts does count; other columns are ignored, whatever their
names; empty tables give an empty result. A text is normalised and hashed whole: it takes some 25 times its bytes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicast.llm.common import blobs, chunks
from indicast.llm.wordhash import U64, Words, mix, windows

GRAM = 3
BLOCK_WORDS = 2_000_000
LEAST_SEEDS = 8
STRETCH = 5
MATCH, MISS, GAP = 2, -1, -1
SHARE = 0.4
LONG_RUN = 25
SHORT_RUN, NEARLY_ALL = 10, 0.9
EDITS, HALF = 2, 0.5
TELLING, EDIT_BITS = 28, 3
UNREAD = 1 << 16
LEAST_SHORT, PAIRS, SHORT = 6, 9, 14
GAPS = (1, 2, 3)
FILTER_LOG2 = 22

_PLAIN = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_MARKS = re.compile("[\xa0\xa1\xab\xbb\xbf\u2000-\u206f\u3000-\u3003]")


def normal(raw: bytes) -> bytes:
    text = raw.decode("utf-8", "replace").lower()
    if not text.isascii():
        text = _MARKS.sub(" ", text)
    return text.encode().translate(_PLAIN)


@dataclass
class Block:
    """A block of items: the words of all items in a row, and the seeds."""

    item_ids: list
    words: np.ndarray
    first: np.ndarray
    vocabulary: np.ndarray
    seeds: np.ndarray | None = None  # sorted hashes
    seed_item: np.ndarray | None = None
    seed_at: np.ndarray | None = None  # position in the item
    sieve: np.ndarray | None = None
    pairs: np.ndarray | None = None  # the same for gapped pairs
    pair_item: np.ndarray | None = None
    pair_at: np.ndarray | None = None
    pair_sieve: np.ndarray | None = None
    copies: np.ndarray | None = None  # how often the benchmark has each item
    bits: np.ndarray | None = None  # information of each word of the items

    @classmethod
    def of(cls, item_ids: list, texts: list[bytes]) -> Block:
        words = Words([normal(t) for t in texts])
        hashes = words.hashes()
        return cls(item_ids, hashes, words.first, np.unique(hashes))

    def choose(self, counts: np.ndarray, total: int) -> None:
        """Choose the seeds; ``counts`` are the corpus counts of the vocabulary."""
        bits = -np.log2(np.maximum(counts, 0.5) / max(total, 1))
        at = np.searchsorted(self.vocabulary, self.words)
        own = bits[at]
        self.bits = -np.log2(np.maximum(counts, 0.5) / (total + UNREAD))[at]
        needed = np.log2(max(total, 2))
        hashes, items, places = [np.empty(0, U64)], [np.empty(0, int)], [np.empty(0, int)]
        pairs = [(np.empty(0, U64), np.empty(0, int), np.empty(0, int))]
        for i in range(len(self.item_ids)):
            low, high = self.first[i], self.first[i + 1]
            n = high - low
            if not n:
                continue
            size = gram_size(n)
            grams = gram_hashes(self.words[low:high], size)
            told = np.convolve(own[low:high], np.ones(size), "valid")
            rare = told >= needed
            if n < GRAM:
                rare[:] = self.bits[low:high].sum() >= min(needed, TELLING)
            elif n <= SHORT:
                rare[:] = True
            else:
                if rare.sum() < LEAST_SEEDS:
                    rare |= told >= np.sort(told)[-LEAST_SEEDS]
                for j in range(0, len(told), STRETCH):
                    rare[j + told[j:j + STRETCH].argmax()] = True
            at = np.flatnonzero(rare)
            hashes.append(grams[at])
            items.append(np.full(len(at), i))
            places.append(at)
            if n > SHORT:
                for gap in GAPS:
                    told = own[low:high - gap] + own[low + gap:high]
                    best = np.array([j + told[j:j + STRETCH].argmax() for j in range(0, len(told), STRETCH)])
                    pairs.append((pair_hashes(self.words[low:high], gap)[best], np.full(len(best), i), best))
        self.seeds, self.seed_item, self.seed_at, self.sieve = _sorted(*(np.concatenate(c) for c in (hashes, items, places)))
        self.pairs, self.pair_item, self.pair_at, self.pair_sieve = _sorted(*(np.concatenate(c) for c in zip(*pairs)))

    def sizes(self) -> list[int]:
        """The gram sizes in use."""
        return sorted({gram_size(int(n)) for n in np.diff(self.first) if n})


def _sorted(hashes: np.ndarray, items: np.ndarray, places: np.ndarray):
    """The seeds by hash, and a table of bits of at least 16 for each."""
    order = np.argsort(hashes, kind="stable")
    sieve = np.zeros(1 << max(FILTER_LOG2, int(16 * len(hashes)).bit_length()), bool)
    sieve[_slot(hashes, sieve)] = True
    return hashes[order], items[order], places[order], sieve


def _slot(hashes: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    return (hashes >> U64(65 - len(sieve).bit_length())).astype(np.int64)


def pair_hashes(words: np.ndarray, gap: int) -> np.ndarray:
    """Hash of every two words ``gap`` apart, the same for all gaps."""
    return mix(words[:-gap] * U64(0x9E3779B97F4A7C15) + words[gap:], 43) if len(words) > gap else np.empty(0, U64)


def gram_size(n: int) -> int:
    """Words of a seed of an item of ``n`` words."""
    return 2 if LEAST_SHORT <= n < PAIRS else min(GRAM, n)


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    return mix(windows(words, size, 6) + U64(size), 41)


def align(item: np.ndarray, text: np.ndarray, gains=None, miss=MISS, gap=GAP):
    """Score of the best local alignment and where it ends in ``text`` (exclusive).
    ``gains`` are the scores of the item's words, ``MATCH`` each if not given."""
    gains = np.full(len(item), MATCH) if gains is None else gains
    ramp = np.arange(1, len(text) + 1) * -gap
    row = np.zeros(len(text) + 1, gains.dtype)
    best, end = 0, 0
    for word, gain in zip(item, gains):
        step = row[:-1] + np.where(text == word, gain, miss)
        up = np.maximum(np.maximum(step, row[1:] + gap), 0)
        # A gap in the item: the best earlier cell less a gap for every step from it.
        row[1:] = np.maximum.accumulate(up + ramp) - ramp
        at = int(row.argmax())
        if row[at] > best:
            best, end = row[at].item(), at
    return best, end


def least(size: int) -> tuple[float, float]:
    """The least score that counts, and the least that counts however common the words are."""
    full = MATCH * size
    low = min(SHARE * full, LONG_RUN * MATCH)
    sure = max(low, min(NEARLY_ALL * full, SHORT_RUN * MATCH))
    if size < LEAST_SHORT:
        return sure, sure
    return min(sure, max(low, HALF * full, full - EDITS * (MATCH - MISS))), sure


def placed(item: np.ndarray, text: np.ndarray, bits: np.ndarray, rarest: bool = False) -> tuple[int, int, int]:
    """``score, start, end`` of the best alignment, or of the one with the most information."""
    by = (bits, -EDIT_BITS, -EDIT_BITS) if rarest else (None, MISS, GAP)
    score, end = align(item, text, *by)
    back = by[0][::-1] if rarest else None
    _, length = align(item[::-1], text[:end][::-1], back, *by[1:])
    return (align(item, text[end - length:end])[0] if rarest else score), end - length, end


def promising(item: np.ndarray, bits: np.ndarray, text: np.ndarray, begin: np.ndarray, width: int) -> np.ndarray:
    """The stretches of ``width`` words that hold enough of the item's words for an alignment that counts."""
    low, sure = least(len(item))
    order = np.argsort(item)
    at = order[np.minimum(np.searchsorted(item[order], text), len(item) - 1)]
    same = item[at] == text
    words = np.append(0, np.cumsum(same))
    told = np.append(0, np.cumsum(np.where(same, bits[at], 0)))
    first, last = np.clip(begin, 0, len(text)), np.clip(begin + width, 0, len(text))
    score = MATCH * (words[last] - words[first])
    return begin[(score >= sure) | ((score >= low) & (told[last] - told[first] >= TELLING - 1e-6))]


def found_in(item: np.ndarray, text: np.ndarray, bits: np.ndarray):
    """``score, start, end`` of the best alignment of an item with a stretch that contaminates it, or None."""
    low, sure = least(len(item))
    got = placed(item, text, bits)
    if got[0] >= sure:
        return got
    if low < sure and got[0] >= low:
        for score, start, end in (got, placed(item, text, bits, rarest=True)):
            if score >= low and align(item, text[start:end], bits, -EDIT_BITS, -EDIT_BITS)[0] >= TELLING:
                return score, start, end
    return None


def slack_of(size: int) -> int:
    """Words by which a copy of ``size`` words may begin earlier or end later than a seed tells."""
    return size // 4 + 5


def matches(block: Block, hashes: np.ndarray, item: np.ndarray, place: np.ndarray):
    """``item, score, start, end`` of the items that contaminate one document,
    given its word hashes and the places at which its seeds let items begin."""
    for i in np.unique(item):
        own = block.words[block.first[i]:block.first[i + 1]]
        size = len(own)
        slack = slack_of(size)
        begin = np.unique(place[item == i]) - slack
        bits = block.bits[block.first[i]:block.first[i + 1]]
        if size <= SHORT:
            begin = promising(own, bits, hashes, begin, size + 2 * slack)
        low = high = None
        best = (0, 0, 0)
        for b in [*begin.tolist(), None]:
            # The stretches of a short item are not joined: each is judged by its own best alignment.
            if low is not None and (b is None or b > high or size <= SHORT):
                lo, hi = max(low, 0), min(high, len(hashes))
                got = found_in(own, hashes[lo:hi], bits)
                if got and got[0] > best[0]:
                    best = (got[0], lo + got[1], lo + got[2])
                low = None
            if b is not None:
                low = b if low is None else low
                high = b + size + 2 * slack
        if best[0]:
            yield int(i), best[0] / (MATCH * size), best[1], best[2]


def _hits(grams: np.ndarray, reach: int, words: Words, seeds: np.ndarray, sieve: np.ndarray):
    """``document, place, seed`` of the grams that are seeds and lie within one document."""
    at = np.flatnonzero(sieve[_slot(grams, sieve)])
    first = np.searchsorted(seeds, grams[at], "left")
    n = np.searchsorted(seeds, grams[at], "right") - first
    place = np.repeat(at, n)
    seed = np.repeat(first - np.concatenate(([0], np.cumsum(n)))[:-1], n) + np.arange(n.sum())
    doc = np.searchsorted(words.first, place, "right") - 1
    inside = place + reach <= words.first[doc + 1]
    return doc[inside], place[inside], seed[inside]


def seeded(block: Block, words: Words, hashes: np.ndarray):
    """``document, item, begin``: where the seeds let items begin, in order of documents."""
    out = [(np.empty(0, int),) * 3]
    for size in block.sizes():
        if len(hashes) >= size:
            doc, place, seed = _hits(gram_hashes(hashes, size), size, words, block.seeds, block.sieve)
            out.append((doc, block.seed_item[seed], place - block.seed_at[seed]))
    pairs = [(np.empty(0, int),) * 4]
    for gap in GAPS if len(block.pairs) else ():
        if len(hashes) > gap:
            doc, place, seed = _hits(pair_hashes(hashes, gap), gap + 1, words, block.pairs, block.pair_sieve)
            pairs.append((doc, block.pair_item[seed], place - block.pair_at[seed], block.pair_at[seed]))
    doc, item, begin, at = (np.concatenate(c) for c in zip(*pairs))
    order = np.lexsort((begin, item, doc))
    doc, item, begin, at = doc[order], item[order], begin[order], at[order]
    # Two pairs of the item, at different places of it, that let it begin near one place.
    slack = slack_of(np.diff(block.first)[item])
    both = (doc[1:] == doc[:-1]) & (item[1:] == item[:-1]) & (begin[1:] - begin[:-1] <= slack[1:]) & (at[1:] != at[:-1])
    good = np.zeros(len(doc), bool)
    good[1:] |= both
    good[:-1] |= both
    out.append((doc[good], item[good], begin[good]))
    doc, item, begin = (np.concatenate(c) for c in zip(*out))
    order = np.argsort(doc, kind="stable")
    return doc[order], item[order], begin[order]


def find(block: Block, texts: list[bytes]):
    """For each text that some item contaminates: its index and its matches."""
    if not len(block.seeds):
        return
    words = Words([normal(t) for t in texts])
    hashes = words.hashes()
    doc, item, begin = seeded(block, words, hashes)
    for d in np.unique(doc):
        low, high = words.first[d], words.first[d + 1]
        mine = slice(*np.searchsorted(doc, [d, d + 1]))
        found = list(matches(block, hashes[low:high], item[mine], begin[mine] - low))
        if found:
            yield int(d), found


def _count(block):
    def run(batches):
        known = block.value
        for part in chunks(batches, "text"):
            hashes = Words([normal(t) for t in blobs(part.column("text"))]).hashes()
            at = np.minimum(np.searchsorted(known, hashes), max(len(known) - 1, 0))
            hit = at[known[at] == hashes] if len(known) else at[:0]
            place, n = np.unique(hit, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(place, -1)), pa.array(np.append(n, len(hashes)))], ["place", "n"])
    return run


def blocks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The benchmark's blocks, one after the other, with their seeds chosen by
    the counts over all of ``docs``; each comes as a broadcast."""
    spark = docs.sparkSession
    # An item that the benchmark repeats is taken once, with its number.
    items = benchmark.filter(F.col("text").isNotNull()).groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    spaces = F.sum(F.octet_length(F.col("text"))).alias("n")
    total = items.agg(spaces).first()["n"] or 0
    n = max(1, -(-total // (4 * block_words)))
    texts = docs.select(F.col("text").cast("binary").alias("text"))
    for i in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else items
        # About block_words words, whatever the size of the benchmark.
        rows = sorted(own.collect(), key=lambda r: (r["item_id"] is not None, r["item_id"], r["text"]))
        block = Block.of([r["item_id"] for r in rows], [r["text"].encode() for r in rows])
        block.copies = np.array([r["copies"] for r in rows], int)
        if not len(block.words):
            continue
        counted = texts.mapInArrow(_count(spark.sparkContext.broadcast(block.vocabulary)), "place long, n long")
        sums = {r["place"]: r["n"] for r in counted.groupBy("place").agg(F.sum("n").alias("n")).collect()}
        counts = np.zeros(len(block.vocabulary))
        for place, k in sums.items():
            if place >= 0:
                counts[place] = k
        block.choose(counts, sums.get(-1, 0))
        yield spark.sparkContext.broadcast(vars(block))


def _matches(block):
    def run(batches):
        own = Block(**block.value)
        for part in chunks(batches, "text"):
            ids = part.column("doc_id")
            rows = [(d, own.item_ids[i], score, lo, hi) for d, found in find(own, blobs(part.column("text")))
                    for i, score, lo, hi in found for _ in range(own.copies[i])]
            if rows:
                at, items, scores, lows, highs = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at)), pa.array(items, pa.int64()), pa.array(scores, pa.float64()),
                     pa.array(lows, pa.int64()), pa.array(highs, pa.int64())],
                    ["doc_id", "item_id", "score", "start_word", "end_word"])
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, item_id, score, start_word, end_word``: for each contaminated
    document and item the best alignment's share of the full score and its
    place among the document's normalised words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, score double, start_word long, end_word long"
    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for i, block in enumerate(blocks(docs, benchmark, block_words)):
        found = own.mapInArrow(_matches(block), schema)
        out = found if i == 0 else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, all columns as they are."""
    at, schema, out = docs.columns.index("text"), docs.schema, docs

    def keep(block):
        def run(batches):
            own = Block(**block.value)
            for part in chunks(batches, "text"):
                stay = np.ones(part.num_rows, bool)
                stay[[d for d, _ in find(own, blobs(part.column(at).cast(pa.binary())))]] = False
                yield part.filter(pa.array(stay))
        return run
    for block in blocks(docs, benchmark, block_words):
        out = out.mapInArrow(keep(block), schema)
    return out
