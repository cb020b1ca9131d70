"""Periodic run detection by online dyadic square catching.

Words are maximal stretches outside ``[\\x20\\x09-\\x0D]``. A run of period q is
a maximal stretch of words in which words q apart are equal, whose smallest
period is q and whose length is at least ``max(MIN_LENGTH, POWERS * q)``.

Words are appended in pieces (``SquareCatcher.append``). Level b looks after
the periods q from ``2**(b+1) - 1`` to ``2**(b+2) - 2``: any q consecutive words
hold a completed, aligned block of ``2**b`` words, and two blocks at most lie
that far before a given place. So each block is a catcher for as long as such
places are appended: every new window of ``2**b`` words is compared with its two
blocks. Equal blocks one after the other at one distance form a chain, which
each appended block advances or ends; a chain as long as its distance is a
square, and squares merge into a run as the chain grows. A chain that ends is
kept if it may be long enough for a run. At the end of the text the kept chains
are lengthened word by word (by less than a block at either end) to runs, small
periods first; a chain inside a run whose period divides its own is that run again.

A window's hash mixes those of its halves (64 bits, not linear, so that no
pattern of words makes equal hashes for unequal windows); a run is confirmed on
the words' own 64-bit hashes.

Memory: 8 bytes a word and 16 for the levels, beside temporary arrays for one
piece. Texts are taken together in chunks, parted by words that occur once. A
text past a chunk is a chunk of its own and is appended piece by piece; the text,
its words and its result take 10 to 12 times its bytes at the peak.

Edge cases: null and empty texts have no words and no runs; repeated rows get
the same result; a null id is returned as null; all columns but ``doc_id`` and
``text`` are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicast.llm.common import blobs, chunks
from indicast.llm.wordhash import U64, Words, mix

MIN_LENGTH = 6
POWERS = 4
PIECE = 1 << 17
SPACES = "[\\x20\\x09-\\x0D]+"
_STEP = U64(0xD6E8FEB86659FD93)
_SCHEMA = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


class _Level:
    """The catchers for the periods of one level."""

    def __init__(self, b: int):
        self.b, self.size = b, 1 << b
        self.least = 2 * self.size - 1  # the smallest period
        self.tail = np.empty(0, U64)  # the last windows, whose second half on the next level is not complete
        self.blocks = np.empty(0, U64)
        self.open = np.empty((3, 0), np.int64)  # distance, first and last block of a chain
        self.kept: list[np.ndarray] = []

    def _grow(self, hashes: np.ndarray, lowest: int) -> None:
        whole = hashes[-lowest % self.size::self.size]
        need = (lowest + len(hashes) - 1) // self.size + 1
        if need > len(self.blocks):
            self.blocks = np.concatenate([self.blocks, np.empty(max(need, 2 * len(self.blocks)) - len(self.blocks), U64)])
        begin = -(-lowest // self.size)
        self.blocks[begin:begin + len(whole)] = whole

    def advance(self, hashes: np.ndarray, lowest: int, words: int) -> None:
        """Compare the windows that begin at ``lowest`` and after with their two
        blocks; ``words`` have been appended so far."""
        self._grow(hashes, lowest)
        latest = (np.arange(lowest, lowest + len(hashes)) - self.least) >> self.b
        found = [self.open]
        for block in (latest, latest - 1):
            from_ = int(np.searchsorted(block, 0))
            hit = from_ + np.flatnonzero(hashes[from_:] == self.blocks[block[from_:]])
            at = block[hit]
            found.append(np.stack([lowest + hit - (at << self.b), at, at]))
        q, low, high = np.concatenate(found, axis=1)
        order = np.lexsort((low, q))
        q, low, high = q[order], low[order], high[order]
        new = np.ones(len(q), bool)
        new[1:] = (q[1:] != q[:-1]) | (low[1:] != high[:-1] + 1)
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(q))[:len(start)] - 1
        chains = np.stack([q[start], low[start], high[end]])
        # The next block of an open chain has not been compared yet.
        live = ((chains[2] + 2) << self.b) + chains[0] > words
        self._keep(chains[:, ~live])
        self.open = chains[:, live]

    def _keep(self, chains: np.ndarray) -> None:
        q, low, high = chains
        equal = (high + 1 - low) << self.b  # words known to equal those q later
        enough = equal >= np.maximum(MIN_LENGTH - q, (POWERS - 1) * q) - 2 * (self.size - 1)
        if enough.any():
            self.kept.append(chains[:, enough])

    def chains(self) -> np.ndarray:
        """``period, first word, end`` of the stretches whose words equal those a period later."""
        self._keep(self.open)
        self.open = self.open[:, :0]
        q, low, high = np.concatenate(self.kept, axis=1) if self.kept else np.empty((3, 0), np.int64)
        return np.stack([q, low << self.b, (high + 1) << self.b])


class SquareCatcher:
    """Finds the runs of a sequence of word hashes that is appended piece by piece.
    ``longest``: no run is longer (bounds the levels)."""

    def __init__(self, longest: int):
        self.longest, self.n = longest, 0
        self.words = np.empty(min(longest, PIECE), U64)
        self.levels: list[_Level] = []

    def append(self, words: np.ndarray) -> None:
        for at in range(0, len(words), PIECE):
            self._append(words[at:at + PIECE])

    def _append(self, piece: np.ndarray) -> None:
        if self.n + len(piece) > len(self.words):
            more = np.empty(max(self.n + len(piece), 2 * len(self.words)), U64)
            more[:self.n] = self.words[:self.n]
            self.words = more
        self.words[self.n:self.n + len(piece)] = piece
        low, self.n = self.n, self.n + len(piece)
        hashes, b = piece, 0
        while POWERS * ((2 << b) - 1) <= self.longest and len(hashes):
            if b == len(self.levels):
                self.levels.append(_Level(b))
            level = self.levels[b]
            level.advance(hashes, low, self.n)
            # Windows of the next level: the earlier ones of this level may be their first halves.
            both = np.concatenate([level.tail, hashes])
            begin = low - len(level.tail)
            n = max(0, len(both) - level.size)
            level.tail = both[n:]
            left, right = both[:n], both[level.size:]
            hashes = mix(left * _STEP + (right ^ (right >> U64(29))), b + 1)
            low, b = begin, b + 1

    def runs(self) -> np.ndarray:
        """``start, end, period`` of all runs, by start and then period."""
        words = self.words[:self.n]
        found = np.empty((3, 0), np.int64)
        for level in self.levels:
            chains = level.chains()
            if not chains.shape[1]:
                continue
            fresh = chains[:, ~_inside(found, chains[0], chains[1], chains[2] + chains[0])]
            own, seen = [], set()
            for q, low, high in sorted(map(tuple, fresh.T.tolist())):
                low -= _agree(words[max(0, low - level.size):low][::-1], words[max(0, low - level.size) + q:low + q][::-1])
                high += _agree(words[high:high + level.size], words[high + q:high + q + level.size])
                size = high + q - low
                if size >= max(MIN_LENGTH, POWERS * q) and (low, high + q) not in seen:
                    seen.add((low, high + q))
                    if (words[low:high] == words[low + q:high + q]).all():
                        own.append((low, high + q, q))
            if own:
                found = np.concatenate([found, np.array(own).T], axis=1)
                found = found[:, np.lexsort((found[2], found[0]))]
        return found


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal words at the beginning of two stretches."""
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    return int(differ.argmax()) if differ.any() else n


def _inside(runs: np.ndarray, q: np.ndarray, low: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which stretches lie in a run whose period divides theirs. Two runs that
    hold a stretch of twice the period would be one, so of the runs that begin
    in time only the one that reaches furthest can be it."""
    if not runs.shape[1]:
        return np.zeros(len(q), bool)
    start, reach, period = runs
    best = np.maximum.accumulate(reach)
    furthest = np.maximum.accumulate(np.where(reach == best, np.arange(len(reach)), 0))
    at = np.searchsorted(start, low, side="right") - 1
    run = furthest[np.maximum(at, 0)]
    return (at >= 0) & (reach[run] >= end) & (q % period[run] == 0)


def runs_of(texts: list[bytes]):
    """For each text its number of words and its runs (``start, length, period`` lists)."""
    words = Words(texts)
    hashes, first = words.hashes(), words.first
    sizes = np.diff(first)
    longest = int(sizes.max(initial=0))
    catcher = SquareCatcher(longest)
    # A word that occurs once stands before each text, so that nothing reaches across.
    parted = np.insert(hashes, first[:-1], mix(np.arange(len(texts), dtype=U64), 97))
    catcher.append(parted)
    del parted, hashes, words
    start, end, period = catcher.runs()
    begin = first[:-1] + np.arange(1, len(texts) + 1)
    doc = np.searchsorted(begin, start, side="right") - 1
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    start = start - begin[doc]
    length = end - begin[doc] - start
    for d in range(len(texts)):
        mine = slice(cut[d], cut[d + 1])
        yield int(sizes[d]), start[mine].tolist(), length[mine].tolist(), period[mine].tolist()


def collapse(text: bytes, start: list[int], length: list[int], period: list[int]) -> bytes:
    """The words joined by one space, of every run only the first period's words."""
    words = text.split()  # bytes: white space is exactly [\x20\x09-\x0D]
    if start:
        gone = np.zeros(len(words) + 1, np.int64)
        np.add.at(gone, np.add(start, period), 1)
        np.add.at(gone, np.add(start, length), -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
    return b" ".join(words)


def _detect(batches):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for part in chunks(batches, "text"):
        texts = blobs(part.column("text"))
        counts, starts, lengths, periods, kept, offsets = [], [], [], [], [], [0]
        for text, (n, start, length, period) in zip(texts, runs_of(texts)):
            counts.append(n)
            starts += start
            lengths += length
            periods += period
            offsets.append(len(starts))
            kept.append(collapse(text, start, length, period).decode("utf-8", "replace"))
        fields = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (starts, lengths, periods)],
                                            ["start", "length", "period"])
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(counts, pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), fields).cast(kind), pa.array(kept)],
            ["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of each row of ``docs``: the runs by
    start and then period, and the words that stay when every run keeps its first
    period only. A map over the rows: nothing is shuffled."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(_detect, f"doc_id {kind}, {_SCHEMA}")


def with_echoes(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` in which, for ids whose crc32 is divisible by ten, the
    words from some place on repeat those of a first period (place and period
    follow from the id): word i >= a becomes word ``a + (i - a) % p``."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split("text", SPACES, -1), lambda w: w != "")
    n, a, p = F.col("__n"), F.col("__a"), F.col("__p")
    place = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
    echoed = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(F.col("__words"), place(i)))
    size = F.size("__words").cast("long")
    return (docs.select("doc_id", "text", g.alias("__g"), F.when(F.pmod(h, F.lit(10)) == 0, words).alias("__words"))
            .withColumn("__n", F.when(size > 0, size))
            .withColumn("__a", F.pmod("__g", "__n"))
            .withColumn("__p", 1 + F.floor((n - a) / (3 + F.pmod(F.col("__g"), F.lit(8)))))
            .select("doc_id", F.when(n.isNotNull(), F.array_join(echoed, " ")).otherwise(F.col("text")).alias("text")))


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns from the operator's."""
    text = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(text, F.lit("\n"))).otherwise(F.lit(""))
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    own = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    length, start, period = F.col("best.length"), -F.col("best.start"), -F.col("best.period")
    return own.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"),
        period.alias("period"), F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
