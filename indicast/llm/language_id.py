"""Language ID by language-bitmask n-gram filters.

Texts are lower-cased; every run of characters that are not letters becomes one
space, also at both ends; the n-grams are ``GRAM`` characters long.

Learning: the n-grams of a sample of labelled documents (an expected
``SAMPLE_DOCS`` per language, chosen by a hash of the row) are counted per
language in Spark. An n-gram enters the filter of a language if its share of
that language's n-grams is at least ``FLOOR`` (so a filter holds at most
1 / FLOOR of them) and at least ``KEEP`` times its largest share in any.

The Bloom filters of all languages are bit-sliced: they share the hash
functions, and slot s holds a word with bit l set if filter l has slot s. The
AND over an n-gram's slots is the set of all languages that contain it. A
text's hits are counted per language bit and corrected for the filter's false
positive rate f: (hits - n f) / (1 - f). The language with the most wins; the
score is its share of all languages' corrected hits, and ``coverage`` its
corrected hits by n-gram.

Edge cases: ``und`` with score 0 if a text is null, empty or has no letter; a
text whose n-grams no filter knows gets the most frequent language with score
0; ties go to the more frequent language, then the smaller name; with nothing to
learn from every text is ``und``; a null id is neither held out nor learned from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicast.llm.common import blobs, chunks, row_key, worker_cache
from indicast.llm.wordhash import U64, mix

GRAM = 3
SAMPLE_DOCS = 4000
FLOOR = 1e-4
KEEP = 0.25
SLOTS_LOG2 = 17
HASHES = 3
#: Texts of so many bytes are worked through in blocks of their own.
LONG = 1 << 19
UNKNOWN = "und"
#: A text is in none of the languages if each covers less of its n-grams than this,
#: and less than this share of what the language's filter covers of its own texts
#: (which is little where the n-grams are many and alike in frequency).
MIN_COVERAGE = 0.2
MIN_OF_OWN = 1 / 3


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def grams(texts: list[bytes], size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams and the index of the text of each."""
    plain = [t.decode("utf-8", "replace").lower() for t in texts]
    joined = np.frombuffer(("\n" + "\n".join(plain) + "\n").encode("utf-32-le", "replace"), np.uint32)
    letter = worker_cache("letters", _letters)[joined]
    first = np.concatenate(([1], 1 + np.cumsum([len(t) + 1 for t in plain])))[:-1]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other character after a letter stands for the gap
    keep[0] = True
    at = np.flatnonzero(keep)
    chars = np.where(letter[at], joined[at], 32).astype(U64)
    text = np.searchsorted(first, at, side="right") - 1
    n = len(at) - size + 1
    if n <= 0:
        return np.empty(0, U64), np.empty(0, np.int64)
    gap = chars == 32
    # The text of a gram is that of its letters; a gap is taken with the letter beside it.
    ahead = np.append(text[1:], text[-1])
    low = np.where(gap, ahead, text)[:n]
    high = np.where(gap, np.append(text[:1], text[:-1]), text)[size - 1:]
    whole = low == high
    return _hashed(chars, size)[whole], low[whole]


def _hashed(chars: np.ndarray, size: int) -> np.ndarray:
    n = max(0, len(chars) - size + 1)
    out = np.zeros(n, U64)
    for i in range(size):
        out = (out ^ chars[i:i + n]) * U64(0x9E3779B97F4A7C15)
        out ^= out >> U64(29)
    return out


def long_grams(text: bytes, size: int = GRAM, block: int = LONG):
    """The hashes of one long text's n-grams, in blocks: the same as of :func:`grams`."""
    plain = text.decode("utf-8", "replace").lower() + "\n"
    tail, after_letter = np.array([32], U64), False
    for i in range(0, len(plain), block):
        part = np.frombuffer(plain[i:i + block].encode("utf-32-le", "replace"), np.uint32)
        letter = worker_cache("letters", _letters)[part]
        keep = letter | np.append(after_letter, letter[:-1])
        after_letter = bool(letter[-1])
        chars = np.concatenate((tail, np.where(letter, part, 32)[keep].astype(U64)))
        yield _hashed(chars, size)
        tail = chars[max(0, len(chars) - size + 1):]


def gram_blocks(texts: list[bytes]):
    """Pairs of hashes and text indices that cover all n-grams of all texts, a bounded number at a time."""
    short = [i for i, t in enumerate(texts) if len(t) < LONG]
    if short:
        hashes, text = grams([texts[i] for i in short])
        yield hashes, np.array(short)[text]
    for i, t in enumerate(texts):
        if len(t) >= LONG:
            for hashes in long_grams(t):
                yield hashes, np.full(len(hashes), i)


def _count(batches):
    for part in chunks(batches, "text"):
        langs = np.array(part.column("lang").to_pylist(), object)
        for hashes, text in gram_blocks(blobs(part.column("text"))):
            for lang in sorted(set(langs)):
                found, counts = np.unique(hashes[(langs == lang)[text]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(counts, pa.int64())],
                    ["lang", "gram", "n"])


@dataclass
class Filters:
    """Bit-sliced filters: ``slots[s, w]`` holds the bits of languages 64w to 64w + 63."""

    langs: list[str]
    slots: np.ndarray
    false_rate: np.ndarray
    mass: np.ndarray  # share of a language's own n-grams that its filter holds

    @classmethod
    def build(cls, langs: list[str], members: list[np.ndarray], slots_log2: int = SLOTS_LOG2, mass=None) -> Filters:
        slots = np.zeros((1 << slots_log2, max(1, -(-len(langs) // 64))), U64)
        for i, hashes in enumerate(members):
            for at in cls._places(hashes, slots_log2):
                slots[at, i // 64] |= U64(1 << i % 64)
        fill = np.array([((slots[:, i // 64] >> U64(i % 64)) & U64(1)).mean() for i in range(len(langs))])
        return cls(langs, slots, fill ** HASHES, np.ones(len(langs)) if mass is None else np.asarray(mass, float))

    @staticmethod
    def _places(hashes: np.ndarray, slots_log2: int) -> list[np.ndarray]:
        return [(mix(hashes, 21 + j) >> U64(64 - slots_log2)).astype(np.int64) for j in range(HASHES)]

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash the words of language bits set in all its slots."""
        places = self._places(hashes, len(self.slots).bit_length() - 1)
        found = self.slots[places[0]]
        for at in places[1:]:
            found = found & self.slots[at]
        return found

    def corrected(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Corrected hits by text and language, and the number of n-grams by text."""
        total = np.zeros(len(texts), np.int64)
        hits = np.zeros((len(texts), len(self.langs)))
        for hashes, text in gram_blocks(texts):
            found = self.lookup(hashes)
            total += np.bincount(text, minlength=len(texts))
            for i in range(len(self.langs)):
                bit = (found[:, i // 64] >> U64(i % 64)) & U64(1)
                hits[:, i] += np.bincount(text, weights=bit.astype(np.float64), minlength=len(texts))
        rate = self.false_rate
        return np.clip((hits - total[:, None] * rate) / np.maximum(1 - rate, 1e-9), 0, total[:, None]), total


def learnable() -> Column:
    """True for the documents that may be learned from."""
    return held_out().isNotNull() & ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Filters:
    """Learn the filters from ``docs(doc_id, text, lang)``."""
    rows = docs.filter(learnable())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"))
    names = sorted((-r["n"], r["lang"]) for r in sizes.collect())
    langs = [lang for _, lang in names]
    if not langs:
        return Filters.build([], [])
    # A share of each language's rows, chosen by the row key: sample_docs of them on average.
    share = F.col("k1").bitwiseAND(F.lit((1 << 40) - 1)) / float(1 << 40)
    sample = (rows.select("lang", F.col("text").cast("binary").alias("text"), *row_key())
              .join(F.broadcast(sizes), "lang").filter(share * F.col("n") < sample_docs).select("lang", "text"))
    counts = sample.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    total = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(total), "lang").select("lang", "gram", (F.col("n") / F.col("total")).alias("p"))
    shares = shares.filter(F.col("p") >= FLOOR)
    # At most 1 / FLOOR rows a language.
    found = shares.toPandas()
    best = found.groupby("gram")["p"].transform("max")
    found = found[found["p"] >= KEEP * best]
    own = {lang: found[found["lang"] == lang] for lang in langs}
    return Filters.build(langs, [own[lang]["gram"].to_numpy(np.int64).view(U64) for lang in langs],
                         mass=[own[lang]["p"].sum() for lang in langs])


def _predict(filters):
    def run(batches):
        model = filters.value
        for part in chunks(batches, "text"):
            hits, total = model.corrected(blobs(part.column("text")))
            if not model.langs:
                total = np.zeros_like(total)
                hits = np.zeros((len(total), 1))
            best = hits.argmax(axis=1)
            top = hits[np.arange(len(hits)), best]
            score = np.where(top > 0, top / np.maximum(hits.sum(axis=1), 1e-12), 0.0)
            cover = top / np.maximum(total, 1)
            lang = [model.langs[b] if n else UNKNOWN for b, n in zip(best, total)]
            rest = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in rest] + [pa.array(lang, pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(cover)],
                rest + ["lang_pred", "score", "coverage"])
    return run


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """``doc_id, k1, k2, lang_pred, score, coverage`` for every row of ``docs(doc_id, text)``."""
    model = docs.sparkSession.sparkContext.broadcast(filters)  # 2**SLOTS_LOG2 words for every 64 languages
    kind = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select("doc_id", *row_key(), F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(_predict(model), f"doc_id {kind}, k1 long, k2 long, lang_pred string, score double, coverage double")


def accepted(docs: DataFrame, filters: Filters, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """The rows of ``docs`` in a known language, all columns as they are. Rejected
    are texts without a letter and those of which every language covers too little."""
    bars = np.minimum(min_coverage, MIN_OF_OWN * filters.mass)
    model = docs.sparkSession.sparkContext.broadcast(filters)
    names = docs.columns
    at = names.index("text")
    schema = docs.schema

    def run(batches):
        for part in chunks(batches, "text"):
            column = part.column(at)
            hits, total = model.value.corrected(blobs(column.cast(pa.binary())))
            keep = (total > 0) & ((hits > 0) & (hits >= bars * total[:, None])).any(axis=1)
            yield part.filter(pa.array(keep))
    return docs.mapInArrow(run, schema)
