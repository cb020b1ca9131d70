"""BPE encoding and decoding for word-end vocabularies (``tokenizer.json`` files).

A text is cut at white space into pieces. No pre-token spans white space, a
merge never leaves its pre-token, and the normaliser treats each piece alone,
so a text's ids are its pieces' ids in a row; a task remembers the words and
pieces it met last and looks them up. The file's own normaliser and
pre-tokeniser settings split a piece into words; the merging is done here:

A word is held as part boundaries and the ranks of adjacent pairs in two flat
lists. The lowest rank is found by scanning, its inner boundary is deleted, and
the ranks left and right of it are refreshed, until no pair has a rank. Words of
more than ``LONG`` symbols merge through a heap, with the same result (lowest
rank first, leftmost of equals), so the time stays near linear.

Decoding joins the tokens of the ids as the library does for a file without a
decoder: one space between tokens, word ends and byte symbols as they stand.

Edge cases: a null or empty text, or one of white space only, has no tokens;
special tokens' strings in a text become their ids, as in the library; texts of
any length are whole; repeated rows repeat; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import json
import re
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indicast.llm.common import blobs, chunks, worker_cache
from indicast.llm.pieces import Recent, pieces, simple_words

LONG = 64
NONE = 1 << 60
#: Words and pieces remembered during a task, in each of two generations (about 350 bytes each).
WORDS, PIECES = 200_000, 120_000


def byte_symbols() -> dict[int, str]:
    """The printable symbol of each byte, by the usual rule: printable Latin-1
    stands for itself, the other bytes follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in plain]
    return {x: chr(x) for x in plain} | {x: chr(256 + i) for i, x in enumerate(rest)}


class Bpe:
    """Encoder and decoder of one ``tokenizer.json`` (given as its content)."""

    def __init__(self, content: str):
        from tokenizers import Tokenizer
        spec = json.loads(content)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] or not model.get("end_of_word_suffix"):
            raise ValueError("expected a BPE file with word ends and no decoder")
        self.library = Tokenizer.from_str(content)
        self.suffix, self.ids = model["end_of_word_suffix"], dict(model["vocab"])
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): i for i, (a, b) in enumerate(pairs)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")")
        self.tokens = {i: t for t, i in (self.ids | special).items()}
        self.symbols = byte_symbols()
        self.forget()

    def forget(self) -> None:
        self.words = Recent(self._make_words, WORDS)
        self.pieces = Recent(self._make_pieces, PIECES)

    def merge(self, word: str) -> list[str]:
        """The parts of one word of byte symbols."""
        text, n = word + self.suffix, len(word)
        if n > LONG:
            return self._merge_long(text, n)
        bound = [*range(n), len(text)]
        rank_of, part = self.ranks.get, [text[a:b] for a, b in zip(bound, bound[1:])]
        rank = [rank_of(p, NONE) for p in zip(part, part[1:])]
        while rank:
            low = min(rank)
            if low == NONE:
                break
            i = rank.index(low)
            del bound[i + 1], rank[i]
            a, b = bound[i], bound[i + 1]
            if i:
                rank[i - 1] = rank_of((text[bound[i - 1]:a], text[a:b]), NONE)
            if i < len(rank):
                rank[i] = rank_of((text[a:b], text[b:bound[i + 2]]), NONE)
        return [text[a:b] for a, b in zip(bound, bound[1:])]

    def _merge_long(self, text: str, n: int) -> list[str]:
        end = [*range(1, n), len(text)]  # end of the part that starts here; 0: no part starts here
        before = [-1, *range(n - 1)]
        rank_of, heap = self.ranks.get, []

        def offer(a):
            b = end[a]
            if b < n:
                r = rank_of((text[a:b], text[b:end[b]]))
                if r is not None:
                    heapq.heappush(heap, (r, a, b, end[b]))
        for a in range(n):
            offer(a)
        while heap:
            _, a, b, c = heapq.heappop(heap)
            if not end[a] or end[a] != b or end[b] != c:
                continue
            end[a], end[b] = c, 0
            if c < n:
                before[c] = a
            if before[a] >= 0:
                offer(before[a])
            offer(a)
        return [text[a:b] for a, b in enumerate(end) if b]

    def _known(self, parts: list[str]) -> tuple[str, str]:
        """Decimal ids and tokens of merged parts."""
        ids = [self.ids[t] for t in parts if t in self.ids]
        return " ".join(map(str, ids)), self.decode(ids)

    def _make_words(self, words: list[str]):
        for word in words:
            yield self._known(self.merge(word if word.isascii()
                                         else word.encode().decode("latin-1").translate(self.symbols)))

    def _make_pieces(self, found: list[str]):
        simple = [None if "<" in p else simple_words(p) for p in found]
        known = self.words.over([w for words in simple if words for w in words])
        for piece, words in zip(found, simple):
            if words is None:
                yield self._other(piece)
            elif len(words) == 1:
                yield known[words[0]]
            else:
                ids, tokens = zip(*map(known.__getitem__, words))
                yield " ".join(ids), " ".join(tokens)

    def _other(self, piece: str) -> tuple[str, str]:
        """A piece with special tokens or further characters, by the file's own rules."""
        out = []
        for part in self.cut.split(piece):
            if part in self.special:
                out.append((str(self.special[part]), part))
            elif part:
                normal = self.library.normalizer.normalize_str(part)
                out += [self._known(self.merge(w)) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]
        return " ".join(i for i, _ in out if i), " ".join(t for i, t in out if i)

    def decode(self, ids: list[int]) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))

    def both(self, text: str) -> tuple[str, str]:
        """Decimal ids joined by spaces, and the text decoded from them."""
        found = pieces(text)
        out = []
        for at in range(0, len(found), PIECES // 4):
            part = found[at:at + PIECES // 4]
            out += map(self.pieces.over(part).__getitem__, part)
        return " ".join([i for i, _ in out]), " ".join([t for _, t in out])

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.both(text)[0].split()))


def _encoder(content):
    def run(batches):
        text = content.value
        bpe = worker_cache("bpe_" + sha1(text.encode()).hexdigest(), lambda: Bpe(text))
        for part in chunks(batches, "text"):
            ids, decoded = zip(*(bpe.both(t.decode("utf-8", "replace")) for t in blobs(part.column("text"))))
            counts = [x.count(" ") + 1 if x else 0 for x in ids]
            rest = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [part.column(n) for n in rest] + [pa.array(counts, pa.int64()), pa.array(ids, pa.string()),
                                                  pa.array(decoded, pa.string())],
                rest + ["n_tokens", "ids", "decoded"])
        bpe.forget()  # the worker may serve other stages next; it keeps the vocabulary only
    return run


def encode_decode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` for every row of ``docs(doc_id, text)``;
    ``ids`` are decimal, joined by spaces; ``tokenizer`` is the path of a
    ``tokenizer.json`` the driver can read."""
    with open(tokenizer, encoding="utf-8") as file:
        content = docs.sparkSession.sparkContext.broadcast(file.read())  # one vocabulary file, a few MB
    kind = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return own.mapInArrow(_encoder(content), f"doc_id {kind}, n_tokens long, ids string, decoded string")
