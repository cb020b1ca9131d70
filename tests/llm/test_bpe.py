import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from indicast.llm import bpe, pieces

PATH = public_tokenizers.path("word_bpe_49k.json")
COLUMNS = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
ODD = [None, "", " \n\t", "\x1c a\x1db", "Hello'S WE'LL <|endoftext|>x<|startoftext|> <|ENDOFTEXT|><|endoftext", "İstanbul Σας ß",
       "é ́x å̧", "日本語 テキスト", "١²½ 42", "x" * 5000, "ab" * 3000, "a​‍b", "\x00\x7f\x80",
       "a　b\x85c\xa0d e f", "''s 'sx don't", "ﬁ Å Ω", "A1b2C3" * 30000, "w " * 40000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Bpe(file.read())


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_query_against_the_library(run, library):
    rnd = random.Random(2)
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "the cat"), (7, "the cat"), (7, "the cat")]
    rows += [(100 + i, " ".join(rnd.choice(["Ünder", "thing,", "re-do!", "%%%", "the"]) for _ in range(50))) for i in range(30)]

    def row(doc, text):
        ids, decoded = expected(library, text)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        return doc, len(ids), sha(" ".join(map(str, ids))), sha(decoded)
    want = sorted((row(*r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))
    assert run("op2_bpe", rows, COLUMNS) == want


def test_random_characters(own, library):
    rnd = random.Random(1)
    pick = [lambda: rnd.randrange(32, 127), lambda: rnd.randrange(0x500), lambda: rnd.randrange(0xD800), lambda: rnd.randrange(0x1F000, 0x20000)]
    for _ in range(4000):
        text = "".join(chr(rnd.choice(pick)()) for _ in range(rnd.randrange(30)))
        ids, decoded = expected(library, text)
        assert own.encode(text) == ids and own.decode(ids) == decoded, repr(text)


def test_long_and_short_merges_agree(own):
    rnd = random.Random(3)
    for _ in range(300):
        word = "".join(rnd.choice("theranding") for _ in range(rnd.randrange(2, bpe.LONG + 1)))
        assert own.merge(word) == own._merge_long(word + own.suffix, len(word))


def test_forgetting_changes_nothing():
    calls = []
    memory = pieces.Recent(lambda keys: [calls.append(k) or k.upper() for k in keys], 3)
    for keys in (["a", "b"], ["c", "d"], ["a"], ["e", "f", "a"], ["b"]):
        found = memory.over(keys)
        assert [found[k] for k in keys] == [k.upper() for k in keys]
    assert calls.count("a") == 1 and calls.count("b") == 2
    assert len(memory.young) <= 3


def test_empty_table(docs):
    assert bpe.encode_decode(docs([]), PATH).count() == 0
