"""Extra columns whose names the operators use themselves change nothing, and empty tables give empty results."""

import public_tokenizers
from pyspark.sql import functions as F

from indicast.llm import bpe, language_id, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
NAMES = ["id", "k1", "k2", "ids", "decoded", "n_tokens", "start", "lang_pred", "score", "coverage", "gram", "p", "n", "total"]
ROWS = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, None, "en"), (None, "", None)]


def clash(df):
    return df.withColumns({n: F.lit("clash") for n in NAMES})


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_bpe(docs):
    plain = docs(ROWS)
    assert rows(bpe.encode_decode(clash(plain), PATH)) == rows(bpe.encode_decode(plain, PATH))
    assert rows(bpe.encode_decode(clash(docs([])), PATH)) == []


def test_token_files(spark, docs):
    def back(df):
        manifest, folder = token_files.write_tokens(df, PATH)
        return rows(token_files.crc_of_ids(token_files.read_tokens(spark, manifest, folder)))
    plain = docs(ROWS)
    assert back(clash(plain)) == back(plain) and len(back(plain)) == 4
    assert back(clash(docs([]))) == []


def test_language_id(docs):
    plain = docs([(i, t, lang) for i in range(0, 40, 4) for t, lang in [(r[1], r[2]) for r in ROWS[:2]]] + ROWS)
    filters = language_id.fit(plain)
    assert rows(language_id.predict(clash(plain), language_id.fit(clash(plain)))) == rows(language_id.predict(plain, filters))
    assert rows(language_id.predict(clash(docs([])), filters)) == []
    kept = language_id.accepted(clash(plain), filters)
    assert kept.columns == clash(plain).columns
