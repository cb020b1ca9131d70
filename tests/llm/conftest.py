import pytest

from indicast.llm import queries

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, optionally with lang and source."""
    def make(rows):
        full = [(*r, *[None] * (4 - len(r))) for r in rows]
        return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], DOCS)
    return make


@pytest.fixture
def run(spark, docs, tmp_path):
    """Run a registered query over the given rows of documents, as sorted tuples."""
    count = iter(range(1000))

    def go(name, rows, columns, **tables):
        home = tmp_path / f"in{next(count)}"
        docs(rows).repartition(3).write.parquet(f"{home}/documents.parquet")
        for key, df in tables.items():
            df.write.parquet(f"{home}/{key}.parquet")
        out = queries.QUERIES[name](spark, str(home)).select(*columns).collect()
        return sorted((tuple(r) for r in out), key=lambda r: tuple((x is not None, x) for x in r))
    return go
