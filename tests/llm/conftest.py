from __future__ import annotations

import pyarrow.parquet as pq
import pytest

from tillwork.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    return ship(spark)


@pytest.fixture(scope="session")
def texts(folder):
    """doc_id -> text of the test table."""
    table = pq.read_table(f"{folder}/documents.parquet", columns=["doc_id", "text"])
    return dict(zip(table["doc_id"].to_pylist(), table["text"].to_pylist()))


@pytest.fixture(scope="session")
def result(spark, folder):
    """Rows of a registered query, by its first column."""
    from tillwork.llm.queries import queries

    def run(name):
        rows = queries()[name](spark, folder).collect()
        return {r[0]: r for r in rows}

    return run


LONG = " ".join(f"word{i % 977} über{i % 31}" for i in range(20_000))
# extra columns whose names the operators use themselves
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, url string, "
    "ids string, key int, bucket int, _row int, _content string, kept string, n_words int, shard int, `a.b` int"
)


def messy_rows():
    plain = "the quick brown fox jumps over the lazy dog and runs far away from the big bad wolf in the woods tonight"
    texts = [
        (1, plain, "en", "s", "http://A.example.net/en/1"),
        (2, plain, "en", "s", "http://a.example.net/en/1?x"),
        (2, plain, "en", "s", "http://a.example.net/en/1?x"),
        (3, None, "en", None, None),
        (4, "", None, "s", "no address"),
        (5, LONG, "de", "s", "http://b.example.org"),
        (6, " \n\t ", None, None, "ftp://org/fr/"),
        (7, "one", "en", "t", "http://x.net"),
        (None, plain + " again", "en", "t", "http://example.com/de/#f"),
        (None, None, None, None, None),
        (8, "<|endoftext|> ▁ \u0000 ሴ 😀 é\u0301", "fr", "t", "http://net/?/"),
    ]
    return [(*r, "i", 1, 2, 3, "c", "k", 4, 5, 6) for r in texts]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
