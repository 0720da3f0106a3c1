import os
import sys

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import SMALL  # noqa: E402


def texts():
    """Real texts of the smallest table, with copies, edits and odd cases."""
    t = pq.read_table(f"{SMALL}/documents.parquet").column("text").to_pylist()
    base = t[0]
    odd = ["", None, " \n\t ", "one", "one two", "One  TWO\tthree\nfour five", "é ü\né ü\n\né ü", "a " * 300, "x" * 700,
           base, base.upper(), base + " tail", "head " + base, " ".join(base.split()[:-1]),
           "same line here now\n" * 40, "#*$%&|<> <|endoftext|>     \x00 end", "\r\n".join(t[1].split(". ")) + " " * 50]
    return t + odd + [" ".join(x for x in t if x)[:150_000]]


@pytest.fixture(scope="session")
def rows():
    """(doc_id, text): one null id, one repeated row, two rows sharing an id."""
    t = texts()
    out = [(i, x) for i, x in enumerate(t)]
    return out + [(3, t[3]), (4, "another text under an id that exists already"), (None, t[5])]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """As the table, with columns whose names clash with those used inside."""
    data = [(i, x, "en", "s", 1, "k", "t", 5) for i, x in rows]
    return spark.createDataFrame(
        data, "doc_id long, text string, lang string, source string, n_chars long, _key string, _text string, size long").repartition(5)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
