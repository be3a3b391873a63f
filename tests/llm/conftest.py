import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_helpers import DOCS, docs_df, text, words  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and long texts, ties, repeated rows, copies and near copies."""
    base = words(1, 200)
    near = base[:]
    near[17] = "changed"
    far = base[:]
    far[20:120] = words(99, 100)
    long = text(5, 30_000)
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "one two"), (5, "One TWO"), (6, " ".join(base)), (7, " ".join(near)),
            (8, " ".join(far)), (9, " ".join(base)), (10, long), (11, long + " tail"), (12, "a" * 50_000),
            (13, "é ñ ß 中文 words here now yes"), (14, "one two three four five"), (15, "one two three four five six")]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    return docs_df(spark, odd_rows)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
