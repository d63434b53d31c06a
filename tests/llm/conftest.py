import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    from liqspark.llm.tables import table
    return table(spark, SF, "documents")


@pytest.fixture(scope="session")
def odd(spark, docs):
    """Documents with nulls, repeated rows, ids that share a row, blank and short texts, and a
    further column with a name that operators use."""
    long = " ".join(f"word{i}" for i in range(3000))
    rows = [(1, "one two three four five six seven", "en", "a", 33), (1, "one two three four five six seven", "en", "a", 33),
            (2, None, None, None, None), (3, "", "en", None, 0), (4, " \n\t ", "de", "b", 4), (5, "short text", "en", "b", 10),
            (6, "short text", "fr", "a", 10), (None, "short text", "en", "a", 10), (7, long, "en", "c", len(long)),
            (8, long + " tail", "en", "c", len(long) + 5), (9, "Ünïcödé ▁ 字 😀 token=abcdefghijkl1234", "en", "c", 36),
            (10, "x" * 5000, "en", "b", 5000), (11, "One Two three four five six seven", "en", None, 33)]
    return spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, class_id string")


@pytest.fixture(scope="session")
def empty(spark, docs):
    return spark.createDataFrame([], docs.schema)
