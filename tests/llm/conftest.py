import pytest

from shelfwise.llm.common import bound_batches
from tests.conftest import SF_SMALL

LONG = " ".join(f"word{i % 977} line{i % 13}." for i in range(40_000))

# Null, empty and blank texts, ties, repeated rows, a null id, capitals and a long text.
EDGE = [(1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa"),
        (2, "alpha BETA gamma delta epsilon zeta eta theta iota kappa"),
        (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "one"), (7, "one"), (8, "one two"),
        (None, "text without an id, text without an id"), (9, LONG), (10, LONG + " end"), (11, "ÄÖ é 中文 \x1c ʼn")]


@pytest.fixture(scope="session")
def edge(spark):
    """Edge rows with extra columns named like the operators' own helpers."""
    bound_batches(spark)
    rows = [(i, t, i, "x", 1, "y", i, t) for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, sid long, fp string, n int, label string, "
                                       "part long, token string")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def documents(spark):
    bound_batches(spark)
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").cache()


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def texts_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=repr)
