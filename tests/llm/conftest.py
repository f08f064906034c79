from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, ties, and extra columns with clashing names."""
    long_text = " ".join(f"word{i % 997} and{i}" for i in range(20_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta", "x", "k"),
        (1, "alpha beta gamma delta epsilon zeta eta theta", "x", "k"),
        (2, None, "y", None),
        (3, "", "y", "k"),
        (4, " \n\t ", None, "k"),
        (5, long_text, "z", "k"),
        (None, "alpha beta gamma delta epsilon zeta eta theta", None, None),
        (6, "ALPHA beta\tgamma delta epsilon zeta eta theta", "x", "k"),
        (7, "one", "x", "k"),
    ]
    schema = "doc_id long, text string, label string, `n` string"
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, n_chars long")
