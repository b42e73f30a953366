from __future__ import annotations

import pytest

from parcelake.llm import tables

SF = "/root/testdata/sf0.001"
WIDE = "doc_id long, text string, lang string, source string, n_chars long, score double, label string, a long, node long"


@pytest.fixture(scope="session")
def docs(spark):
    return tables.read(spark, SF, "documents")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls everywhere, empty and very long texts, ties, repeated rows and extra
    columns named like columns the operators make."""
    rows = [(1, None, None), (2, "", "en"), (None, "the lost and found of the of", "en"), (4, "!!! ...", None),
            (5, "word " * 40_000, "en"), (6, "same text here for all of us", "en"),
            (6, "same text here for all of us", "en"), (7, "same text here for all of us", "de"),
            (8, "été 中文 \U0001f642\n\n  x", None), (None, None, None)]
    return spark.createDataFrame([(d, t, lang, "s", 0, 0.5, "l", 1, 2) for d, t, lang in rows], WIDE)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def by_id():
    def collect(df, key="doc_id"):
        return {r[key]: r for r in df.collect()}

    return collect
