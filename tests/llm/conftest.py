import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents with extra columns that clash with the operators' own names."""
    import brute

    frame = spark.createDataFrame(brute.odd_documents(), brute.DOC_SCHEMA)
    extra = "_key _text _id _row node bands score kept n_words keep_id class_id length rank offset a b _gone _found spans"
    return frame.selectExpr("*", *(f"'x' AS {name}" for name in extra.split()))


@pytest.fixture(scope="session")
def empty(spark):
    import brute

    return spark.createDataFrame([], brute.DOC_SCHEMA)
