import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpora  # noqa: E402


@pytest.fixture
def odd(spark):
    return corpora.documents(spark, corpora.odd_rows())


@pytest.fixture
def empty(spark):
    return corpora.documents(spark, [])
